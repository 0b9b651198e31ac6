import json

import pytest

from threadloom.operators.ledger_tables import child_positions, child_table
from threadloom.operators.shred import decode_payload, shred_columns, walk_json

CHAIN = (
    "id string, category string, shape string, domain string, peers array<struct<name:string,role:string,bio:string>>, "
    "messages array<struct<seq:int,peer:string,text:string>>, facts array<struct<id:string,text:string,first_seq:int,kind:string>>, "
    "changes array<struct<fact_id:string,superseded_by:string,seq:int>>, distractors array<struct<text:string>>, "
    "chunks array<struct<k:int,seqs:array<int>>>, chunks_long array<struct<k:int,seqs:array<int>>>, `__failed__` string, "
    "created_at timestamp, received_at timestamp"
)


def chain(spark, rows, extra=""):
    names = [c.strip().split(" ")[0].strip("`") for c in CHAIN.split(", ") if " " in c.strip() and ":" not in c.split(" ")[0]]
    full = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(full, CHAIN)


def raw(spark, rows):
    return spark.createDataFrame([(i, c, None, p) for i, (c, p) in enumerate(rows)], "record_id long, chain string, received_at timestamp, payload string")


BASE = {
    "id": "c1",
    "peers": [("A", "user", None), None, ("B", None, "x")],
    "facts": [("f1", "one", 1, "date"), None, ("f2", "two", 2, None), ("f1", "again", 3, None), (None, "no id", 4, None)],
    "changes": [("f1", "f2", 9), None, ("zz", "f1", 3), (None, None, None)],
    "distractors": [],
}


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(
    "text, found",
    [
        (None, None),
        ("", None),
        ("  \n", None),
        ("null", None),
        ("12", None),
        ('{"a": 1}', {"a": "1"}),
        ('```json\n{"a": [1.50, null]}\n```', {"a": ["1.50", None]}),
        (json.dumps(json.dumps({"a": "b"})), {"a": "b"}),
        ('Here it is: {"a": {"b": "c"}} done', {"a": {"b": "c"}}),
        ('{"a": [1, 2,],}', {"a": ["1", "2"]}),
        ('{"a": {"b": "c"}, "d', None),
        ('{"a": [{"b": "c"}, {"b"', None),
        ("__FAILED__: timeout", None),
        ("{broken} {\"a\": true}", {"a": True}),
    ],
)
def test_payload(text, found):
    assert decode_payload(text) == found


def test_payload_of_any_depth():
    deep = "[" * 300 + "]" * 300
    assert len(list(walk_json(json.loads('{"a": ' + deep + "}")))) == 301


def test_positions_of_typed_chains(spark):
    got = rows_of(child_positions(chain(spark, [BASE, BASE, {"id": "c2", "__failed__": "x"}, {"id": None, "facts": BASE["facts"]}]), raw(spark, [])))
    assert got == sorted(
        [("c1", "peers", 0, -1, -1), ("c1", "peers", 2, -1, -1)]
        + [("c1", "facts", p, -1, -1) for p in (0, 2, 3, 4)]
        + [("c1", "changes", 0, 0, 2), ("c1", "changes", 2, -1, 0), ("c1", "changes", 3, -1, -1)]
    )


def test_positions_of_json(spark):
    ledger = {"facts": {"id": 1, "text": "lone"}, "changes": [{"fact_id": "1", "superseded_by": 2}], "peers": "A", "distractors": [None, "x", {}]}
    wrapped = {"result": {"message": {"content": [{"type": "note"}, {"type": "chain", "chain": {"ledger": ledger}}]}}}
    want = [("peers", 0, -1, -1), ("facts", 0, -1, -1), ("changes", 0, 0, -1), ("distractors", 1, -1, -1), ("distractors", 2, -1, -1)]
    payloads = [("a", json.dumps(ledger)), ("b", json.dumps(wrapped)), ("c", "```json\n" + json.dumps({"ledger": ledger}) + "\n```"), ("d", json.dumps(json.dumps(ledger)))]
    got = rows_of(child_positions(chain(spark, []), raw(spark, payloads + payloads + [("e", None), ("f", '{"facts": [{"id": "f1"}'), (None, "{}")])))
    assert got == sorted((c, *w) for c in "abcd" for w in want)


def test_positions_of_nothing(spark):
    assert rows_of(child_positions(chain(spark, []), raw(spark, []))) == []


def test_child_table_and_extra_columns(spark):
    from pyspark.sql import functions as F

    df = chain(spark, [BASE]).withColumn("doc", F.lit(1)).withColumn("label", F.lit("x")).withColumn("node", F.lit("y"))
    got = rows_of(child_table(df, raw(spark, [("j", '{"facts": ["just text"]}')]), "facts", ["id", "text", "kind"]).fillna(""))
    assert ("c1", 0, "f1", "one", "date") in got and ("j", 0, "", "just text", "") in got and len(got) == 5


def test_shredded_nodes_tie_to_parents(spark):
    df = spark.createDataFrame([(7, [("k", [1, None])])], "d long, x array<struct<a:string,b:array<int>>>")
    nodes = {r.node: r for r in shred_columns(df, "d", ["x"]).collect()}
    assert nodes["/x/0/b/0"].scalar == "1" and nodes["/x/0/b/1"].kind == "null"
    assert all(n.parent == "/" or n.parent in nodes for n in nodes.values())
