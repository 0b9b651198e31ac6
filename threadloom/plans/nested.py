"""Queries over nested ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from threadloom.operators.ledger_tables import child_positions, child_table
from threadloom.sources.tables import table


def _both(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, base, "chains"), table(spark, base, "chain_raw")


def _child(child: str, fields: list[str]):
    return lambda spark, base: child_table(*_both(spark, base), child, fields)


FIELDS = {
    "facts": ["id", "text", "first_seq", "kind"],
    "changes": ["fact_id", "superseded_by", "seq"],
    "peers": ["name", "role", "bio"],
    "distractors": ["text"],
}
QUERIES = {"p1_found": lambda spark, base: child_positions(*_both(spark, base))} | {f"p1_{c}": _child(c, f) for c, f in FIELDS.items()}

CHILDREN = ("peers", "facts", "changes", "distractors")

#: The object of each payload (fences and string wrappings off, the chain of a delivered message), then each child
#: array, a lone value as an array of one. The fixtures of the tests hold the shapes that this SQL doesn't know.
_OBJECTS = r"""raw AS (SELECT chain, trim(regexp_replace(regexp_replace(trim(payload), '^```[a-z]*', ''), '```$', '')) AS p FROM chain_raw WHERE payload IS NOT NULL),
 one AS (SELECT chain, p::JSON AS j FROM raw WHERE json_valid(p)),
 two AS (SELECT chain, CASE WHEN json_type(j) = 'VARCHAR' THEN CASE WHEN json_valid(j ->> '$') THEN (j ->> '$')::JSON END ELSE j END AS j FROM one),
 obj AS (SELECT chain, CASE WHEN json_exists(j, '$.result') THEN list_filter(json_extract(j, '$.result.message.content[*].chain'), lambda x: x IS NOT NULL)[1] ELSE j END AS j FROM two WHERE json_type(j) = 'OBJECT')"""


def _elements_sql() -> str:
    arrays = " UNION ALL ".join(
        f"SELECT chain, '{c}' AS child, CASE WHEN json_type(v) = 'ARRAY' THEN json_extract(v, '$[*]') ELSE [v] END AS xs, md5(j::VARCHAR) AS doc"
        f" FROM (SELECT chain, j, coalesce(json_extract(j, '$.{c}'), json_extract(j, '$.ledger.{c}')) AS v FROM obj) WHERE v IS NOT NULL AND json_type(v) <> 'NULL'"
        for c in CHILDREN
    )
    typed = " UNION ALL ".join(
        f"SELECT id, '{c}', json_extract(to_json({c}), '$[*]'), md5(to_json({{'p': peers, 'f': facts, 'c': changes, 'd': distractors}})::VARCHAR) FROM chains WHERE {c} IS NOT NULL AND id IS NOT NULL"
        for c in CHILDREN
    )
    return f"""WITH {_OBJECTS}, a AS ({arrays} UNION ALL {typed}),
 e AS (SELECT DISTINCT chain, child, doc, CAST(p - 1 AS INTEGER) AS pos, xs[p] AS x FROM a, LATERAL (SELECT unnest(range(1, len(xs) + 1)) AS p) WHERE xs[p] IS NOT NULL AND json_type(xs[p]) <> 'NULL')"""


def _found_sql() -> str:
    return f"""{_elements_sql()},
 f AS (SELECT chain, doc, json_extract_string(x, '$.id') AS id, min(pos) AS pos FROM e WHERE child = 'facts' AND json_extract_string(x, '$.id') IS NOT NULL GROUP BY ALL)
 SELECT DISTINCT e.chain, e.child, e.pos, CASE WHEN e.child = 'changes' THEN coalesce(o.pos, -1) ELSE -1 END AS old_pos, CASE WHEN e.child = 'changes' THEN coalesce(n.pos, -1) ELSE -1 END AS new_pos
 FROM e LEFT JOIN f o ON o.chain = e.chain AND o.doc = e.doc AND o.id = json_extract_string(e.x, '$.fact_id') LEFT JOIN f n ON n.chain = e.chain AND n.doc = e.doc AND n.id = json_extract_string(e.x, '$.superseded_by')"""


def _child_sql(child: str, fields: list[str]) -> str:
    lone = next((f for f in ("text", "name") if f in fields), None)
    picked = ", ".join(
        f"CASE WHEN json_type(x) = 'OBJECT' THEN json_extract_string(x, '$.{f}')" + (" ELSE x ->> '$'" if f == lone else "") + f" END AS {f}"
        for f in fields
    )
    return f"{_elements_sql()} SELECT DISTINCT chain, pos, {picked} FROM e WHERE child = '{child}'"


SQL: dict[str, str] = {"p1_found": _found_sql()} | {f"p1_{c}": _child_sql(c, f) for c, f in FIELDS.items()}
