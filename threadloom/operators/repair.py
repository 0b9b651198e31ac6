"""Generated JSON, repaired and validated into ledgers."""

from __future__ import annotations

from collections.abc import Iterator

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import anchors, has_fact_sql, normalise, tokens
from threadloom.operators.shred import decode_payload


def repaired_json(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, object): the first complete object of each text as JSON, null if there is none; numbers stay numbers.

    Texts that are JSON objects already pass through in the JVM; only the others are sent to Python.
    """
    kind = dict(df.dtypes)[key]
    t = df.select(key, F.make_valid_utf8(F.col(text)).alias("t"))
    parsed = t.withColumn("ok", F.trim("t").startswith("{") & F.try_parse_json("t").isNotNull())
    plain = parsed.where("ok").select(key, F.trim("t").alias("object"))

    def repair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decoder = json.JSONDecoder()
        for batch in batches:
            found = [decode_payload(x, decoder=decoder) for x in batch["t"]]
            yield pd.DataFrame({key: batch[key], "object": [json.dumps(o, ensure_ascii=False) if isinstance(o, dict) else None for o in found]})

    rest = parsed.where("ok IS NULL OR NOT ok").select(key, "t").mapInPandas(repair, f"`{key}` {kind}, object string")
    return plain.unionByName(rest)


def parsed_replies(df: DataFrame, key: str, text: str, needed: str = "messages") -> DataFrame:
    """(key, object, reason): a whole reply as one object. What was only repaired counts if it has the needed field, as the
    first complete object of a reply that broke off is some inner one."""
    whole = F.try_parse_json(F.regexp_replace(F.trim(F.coalesce(F.col(text), F.lit(""))), r"^```(?:json)?\s*|\s*```$", ""))
    bare = df.select(key, F.col(text).alias("_t"), F.schema_of_variant(whole).startswith("OBJECT").alias("_whole"))
    found = bare.join(repaired_json(df, key, text), key, "left")
    good = F.coalesce("_whole", F.lit(False)) | F.array_contains(F.json_object_keys("object"), needed)
    kept = F.coalesce(good & F.col("object").isNotNull(), F.lit(False))
    why = F.concat(F.lit("not one JSON object of "), F.length(F.trim(F.coalesce("_t", F.lit("")))).cast("string"), F.lit(" characters, broken off?"))
    return found.select(key, F.when(kept, F.col("object")).alias("object"), F.when(~kept, why).alias("reason"))


def _blank(x: str) -> str:
    return f"coalesce({x}, '') rlike '^[\\\\s\\\\p{{Z}}]*$'"


def repair_chains(chains: DataFrame, block: int = 20, least_messages: int = 60, per_block: int = 2, lenient: dict[str, int] | None = None) -> DataFrame:
    """(id, category, peers, messages, facts, changes, distractors, reason) of generated chains made fit for scoring.

    Blank messages go and the rest are cut to whole blocks and numbered from 1; peers are those who speak, undeclared
    speakers added with role ``peer``; facts are those that stand verbatim in a message whatever their case, each text
    once, with the first message that has it, and numbered anew if ids clash; changes name two such facts, the new one
    later, and take place where it does; distractors that messages or facts state go. reason is the first of
    too_few_messages, too_few_speakers, too_few_facts, no_change and no_distractor that holds, else ``ok``. All of it is
    expressions within one record.
    """
    lenient = lenient or {"chit-chat": 1}
    base = chains.select(
        "id",
        "category",
        F.expr(f"transform(filter(coalesce(peers, array()), p -> NOT {_blank('p.name')}), p -> struct(trim(p.name) AS name, coalesce(nullif(p.role, ''), 'peer') AS role, coalesce(p.bio, '') AS bio))").alias("declared"),
        F.expr(f"transform(filter(coalesce(messages, array()), m -> NOT {_blank('m.peer')} AND NOT {_blank('m.text')}), m -> struct(trim(m.peer) AS peer, trim(m.text) AS text))").alias("said"),
        "facts",
        "changes",
        "distractors",
    )
    numbered = base.withColumn("messages", F.expr(f"transform(slice(said, 1, size(said) div {block} * {block}), (m, i) -> struct(i + 1 AS seq, m.peer AS peer, m.text AS text))"))
    spoken = numbered.withColumn("speakers", F.expr("array_distinct(transform(messages, m -> m.peer))"))
    peered = spoken.withColumn(
        "peers",
        F.expr("concat(filter(declared, p -> array_contains(speakers, p.name)), transform(array_except(speakers, transform(declared, p -> p.name)), s -> struct(s AS name, 'peer' AS role, '' AS bio)))"),
    )
    texts = (
        f"filter(transform(coalesce(facts, array()), f -> struct(f.id AS id, trim(regexp_replace(f.text, '\\\\s+', ' ')) AS text, f.kind AS kind)), f -> NOT {_blank('f.text')})"
    )
    seen = peered.withColumn("texts", F.expr(texts)).withColumn(
        "texts", F.expr("filter(texts, (f, i) -> array_position(transform(texts, g -> lower(g.text)), lower(f.text)) = i + 1)")
    )
    seq = "array_min(transform(filter(messages, m -> contains(lower(m.text), lower(f.text))), m -> m.seq))"
    dated = seen.withColumn("dated", F.expr(f"filter(transform(texts, f -> struct(f.id AS id, f.text AS text, {seq} AS first_seq, coalesce(f.kind, 'other') AS kind)), f -> f.first_seq IS NOT NULL)"))
    named = dated.withColumn("named", F.expr("transform(dated, (f, i) -> struct(coalesce(f.id, concat('f', i + 1)) AS id, f.text AS text, f.first_seq AS first_seq, f.kind AS kind))"))
    clash = "size(array_distinct(transform(named, f -> f.id))) < size(named)"
    factual = named.withColumn("facts", F.expr(f"transform(named, (f, i) -> struct(CASE WHEN {clash} THEN concat('f', i + 1) ELSE f.id END AS id, f.text AS text, f.first_seq AS first_seq, f.kind AS kind))"))
    at = lambda x: f"get(filter(facts, f -> f.id = c.{x}), 0)"
    changed = factual.withColumn(
        "changes",
        F.expr(
            f"transform(filter(transform(coalesce(changes, array()), c -> struct({at('fact_id')} AS o, {at('superseded_by')} AS n)), x -> x.n.first_seq > x.o.first_seq),"
            " x -> struct(x.o.id AS fact_id, x.n.id AS superseded_by, x.n.first_seq AS seq))"
        ),
    )
    body = normalise(F.expr("array_join(transform(messages, m -> m.text), '\\n')"))
    ready = changed.select(
        "id", "category", "peers", "messages", "facts", "changes", body.alias("bt"),
        F.transform("facts", lambda f: F.struct(F.trim(normalise(f["text"])).alias("f"), anchors(tokens(normalise(f["text"]))).alias("a"))).alias("fp"),
        F.transform(
            F.expr(f"filter(transform(coalesce(distractors, array()), d -> trim(d.text)), d -> NOT {_blank('d')})"),
            lambda d: F.struct(d.alias("text"), normalise(d).alias("t"), tokens(normalise(d)).alias("k"), F.trim(normalise(d)).alias("f"), anchors(tokens(normalise(d))).alias("a")),
        ).alias("dp"),
    ).withColumn("bk", tokens(F.col("bt")))
    stated = has_fact_sql("bt", "bk", "d.f", "d.a")
    states = has_fact_sql("d.t", "d.k", "q.f", "q.a")
    kept = ready.withColumn("distractors", F.expr(f"transform(filter(dp, d -> NOT ({stated}) AND NOT exists(fp, q -> {states})), d -> struct(d.text AS text))"))
    blocks = F.floor(F.size("messages") / block)
    least = F.lit(per_block)
    for category, n in lenient.items():
        least = F.when(F.col("category") == category, n).otherwise(least)
    reason = (
        F.when(F.size("messages") < least_messages, "too_few_messages")
        .when(F.size("peers") < 2, "too_few_speakers")
        .when(F.size("facts") < least * blocks, "too_few_facts")
        .when((F.col("category") == "supersession") & (F.size("changes") == 0), "no_change")
        .when(F.size("distractors") == 0, "no_distractor")
        .otherwise("ok")
    )
    return kept.select("id", "category", "peers", "messages", "facts", "changes", "distractors", reason.alias("reason"))


def chain_outcome(error: str, text: str, reason: str, stop: str) -> Column:
    """Why a generated chain failed, null if it didn't: the producer's error, an empty reply, or what is wrong with it, with
    a word on the cap if the reply hit it."""
    capped = F.when(F.coalesce(stop, F.lit("")).isin("max_tokens", "length"), F.concat(F.lit("; hit its cap: "), F.col(stop))).otherwise("")
    return (
        F.when(F.coalesce(error, F.lit("")) != "", F.col(error))
        .when(F.coalesce(text, F.lit("")) == "", "empty response")
        .when(F.coalesce(reason, F.lit("ok")) != "ok", F.concat(F.lit("invalid chain: "), F.col(reason), capped))
    )


def first_mentions(chains: DataFrame) -> DataFrame:
    """(chain, pos, seq): the first message that holds each fact verbatim, whatever its case; null if none does."""
    facts = chains.select(F.col("id").alias("chain"), "messages", F.posexplode("facts").alias("pos", "f")).where("coalesce(f.text, '') <> ''")
    seq = "array_min(transform(filter(coalesce(messages, array()), m -> contains(lower(m.text), lower(f.text))), m -> m.seq))"
    return facts.select("chain", "pos", F.expr(seq).alias("seq"))
