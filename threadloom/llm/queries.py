"""Queries of this subpackage and, where it can express them on whole tables, their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import bpe, chunks, components, defects, leakage, overlap, repetition, truncation
from threadloom.sources.tables import table


#: Ways of stopping that say nothing against a text (fixed values).
STOPPED_WELL = ("end_turn", "stop", "eos")


def _summaries(spark: SparkSession, base: str, tabs: tuple[str, ...] = ("chosen", "eval")) -> DataFrame:
    """tab, row_id, summary, source, trusted: it stopped well, didn't fail, and scored without a flag."""
    source, reason = {"chosen": "teacher", "eval": "model"}, {"chosen": "stop_reason", "eval": "finish_reason"}
    flags = ("over_limit", "empty", "bullets", "meta", "think_leak", "narration", "echo", "fabrication")
    flagless = ~reduce(lambda a, b: a | b, [F.coalesce(F.col("score")[x], F.lit(True)) for x in flags])
    parts = []
    for t in tabs:
        good = F.col(reason[t]).isin(*STOPPED_WELL) & (F.coalesce(F.col("`__failed__`"), F.lit("")) == "") & flagless
        parts.append(table(spark, base, t).select(F.lit(t).alias("tab"), "row_id", "summary", F.col(source[t]).alias("source"), good.alias("trusted")))
    return components.union_all(parts)


def p2_found(spark: SparkSession, base: str) -> DataFrame:
    return defects.defective_pairs(*(table(spark, base, t) for t in ("chosen", "dpo", "chains")))


def p2_report(spark: SparkSession, base: str) -> DataFrame:
    return defects.defect_report(p2_found(spark, base))


def p2_evidence(spark: SparkSession, base: str) -> DataFrame:
    """How many refusals templates, phrases of such, and the lexicon told."""
    looked = defects.looked_pairs(*(table(spark, base, t) for t in ("chosen", "dpo", "chains")))
    return defects.refusals(looked).groupBy("evidence").agg(F.count("*").alias("pairs"))


def p3_found(spark: SparkSession, base: str) -> DataFrame:
    pairs = overlap.cross_split_overlaps(table(spark, base, "sft"))
    return pairs.select(F.least("train_id", "other_id").alias("row_a"), F.greatest("train_id", "other_id").alias("row_b")).distinct()


def p3_report(spark: SparkSession, base: str) -> DataFrame:
    """Records outside train and how many of them also stand in train, by split and source."""
    return overlap.overlap_report(*overlap.overlap_classes(table(spark, base, "sft")))


def p4_found(spark: SparkSession, base: str) -> DataFrame:
    return truncation.cut_texts(_summaries(spark, base), ["tab", "row_id"], "summary", "source").select("tab", "row_id")


def p4_rates(spark: SparkSession, base: str) -> DataFrame:
    """How many distinct rows of each teacher and model are cut."""
    return truncation.cut_rates(_summaries(spark, base), ["tab", "row_id"], "summary", "source", ["tab", "source"])


def p4_limits(spark: SparkSession, base: str) -> DataFrame:
    """Lengths and bands of lengths at which a source's texts end incompletely significantly often."""
    return truncation.length_report(_summaries(spark, base), ["tab", "row_id"], "summary", "source")


def p5_found(spark: SparkSession, base: str) -> DataFrame:
    return repetition.repeated_documents(_summaries(spark, base), ["tab", "row_id"], "summary", "trusted").select("tab", "row_id")


def p5_shares(spark: SparkSession, base: str) -> DataFrame:
    """The share of repeated words of every summary."""
    return repetition.repetition_shares(_summaries(spark, base), ["tab", "row_id"], "summary")


def p5_ratio(spark: SparkSession, base: str) -> DataFrame:
    """How many summaries the ratio lets through, and how many of those repeat themselves enough."""
    scored = repetition.repetition_scores(_summaries(spark, base), ["tab", "row_id"], "summary", "trusted")
    kept = repetition.candidates(scored, 0.3).withColumn("repeated", repetition.covered(5))
    found = F.count_if((F.col("words") >= 10) & (F.col("repeated") >= F.lit(0.3) * F.col("words")))
    return kept.groupBy("tab").agg(F.count("*").alias("candidates"), found.alias("found"))


def p6_found(spark: SparkSession, base: str) -> DataFrame:
    groups = components.chain_components(table(spark, base, "chains"))
    return groups.where("root < member").select(F.col("root").alias("chain_a"), F.col("member").alias("chain_b"))


def p6_splits(spark: SparkSession, base: str) -> DataFrame:
    """The split of every chain."""
    return components.split_chains(table(spark, base, "chains"))


def p6_sft_splits(spark: SparkSession, base: str) -> DataFrame:
    """The split of every sft record, by its chain; a record of no known chain has none."""
    splits = components.split_chains(table(spark, base, "chains")).select("chain", F.col("split").alias("new_split"))
    return table(spark, base, "sft").select("row_id", "chain").distinct().join(splits, "chain", "left").select("row_id", "new_split")


def p6_split_report(spark: SparkSession, base: str) -> DataFrame:
    return components.split_chains(table(spark, base, "chains")).groupBy("category", "split").agg(F.count("*").alias("chains"))


def p7_ids(spark: SparkSession, base: str) -> DataFrame:
    ranks = bpe.rank_file(spark)
    return table(spark, base, "documents").select("doc_id", bpe.token_ids(F.col("text"), ranks).alias("ids"))


def p8_found(spark: SparkSession, base: str) -> DataFrame:
    found = leakage.leaked_passages(table(spark, base, "documents"), table(spark, base, "eval_items"))
    return found.where("kind = 'passage'").select("doc_id", "item_id")


def p8_report(spark: SparkSession, base: str) -> DataFrame:
    """Leaked items of each split."""
    items = table(spark, base, "eval_items")
    return leakage.leak_report(leakage.leaked_passages(table(spark, base, "documents"), items), items)


def p8_paraphrases(spark: SparkSession, base: str) -> DataFrame:
    """Documents that hold most of an item's words in order but no long run of them."""
    found = leakage.leaked_passages(table(spark, base, "documents"), table(spark, base, "eval_items"))
    return found.where("kind = 'paraphrase'").select("doc_id", "item_id", "lcs", "item_words")


def p9_found(spark: SparkSession, base: str) -> DataFrame:
    """The documents that are split, one row for each row of the table."""
    return p9_pieces(spark, base).where("piece = 0").select("doc_id")


def p9_pieces(spark: SparkSession, base: str) -> DataFrame:
    return chunks.split_oversized(table(spark, base, "documents"), "doc_id", "text", bpe.rank_file(spark))


QUERIES = {
    "p2_found": p2_found,
    "p2_report": p2_report,
    "p2_evidence": p2_evidence,
    "p3_found": p3_found,
    "p3_report": p3_report,
    "p4_found": p4_found,
    "p4_rates": p4_rates,
    "p4_limits": p4_limits,
    "p5_found": p5_found,
    "p5_shares": p5_shares,
    "p5_ratio": p5_ratio,
    "p6_found": p6_found,
    "p6_splits": p6_splits,
    "p6_sft_splits": p6_sft_splits,
    "p6_split_report": p6_split_report,
    "p7_ids": p7_ids,
    "p8_found": p8_found,
    "p8_report": p8_report,
    "p8_paraphrases": p8_paraphrases,
    "p9_found": p9_found,
    "p9_pieces": p9_pieces,
}

SQL: dict[str, str] = {}


def _quoted(text: str) -> str:
    """A string of SQL; control characters by number."""
    return " || ".join([f"chr({ord(c)})" if ord(c) < 32 else "'" + c.replace("'", "''") + "'" for c in text])


def _cut_sql() -> str:
    """Common table expressions up to ``cut`` (tab, row_id): texts with an incomplete ending, whatever their length."""
    space, closing = _quoted(truncation._SPACE), _quoted(truncation._CLOSING)
    marks = ", ".join(f"'{m}'" for m in truncation._MARKS)
    drop = '"“”„«»()[]{},;:*'
    plain = lambda x: f"lower(translate({x}, '123456789!?。！？' || chr(10) || '{drop}', '000000000.....' || chr(1)))"
    tail = lambda x, n: f"array_to_string(string_split(trim({x}, ' .'), ' ')[-{n}:], ' ')"
    bullet = r"^\s*([-*•–—‣▪◦·]|\d+[.)])\s+"
    return f"""u AS (SELECT DISTINCT 'chosen' AS tab, row_id, summary, teacher AS source FROM chosen UNION ALL SELECT DISTINCT 'eval', row_id, summary, model FROM eval),
 t AS (SELECT tab, row_id, trim(summary, {space}) AS t, regexp_matches(summary, '[\\p{{L}}\\p{{N}}]') AND NOT regexp_matches(summary, '{truncation._PLACEHOLDER}') AS filled FROM u WHERE summary IS NOT NULL),
 e AS (SELECT *, rtrim(t, {space} || {closing}) AS core, trim(string_split(t, chr(10))[-1], {space}) AS line FROM t WHERE filled),
 k AS (SELECT *, CASE WHEN ends_with(core, '…') OR ends_with(core, '..') OR ends_with(core, '. .') OR ends_with(t, chr(65533)) THEN 'cut' WHEN right(core, 1) IN ({marks}) THEN 'whole' WHEN regexp_matches(line, '{bullet}\\S') THEN 'item' ELSE 'cut' END AS ending FROM e),
 s AS (SELECT unnest(regexp_split_to_array({plain('t')}, '\x01+|[.] +')[:-2]) AS s FROM t), w AS (SELECT DISTINCT {tail('s', 2)} AS w FROM s WHERE length(s) > 2),
 cut AS (SELECT tab, row_id FROM k WHERE ending = 'cut' OR (ending = 'item' AND {tail(plain(f"regexp_replace(line, '{bullet}', '')"), 2)} NOT IN (SELECT w FROM w)))"""


SQL["p4_found"] = f"WITH {_cut_sql()} SELECT tab, row_id FROM cut"

SQL["p4_rates"] = f"WITH {_cut_sql()}, r AS (SELECT DISTINCT tab, source, row_id FROM u) SELECT r.tab, r.source, count(*) AS rows, count(c.row_id) AS cut FROM r LEFT JOIN cut c ON c.tab = r.tab AND c.row_id = r.row_id GROUP BY ALL"

SQL["p5_found"] = """WITH t AS (SELECT DISTINCT 'chosen' AS tab, row_id, summary FROM chosen UNION ALL SELECT DISTINCT 'eval', row_id, summary FROM eval),
 w AS (SELECT tab, row_id, regexp_extract_all(lower(summary), '[\\p{L}\\p{N}_]+') AS ws FROM t WHERE summary IS NOT NULL),
 g AS (SELECT tab, row_id, len(ws) AS n, p, list_slice(ws, p, p + 4) AS gram FROM w, LATERAL (SELECT unnest(range(1, len(ws) - 3)) AS p)),
 r AS (SELECT *, row_number() OVER (PARTITION BY tab, row_id, gram ORDER BY p) AS seen FROM g),
 c AS (SELECT tab, row_id, n, p, lead(p) OVER (PARTITION BY tab, row_id ORDER BY p) AS following FROM r WHERE seen > 1)
 SELECT tab, row_id FROM c GROUP BY tab, row_id, n HAVING n >= 10 AND sum(CASE WHEN following IS NULL THEN 5 ELSE least(5, following - p) END) >= 0.3::DOUBLE * n"""

SQL["p5_shares"] = """WITH t AS (SELECT DISTINCT 'chosen' AS tab, row_id, summary FROM chosen UNION ALL SELECT DISTINCT 'eval', row_id, summary FROM eval),
 w AS (SELECT tab, row_id, coalesce(regexp_extract_all(lower(summary), '[\\p{L}\\p{N}_]+'), []) AS ws FROM t),
 g AS (SELECT tab, row_id, p, list_slice(ws, p, p + 4) AS gram FROM w, LATERAL (SELECT unnest(range(1, len(ws) - 3)) AS p)),
 r AS (SELECT *, row_number() OVER (PARTITION BY tab, row_id, gram ORDER BY p) AS seen FROM g),
 c AS (SELECT tab, row_id, p, lead(p) OVER (PARTITION BY tab, row_id ORDER BY p) AS following FROM r WHERE seen > 1),
 k AS (SELECT tab, row_id, sum(CASE WHEN following IS NULL THEN 5 ELSE least(5, following - p) END) AS repeated FROM c GROUP BY tab, row_id)
 SELECT w.tab, w.row_id, CAST(len(w.ws) AS INTEGER) AS words, CAST(coalesce(k.repeated, 0) AS INTEGER) AS repeated FROM w LEFT JOIN k ON w.tab = k.tab AND w.row_id = k.row_id"""

SQL["p6_found"] = """WITH RECURSIVE n AS (SELECT DISTINCT id, trim(regexp_replace(nfc_normalize(lower(p.name)), '[\\s\\p{Z}]+', ' ', 'g')) AS name FROM chains, LATERAL (SELECT unnest(peers) AS p)
  WHERE id IS NOT NULL AND p.name IS NOT NULL AND trim(regexp_replace(lower(coalesce(p.role, '')), '[\\s\\p{Z}]+', ' ', 'g')) <> 'assistant'),
 k AS (SELECT * FROM n WHERE name NOT IN ('', 'user', 'guest', 'unknown', 'n/a')), e AS (SELECT DISTINCT a.id AS a, b.id AS b FROM k a JOIN k b USING (name)),
 r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a), m AS (SELECT b, min(a) AS a FROM r GROUP BY b)
 SELECT a AS chain_a, b AS chain_b FROM m WHERE a < b"""

SQL["p8_found"] = """WITH d AS (SELECT doc_id, regexp_extract_all(strip_accents(lower(text)), '[\\p{L}\\p{N}]+') AS ws FROM documents WHERE text IS NOT NULL),
 i AS (SELECT item_id, regexp_extract_all(strip_accents(lower(item_text)), '[\\p{L}\\p{N}]+') AS ws FROM eval_items),
 dg AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, p, p + 11), ' ') AS g FROM d, LATERAL (SELECT unnest(range(1, len(ws) - 10)) AS p)),
 ig AS (SELECT DISTINCT item_id, array_to_string(list_slice(ws, p, p + 11), ' ') AS g FROM i, LATERAL (SELECT unnest(range(1, len(ws) - 10)) AS p))
 SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)"""

SQL["p8_report"] = f"""WITH f AS ({SQL["p8_found"]}), h AS (SELECT item_id, count(DISTINCT doc_id) AS n FROM f GROUP BY item_id)
 SELECT item_split, count(*) AS items, count(n) AS leaked, CAST(coalesce(sum(n), 0) AS BIGINT) AS documents FROM (SELECT DISTINCT item_id, item_split FROM eval_items) LEFT JOIN h USING (item_id) GROUP BY item_split"""
