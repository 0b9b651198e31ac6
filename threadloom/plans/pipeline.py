"""Queries over routes, reports, checklists and hold-outs, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.operators import generation, routing, scoring, steps
from threadloom.plans.reference import BLANK_SQL, DUE, GOOD, STEPS, scores_sql
from threadloom.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


_FAILED = "coalesce(\"__failed__\", '') <> ''"
_OVER = f"(NOT ({BLANK_SQL}) AND coalesce(output_words, 0) > 0 AND coalesce(words, 0) > 0.8::DOUBLE * coalesce(output_words, 0))"
_CUT = "coalesce(stop_reason, '') IN ('max_tokens', 'length')"


@query(
    f"SELECT DISTINCT row_id, CASE WHEN {_FAILED} THEN 'failed' WHEN {BLANK_SQL} THEN 'empty' WHEN {_CUT} THEN 'truncated' WHEN {_OVER} THEN 'over_budget' ELSE 'good' END AS outcome,"
    f" CASE WHEN NOT {_FAILED} AND NOT {_OVER} THEN 'none' WHEN {_FAILED} AND coalesce(attempts, 0) >= 3 THEN 'give_up' WHEN {_OVER} AND NOT {_CUT} THEN CASE WHEN coalesce(attempts, 0) >= 2 THEN 'compress_last' ELSE 'compress' END ELSE 'fresh' END AS job FROM chosen"
)
def row_routes(spark, base):
    return table(spark, base, "chosen").select("row_id", routing.outcome().alias("outcome"), routing.next_job().alias("job")).distinct()


@query(
    f"""WITH f AS ({scores_sql('chosen')}), o AS (SELECT DISTINCT row_id, CASE WHEN {_FAILED} THEN 'failed' WHEN {BLANK_SQL} THEN 'empty' WHEN {_CUT} THEN 'truncated' WHEN {_OVER} THEN 'over_budget' ELSE 'good' END AS outcome FROM chosen)
 SELECT o.row_id, o.outcome, f.fact_coverage_new, f.fact_coverage_carry, f.fabrication FROM o LEFT JOIN f ON f.row_id = o.row_id AND o.outcome IN ('good', 'over_budget')"""
)
def scored_outcomes(spark, base):
    """What became of each row, with fresh scores where there is something to score."""
    rows = table(spark, base, "chosen")
    scores = scoring.score_rows(rows, steps.good_chains(table(spark, base, "chains"))).select("row_id", "fact_coverage_new", "fact_coverage_carry", "fabrication")
    return routing.scored_outcomes(rows, scores)


@query(
    f"""SELECT teacher, count(*) AS rows, count(*) FILTER ({_FAILED}) AS failed, count(*) FILTER ({_OVER}) AS over_budget, count(*) FILTER ({_FAILED} AND coalesce(attempts, 0) >= 3) AS gave_up
 FROM (SELECT DISTINCT row_id, teacher, summary, words, output_words, attempts, "__failed__" FROM chosen) GROUP BY teacher"""
)
def producer_report(spark, base):
    rows = table(spark, base, "chosen").select("row_id", "teacher", "summary", "words", "output_words", "attempts", "__failed__").distinct()
    return rows.groupBy("teacher").agg(
        F.count("*").alias("rows"),
        F.count_if(routing.failed()).alias("failed"),
        F.count_if(routing.over_budget()).alias("over_budget"),
        F.count_if(routing.gave_up()).alias("gave_up"),
    )


@query("SELECT substring(\"__failed__\", 1, 60) AS reason, count(*) AS rows FROM (SELECT DISTINCT row_id, \"__failed__\" FROM eval) WHERE coalesce(\"__failed__\", '') <> '' GROUP BY ALL")
def failure_report(spark, base):
    rows = table(spark, base, "eval").select("row_id", "__failed__").distinct().where(routing.failed())
    return rows.groupBy(F.substring("__failed__", 1, 60).alias("reason")).agg(F.count("*").alias("rows"))


@query(
    f"""WITH {DUE} SELECT s.chain, s.kind, s.k, coalesce(string_agg(d.due || ': ' || d.text, chr(10) ORDER BY d.due DESC, d.pos), '(none)') AS checklist
 FROM steps s LEFT JOIN due d ON d.chain = s.chain AND d.kind = s.kind AND d.k = s.k GROUP BY ALL"""
)
def checklist(spark, base):
    """The facts each step must state, as text."""
    good = steps.good_chains(table(spark, base, "chains"))
    line = F.struct((F.col("due") == "carry").alias("after"), "pos", F.concat_ws(": ", "due", "text").alias("line"))
    listed = scoring.facts_due(good).groupBy("chain", "kind", "k").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["line"]), "\n").alias("checklist")
    )  # a ledger's facts
    return steps.steps(good).join(listed, ["chain", "kind", "k"], "left").select("chain", "kind", "k", F.coalesce("checklist", F.lit("(none)")).alias("checklist"))


@query(
    """WITH e AS (SELECT DISTINCT row_id, model, chain, coalesce("__failed__", '') <> '' AS bad FROM eval WHERE chain IS NOT NULL),
 s AS (SELECT *, sum(CAST(bad AS INTEGER)) OVER (PARTITION BY model, chain ORDER BY row_id) AS island FROM e), r AS (SELECT model, chain, island, count(*) AS n FROM s WHERE NOT bad GROUP BY ALL)
 SELECT a.model, a.chain, coalesce(max(r.n), 0) AS streak FROM (SELECT DISTINCT model, chain FROM e) a LEFT JOIN r ON r.model IS NOT DISTINCT FROM a.model AND r.chain = a.chain GROUP BY ALL"""
)
def longest_streak(spark, base):
    """Most evaluations in a row without a failure, by model and chain."""
    rows = table(spark, base, "eval").where("chain IS NOT NULL").select("row_id", "model", "chain", "__failed__").distinct()
    return routing.longest_streak(rows, ["model", "chain"], "row_id", ~routing.failed())


@query(
    """WITH e AS (SELECT DISTINCT row_id, id, run_no, coalesce("__failed__", '') <> '' AS bad FROM eval WHERE id IS NOT NULL),
 s AS (SELECT row_id, id, coalesce(sum(CAST(bad AS INTEGER)) OVER (PARTITION BY id ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM e) SELECT id, row_id FROM s WHERE before = 0"""
)
def until_failure(spark, base):
    rows = table(spark, base, "eval").where("id IS NOT NULL").select("row_id", "id", "__failed__").distinct()
    return routing.until_failure(rows, ["id"], "row_id").select("id", "row_id")


@query("SELECT DISTINCT row_id, regexp_matches(coalesce(id, ''), '^[a-zA-Z0-9_-]{1,64}$') AS valid FROM chosen")
def valid_names(spark, base):
    return table(spark, base, "chosen").select("row_id", routing.valid_name(F.col("id")).alias("valid")).distinct()


_PICK = "CAST(('0x' || substring(md5('{0}' || CAST(id AS VARCHAR)), 1, 7))::BIGINT % {1} AS INTEGER)"
_PLAN = f"""c AS (SELECT category, count(*) AS n FROM good WHERE category IS NOT NULL GROUP BY category), w AS (SELECT category, CAST(ceil(n * 20 / (SELECT sum(n) FROM c)::DOUBLE) AS INTEGER) AS w FROM c),
 q AS (SELECT row_number() OVER (ORDER BY (i + 0.5::DOUBLE) / w, category) - 1 AS place, category FROM w, LATERAL (SELECT unnest(range(0, w)) AS i)),
 th AS (SELECT list(domain ORDER BY domain) AS ts FROM (SELECT DISTINCT domain FROM good WHERE domain IS NOT NULL)),
 plan AS (SELECT printf('c%08d', id) AS id, q.category, ts[{_PICK.format('theme', 'len(ts)')} + 1] AS theme, [60, 80, 100, 120][{_PICK.format('size', 4)} + 1] AS n_messages FROM (SELECT unnest(range(0, 1000)) AS id) r CROSS JOIN th JOIN q ON q.place = r.id % (SELECT sum(w) FROM w))"""


@query(f"WITH {GOOD}, {_PLAN} SELECT id, category, theme, n_messages FROM plan")
def generation_plan(spark, base):
    """A plan of 1,000 conversations over the chains' own categories and domains."""
    good = steps.good_chains(table(spark, base, "chains"))
    weights = {r.category: r.w for r in generation.weights_of(good, "category").collect()}  # at most a row a category
    domains = generation.weights_of(good, "domain").orderBy("category").select("category").collect()
    return generation.plan(spark, 1000, weights or {"any": 1}, [r.category for r in domains] or ["any"])


@query(f"WITH {GOOD}, {_PLAN} SELECT id, 2::BIGINT AS n_new, 0::BIGINT AS n_carry, 1.0::DOUBLE AS fact_coverage_new, NULL::DOUBLE AS latest_state, false AS fabrication FROM plan")
def mock_scores(spark, base):
    """Generated chains scored with their first block as the summary: all its facts are covered."""
    chains = generation.mock_chains(generation_plan(spark, base), peers=3)
    t = steps.transcripts(chains, "short").where("k = 0")
    rows = t.select(F.substring("chain", 2, 8).cast("long").alias("row_id"), "chain", F.lit("short").alias("kind"), "k", F.col("transcript").alias("summary"), F.lit(400).alias("output_words"))
    got = scoring.score_rows(rows, chains)
    return got.select(F.format_string("c%08d", "row_id").alias("id"), "n_new", "n_carry", "fact_coverage_new", "latest_state", "fabrication")
