"""Queries over wanted, ready and invalidated rows, prompts, run comparisons and training arrays, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.operators import (
    alignment,
    curation,
    evaluation,
    generation,
    maintenance,
    prompts,
    repair,
    scoring,
    selection,
    steps,
    training,
    workflow,
)
from threadloom.operators.steps import NO_PREVIOUS
from threadloom.plans.reference import BLANK_SQL, CHANGES, DUE, FACTS, GOOD, SHA, STEPS, _good
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


_BAD = "coalesce(\"__failed__\", '') <> ''"
_OVER = f"(NOT ({BLANK_SQL}) AND coalesce(output_words, 0) > 0 AND coalesce(words, 0) > 0.8::DOUBLE * coalesce(output_words, 0))"
#: The last row of each id, good ones first.
ROWS = f"""rows_ AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ({_BAD}), row_id DESC) AS rn FROM chosen WHERE id IS NOT NULL) WHERE rn = 1)"""
PRODUCED = f"""produced AS (SELECT DISTINCT chain, kind, k FROM eval WHERE NOT {_BAD} AND chain IS NOT NULL AND k IS NOT NULL)"""
WANTED = f"""wanted AS (SELECT chain, kind, k, 'clean' AS variant FROM steps UNION ALL SELECT s.chain, s.kind, s.k, 'base_prev' FROM steps s JOIN produced p ON p.chain = s.chain AND p.kind = s.kind AND p.k + 1 = s.k
 WHERE s.k >= 1 AND {SHA.format("s.chain || '-' || s.kind || '-' || CAST(s.k AS VARCHAR)")} < 300)"""
_NAME = "chain || '-' || CASE WHEN kind = 'short' THEN 's' ELSE 'l' END || CAST({0} AS VARCHAR)"
NAMED = f"named AS (SELECT *, {_NAME.format('k')} || CASE WHEN variant = 'base_prev' THEN 'b' ELSE '' END AS id, {_NAME.format('k - 1')} AS before FROM wanted)"


def _rows(spark, base):
    rows = table(spark, base, "chosen").where("id IS NOT NULL")
    none = spark.createDataFrame([], rows.schema)
    return maintenance.upsert(none, rows)


def _produced(spark, base):
    good = table(spark, base, "eval").where(~curation.failed() & F.col("chain").isNotNull() & F.col("k").isNotNull())
    return good.select("chain", "kind", "k").distinct()


def _wanted(spark, base):
    return workflow.wanted_rows(steps.steps(_good(spark, base)), _produced(spark, base))


_STORED = "SELECT id AS chain, '{0}' AS kind, c.k AS k, c.seqs[1] AS lo, c.seqs[2] AS hi FROM good, LATERAL (SELECT unnest({1}) AS c) WHERE c IS NOT NULL"


@query(f"WITH {GOOD} {_STORED.format('short', 'chunks')} UNION ALL {_STORED.format('long', 'chunks_long')}")
def stored_steps(spark, base):
    """Blocks as the chains' own lists have them."""
    return steps.stored_steps(_good(spark, base))


@query(f"WITH {GOOD}, {STEPS} SELECT chain, kind, k, lo, hi FROM steps")
def attached_steps(spark, base):
    """Blocks by lists attached anew."""
    return steps.stored_steps(steps.with_chunks(_good(spark, base)))


@query(f"WITH {GOOD}, {STEPS}, {PRODUCED}, {WANTED} SELECT * FROM wanted")
def wanted_rows(spark, base):
    return _wanted(spark, base)


@query(
    f"""WITH {ROWS}, l AS (SELECT chain, kind, k, max(summary) AS summary FROM rows_ WHERE variant = 'clean' AND NOT {_BAD} AND chain IS NOT NULL GROUP BY ALL)
 SELECT a.chain, a.kind, a.k, length(b.summary) AS previous_chars FROM l a LEFT JOIN l b ON b.chain = a.chain AND b.kind = a.kind AND b.k + 1 = a.k"""
)
def previous_outputs(spark, base):
    rows = _rows(spark, base).where((F.col("variant") == "clean") & ~curation.failed() & F.col("chain").isNotNull())
    own = rows.groupBy("chain", "kind", "k").agg(F.max("summary").alias("summary"))
    return workflow.previous_outputs(own, "summary").select("chain", "kind", "k", F.length("previous").alias("previous_chars"))


@query(
    f"""WITH {GOOD}, {STEPS}, {PRODUCED}, {WANTED}, {NAMED}, {ROWS}
 SELECT n.id, n.chain, n.kind, n.k, n.variant FROM named n WHERE NOT EXISTS (SELECT 1 FROM rows_ r WHERE r.id = n.id AND (NOT {_BAD} OR coalesce(attempts, 0) >= 3))
 AND (n.k = 0 OR (n.variant = 'clean' AND EXISTS (SELECT 1 FROM rows_ r WHERE r.id = n.before AND NOT {_BAD})) OR n.variant = 'base_prev')"""
)
def ready_rows(spark, base):
    return workflow.ready_rows(_wanted(spark, base), _rows(spark, base), _produced(spark, base))


@query(
    f"""WITH {GOOD}, {STEPS}, {PRODUCED}, {WANTED}, {NAMED}, {ROWS}, j AS (SELECT n.kind, r.id AS there, {_BAD} AS bad, {_BAD} AND coalesce(r.attempts, 0) >= 3 AS gone FROM named n LEFT JOIN rows_ r ON r.id = n.id)
 SELECT kind, count(*) FILTER (NOT coalesce(gone, false) AND (there IS NULL OR bad)) AS todo, count(*) FILTER (gone) AS given_up FROM j GROUP BY kind"""
)
def remaining_counts(spark, base):
    return workflow.remaining(_wanted(spark, base), _rows(spark, base))


STALE = f"""p AS (SELECT id, CASE WHEN previous_from NOT LIKE '%@base' THEN previous_from END AS p, CASE WHEN {_BAD} THEN 'failed' WHEN {_OVER} THEN 'over_budget' END AS reason FROM rows_),
 bad(id) AS (SELECT id FROM p WHERE reason IS NOT NULL OR (p IS NOT NULL AND p NOT IN (SELECT id FROM p)) UNION SELECT p.id FROM p JOIN bad ON p.p = bad.id),
 invalid AS (SELECT b.id, coalesce(p.reason, 'stale') AS reason FROM bad b JOIN p ON p.id = b.id)"""


def _pointed(rows):
    return rows.withColumn("previous_from", F.when(~F.col("previous_from").endswith("@base"), F.col("previous_from")))


@query(f"WITH RECURSIVE {ROWS}, {STALE} SELECT id, reason FROM invalid")
def invalidated_rows(spark, base):
    return workflow.invalidated(_pointed(_rows(spark, base)))


@query(
    f"""WITH RECURSIVE r0 AS (SELECT * FROM chosen WHERE id IS NOT NULL), {ROWS.replace('FROM chosen', 'FROM (SELECT * FROM r0 WHERE row_id % 3 <> 0) AS chosen')}, {STALE},
 every_ AS (SELECT r.id, r.row_id, r.id NOT IN (SELECT id FROM invalid) AS good, 0 AS v FROM rows_ r UNION ALL SELECT id, row_id, NOT {_BAD}, 1 FROM r0 WHERE row_id % 3 = 0)
 SELECT id, row_id FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY good DESC, v DESC, row_id DESC) AS rn FROM every_) WHERE rn = 1"""
)
def upsert_invalidated(spark, base):
    """The rows of one load merged into those of two others, of which invalidated ones count as failed."""
    rows = table(spark, base, "chosen").where("id IS NOT NULL")
    old = maintenance.upsert(spark.createDataFrame([], rows.schema), rows.where("row_id % 3 <> 0"))
    return workflow.upsert_invalidated(_pointed(old), rows.where("row_id % 3 = 0")).select("id", "row_id")


@query(f"SELECT DISTINCT id FROM eval WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM eval WHERE NOT {_BAD} AND run_no <= 100 AND id IS NOT NULL)")
def todo_ids(spark, base):
    rows = table(spark, base, "eval").where("id IS NOT NULL")
    return workflow.todo_ids(rows, rows.where("run_no <= 100"))


@query(f"SELECT DISTINCT row_id, coalesce(summary, '') <> '' AND NOT regexp_matches(summary, '[.!?\"”)\\]]\\s*$') AS cut FROM eval WHERE NOT {_BAD}")
def cut_unmarked(spark, base):
    return table(spark, base, "eval").where(~curation.failed()).select("row_id", workflow.cut_unmarked().alias("cut")).distinct()


@query(
    f"""WITH s AS (SELECT DISTINCT chain AS id FROM sft), u AS (SELECT id, 0 AS source, received_at FROM chains WHERE shape IS NOT NULL AND id IN (SELECT id FROM s) AND NOT {_BAD}
 UNION ALL SELECT id, 1, received_at FROM chains WHERE category = 'supersession' AND id IS NOT NULL AND NOT {_BAD}), f AS (SELECT id, min(source) AS source FROM u GROUP BY id)
 SELECT id, source FROM f"""
)
def select_chains(spark, base):
    """Chains that sft names and, as extras, all of one category: the first source of each wins."""
    chains = table(spark, base, "chains")
    ids = table(spark, base, "sft").select(F.col("chain").alias("id"))
    return selection.select_chains([chains.where("shape IS NOT NULL")], ids, [chains.where("category = 'supersession'")]).select("id", "source")


@query(f"WITH {GOOD} SELECT id FROM good WHERE id NOT IN (SELECT chain FROM dpo WHERE chain IS NOT NULL) AND id NOT IN (SELECT chain FROM sft WHERE split = 'test' AND chain IS NOT NULL)")
def unused_chains(spark, base):
    return selection.without_chains(_good(spark, base), [table(spark, base, "dpo"), table(spark, base, "sft").where("split = 'test'")]).select("id")


@query(f"WITH {GOOD} SELECT DISTINCT row_id FROM chosen WHERE chain IN (SELECT id FROM good) AND kind = 'long' AND category IN ('supersession', 'dense-facts')")
def rows_with_chain(spark, base):
    rows = selection.only(table(spark, base, "chosen"), "long", ["supersession", "dense-facts"])
    return selection.with_chain(rows, _good(spark, base)).select("row_id").distinct()


@query(f"WITH {GOOD} SELECT id FROM good ORDER BY id LIMIT 25")
def first_chains(spark, base):
    """The first 25 chains by id: the limit is the feature."""
    return selection.first_chains(_good(spark, base), 25).select("id")


@query(
    """SELECT e.id, coalesce(CAST(p.place AS BIGINT), 1000000000) AS place FROM (SELECT DISTINCT id FROM eval WHERE id IS NOT NULL) e
 LEFT JOIN (SELECT id, min(row_id) AS place FROM chosen WHERE id IS NOT NULL GROUP BY id) p ON p.id = e.id"""
)
def plan_order(spark, base):
    """Evaluated steps with their place among the chosen rows, those without one after all others."""
    plan = table(spark, base, "chosen").where("id IS NOT NULL").groupBy("id").agg(F.min("row_id").alias("place"))
    return selection.plan_order(table(spark, base, "eval").where("id IS NOT NULL").select("id").distinct(), plan)


@query("SELECT kind, k, CAST(row_number() OVER (PARTITION BY kind ORDER BY CAST(k AS VARCHAR)) AS INTEGER) AS place FROM (SELECT DISTINCT kind, k FROM chosen WHERE k IS NOT NULL)")
def groups_by_text(spark, base):
    from pyspark.sql.window import Window

    groups = table(spark, base, "chosen").where("k IS NOT NULL").select("kind", "k").distinct()  # as many as a chain has steps
    return groups.withColumn("place", F.row_number().over(Window.partitionBy("kind").orderBy(selection.text_order("k"))))


@query("WITH l AS (SELECT id, run_no, arg_max(coalesce(words, -1), row_id) AS words FROM eval WHERE id IS NOT NULL GROUP BY ALL) SELECT a.id, b.run_no, a.words AS first_value, b.words AS value FROM l a LEFT JOIN l b ON b.id = a.id AND b.run_no <> 1 WHERE a.run_no = 1")
def runs_aligned(spark, base):
    """The first run's steps beside those of every other run."""
    rows = table(spark, base, "eval").where("id IS NOT NULL").withColumn("words", F.coalesce("words", F.lit(-1)))
    return alignment.align_to_first(rows, 1, "words")


@query(
    f"""WITH a AS (SELECT model, kind, count(*) FILTER (NOT {_BAD}) AS n, round(median(score.words) FILTER (NOT {_BAD}), 3) AS median_words, count(*) FILTER (NOT {_BAD} AND score.fabrication) AS fabrication_rows FROM eval GROUP BY ALL)
 SELECT kind, model, metric, value FROM (SELECT kind, model, 'n' AS metric, n::DOUBLE AS value FROM a UNION ALL SELECT kind, model, 'median_words', median_words FROM a UNION ALL SELECT kind, model, 'fabrication_rows', fabrication_rows::DOUBLE FROM a)"""
)
def metric_table(spark, base):
    """Metrics of every model, one a row."""
    found = evaluation.aggregate_runs(table(spark, base, "eval"), ["model", "kind"]).select("model", "kind", "n", "median_words", "fabrication_rows")
    return alignment.metric_table(found, ["kind"], "model")


_LINES = """l AS (SELECT DISTINCT id AS chain, CAST((x.seq - 1) // 20 AS INTEGER) AS k, x.text AS line FROM good, LATERAL (SELECT unnest(messages) AS x) WHERE coalesce(x.text, '') <> '' AND (x.seq - 1) // 20 < len(messages) // 20),
 q AS (SELECT DISTINCT row_id, line FROM (SELECT row_id, trim(regexp_replace(unnest(string_split(c, chr(10))), '^[^:]*:', '')) AS line FROM (SELECT DISTINCT row_id, regexp_extract(list_filter(messages, lambda m: m.role = 'user')[-1].content, '<conversation>\\s*(.*?)\\s*</conversation>', 1, 's') AS c FROM sft)) WHERE line <> '')"""


@query(
    f"""WITH {GOOD}, {_LINES}, h AS (SELECT q.row_id, l.chain, l.k, count(*) AS hits FROM q JOIN l USING (line) GROUP BY ALL),
 b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY hits DESC, chain, k) AS rn FROM h) WHERE rn = 1)
 SELECT b.row_id, b.chain, b.k, b.hits, (SELECT count(*) FROM l WHERE l.chain = b.chain AND l.k = b.k) - b.hits AS missing, (SELECT count(*) FROM q WHERE q.row_id = b.row_id) - b.hits AS extra FROM b"""
)
def prompt_differences(spark, base):
    """The step each stored prompt was made from, and the lines that only one of the two has."""
    lines = steps.step_messages(_good(spark, base), "short").where("text <> ''").select("chain", "k", F.col("text").alias("line")).distinct()
    asked = table(spark, base, "sft").select("row_id", F.expr("try_element_at(filter(messages, m -> m.role = 'user'), -1).content").alias("c")).distinct()
    talk = F.regexp_extract("c", r"(?s)<conversation>\s*(.*?)\s*</conversation>", 1)
    sent = asked.select("row_id", F.explode(F.split(talk, "\n")).alias("line")).select("row_id", F.trim(F.regexp_replace("line", r"^[^:]*:", "")).alias("line")).where("line <> ''").distinct()
    return alignment.prompt_differences(sent, lines)


TEMPLATE = "Sum up in at most {limit} words.\n<previous_summary>\n{previous}\n</previous_summary>\n<conversation>\n{conversation}\n</conversation>"
_TALK = f"""m AS (SELECT id AS chain, x.seq AS seq, coalesce(x.peer, '') AS peer, coalesce(x.text, '') AS text FROM good, LATERAL (SELECT unnest(messages) AS x)),
 t AS (SELECT s.chain, s.kind, s.k, string_agg(m.peer || ': ' || m.text, chr(10) ORDER BY m.seq) AS transcript, CAST(sum((length(m.text) + 3) // 4) AS INTEGER) AS tokens FROM steps s JOIN m ON m.chain = s.chain AND m.seq BETWEEN s.lo AND s.hi GROUP BY ALL),
 c AS (SELECT DISTINCT row_id, chain, kind, k, output_words, coalesce(max_tokens, CASE kind WHEN 'short' THEN 1000 ELSE 4000 END) AS cap, CASE WHEN regexp_matches(coalesce(previous_summary, ''), '[^\\s\\x1c-\\x1f\\x{{85}}\\p{{Z}}]') THEN previous_summary END AS previous FROM chosen),
 b AS (SELECT c.*, t.transcript, CAST(floor(CASE WHEN c.kind = 'short' THEN least(t.tokens + CASE WHEN previous IS NULL THEN 0 ELSE (length(previous) + 3) // 4 END, cap) ELSE cap END * 0.75::DOUBLE) AS INTEGER) AS rebuilt_limit FROM c JOIN t ON t.chain = c.chain AND t.kind = c.kind AND t.k = c.k)"""


def _built(spark, base):
    rows = table(spark, base, "chosen").select("row_id", "chain", "kind", "k", "previous_summary", "max_tokens", "output_words").distinct()
    return prompts.build_steps(rows, _good(spark, base), TEMPLATE)


@query(f"WITH {GOOD}, {STEPS}, {_TALK} SELECT row_id, output_words, rebuilt_limit, output_words IS NOT DISTINCT FROM rebuilt_limit AS same FROM b")
def rebuilt_limits(spark, base):
    """Limits of stored rows, of both kinds, rebuilt from their steps, and whether they are the stored ones."""
    return _built(spark, base).select("row_id", "output_words", "rebuilt_limit", F.col("output_words").eqNullSafe(F.col("rebuilt_limit")).alias("same"))


@query(
    f"""WITH {GOOD}, {STEPS}, {_TALK} SELECT row_id, md5('Sum up in at most ' || CAST(rebuilt_limit AS VARCHAR) || ' words.' || chr(10) || '<previous_summary>' || chr(10) || coalesce(previous, '{NO_PREVIOUS}') || chr(10) || '</previous_summary>' || chr(10) || '<conversation>' || chr(10) || transcript || chr(10) || '</conversation>') AS digest FROM b"""
)
def rendered_prompts(spark, base):
    return _built(spark, base).select("row_id", F.md5("prompt").alias("digest"))


@query(
    f"""WITH {DUE}, n AS (SELECT chain, kind, k, count(*) AS due FROM due GROUP BY ALL), c AS (SELECT DISTINCT row_id, chain, kind, k, output_words FROM chosen WHERE output_words IS NOT NULL), s2 AS (SELECT chain, kind, k FROM steps)
 SELECT c.row_id, CAST(floor(c.output_words * 0.7::DOUBLE) AS INTEGER) AS budget, CAST(greatest(1, coalesce(n.due, 0) // 10) AS INTEGER) AS may_drop FROM c JOIN s2 USING (chain, kind, k) LEFT JOIN n USING (chain, kind, k)"""
)
def job_budgets(spark, base):
    """Words a job asks for and facts its last attempt may drop."""
    counts = scoring.due_counts(_good(spark, base))
    rows = table(spark, base, "chosen").where("output_words IS NOT NULL").select("row_id", "chain", "kind", "k", "output_words").distinct()
    at = rows.join(counts, ["chain", "kind", "k"])
    return at.select("row_id", prompts.budget(F.col("output_words")).alias("budget"), prompts.may_drop(F.col("n_new") + F.col("n_carry")).alias("may_drop"))


@query(
    f"""WITH {GOOD}, {STEPS}, {FACTS}, {CHANGES}, f AS (SELECT chain, fact_id, arg_max(text, pos) AS text FROM facts GROUP BY ALL)
 SELECT s.chain, s.kind, s.k, string_agg(coalesce(o.text, '') || ' -> ' || coalesce(n.text, ''), chr(10) ORDER BY c.seq, coalesce(o.text, ''), coalesce(n.text, '')) AS changed
 FROM steps s JOIN changes c ON c.chain = s.chain AND c.seq <= s.hi LEFT JOIN f o ON o.chain = c.chain AND o.fact_id = c.old LEFT JOIN f n ON n.chain = c.chain AND n.fact_id = c.new GROUP BY ALL"""
)
def changed_values(spark, base):
    """The old and the new text of every change a step has seen, as lines."""
    good = _good(spark, base)
    listed = scoring.changed_facts(good).join(steps.steps(good), "chain").where("seq <= hi")
    line = F.struct("seq", "old_text", "new_text")
    lines = F.array_sort(F.collect_list(line))  # a chain's changes
    return listed.groupBy("chain", "kind", "k").agg(F.array_join(F.transform(lines, lambda x: F.concat_ws(" -> ", x["old_text"], x["new_text"])), "\n").alias("changed"))


@query(
    f"""WITH r AS (SELECT coalesce(category, '') AS category, {_BAD} AS bad, len(coalesce(messages, [])) AS n FROM (SELECT DISTINCT ON (id) * FROM chains WHERE id IS NOT NULL ORDER BY id, received_at)),
 g AS (SELECT category, list_sort(list(n)) AS ns FROM r WHERE NOT bad GROUP BY category)
 SELECT r.category, count(*) AS rows, count(*) FILTER (NOT bad) AS good, CAST(coalesce(sum(n // 20 + n // 60) FILTER (NOT bad), 0) AS BIGINT) AS steps, any_value(g.ns[len(g.ns) // 2 + 1]) AS median_messages FROM r LEFT JOIN g USING (category) GROUP BY r.category"""
)
def chain_report(spark, base):
    """Chains, good ones, their steps and the upper median of their messages by category."""
    first = maintenance.first_of(table(spark, base, "chains").where("id IS NOT NULL").select("id", "category", "messages", "__failed__", "received_at"), ["id"], ["received_at"])
    n = F.coalesce(F.size("messages"), F.lit(0))
    rows = first.select(F.coalesce("category", F.lit("")).alias("category"), curation.failed().alias("bad"), n.cast("long").alias("n"))
    counts = rows.groupBy("category").agg(
        F.count("*").alias("rows"), F.count_if(~F.col("bad")).alias("good"),
        F.coalesce(F.sum(F.when(~F.col("bad"), F.floor(F.col("n") / 20) + F.floor(F.col("n") / 60))), F.lit(0)).cast("long").alias("steps"),
    )
    middle = alignment.order_statistics(rows.where("NOT bad"), ["category"], "n", {"median_messages": (1, 2)}).select("category", "median_messages")
    return counts.join(middle, "category", "left")


_IDS = "list_transform(list_filter(regexp_split_to_array(coalesce({0}, ''), '\\s+'), lambda w: w <> ''), lambda w: CAST(('0x' || substring(md5(w), 1, 7))::BIGINT % 50000 AS INTEGER))"
_ASKED = "array_to_string(list_transform(list_filter({0}, lambda m: m IS NOT NULL), lambda m: coalesce(m.role, '') || ': ' || coalesce(m.content, '')), chr(10))"


def _whole(messages: str):
    return F.expr(f"array_join(transform(filter({messages}, m -> m IS NOT NULL), m -> concat(coalesce(m.role, ''), ': ', coalesce(m.content, ''))), '\\n')")


@query(
    f"""WITH d AS (SELECT DISTINCT row_id, {_ASKED.format('prompt')} AS p, chosen, rejected FROM dpo), e AS (SELECT row_id, len({_IDS.format('p')}) AS p, len({_IDS.format('chosen')}) AS c, {_IDS.format('rejected')} AS rj FROM d)
 SELECT row_id, CAST(p + c AS INTEGER) AS chosen_n, CAST(p + len(rj) AS INTEGER) AS rejected_n, CAST(coalesce(list_sum(rj), 0) AS BIGINT) AS rejected_sum FROM e WHERE p + greatest(c, len(rj)) <= 900"""
)
def encoded_pairs(spark, base):
    """Both sides of preference pairs after their whole prompt; pairs of which one side is too long are dropped."""
    pairs = table(spark, base, "dpo").select("row_id", _whole("prompt").alias("p"), "chosen", "rejected").distinct()
    ids = pairs.select("row_id", *[training.word_ids(F.col(c)).alias(n) for c, n in (("p", "pi"), ("chosen", "ci"), ("rejected", "ri"))])
    got = training.encode_pairs(ids, "row_id", "pi", "ci", "ri", 900)
    trained = F.filter("rejected_labels", lambda x: x != training.IGNORED)
    total = F.aggregate(trained, F.lit(0).cast("long"), lambda a, x: a + x)
    return got.select("row_id", F.size("chosen_input_ids").alias("chosen_n"), F.size("rejected_input_ids").alias("rejected_n"), total.alias("rejected_sum"))


_SAMPLES = f"""s AS (SELECT DISTINCT row_id, kind, messages FROM sft), n AS (SELECT kind, len({_IDS.format(_ASKED.format('messages[:-2]'))}) + len({_IDS.format('messages[-1].content')}) AS n FROM s WHERE messages[-1].role = 'assistant')"""


@query(
    f"""WITH {_SAMPLES}, k AS (SELECT kind, list_sort(list(n)) AS ns FROM n WHERE n <= 900 GROUP BY kind)
 SELECT n.kind, count(*) AS samples, count(*) FILTER (n <= 900) AS kept, count(*) FILTER (n > 900) AS dropped, any_value(ns[1]) AS least, any_value(ns[len(ns) // 2 + 1]) AS median, any_value(ns[len(ns) * 95 // 100 + 1]) AS p95, any_value(ns[len(ns)]) AS most
 FROM n LEFT JOIN k ON k.kind IS NOT DISTINCT FROM n.kind GROUP BY n.kind"""
)
def sample_report(spark, base):
    """How many training samples fit, and their lengths."""
    rows = table(spark, base, "sft").where("element_at(messages, -1).role = 'assistant'").select("row_id", "kind", "messages").distinct()
    turns = training.turns_of(rows, calls=None).join(rows.select("row_id", "kind").withColumnRenamed("kind", "block"), "row_id")
    n = turns.select(F.col("block").alias("kind"), _whole("prefix").alias("p"), "target").select("kind", (F.size(training.word_ids(F.col("p"))) + F.size(training.word_ids(F.col("target")))).cast("long").alias("n"))
    return training.sample_report(n, "n", 900, ["kind"])


@query("WITH i AS (SELECT DISTINCT row_id FROM sft), r AS (SELECT row_id, row_number() OVER (ORDER BY sha1('42' || CAST(row_id AS VARCHAR)), row_id) AS place, count(*) OVER () AS n FROM i) SELECT row_id, n >= 20 AND place <= least(64, greatest(1, n // 20)) AS held FROM r")
def hold_out(spark, base):
    return training.hold_out(table(spark, base, "sft"), "row_id")


_BLANK = "regexp_matches(coalesce({0}, ''), '^[\\s\\p{{Z}}]*$')"


@query(
    f"""WITH {GOOD}, a AS (SELECT id, category, list_filter(coalesce(messages, []), lambda m: m IS NOT NULL AND NOT {_BLANK.format('m.peer')} AND NOT {_BLANK.format('m.text')}) AS said, coalesce(facts, []) AS fs FROM good),
 m AS (SELECT id, category, said[:len(said) // 20 * 20] AS ms, fs FROM a), x AS (SELECT id, p, ms[p].text AS text, trim(ms[p].peer) AS peer FROM m, LATERAL (SELECT unnest(range(1, len(ms) + 1)) AS p)),
 f AS (SELECT id, min(p) AS p, text FROM (SELECT id, p, lower(trim(regexp_replace(fs[p].text, '\\s+', ' ', 'g'))) AS text FROM m, LATERAL (SELECT unnest(range(1, len(fs) + 1)) AS p) WHERE fs[p] IS NOT NULL AND NOT {_BLANK.format('fs[p].text')}) GROUP BY ALL),
 v AS (SELECT f.id, f.text, min(x.p) AS seq FROM f JOIN x ON x.id = f.id AND contains(lower(trim(x.text)), f.text) GROUP BY ALL)
 SELECT m.id, CAST(len(ms) AS INTEGER) AS messages, CAST((SELECT count(DISTINCT peer) FROM x WHERE x.id = m.id) AS INTEGER) AS peers, CAST((SELECT count(*) FROM v WHERE v.id = m.id) AS INTEGER) AS facts, CAST((SELECT coalesce(sum(seq), 0) FROM v WHERE v.id = m.id) AS BIGINT) AS first_seqs FROM m"""
)
def chain_repair(spark, base):
    """Chains made fit for scoring: whole blocks, speakers, verbatim facts with their first mention."""
    fixed = repair.repair_chains(_good(spark, base))
    total = F.aggregate("facts", F.lit(0).cast("long"), lambda a, f: a + f["first_seq"])
    return fixed.select("id", F.size("messages").alias("messages"), F.size("peers").alias("peers"), F.size("facts").alias("facts"), total.alias("first_seqs"))


@query()
def chain_reasons(spark, base):
    """Why generated chains would be refused; tested on small chains."""
    return repair.repair_chains(_good(spark, base)).groupBy("reason").agg(F.count("*").alias("chains"))


@query(
    f"""WITH {GOOD}, c AS (SELECT category, count(*) AS n FROM good WHERE category IS NOT NULL GROUP BY category), w AS (SELECT category, CAST(ceil(n * 20 / (SELECT sum(n) FROM c)::DOUBLE) AS INTEGER) AS w FROM c), e AS (SELECT category, (i + 0.5::DOUBLE) / w AS spot FROM w, LATERAL (SELECT unnest(range(0, w)) AS i))
 SELECT row_number() OVER (ORDER BY spot, category) - 1 AS place, category FROM e"""
)
def category_sequence(spark, base):
    """The chains' own categories by their shares in twenty, spread evenly."""
    return generation.sequence_of(generation.weights_of(_good(spark, base), "category"))
