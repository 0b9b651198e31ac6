"""Queries over steps, ledgers, scores and row tables, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions import text as tx
from threadloom.operators import alignment, curation, evaluation, maintenance, repair, scoring, steps, training, walk
from threadloom.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: Good chains, each once, as a common table expression.
GOOD = 'good AS (SELECT DISTINCT ON (id) * FROM chains WHERE id IS NOT NULL AND "__failed__" IS NULL ORDER BY id, received_at)'
STEPS = """steps AS (SELECT id AS chain, kind, CAST(k AS INTEGER) AS k, CAST(k * size + 1 AS INTEGER) AS lo, CAST((k + 1) * size AS INTEGER) AS hi
 FROM good, (VALUES ('short', 20), ('long', 60)) AS s(kind, size), LATERAL (SELECT unnest(range(0, coalesce(len(messages), 0) // size)) AS k))"""
FACTS = """facts AS (SELECT id AS chain, p - 1 AS pos, facts[p].id AS fact_id, coalesce(facts[p].text, '') AS text, facts[p].first_seq AS first_seq
 FROM good, LATERAL (SELECT unnest(range(1, coalesce(len(facts), 0) + 1)) AS p) WHERE facts[p].id IS NOT NULL AND facts[p].first_seq IS NOT NULL)"""
CHANGES = """changes AS (SELECT id AS chain, c.fact_id AS old, c.superseded_by AS new, c.seq AS seq
 FROM good, LATERAL (SELECT unnest(changes) AS c) WHERE c.seq IS NOT NULL)"""
DUE = f"""{GOOD}, {STEPS}, {FACTS}, {CHANGES},
 gone AS (SELECT chain, old AS fact_id, min(seq) AS gone_at FROM changes WHERE old IS NOT NULL GROUP BY ALL),
 due AS (SELECT s.chain, s.kind, s.k, f.pos, f.fact_id, f.text, CASE WHEN f.first_seq >= s.lo THEN 'new' ELSE 'carry' END AS due
  FROM steps s JOIN facts f ON s.chain = f.chain AND f.first_seq <= s.hi LEFT JOIN gone g ON g.chain = f.chain AND g.fact_id = f.fact_id
  WHERE g.gone_at IS NULL OR g.gone_at > s.hi)"""
HUMANS = """humans AS (SELECT DISTINCT id AS chain, lower(p.name) AS name FROM good, LATERAL (SELECT unnest(peers) AS p)
 WHERE coalesce(p.name, '') <> '' AND lower(coalesce(p.role, '')) <> 'assistant')"""
FLAG_SQL = {k: v.replace("'", "''") for k, v in tx.FLAGS.items()}
WORDS_SQL = r"CAST(len(list_filter(regexp_split_to_array(coalesce({0}, ''), '[\s\x1c-\x1f\x{{85}}\p{{Z}}]+'), lambda w: w <> '')) AS INTEGER)"


def _good(spark: SparkSession, base: str) -> DataFrame:
    return steps.good_chains(table(spark, base, "chains"))


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


@query(f"WITH {GOOD}, {STEPS} SELECT * FROM steps")
def chunk_steps(spark, base):
    return steps.steps(_good(spark, base))


@query(
    f"""WITH {GOOD}, {STEPS} SELECT chain, kind, k, CAST(row_number() OVER (PARTITION BY chain ORDER BY hi, kind DESC) AS INTEGER) AS place FROM steps"""
)
def step_order(spark, base):
    return steps.step_order(steps.steps(_good(spark, base))).select("chain", "kind", "k", "place")


@query(f"WITH {GOOD}, {STEPS} SELECT chain, kind, count(*) AS steps FROM steps GROUP BY ALL")
def step_counts(spark, base):
    return steps.steps(_good(spark, base)).groupBy("chain", "kind").agg(F.count("*").alias("steps"))


@query(
    f"""WITH {GOOD}, {STEPS}, m AS (SELECT id AS chain, x.seq AS seq, coalesce(x.text, '') AS text FROM good, LATERAL (SELECT unnest(messages) AS x))
 SELECT s.chain, s.k, count(*) AS messages, CAST(sum(length(m.text)) AS BIGINT) AS chars FROM steps s JOIN m ON m.chain = s.chain AND m.seq BETWEEN s.lo AND s.hi WHERE s.kind = 'short' GROUP BY ALL"""
)
def step_messages(spark, base):
    return steps.step_messages(_good(spark, base), "short").groupBy("chain", "k").agg(
        F.count("*").alias("messages"), F.sum(F.length("text")).alias("chars")
    )


def _transcript_sql(kind: str) -> str:
    return f"""WITH {GOOD}, {STEPS}, m AS (SELECT id AS chain, x.seq AS seq, coalesce(x.peer, '') AS peer, coalesce(x.text, '') AS text FROM good, LATERAL (SELECT unnest(messages) AS x))
 SELECT s.chain, s.k, string_agg(m.peer || ': ' || m.text, chr(10) ORDER BY m.seq) AS transcript, CAST(sum((length(m.text) + 3) // 4) AS INTEGER) AS tokens
 FROM steps s JOIN m ON m.chain = s.chain AND m.seq BETWEEN s.lo AND s.hi WHERE s.kind = '{kind}' GROUP BY ALL"""


@query(_transcript_sql("short"))
def step_transcript(spark, base):
    return steps.transcripts(_good(spark, base), "short")


@query(_transcript_sql("long"))
def step_transcript_long(spark, base):
    return steps.transcripts(_good(spark, base), "long")


@query(
    f"""WITH t AS ({_transcript_sql("short")}), p AS (SELECT DISTINCT row_id, chain, k, previous_summary FROM chosen WHERE kind = 'short')
 SELECT p.row_id, CAST(floor(least(t.tokens + (length(coalesce(p.previous_summary, '')) + 3) // 4, 1000) * 0.75::DOUBLE) AS INTEGER) AS word_limit
 FROM p JOIN t ON p.chain = t.chain AND p.k = t.k"""
)
def step_limits(spark, base):
    """Word limits of stored steps, rebuilt from their messages and previous summary."""
    t = steps.transcripts(_good(spark, base), "short").select("chain", "k", "tokens")
    p = table(spark, base, "chosen").where("kind = 'short'").select("row_id", "chain", "k", "previous_summary").distinct()
    total = F.col("tokens") + tx.token_estimate(F.col("previous_summary"))
    return p.join(t, ["chain", "k"]).select("row_id", steps.word_limit("short", total).alias("word_limit"))


@query(
    """SELECT DISTINCT row_id, regexp_extract(id, '^(.*)-(.)([0-9]*)([^-]*)$', 1) AS chain, CASE WHEN regexp_extract(id, '^(.*)-(.)([0-9]*)([^-]*)$', 2) = 's' THEN 'short' ELSE 'long' END AS kind,
 TRY_CAST(regexp_extract(id, '^(.*)-(.)([0-9]*)([^-]*)$', 3) AS INTEGER) AS k, regexp_extract(id, '^(.*)-(.)([0-9]*)([^-]*)$', 4) AS variant, id AS rebuilt FROM chosen WHERE id IS NOT NULL"""
)
def step_id_roundtrip(spark, base):
    parsed = table(spark, base, "chosen").where("id IS NOT NULL").select("row_id", *steps.parse_step_id(F.col("id")))
    return parsed.withColumn("rebuilt", steps.step_id(*(F.col(c) for c in ("chain", "kind", "k", "variant")))).distinct()


@query(
    r"""SELECT DISTINCT row_id, regexp_extract(c, '<previous_summary>\s*(.*?)\s*</previous_summary>', 1, 's') AS previous,
 TRY_CAST(regexp_extract(c, '([0-9]+) words', 1) AS INTEGER) AS word_limit FROM (SELECT row_id, list_filter(messages, lambda m: m.role = 'user')[-1].content AS c FROM sft) WHERE c IS NOT NULL"""
)
def prompt_fields(spark, base):
    asked = table(spark, base, "sft").select("row_id", F.expr("try_element_at(filter(messages, m -> m.role = 'user'), -1).content").alias("c")).where("c IS NOT NULL")
    return asked.select("row_id", *steps.prompt_fields(F.col("c"))).drop("conversation").distinct()


@query(f"SELECT doc_id, {WORDS_SQL.format('text')} AS words, CAST((length(coalesce(text, '')) + 3) // 4 AS INTEGER) AS tokens FROM documents")
def word_token_counts(spark, base):
    return table(spark, base, "documents").select("doc_id", tx.word_count(F.col("text")).alias("words"), tx.token_estimate(F.col("text")).alias("tokens"))


@query("SELECT DISTINCT row_id, " + ", ".join(f"regexp_matches(coalesce(summary, ''), '{p}') AS {n}" for n, p in FLAG_SQL.items()) + " FROM chosen")
def format_flags(spark, base):
    return table(spark, base, "chosen").select("row_id", *[tx.flag(F.col("summary"), n).alias(n) for n in tx.FLAGS]).distinct()


def _norm_sql(column: str) -> str:
    out = f"translate(lower(coalesce({column}, '')), '’‘“”', '''''\"\"')"
    out = f"regexp_replace({out}, '(\\d),(\\d{{3}})(\\D|$)', '\\1\\2\\3', 'g')"
    for word, value in tx.NUMBERS.items():
        for _ in range(2):
            out = f"regexp_replace({out}, '(^|[^\\p{{L}}\\p{{N}}_]){word}($|[^\\p{{L}}\\p{{N}}_])', '\\1{value}\\2', 'g')" if word in ("one", "two", "four", "five", "six", "seven", "eight", "nine", "ten") or _ == 0 else out
    return out


@query(f"WITH {GOOD}, {FACTS} SELECT chain, CAST(pos AS INTEGER) AS pos, {_norm_sql('text')} AS normalised FROM facts")
def normalized_text(spark, base):
    facts, _, _ = scoring.ledger(_good(spark, base))
    return facts.select("chain", "pos", tx.normalise(F.col("text")).alias("normalised"))


@query(
    f"""WITH {GOOD}, {FACTS}, n AS (SELECT chain, CAST(pos AS INTEGER) AS pos, {_norm_sql('text')} AS t FROM facts)
 SELECT chain, pos, array_to_string(list_filter(regexp_extract_all(t, '[\\p{{L}}\\p{{N}}]+(?:[.,:/][0-9]+)*'), lambda w: NOT list_contains([{', '.join(repr(w) for w in tx.STOPWORDS)}], w) AND (length(w) >= 2 OR regexp_matches(w, '^\\p{{Nd}}$'))), ' ') AS anchors FROM n"""
)
def anchors(spark, base):
    facts, _, _ = scoring.ledger(_good(spark, base))
    return facts.select("chain", "pos", F.array_join(tx.anchors(tx.tokens(tx.normalise(F.col("text")))), " ").alias("anchors"))


@query(f"WITH {DUE} SELECT chain, kind, k, CAST(pos AS INTEGER) AS pos, fact_id, due FROM due")
def facts_due(spark, base):
    return scoring.facts_due(_good(spark, base)).drop("text")


@query(
    f"""WITH {DUE} SELECT s.chain, s.kind, s.k, count(d.pos) FILTER (d.due = 'new') AS n_new, count(d.pos) FILTER (d.due = 'carry') AS n_carry
 FROM steps s LEFT JOIN due d ON d.chain = s.chain AND d.kind = s.kind AND d.k = s.k GROUP BY ALL"""
)
def due_counts(spark, base):
    return scoring.due_counts(_good(spark, base))


@query(
    f"""WITH {GOOD}, {STEPS}, {CHANGES} SELECT s.chain, s.kind, s.k, count(DISTINCT c.old) AS superseded FROM steps s JOIN changes c ON c.chain = s.chain AND c.seq <= s.hi WHERE c.old IS NOT NULL GROUP BY ALL"""
)
def facts_superseded(spark, base):
    good = _good(spark, base)
    _, changes, _ = scoring.ledger(good)
    return steps.steps(good).join(changes.where("old IS NOT NULL"), "chain").where("seq <= hi").groupBy("chain", "kind", "k").agg(
        F.countDistinct("old").alias("superseded")
    )


@query(
    f"""WITH {DUE}, c AS (SELECT DISTINCT row_id, chain, kind, k, coalesce(summary, '') AS summary FROM chosen)
 SELECT c.row_id, count(*) AS due, count(*) FILTER (contains({_norm_sql('c.summary')}, trim({_norm_sql('d.text')})) AND trim(d.text) <> '') AS hits
 FROM c JOIN due d ON d.chain = c.chain AND d.kind = c.kind AND d.k = c.k GROUP BY ALL"""
)
def fact_match_exact(spark, base):
    """Due facts that stand in a summary as they are, after normalising both once."""
    due = scoring.facts_due(_good(spark, base)).select("chain", "kind", "k", F.trim(tx.normalise(F.col("text"))).alias("f"))
    rows = table(spark, base, "chosen").select("row_id", "chain", "kind", "k", tx.normalise(F.col("summary")).alias("t")).distinct()
    hit = (F.col("f") != "") & F.contains("t", "f")
    return rows.join(due, ["chain", "kind", "k"]).groupBy("row_id").agg(F.count("*").alias("due"), F.count_if(hit).alias("hits"))


STOP_SQL = "[" + ", ".join(repr(w) for w in tx.STOPWORDS) + "]"


def anchors_sql(tokens: str, names: str) -> str:
    return f"list_filter({tokens}, lambda w: NOT list_contains({STOP_SQL}, w) AND NOT list_contains({names}, w) AND (length(w) >= 2 OR regexp_matches(w, '^\\p{{Nd}}$')))"


def stated_sql(t: str, tk: str, f: str, a: str, strict: bool = False) -> str:
    """Whether a text (normalised, tokens) states a fact (normalised, anchors): its words as they are, or anchors in a window
    of tokens that begins with one."""
    span = tx.STRICT_WINDOW if strict else tx.WINDOW
    window = f"{tk}[i:i + {span - 1}]"
    need = f"len({a})" if strict else f"len({a}) - CASE WHEN len({a}) > 2 THEN 1 ELSE 0 END"
    there = f"len(list_filter({a}, lambda x: list_contains({window}, x))) >= {need}"
    numbers = f"len(list_filter({a}, lambda n: regexp_matches(n, '[0-9]') AND NOT list_contains({window}, n))) = 0"
    near = f"len(list_filter(range(1, len({tk}) + 1), lambda i: list_contains({a}, {tk}[i]) AND {there} AND {numbers})) > 0"
    if strict:
        pair = f"len(list_filter(range(1, len({tk}) + 1), lambda i: {tk}[i] = {a}[1] AND list_contains({tk}[i + 1:i + 2], {a}[2]))) > 0"
        near = f"CASE WHEN len({a}) = 2 THEN {pair} ELSE {near} END"
    return f"({f} <> '' AND {t} <> '' AND (contains({t}, {f}) OR (len({a}) > 0 AND {near})))"


_TK = "regexp_extract_all({0}, '[\\p{{L}}\\p{{N}}]+(?:[.,:/][0-9]+)*')"


def scores_sql(table: str) -> str:
    """Scores of a table's rows from the ledger, fact by fact."""
    flags = ", ".join(f"regexp_matches(summary, '{p}') AS {n}" for n, p in FLAG_SQL.items())
    prepare = lambda name, source, keys: f"""{name} AS (SELECT {keys}, trim(nt) AS f, {anchors_sql(_TK.format('nt'), 'ns')} AS a FROM (SELECT {keys}, {_norm_sql('text')} AS nt, ns FROM {source} JOIN names USING (chain)))"""
    return f"""WITH {DUE}, names AS (SELECT id AS chain, list_transform(list_filter(coalesce(peers, []), lambda p: p IS NOT NULL AND coalesce(p.name, '') <> ''), lambda p: lower(p.name)) AS ns FROM good),
 c AS (SELECT DISTINCT ON (row_id) row_id, chain, kind, k, coalesce(summary, '') AS summary, output_words FROM {table}),
 b AS (SELECT row_id, chain, kind, k, output_words, {WORDS_SQL.format('summary')} AS words, {flags}, {_norm_sql('summary')} AS t FROM c),
 b2 AS (SELECT *, {_TK.format('t')} AS tk, words > 0 AND NOT narration AS usable FROM b),
 news AS (SELECT g.chain, g.seq, coalesce(x.text, '') AS text FROM changes g LEFT JOIN (SELECT chain, fact_id, arg_max(text, pos) AS text FROM facts GROUP BY ALL) x ON x.chain = g.chain AND x.fact_id = g.new),
 wrong AS (SELECT id AS chain, d.text AS text FROM good, LATERAL (SELECT unnest(distractors) AS d) WHERE d.text IS NOT NULL),
 {prepare('pd', 'due', 'chain, kind, k, due')}, {prepare('pn', 'news', 'chain, seq')}, {prepare('pw', 'wrong', 'chain')},
 cov AS (SELECT row_id, avg(CASE WHEN due = 'new' THEN hit::INT END) AS cn, avg(CASE WHEN due = 'carry' THEN hit::INT END) AS cc FROM (SELECT b2.row_id, pd.due, {stated_sql('b2.t', 'b2.tk', 'pd.f', 'pd.a')} AS hit FROM b2 JOIN pd USING (chain, kind, k) WHERE usable) GROUP BY row_id),
 st AS (SELECT row_id, avg(hit::INT) AS ls FROM (SELECT b2.row_id, usable AND {stated_sql('b2.t', 'b2.tk', 'pn.f', 'pn.a')} AS hit FROM b2 JOIN steps s USING (chain, kind, k) JOIN pn ON pn.chain = b2.chain AND pn.seq <= s.hi) GROUP BY row_id),
 fb AS (SELECT row_id, bool_or(hit) AS fab FROM (SELECT b2.row_id, {stated_sql('b2.t', 'b2.tk', 'pw.f', 'pw.a', True)} AS hit FROM b2 JOIN pw USING (chain) WHERE usable) GROUP BY row_id),
 n AS (SELECT s.chain, s.kind, s.k, count(d.pos) FILTER (d.due = 'new') AS n_new, count(d.pos) FILTER (d.due = 'carry') AS n_carry FROM steps s LEFT JOIN due d ON d.chain = s.chain AND d.kind = s.kind AND d.k = s.k GROUP BY ALL)
 SELECT b2.row_id, words, CASE WHEN coalesce(output_words, 0) <> 0 THEN round_even(words / output_words::DOUBLE, 3) END AS limit_ratio, coalesce(output_words <> 0 AND words > output_words, false) AS over_limit, words = 0 AS empty,
 bullets, meta, think_leak, narration, echo, n_new, n_carry, CASE WHEN n_new > 0 THEN round_even(CASE WHEN usable THEN cn ELSE 0 END, 3) END AS fact_coverage_new, CASE WHEN n_carry > 0 THEN round_even(CASE WHEN usable THEN cc ELSE 0 END, 3) END AS fact_coverage_carry,
 round_even(ls, 3) AS latest_state, coalesce(fab, false) AS fabrication FROM b2 JOIN n USING (chain, kind, k) LEFT JOIN cov USING (row_id) LEFT JOIN st USING (row_id) LEFT JOIN fb USING (row_id)"""


@query(scores_sql("chosen"))
def score_steps(spark, base):
    """Every chosen summary scored against its ledger."""
    return scoring.score_rows(table(spark, base, "chosen"), _good(spark, base))


@query(scores_sql("eval"))
def score_eval(spark, base):
    return scoring.score_rows(table(spark, base, "eval"), _good(spark, base))


BLANK_SQL = r"NOT regexp_matches(coalesce(summary, ''), '[^\s\x1c-\x1f\x{85}\p{Z}]')"
KEEP_SQL = f"""CASE WHEN coalesce("__failed__", '') <> '' OR {BLANK_SQL} THEN 'failed_or_empty' WHEN score.empty THEN 'empty'
 WHEN score.bullets THEN 'bullets' WHEN score.meta THEN 'meta' WHEN score.think_leak THEN 'think_leak' WHEN score.narration THEN 'narration' WHEN score.echo THEN 'echo'
 WHEN score.fabrication THEN 'fabrication' WHEN score.fact_coverage_new < 0.9::DOUBLE THEN 'low_coverage_new' WHEN score.fact_coverage_carry < 0.9::DOUBLE THEN 'low_coverage_carry'
 WHEN score.latest_state < 1.0::DOUBLE THEN 'stale_value' WHEN words > 0.8::DOUBLE * output_words THEN 'over_0.8x_limit' ELSE 'kept' END"""


_RESCORED = ", ".join(
    f"{c} := CASE WHEN f.row_id IS NULL THEN c.score.{c} ELSE f.{c} END"
    for c in ("empty", "bullets", "meta", "think_leak", "narration", "echo", "fabrication", "fact_coverage_new", "fact_coverage_carry", "latest_state")
)


@query(
    f"""WITH f AS ({scores_sql('(SELECT * FROM chosen WHERE coalesce("__failed__", ' + "''" + f") = '' AND NOT ({BLANK_SQL}))")}), c AS (SELECT DISTINCT ON (row_id) * FROM chosen),
 r AS (SELECT c.row_id, c.summary, c."__failed__", c.output_words, CASE WHEN f.row_id IS NULL THEN c.words ELSE f.words END AS words, struct_pack({_RESCORED}) AS score FROM c LEFT JOIN f ON f.row_id = c.row_id)
 SELECT row_id, {KEEP_SQL} AS reason FROM r"""
)
def rescored_reasons(spark, base):
    """Keep reasons by fresh scores."""
    fresh = scoring.rescore(table(spark, base, "chosen"), _good(spark, base))
    return fresh.select("row_id", curation.keep_reason().alias("reason"))


@query(f"SELECT DISTINCT row_id, {KEEP_SQL} AS reason FROM chosen")
def keep_reason(spark, base):
    return table(spark, base, "chosen").select("row_id", curation.keep_reason().alias("reason")).distinct()


@query(f"SELECT kind, variant, reason, count(*) AS rows FROM (SELECT DISTINCT row_id, kind, variant, {KEEP_SQL} AS reason FROM chosen) GROUP BY ALL")
def drop_reason_counts(spark, base):
    rows = table(spark, base, "chosen").select("row_id", "kind", "variant", curation.keep_reason().alias("reason")).distinct()
    return rows.groupBy("kind", "variant", "reason").agg(F.count("*").alias("rows"))


@query(
    f"""WITH {GOOD}, {HUMANS}, r AS (SELECT id AS chain, coalesce(category, '') AS category, row_number() OVER (PARTITION BY coalesce(category, '') ORDER BY sha1('7' || id), id) AS place, count(*) OVER (PARTITION BY coalesce(category, '')) AS total FROM good),
 drawn AS (SELECT chain, category, place <= CASE WHEN total > 1 THEN least(total - 1, greatest(1, CAST(round_even(total * 0.3::DOUBLE, 0) AS BIGINT))) ELSE 0 END AS held FROM r),
 known AS (SELECT DISTINCT h.name FROM humans h JOIN drawn d ON d.chain = h.chain WHERE d.held), near AS (SELECT DISTINCT h.chain FROM humans h JOIN known USING (name))
 SELECT d.chain, d.category, CASE WHEN d.held OR n.chain IS NOT NULL THEN 'eval' ELSE 'train' END AS split FROM drawn d LEFT JOIN near n ON n.chain = d.chain"""
)
def persona_split(spark, base):
    return curation.persona_split(_good(spark, base))


@query(
    f"""WITH {GOOD}, {HUMANS}, held AS (SELECT DISTINCT g.id AS chain FROM good g JOIN sft s ON s.chain = g.id WHERE s.split = 'test'),
 known AS (SELECT DISTINCT h.name FROM humans h JOIN held USING (chain)), clash AS (SELECT DISTINCT h.chain FROM humans h JOIN known USING (name))
 SELECT chain, 'eval' AS split FROM held UNION ALL SELECT id, 'train' FROM good WHERE id NOT IN (SELECT chain FROM held) AND id NOT IN (SELECT chain FROM clash)"""
)
def pinned_split(spark, base):
    return curation.pinned_split(_good(spark, base), table(spark, base, "sft").where("split = 'test'"))


SHA = "list_reduce(list_prepend(0, list_transform(range(1, 41), lambda i: instr('0123456789abcdef', substring(sha1({0}), i, 1)) - 1)), lambda a, d: (a * 16 + d) % 1000)"


@query(f"SELECT DISTINCT id, {SHA.format('id')} < 300 AS sampled FROM chosen WHERE id IS NOT NULL")
def hash_sample(spark, base):
    return table(spark, base, "chosen").where("id IS NOT NULL").select("id").distinct().withColumn("sampled", steps.hash_sample(F.col("id"), 300))


PAIRS_SQL = f"""k AS (SELECT * FROM (SELECT DISTINCT row_id, chain, kind, k, variant, previous_summary, summary, score, {KEEP_SQL} AS reason FROM chosen) WHERE reason = 'kept'),
 o AS (SELECT * FROM (SELECT row_id, chain, kind, k, previous_summary, summary, score, row_number() OVER (PARTITION BY chain, kind, k ORDER BY row_id DESC) AS rn FROM eval WHERE coalesce("__failed__", '') = '' AND NOT ({BLANK_SQL})) WHERE rn = 1),
 p AS (SELECT k.row_id, o.row_id AS other_id, CASE WHEN coalesce(k.score.fact_coverage_carry - o.score.fact_coverage_carry >= 0.05::DOUBLE, false) OR coalesce(k.score.fact_coverage_new - o.score.fact_coverage_new >= 0.05::DOUBLE, false) THEN 'dropped_facts'
  WHEN coalesce(o.score.over_limit, false) OR {WORDS_SQL.format('o.summary')} > 1.25::DOUBLE * {WORDS_SQL.format('k.summary')} THEN 'padded'
  WHEN coalesce(o.score.bullets, false) OR coalesce(o.score.meta, false) OR coalesce(o.score.think_leak, false) OR coalesce(o.score.echo, false) OR coalesce(o.score.narration, false) THEN 'format' END AS why
  FROM k JOIN o USING (chain, kind, k) WHERE (k.variant = 'base_prev' OR k.k = 0) AND trim(coalesce(k.previous_summary, '')) = trim(coalesce(o.previous_summary, '')) AND {WORDS_SQL.format('o.summary')} > 0 AND trim(k.summary) <> trim(o.summary))"""


def _pairs(spark, base):
    cols = ["row_id", "chain", "kind", "k", "variant", "previous_summary", "summary", "score"]
    kept = table(spark, base, "chosen").where(curation.keep_reason() == "kept").select(*cols).dropDuplicates(["row_id"])
    others = curation.last_of_step(table(spark, base, "eval").drop("created_at", "loaded_at"), ["row_id"])
    return curation.preference_pairs(kept, others)


@query(f"WITH {PAIRS_SQL} SELECT * FROM p WHERE why IS NOT NULL")
def dpo_pairs(spark, base):
    return _pairs(spark, base)


@query(f"WITH {PAIRS_SQL} SELECT why, count(*) AS pairs FROM p WHERE why IS NOT NULL GROUP BY ALL")
def pair_reason_counts(spark, base):
    return _pairs(spark, base).groupBy("why").agg(F.count("*").alias("pairs"))


_OK = "coalesce(\"__failed__\", '') = ''"
_MEASURES = ", ".join(
    [f"count(*) FILTER ({_OK}) AS n"]
    + [f"round(median(score.{c}) FILTER ({_OK}), 3) AS {a}" for a, c in evaluation.MEDIANS.items()]
    + [f"count(*) FILTER ({_OK} AND score.{c}) AS {c}_rows" for c in evaluation.COUNTS]
    + [
        f"count(*) FILTER ({_OK} AND answered_in_thinking) AS answered_in_thinking",
        f"count(*) FILTER ({_OK} AND finish_reason = 'length') AS finish_length",
        f"round(count(*) FILTER ({_OK} AND score.over_limit) / nullif(count(*) FILTER ({_OK}), 0)::DOUBLE, 3) AS over_limit_rate",
        f"round(median(coalesce(latency_s, 0.0::DOUBLE)) FILTER ({_OK}), 1) AS median_latency",
        f"count(*) FILTER (NOT {_OK}) AS failed_rows",
    ]
)


@query(f"SELECT model, kind, {_MEASURES} FROM eval GROUP BY model, kind")
def score_aggregate(spark, base):
    return evaluation.aggregate_runs(table(spark, base, "eval"), ["model", "kind"])


@query(
    f"""SELECT kind, category, k, count(*) AS n, median(score.fact_coverage_new) AS coverage_new, median(score.fact_coverage_carry) AS coverage_carry, count(*) FILTER (score.over_limit) AS over,
 count(*) FILTER (coalesce(score.bullets, false) OR coalesce(score.meta, false) OR coalesce(score.think_leak, false) OR coalesce(score.echo, false) OR coalesce(score.empty, false)) AS flags
 FROM eval WHERE {_OK} GROUP BY GROUPING SETS ((kind, category), (kind, k))"""
)
def score_breakdown(spark, base):
    return evaluation.breakdown(table(spark, base, "eval"))


@query(
    """WITH h AS (SELECT category, model, count(*) FILTER (score.over_limit) AS hits FROM eval GROUP BY ALL)
 SELECT c.category, m.model, h.hits FROM (SELECT DISTINCT category FROM eval) c CROSS JOIN (SELECT DISTINCT model FROM eval) m LEFT JOIN h ON h.category IS NOT DISTINCT FROM c.category AND h.model IS NOT DISTINCT FROM m.model"""
)
def run_compare(spark, base):
    return evaluation.compare_runs(table(spark, base, "eval"), "model", "category", F.col("score.over_limit"))


@query(
    """WITH l AS (SELECT id, run_no, arg_max(words, row_id) AS words FROM eval WHERE run_no IN (1, 2) AND words IS NOT NULL GROUP BY ALL), u AS (SELECT DISTINCT id, run_no FROM eval WHERE run_no IN (1, 2)),
 w AS (SELECT u.id, u.run_no, l.words FROM u LEFT JOIN l ON u.id = l.id AND u.run_no = l.run_no)
 SELECT a.id, a.words AS first_words, b.words AS second_words FROM w a LEFT JOIN w b ON a.id = b.id AND b.run_no = 2 WHERE a.run_no = 1 AND a.id IS NOT NULL"""
)
def run_align(spark, base):
    return evaluation.align_runs(table(spark, base, "eval"), 1, 2)


@query(
    """WITH g AS (SELECT kind, list_sort(list(words)) AS w FROM eval WHERE words IS NOT NULL GROUP BY kind)
 SELECT kind, len(w) AS n, w[1] AS least, w[len(w)] AS most, w[len(w) // 2 + 1] AS middle, w[len(w) * 95 // 100 + 1] AS p95 FROM g"""
)
def order_statistics(spark, base):
    return alignment.order_statistics(table(spark, base, "eval"), ["kind"], "words", {"middle": (1, 2), "p95": (95, 100)})


@query(
    """WITH e AS (SELECT id, row_id, run_no, summary, coalesce("__failed__", '') = '' AS good FROM eval WHERE id IS NOT NULL)
 SELECT id, arg_max(row_id, (CASE WHEN good THEN 1 ELSE 0 END) * 1e15::DOUBLE + (CASE WHEN run_no > 1 THEN 1 ELSE 0 END) * 1e12::DOUBLE + row_id) AS row_id FROM e GROUP BY id"""
)
def upsert_rows(spark, base):
    rows = table(spark, base, "eval").where("id IS NOT NULL").select("id", "row_id", "run_no", "__failed__")
    return maintenance.upsert(rows.where("run_no <= 1"), rows.where("run_no > 1 OR run_no IS NULL")).select("id", "row_id")


_STEP_ROWS = """s AS (SELECT chain, kind, k, bool_and(coalesce("__failed__", '') <> '') AS bad FROM chosen WHERE variant = 'clean' AND chain IS NOT NULL AND k IS NOT NULL GROUP BY chain, kind, k)"""


def _step_rows(spark, base):
    rows = table(spark, base, "chosen").where("variant = 'clean' AND chain IS NOT NULL AND k IS NOT NULL")
    bad = F.bool_and(curation.failed())
    return rows.groupBy("chain", "kind", "k").agg(F.when(bad, F.lit("failed")).alias("__failed__"))


@query(
    f"""WITH {_STEP_ROWS} SELECT chain, kind, k, coalesce(bool_or(bad) OVER w, false) OR count(*) OVER w < k AS stale FROM s
 WINDOW w AS (PARTITION BY chain, kind ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""
)
def stale_propagation(spark, base):
    return maintenance.stale_steps(_step_rows(spark, base))


@query(
    f"""WITH {GOOD}, {STEPS}, {_STEP_ROWS}, done AS (SELECT chain, kind, k FROM s WHERE NOT bad), miss AS (SELECT chain, kind, k FROM steps EXCEPT SELECT chain, kind, k FROM done)
 SELECT m.chain, m.kind, m.k FROM miss m WHERE m.k = 0 OR EXISTS (SELECT 1 FROM done d WHERE d.chain = m.chain AND d.kind = m.kind AND d.k = m.k - 1)"""
)
def ready_wave(spark, base):
    wanted = steps.steps(_good(spark, base)).select("chain", "kind", "k")
    return maintenance.ready_wave(wanted, _step_rows(spark, base).where("`__failed__` IS NULL"))


@query(
    f"""WITH {GOOD}, {STEPS}, {_STEP_ROWS} SELECT DISTINCT chain, kind FROM (SELECT chain, kind, k FROM steps EXCEPT SELECT chain, kind, k FROM s WHERE NOT bad)"""
)
def resume_todo(spark, base):
    wanted = steps.steps(_good(spark, base)).select("chain", "kind", "k")
    return maintenance.unfinished(wanted, _step_rows(spark, base))


@query(
    """WITH j AS (SELECT DISTINCT row_id, model, coalesce(prompt_tokens, 0) + 4 * coalesce(completion_tokens, 0) AS units FROM eval),
 r AS (SELECT row_id, model, units, CAST(coalesce(sum(units) OVER (PARTITION BY model ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS spent_before FROM j)
 SELECT row_id, spent_before, spent_before <= 1000000 AS runs FROM r"""
)
def running_spend_cap(spark, base):
    units = (F.coalesce("prompt_tokens", F.lit(0)) + 4 * F.coalesce("completion_tokens", F.lit(0))).cast("long")
    jobs = table(spark, base, "eval").select("row_id", "model", units.alias("units")).distinct()
    return maintenance.running_spend(jobs, "units", "row_id", 1_000_000, "model").select("row_id", "spent_before", "runs")


@query(
    """SELECT model, CAST(sum((length(coalesce(previous_summary, '')) + 3) // 4 + 8) AS BIGINT) AS input_tokens, CAST(sum(least(max_tokens, CAST(floor(output_words * 1.4::DOUBLE) AS INTEGER))) AS BIGINT) AS output_tokens FROM eval GROUP BY model"""
)
def token_estimate(spark, base):
    asked = tx.token_estimate(F.col("previous_summary")) + 8
    return table(spark, base, "eval").groupBy("model").agg(
        F.sum(asked).alias("input_tokens"),
        F.sum(F.least("max_tokens", F.floor(F.col("output_words") * F.lit(1.4)).cast("int"))).alias("output_tokens"),
    )


@query(
    f"""WITH {GOOD}, m AS (SELECT id AS chain, x.seq AS seq, x.text AS text FROM good, LATERAL (SELECT unnest(messages) AS x)),
 f AS (SELECT id AS chain, CAST(p - 1 AS INTEGER) AS pos, facts[p].text AS fact FROM good, LATERAL (SELECT unnest(range(1, coalesce(len(facts), 0) + 1)) AS p) WHERE coalesce(facts[p].text, '') <> '')
 SELECT f.chain, f.pos, min(m.seq) AS seq FROM f LEFT JOIN m ON m.chain = f.chain AND contains(lower(m.text), lower(f.fact)) GROUP BY ALL"""
)
def first_seen_fact(spark, base):
    return repair.first_mentions(_good(spark, base))


@query(f"WITH {GOOD} SELECT id AS chain, CAST(len(coalesce(messages, [])) AS INTEGER) AS messages FROM good")
def dedup_first(spark, base):
    return _good(spark, base).select(F.col("id").alias("chain"), F.coalesce(F.size("messages"), F.lit(0)).alias("messages"))


@query()
def json_repair(spark, base):
    """The object in every delivered payload; tested on small payloads."""
    return repair.repaired_json(table(spark, base, "chain_raw"), "record_id", "payload")


@query(
    """WITH s AS (SELECT DISTINCT row_id, messages FROM sft), t AS (SELECT row_id, CAST(i - 1 AS INTEGER) AS turn, coalesce(messages[i].content, '') AS target, messages[i].role AS role FROM s, LATERAL (SELECT unnest(range(1, len(messages) + 1)) AS i))
 SELECT row_id, turn, turn AS prefix_turns, length(target) AS target_chars FROM t WHERE role = 'assistant'"""
)
def sft_targets(spark, base):
    rows = table(spark, base, "sft").select("row_id", "messages").distinct()
    return training.trainable_turns(rows).select("row_id", "turn", F.size("prefix").alias("prefix_turns"), F.length("target").alias("target_chars"))


def _encoded(spark, base):
    pairs = table(spark, base, "dpo").select("row_id", F.expr("try_element_at(prompt, -1).content").alias("asked"), "chosen").distinct()
    ids = pairs.select("row_id", training.word_ids(F.col("asked")).alias("p"), training.word_ids(F.col("chosen")).alias("t"))
    return ids.select("row_id", *training.encode(F.col("p"), F.col("t"), 4096))


_IDS = "list_transform(list_filter(regexp_split_to_array(coalesce({0}, ''), '\\s+'), lambda w: w <> ''), lambda w: CAST(('0x' || substring(md5(w), 1, 7))::BIGINT % 50000 AS INTEGER))"
_ENC = f"""e AS (SELECT row_id, {_IDS.format('asked')} AS p, {_IDS.format('chosen')} AS t FROM (SELECT DISTINCT row_id, prompt[-1].content AS asked, chosen FROM dpo))"""


@query(
    f"""WITH {_ENC} SELECT row_id, CAST(len(p) + len(t) AS INTEGER) AS n, CAST(len(t) AS INTEGER) AS trained, CAST(coalesce(list_sum(t), 0) AS BIGINT) AS label_sum FROM e WHERE len(p) + len(t) <= 4096"""
)
def label_mask(spark, base):
    rows = _encoded(spark, base).where("input_ids IS NOT NULL")
    kept = F.filter("labels", lambda x: x != training.IGNORED)
    return rows.select("row_id", F.size("input_ids").alias("n"), F.size(kept).alias("trained"), F.aggregate(kept, F.lit(0).cast("long"), lambda a, x: a + x).alias("label_sum"))


@query(
    f"""WITH {_ENC}, b AS (SELECT row_id, row_id // 8 AS batch, len(p) + len(t) AS n FROM e WHERE len(p) + len(t) <= 4096) SELECT row_id, CAST(max(n) OVER (PARTITION BY batch) AS INTEGER) AS padded FROM b"""
)
def pad_batch(spark, base):
    rows = _encoded(spark, base).where("input_ids IS NOT NULL").withColumn("batch", F.floor(F.col("row_id") / 8))
    return training.pad_batches(rows.select("row_id", "batch", "input_ids"), "batch", "input_ids", 0).select("row_id", F.size("input_ids").alias("padded"))


_SAID = "CASE WHEN contains(l, ': ') THEN l[:instr(l, ': ') - 1] || ' said ' || rtrim(l[instr(l, ': ') + 2:], '.!?') || '.' ELSE l || ' said .' END"
_SPLIT = "list_filter(regexp_split_to_array({0}, '[\\s\\x1c-\\x1f\\x{{85}}\\p{{Z}}]+'), lambda w: w <> '')"


@query(
    f"""WITH RECURSIVE t AS (SELECT *, 'short' AS kind FROM ({_transcript_sql("short")}) UNION ALL SELECT *, 'long' FROM ({_transcript_sql("long")})),
 s AS (SELECT chain, kind, k, flatten(list_transform(string_split(transcript, chr(10)), lambda l: {_SPLIT.format(_SAID)})) AS ws, CAST(floor(CAST(floor(CASE kind WHEN 'short' THEN least(tokens, 1000) ELSE 4000 END * 0.75::DOUBLE) AS INTEGER) * 0.8::DOUBLE) AS INTEGER) AS room FROM t),
 r AS (SELECT chain, kind, k, ws[:room] AS held FROM s WHERE k = 0 UNION ALL SELECT s.chain, s.kind, s.k, list_concat(r.held, s.ws)[:s.room] FROM r JOIN s ON s.chain = r.chain AND s.kind = r.kind AND s.k = r.k + 1)
 SELECT chain, kind, k, array_to_string(held, ' ') AS summary, NULL::VARCHAR AS error FROM r"""
)
def honest_walk(spark, base):
    """Every chain's steps summarised in order from its own earlier summaries, by a deterministic producer."""
    good = _good(spark, base)
    parts = []
    for kind in ("short", "long"):
        t = steps.transcripts(good, kind)
        parts.append(t.select("chain", F.lit(kind).alias("kind"), "k", "transcript", steps.word_limit(kind, F.col("tokens")).alias("word_limit")))
    return walk.walk(parts[0].unionByName(parts[1]))


@query(
    f"""WITH {GOOD}, l AS (SELECT DISTINCT id AS chain, (x.seq - 1) // 20 AS k, x.text AS line FROM good, LATERAL (SELECT unnest(messages) AS x) WHERE coalesce(x.text, '') <> '' AND (x.seq - 1) // 20 < len(messages) // 20),
 q AS (SELECT row_id, trim(regexp_replace(unnest(string_split(c, chr(10))), '^[^:]*:', '')) AS line FROM (SELECT DISTINCT row_id, regexp_extract(list_filter(messages, lambda m: m.role = 'user')[-1].content, '<conversation>\\s*(.*?)\\s*</conversation>', 1, 's') AS c FROM sft)),
 h AS (SELECT q.row_id, l.chain, l.k, count(DISTINCT q.line) AS hits FROM q JOIN l USING (line) WHERE q.line <> '' GROUP BY ALL)
 SELECT row_id, max(hits) AS hits FROM h GROUP BY row_id"""
)
def best_match(spark, base):
    """For each stored prompt the most lines any step shares with it: an equi-join on lines, no cross join."""
    lines = steps.step_messages(_good(spark, base), "short").where("text <> ''").select("chain", "k", F.col("text").alias("line")).distinct()
    asked = table(spark, base, "sft").select("row_id", F.expr("try_element_at(filter(messages, m -> m.role = 'user'), -1).content").alias("c")).distinct()
    talk = F.regexp_extract("c", r"(?s)<conversation>\s*(.*?)\s*</conversation>", 1)
    sent = asked.select("row_id", F.explode(F.split(talk, "\n")).alias("line")).select("row_id", F.trim(F.regexp_replace("line", r"^[^:]*:", "")).alias("line")).where("line <> ''").distinct()
    hits = sent.join(lines, "line").groupBy("row_id", "chain", "k").agg(F.count("*").alias("hits"))
    return hits.groupBy("row_id").agg(F.max("hits").alias("hits"))
