"""Scores of summaries against their chain's ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions.text import FLAGS, anchors, flag, has_fact, is_blank, normalise, tokens, word_count
from threadloom.operators.steps import steps
from threadloom.session import materialize


def ledger(chains: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Facts (chain, pos, fact_id, text, first_seq), changes (chain, old, new, seq), distractors (chain, text)."""
    facts = chains.select(F.col("id").alias("chain"), F.posexplode("facts").alias("pos", "f")).where(
        "f.id IS NOT NULL AND f.first_seq IS NOT NULL"
    ).select("chain", "pos", F.col("f.id").alias("fact_id"), F.coalesce("f.text", F.lit("")).alias("text"), "f.first_seq")
    changes = chains.select(F.col("id").alias("chain"), F.explode("changes").alias("c")).where("c.seq IS NOT NULL").select(
        "chain", F.col("c.fact_id").alias("old"), F.col("c.superseded_by").alias("new"), "c.seq"
    )
    distractors = chains.select(F.col("id").alias("chain"), F.explode("distractors").alias("d")).where("d.text IS NOT NULL").select("chain", "d.text")
    return facts, changes, distractors


def changed_facts(chains: DataFrame) -> DataFrame:
    """(chain, seq, old, new, old_text, new_text): changes with the texts of both facts, empty where there is none."""
    facts, changes, _ = ledger(chains)
    text = facts.groupBy("chain", "fact_id").agg(F.max_by("text", "pos").alias("text"))
    out = changes
    for side in ("old", "new"):
        named = text.select("chain", F.col("fact_id").alias(side), F.col("text").alias(f"{side}_text"))
        out = out.join(named, ["chain", side], "left")
    return out.select("chain", "seq", "old", "new", *[F.coalesce(f"{s}_text", F.lit("")).alias(f"{s}_text") for s in ("old", "new")])


def facts_due(chains: DataFrame) -> DataFrame:
    """(chain, kind, k, pos, fact_id, text, due): facts a step must state, ``new`` or ``carry``; superseded ones never.

    The join is on the chain with the message number as a further condition, and the superseded are taken out by an
    anti join; both are bounded by a chain's ledger.
    """
    facts, changes, _ = ledger(chains)
    at = steps(chains)
    met = at.join(facts, "chain").where("first_seq <= hi")
    gone = changes.where("old IS NOT NULL").select("chain", F.col("old").alias("fact_id"), "seq")
    live = met.join(
        gone.groupBy("chain", "fact_id").agg(F.min("seq").alias("gone_at")), ["chain", "fact_id"], "left"
    ).where("gone_at IS NULL OR gone_at > hi")
    return live.select(
        "chain", "kind", "k", "pos", "fact_id", "text", F.when(F.col("first_seq") >= F.col("lo"), "new").otherwise("carry").alias("due")
    )


def due_counts(chains: DataFrame) -> DataFrame:
    """(chain, kind, k, n_new, n_carry) of every step, zeros included."""
    due = facts_due(chains).groupBy("chain", "kind", "k").agg(
        F.count_if(F.col("due") == "new").alias("n_new"), F.count_if(F.col("due") == "carry").alias("n_carry")
    )
    zero = F.lit(0).cast("long")
    return steps(chains).join(due, ["chain", "kind", "k"], "left").select(
        "chain", "kind", "k", F.coalesce("n_new", zero).alias("n_new"), F.coalesce("n_carry", zero).alias("n_carry")
    )


def score_rows(rows: DataFrame, chains: DataFrame, key: str = "row_id") -> DataFrame:
    """Each row (key, chain, kind, k, summary, output_words) scored against its step's ledger.

    Texts and facts are normalised and tokenised once each, before they meet. An empty or narrating summary misses all
    that was due; a coverage with nothing due is null.
    """
    asked = rows.select(key, "chain", "kind", "k", F.coalesce("summary", F.lit("")).alias("summary"), "output_words").dropDuplicates([key])
    words = word_count(F.col("summary"))
    base = asked.select(
        key, "chain", "kind", "k", "output_words", words.alias("words"), *[flag(F.col("summary"), f).alias(f) for f in FLAGS], normalise(F.col("summary")).alias("t")
    )
    base = materialize(base.withColumn("tk", tokens(F.col("t"))), "texts")
    usable = base.where("words > 0 AND NOT narration")
    names = chains.select(
        F.col("id").alias("chain"),
        F.expr("transform(filter(coalesce(peers, array()), p -> p IS NOT NULL AND coalesce(p.name, '') <> ''), p -> lower(p.name))").alias("names"),
    )
    _, _, distractors = ledger(chains)

    def prepared(df: DataFrame, text: str) -> DataFrame:
        out = df.join(names, "chain").withColumn("_n", normalise(F.col(text)))
        return out.withColumns({"f": F.trim("_n"), "a": anchors(tokens(F.col("_n")), F.col("names"))}).drop("names", "_n")

    due = materialize(prepared(facts_due(chains), "text").select("chain", "kind", "k", "pos", "due", "f", "a"), "due")
    cover = (
        usable.select(key, "chain", "kind", "k", "t", "tk")
        .join(due, ["chain", "kind", "k"])
        .select(key, "due", has_fact("t", "tk", "f", "a").alias("hit"))
        .groupBy(key)
        .agg(*[F.avg(F.when(F.col("due") == d, F.col("hit").cast("double"))).alias(f"fact_coverage_{d}") for d in ("new", "carry")])
    )
    news = prepared(changed_facts(chains).select("chain", "seq", F.col("new_text").alias("text")), "text").select("chain", "seq", "f", "a")
    at = steps(chains).select("chain", "kind", "k", "hi")
    states = (
        base.select(key, "chain", "kind", "k", "t", "tk", (F.col("words").eqNullSafe(0) | F.col("narration")).alias("unusable"))
        .join(at, ["chain", "kind", "k"])
        .join(news, "chain")
        .where("seq <= hi")
        .select(key, (F.when(F.col("unusable"), F.lit(False)).otherwise(has_fact("t", "tk", "f", "a"))).cast("double").alias("hit"))
        .groupBy(key)
        .agg(F.avg("hit").alias("latest_state"))
    )
    wrong = prepared(distractors, "text").select("chain", "f", "a")
    fabricated = (
        usable.select(key, "chain", "t", "tk")
        .join(wrong, "chain")
        .select(key, has_fact("t", "tk", "f", "a", strict=True).alias("hit"))
        .groupBy(key)
        .agg(F.bool_or("hit").alias("fabrication"))
    )
    counts = due_counts(chains)
    limit = F.col("output_words")
    lost = (F.col("words") == 0) | F.col("narration")

    def coverage(d: str):
        value = F.when(lost, F.lit(0.0)).otherwise(F.col(f"fact_coverage_{d}"))
        return F.when(F.col(f"n_{d}") > 0, F.bround(value, 3)).alias(f"fact_coverage_{d}")

    return (
        base.drop("t", "tk")
        .join(counts, ["chain", "kind", "k"])
        .join(cover, key, "left")
        .join(states, key, "left")
        .join(fabricated, key, "left")
        .select(
            key,
            "words",
            F.when(F.coalesce(limit, F.lit(0)) != 0, F.bround(F.col("words") / limit, 3)).alias("limit_ratio"),
            F.coalesce((limit != 0) & (F.col("words") > limit), F.lit(False)).alias("over_limit"),
            (F.col("words") == 0).alias("empty"),
            *FLAGS,
            "n_new",
            "n_carry",
            coverage("new"),
            coverage("carry"),
            F.bround("latest_state", 3).alias("latest_state"),
            F.coalesce("fabrication", F.lit(False)).alias("fabrication"),
        )
    )


SCORED = ("empty", *FLAGS, "fact_coverage_new", "fact_coverage_carry", "latest_state", "fabrication", "over_limit", "limit_ratio", "n_new", "n_carry")


def rescore(rows: DataFrame, chains: DataFrame, key: str = "row_id") -> DataFrame:
    """Rows with words and score as the scorer gives them now; failed and blank rows, and those of no known step, keep
    what is stored. Scoring again changes nothing."""
    once = rows.dropDuplicates([key])
    fresh = score_rows(once.where((F.coalesce(F.col("`__failed__`"), F.lit("")) == "") & ~is_blank(F.col("summary"))), chains, key)
    fresh = fresh.select(key, F.struct("*").alias("_s"))
    joined = once.join(fresh, key, "left")
    pick = lambda c: F.when(F.col("_s").isNotNull(), F.col(f"_s.{c}")).otherwise(F.col(f"score.{c}")).alias(c)
    words = F.when(F.col("_s").isNotNull(), F.col("_s.words")).otherwise(F.col("words"))
    fields = [c for c in ("words", *SCORED) if c in rows.schema["score"].dataType.names]
    return joined.withColumns({"score": F.struct(*[pick(c) for c in fields]), "words": words}).drop("_s")
