"""Ordered keep reasons, leak-free splits and preference pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadloom.functions.text import is_blank, word_count

FORMAT_FLAGS = ("bullets", "meta", "think_leak", "narration", "echo")


def failed(column: str = "__failed__") -> Column:
    return F.coalesce(F.col(f"`{column}`"), F.lit("")) != ""


def keep_reason(least: float = 0.9, ratio: float = 0.8) -> Column:
    """Why a scored row is dropped, the first reason that holds; ``kept`` if none. A null coverage passes."""
    score = F.col("score")
    out = F.when(failed() | is_blank(F.col("summary")), "failed_or_empty")
    for name in ("empty", *FORMAT_FLAGS, "fabrication"):
        out = out.when(score[name], name)
    return (
        out.when(score["fact_coverage_new"] < F.lit(least), "low_coverage_new")
        .when(score["fact_coverage_carry"] < F.lit(least), "low_coverage_carry")
        .when(score["latest_state"] < F.lit(1.0), "stale_value")
        .when(F.col("words") > F.lit(ratio) * F.col("output_words"), f"over_{ratio}x_limit")
        .otherwise("kept")
    )


def human_peers(chains: DataFrame) -> DataFrame:
    """Distinct (chain, name): lower-case names of peers that aren't assistants."""
    people = chains.select(F.col("id").alias("chain"), F.explode("peers").alias("p"))
    return people.where(
        (F.coalesce("p.name", F.lit("")) != "") & (F.lower(F.coalesce("p.role", F.lit(""))) != "assistant")
    ).select("chain", F.lower("p.name").alias("name")).distinct()


def _ranked(ids: DataFrame, by: str, seed: str) -> DataFrame:
    """ids with ``place`` (from 1) and ``total`` within ``by``, in the order of the sha1 of seed and chain."""
    hashed = ids.withColumn("h", F.sha1(F.concat(F.lit(seed), "chain"))).withColumn("bucket", F.substring("h", 1, 3))
    per = hashed.groupBy(by, "bucket").agg(F.count("*").alias("n"))  # at most 4,096 rows a group
    before = per.select(
        by,
        "bucket",
        F.coalesce(F.sum("n").over(Window.partitionBy(by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy(by)).alias("total"),
    )
    within = Window.partitionBy(by, "bucket").orderBy("h", "chain")
    return hashed.join(before, [by, "bucket"]).withColumn("place", F.col("before") + F.row_number().over(within))


def persona_split(chains: DataFrame, share: float = 0.3, seed: str = "7") -> DataFrame:
    """(chain, category, split): held-out chains by category, and every chain that shares a human with one of them.

    Within a category chains are ranked by the sha1 of seed and id; ranks come from bucket counts and a window over one
    bucket, so no category is sorted in one task. Where every category has one chain only, the draw is over all chains.
    One hop only: a moved chain moves no further ones.
    """
    ids = chains.select(F.col("id").alias("chain"), F.coalesce("category", F.lit("")).alias("category"))
    part = lambda n: F.greatest(F.lit(1), F.bround(n * F.lit(share)).cast("long"))
    size = F.when(F.col("total") > 1, F.least(F.col("total") - 1, part(F.col("total")))).otherwise(0)
    drawn = _ranked(ids, "category", seed).select("chain", "category", "total", (F.col("place") <= size).alias("held"))
    single = F.broadcast(drawn.agg((F.max("total") == 1).alias("singles"), F.count("*").alias("chains")))  # one row
    every = _ranked(ids.withColumn("one", F.lit(1)), "one", seed).select("chain", F.col("place").alias("overall"))
    fallback = F.col("singles") & (F.col("chains") > 1) & F.lit(share > 0) & (F.col("overall") <= part(F.col("chains")))
    drawn = drawn.join(every, "chain").crossJoin(single).select("chain", "category", (F.col("held") | fallback).alias("held"))
    names = human_peers(chains)
    known = names.join(drawn.where("held").select("chain"), "chain", "left_semi").select("name").distinct()
    near = names.join(known, "name", "left_semi").select("chain").distinct().withColumn("near", F.lit(True))
    return drawn.join(near, "chain", "left").select(
        "chain", "category", F.when(F.col("held") | F.coalesce("near", F.lit(False)), "eval").otherwise("train").alias("split")
    )


def pinned_split(chains: DataFrame, pinned: DataFrame) -> DataFrame:
    """(chain, split) with the held-out chains given; other chains that share a human with one are dropped."""
    ids = chains.select(F.col("id").alias("chain"))
    held = ids.join(pinned.select("chain").distinct(), "chain", "left_semi")
    names = human_peers(chains)
    known = names.join(held, "chain", "left_semi").select("name").distinct()
    clash = names.join(known, "name", "left_semi").select("chain").distinct()
    train = ids.join(held, "chain", "left_anti").join(clash, "chain", "left_anti")
    return held.select("chain", F.lit("eval").alias("split")).unionByName(train.select("chain", F.lit("train").alias("split")))


def last_of_step(rows: DataFrame, order: list[str]) -> DataFrame:
    """The last good row of each step."""
    good = rows.where(~failed() & ~is_blank(F.col("summary")))
    return good.groupBy("chain", "kind", "k").agg(F.max_by(F.struct(*rows.columns), F.struct(*order)).alias("r")).select("r.*")


def preference_pairs(kept: DataFrame, others: DataFrame, gap: float = 0.05) -> DataFrame:
    """(row_id, other_id, why): another producer's answer to the same prompt that is measurably worse.

    ``others`` has one row a step. Reasons in order: dropped_facts, padded, format; an answer that isn't worse is out.
    """
    c, r = kept.alias("c"), others.alias("r")
    cs, rs = F.col("c.score"), F.col("r.score")
    lost = F.lit(False)
    for name in ("fact_coverage_carry", "fact_coverage_new"):
        lost = lost | F.coalesce(cs[name] - rs[name] >= F.lit(gap), F.lit(False))
    formed = F.lit(False)
    for name in FORMAT_FLAGS:
        formed = formed | F.coalesce(rs[name], F.lit(False))
    mine, theirs = word_count(F.col("c.summary")), word_count(F.col("r.summary"))
    held = lambda x: F.trim(F.coalesce(F.col(f"{x}.previous_summary"), F.lit("")))
    why = (
        F.when(lost, "dropped_facts")
        .when(F.coalesce(rs["over_limit"], F.lit(False)) | (theirs > F.lit(1.25) * mine), "padded")
        .when(formed, "format")
    )
    same = (
        ((F.col("c.variant") == "base_prev") | (F.col("c.k") == 0))
        & (held("c") == held("r"))
        & (theirs > 0)
        & (F.trim("c.summary") != F.trim("r.summary"))
    )
    keys = [F.col(f"c.{x}") == F.col(f"r.{x}") for x in ("chain", "kind", "k")]
    return c.join(r, keys).where(same).select(F.col("c.row_id"), F.col("r.row_id").alias("other_id"), why.alias("why")).where("why IS NOT NULL")
