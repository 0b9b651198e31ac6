"""Aggregates of scored rows, breakdowns and comparisons of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.operators.alignment import join_nulls

MEDIANS = {
    "median_words": "words",
    "median_limit_ratio": "limit_ratio",
    "median_coverage_new": "fact_coverage_new",
    "median_coverage_carry": "fact_coverage_carry",
    "median_latest_state": "latest_state",
}
COUNTS = ("over_limit", "fabrication", "bullets", "meta", "think_leak", "narration", "echo", "empty")


def _measures(good: Column) -> list[Column]:
    score = F.col("score")
    return [
        F.count_if(good).alias("n"),
        *[F.round(F.median(F.when(good, score[c])), 3).alias(a) for a, c in MEDIANS.items()],
        *[F.count_if(good & score[c]).alias(f"{c}_rows") for c in COUNTS],
    ]


def aggregate_runs(rows: DataFrame, by: list[str]) -> DataFrame:
    """Medians (nulls skipped) and counts of good rows; failed rows are only counted."""
    good = F.coalesce(F.col("`__failed__`"), F.lit("")) == ""
    return rows.groupBy(*by).agg(
        *_measures(good),
        F.count_if(good & F.col("answered_in_thinking")).alias("answered_in_thinking"),
        F.count_if(good & (F.col("finish_reason") == "length")).alias("finish_length"),
        F.round(F.try_divide(F.count_if(good & F.col("score.over_limit")), F.count_if(good)), 3).alias("over_limit_rate"),
        F.round(F.median(F.when(good, F.coalesce("latency_s", F.lit(0.0)))), 1).alias("median_latency"),
        F.count_if(~good).alias("failed_rows"),
    )


def breakdown(rows: DataFrame) -> DataFrame:
    """(kind, category, k, n, new, carry, over, flags) by category and by k: one pass with grouping sets."""
    good = rows.where(F.coalesce(F.col("`__failed__`"), F.lit("")) == "")
    flat = good.select("kind", "category", "k", *[F.col(f"score.{c}") for c in ("fact_coverage_new", "fact_coverage_carry", *COUNTS)])
    flags = F.lit(False)
    for c in ("bullets", "meta", "think_leak", "echo", "empty"):
        flags = flags | F.coalesce(F.col(c), F.lit(False))
    sets = [[F.col("kind"), F.col("category")], [F.col("kind"), F.col("k")]]
    return flat.groupingSets(sets, F.col("kind"), F.col("category"), F.col("k")).agg(
        F.count("*").alias("n"),
        F.median("fact_coverage_new").alias("coverage_new"),
        F.median("fact_coverage_carry").alias("coverage_carry"),
        F.count_if("over_limit").alias("over"),
        F.count_if(flags).alias("flags"),
    )


def compare_runs(rows: DataFrame, run: str, group: str, value: Column) -> DataFrame:
    """(group, run, hits): a measure of every run in every group that either has; 0 and null are told apart.

    Groups and runs are those of the table, null ones included; a pair without rows has null hits.
    """
    hits = rows.groupBy(group, run).agg(F.count_if(value).alias("hits"))
    every = hits.select(group).distinct().crossJoin(hits.select(run).distinct())  # groups by runs, as the table to read has
    return join_nulls(every, hits, [group, run], "left")


def align_runs(rows: DataFrame, first: int, second: int) -> DataFrame:
    """(id, first_words, second_words): steps of the first run with the second run's words; null where it has none.

    A step's words in a run are those of its last row that has any.
    """
    said = lambda n: F.max_by("words", F.when((F.col("run_no") == n) & F.col("words").isNotNull(), F.col("row_id")))
    both = rows.where(F.col("id").isNotNull() & F.col("run_no").isin(first, second)).groupBy("id").agg(
        F.count_if(F.col("run_no") == first).alias("n"), said(first).alias("first_words"), said(second).alias("second_words")
    )
    return both.where("n > 0").drop("n")
