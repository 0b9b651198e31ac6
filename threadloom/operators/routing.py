"""Row predicates and routes: what happens to a produced row next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadloom.functions.text import is_blank
from threadloom.operators.curation import failed

ACCEPTED, ATTEMPTS = 0.8, 3
CUT_END = "[.!?\"”)\\]]\\s*$"


def over_budget() -> Column:
    """More words than the accepted share of the limit; false without a summary or a limit."""
    limit = F.coalesce("output_words", F.lit(0))
    return ~is_blank(F.col("summary")) & (limit > 0) & (F.coalesce("words", F.lit(0)) > F.lit(ACCEPTED) * limit)


def gave_up() -> Column:
    return failed() & (F.coalesce("attempts", F.lit(0)) >= ATTEMPTS)


def outcome(reason: str = "stop_reason") -> Column:
    """failed, empty, truncated (the producer hit its cap), over_budget or good, the first that holds."""
    return (
        F.when(failed(), "failed")
        .when(is_blank(F.col("summary")), "empty")
        .when(F.coalesce(reason, F.lit("")).isin("max_tokens", "length"), "truncated")
        .when(over_budget(), "over_budget")
        .otherwise("good")
    )


def scored_outcomes(rows: DataFrame, scores: DataFrame, key: str = "row_id", reason: str = "stop_reason") -> DataFrame:
    """Distinct rows' key, outcome and scores; rows that failed, are empty or hit their cap have none."""
    told = rows.select(key, outcome(reason).alias("outcome")).distinct()
    scored = told.where(F.col("outcome").isin("good", "over_budget")).select(key).join(scores, key)
    return told.join(scored, key, "left")


def next_job() -> Column:
    """How a row is produced again: compressed if it was merely too long, the last time said so; else afresh."""
    cut = F.coalesce("stop_reason", F.lit("")).isin("max_tokens", "length")
    return (
        F.when(~failed() & ~over_budget(), "none")
        .when(gave_up(), "give_up")
        .when(over_budget() & ~cut, F.when(F.coalesce("attempts", F.lit(0)) >= ATTEMPTS - 1, "compress_last").otherwise("compress"))
        .otherwise("fresh")
    )


def valid_name(name: Column) -> Column:
    return F.coalesce(name, F.lit("")).rlike("^[a-zA-Z0-9_-]{1,64}$")


def until_failure(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """Rows up to and including each group's first failed one: its place is aggregated and joined back."""
    first = rows.where(failed()).groupBy(*by).agg(F.min(order).alias("_first"))
    return rows.join(first, by, "left").where(F.col("_first").isNull() | (F.col(order) <= F.col("_first"))).drop("_first")


def longest_streak(rows: DataFrame, by: list[str], order: str, holds: Column, width: int = 10_000) -> DataFrame:
    """(by, streak): the most rows in a row, in order of an integer, for which ``holds`` is true.

    Islands are found within stretches of ``width`` consecutive numbers and the stretches' summaries (rows, best streak,
    streak at the start and at the end) folded in order, so no group is sorted in one task.
    """
    cut = rows.select(*by, order, holds.alias("_h"), F.floor(F.col(order) / width).alias("_s"))
    so_far = Window.partitionBy(*by, "_s").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    islands = cut.withColumn("_island", F.sum((~F.col("_h")).cast("int")).over(so_far)).groupBy(*by, "_s", "_island").agg(
        F.count_if("_h").alias("n"), F.count("*").alias("rows")
    )
    parts = islands.groupBy(*by, "_s").agg(
        F.sum("rows").alias("rows"),
        F.max("n").alias("best"),
        F.coalesce(F.max(F.when(F.col("_island") == 0, F.col("n"))), F.lit(0).cast("long")).alias("head"),
        F.max_by("n", "_island").alias("tail"),
    )
    folded = parts.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("_s", "rows", "best", "head", "tail"))).alias("parts"))
    fold = (
        "aggregate(parts, named_struct('best', 0L, 'run', 0L), (a, p) -> named_struct("
        "'best', greatest(a.best, p.best, a.run + p.head), 'run', CASE WHEN p.head = p.rows THEN a.run + p.rows ELSE p.tail END), a -> a.best)"
    )
    return folded.select(*by, F.expr(fold).alias("streak"))
