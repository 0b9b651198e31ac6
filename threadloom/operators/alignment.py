"""Order statistics, runs side by side, and prompts against the steps they were made from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def join_nulls(left: DataFrame, right: DataFrame, by: list[str], how: str = "inner") -> DataFrame:
    """A join in which null keys equal each other; the right side's keys are dropped."""
    renamed = right.select(*[F.col(c).alias(f"_right_{c}" if c in by else c) for c in right.columns])
    same = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in by]
    return left.join(renamed, same, how).drop(*[f"_right_{c}" for c in by])


def order_statistics(rows: DataFrame, by: list[str], value: str, shares: dict[str, tuple[int, int]], width: int = 1000) -> DataFrame:
    """by, n, least, most and for each name the value at place n * a div b of a group's sorted values, counted from 0.

    (1, 2) gives the upper median, (95, 100) the value at 95 of 100. Places come from counts: first over stretches of
    ``width``, then over the distinct values of the one stretch that holds the place, so no group is sorted in one task.
    """
    counted = rows.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("v")).agg(F.count("*").alias("c"))
    counted = counted.withColumn("_s", F.floor(F.col("v") / width))
    wide = counted.groupBy(*by, "_s").agg(F.sum("c").alias("c"), F.min("v").alias("least"), F.max("v").alias("most"))
    before = Window.partitionBy(*by).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    placed = wide.withColumn("_b", F.coalesce(F.sum("c").over(before), F.lit(0)))
    groups = wide.groupBy(*by).agg(F.sum("c").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
    out = groups
    for name, (a, b) in shares.items():
        target = groups.select(*by, F.floor(F.col("n") * a / b).cast("long").alias("_t"))
        hit = join_nulls(placed, target, by).where("_t >= _b AND _t < _b + c").select(*by, "_s", "_b", "_t")
        inside = join_nulls(counted, hit, [*by, "_s"]).select(*by, "v", "c", "_b", "_t")
        upto = Window.partitionBy(*by).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
        found = (
            inside.withColumn("_e", F.col("_b") + F.sum("c").over(upto))
            .where("_e > _t")
            .groupBy(*by)
            .agg(F.min("v").alias(name))
        )
        out = join_nulls(out, found, by)
    return out


def metric_table(aggregates: DataFrame, by: list[str], run: str) -> DataFrame:
    """by, metric, run, value: aggregates of runs one metric a row, the form in which any number of runs compare."""
    metrics = [c for c, t in aggregates.dtypes if c not in (*by, run) and t in ("bigint", "int", "double")]
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])).alias("x")
    return aggregates.select(*by, run, pairs).select(*by, run, "x.metric", "x.value")


def align_to_first(rows: DataFrame, first: int, value: str, run: str = "run_no", key: str = "id", order: str = "row_id") -> DataFrame:
    """key, run, first value, value: the first run's steps beside every other run, null where that has none.

    A step's value in a run is that of its last row there. Any number of runs; one aggregation, then a join on the step.
    """
    last = rows.groupBy(key, run).agg(F.max_by(value, order).alias("value"))
    base = last.where(F.col(run) == first).select(key, F.col("value").alias("first_value"))
    others = last.where(F.col(run) != first).join(base.select(key), key, "left_semi").select(key, run, "value")
    return base.join(others, key, "left").select(key, run, "first_value", "value")


def prompt_differences(sent: DataFrame, lines: DataFrame, key: str = "row_id") -> DataFrame:
    """key, chain, k, hits, missing, extra: the step that shares most lines with a sent prompt, the first of equals.

    ``sent``: distinct (key, line) of prompts, ``lines``: distinct (chain, k, line) of steps. missing is how many of the
    step's lines the prompt lacks, extra how many of the prompt's lines the step lacks. An equi-join on lines.
    """
    hits = sent.join(lines, "line").groupBy(key, "chain", "k").agg(F.count("*").alias("hits"))
    best = hits.groupBy(key).agg(F.min_by(F.struct("chain", "k", "hits"), F.struct(-F.col("hits"), "chain", "k")).alias("b")).select(key, "b.*")
    step_size = lines.groupBy("chain", "k").agg(F.count("*").alias("all"))
    sent_size = sent.groupBy(key).agg(F.count("*").alias("sent"))
    return (
        best.join(step_size, ["chain", "k"])
        .join(sent_size, key)
        .select(key, "chain", "k", "hits", (F.col("all") - F.col("hits")).alias("missing"), (F.col("sent") - F.col("hits")).alias("extra"))
    )


def anchors_held(rows: DataFrame, posted: DataFrame) -> DataFrame:
    """rows with ``anchor_seq``, the number of the message their ``summary_message_id`` names, and ``anchor_ok``, whether
    that is the step's last one; null where no message has the id. ``posted``: (chain, seq, message_id)."""
    named = posted.where("message_id IS NOT NULL").groupBy("chain", F.col("message_id").alias("summary_message_id")).agg(F.min("seq").alias("anchor_seq"))
    return rows.join(named, ["chain", "summary_message_id"], "left").withColumn("anchor_ok", F.col("anchor_seq") == F.col("messages_through"))


def harness_report(rows: DataFrame, by: list[str]) -> DataFrame:
    """by, rows, not_stored_rows, misanchored_rows (unknown anchors are none), median_wait_s."""
    return rows.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.count_if(~F.col("stored")).alias("not_stored_rows"),
        F.count_if(~F.col("anchor_ok")).alias("misanchored_rows"),
        F.round(F.median("waited_s"), 1).alias("median_wait_s"),
    )
