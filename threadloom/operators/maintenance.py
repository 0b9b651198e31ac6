"""Row tables that are resumed, merged and invalidated."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadloom.operators.curation import failed


def upsert(old: DataFrame, new: DataFrame, key: str = "id", order: str = "row_id") -> DataFrame:
    """One row a key: a good row beats a failed one, else the newer table's, else the later row.

    One aggregation on the key, so any number of versions of a key costs no skew.
    """
    both = old.withColumn("_version", F.lit(0)).unionByName(new.withColumn("_version", F.lit(1)))
    rank = F.struct((~failed()).alias("good"), F.col("_version"), F.col(order))
    return both.groupBy(key).agg(F.max_by(F.struct(*old.columns), rank).alias("r")).select("r.*")


def stale_steps(rows: DataFrame) -> DataFrame:
    """(chain, kind, k, stale): rows of a chain and kind after a failed or missing one.

    Rows are one a step. The window holds one chain's steps of a kind.
    """
    earlier = Window.partitionBy("chain", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    broke = F.coalesce(F.bool_or(failed()).over(earlier), F.lit(False)) | (F.count("*").over(earlier) < F.col("k"))
    return rows.select("chain", "kind", "k", broke.alias("stale"))


def ready_wave(wanted: DataFrame, done: DataFrame) -> DataFrame:
    """Wanted steps (chain, kind, k) that aren't done and whose predecessor is; ``done`` holds good steps."""
    have = done.select("chain", "kind", "k").distinct()
    before = have.select("chain", "kind", (F.col("k") + 1).alias("k"))
    missing = wanted.join(have, ["chain", "kind", "k"], "left_anti")
    return missing.where("k = 0").unionByName(missing.where("k > 0").join(before, ["chain", "kind", "k"], "left_semi"))


def run_waves(wanted: DataFrame, done: DataFrame, produce, rounds: int = 1000) -> DataFrame:
    """Waves until none is ready or a wave adds nothing: ``produce`` turns a wave into finished steps. Raises after
    ``rounds`` waves."""
    from threadloom.session import materialize

    for _ in range(rounds):
        wave = materialize(ready_wave(wanted, done), "wave")
        if wave.isEmpty():
            return done
        made = materialize(produce(wave).select("chain", "kind", "k").distinct(), "made")
        if made.isEmpty():
            return done
        done = materialize(done.select("chain", "kind", "k").unionByName(made), "done")
    raise RuntimeError(f"steps are still ready after {rounds} waves")


def unfinished(wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """(chain, kind): those of which some wanted step has no good row."""
    good = rows.where(~failed()).select("chain", "kind", "k").distinct()
    return wanted.join(good, ["chain", "kind", "k"], "left_anti").select("chain", "kind").distinct()


def first_of(rows: DataFrame, key: list, order: list) -> DataFrame:
    """The first row of each key."""
    return rows.groupBy(*key).agg(F.min_by(F.struct(*rows.columns), F.struct(*order)).alias("r")).select("r.*")


def running_spend(jobs: DataFrame, cost: str, order: str, cap: float, by: str, width: int = 10_000) -> DataFrame:
    """Jobs with the spend so far within ``by``, in order of an integer, and whether they still start under the cap.

    Two levels of prefix sums: over stretches of ``width`` consecutive numbers, then within a stretch, so no group is
    sorted in one task.
    """
    cut = jobs.withColumn("_stretch", F.floor(F.col(order) / width))
    zero = F.lit(0).cast(dict(jobs.dtypes)[cost])
    sums = cut.groupBy(by, "_stretch").agg(F.sum(cost).alias("_sum"))
    above = Window.partitionBy(by).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(by, "_stretch", F.coalesce(F.sum("_sum").over(above), zero).alias("_before"))
    within = Window.partitionBy(by, "_stretch").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    near = cut.withColumn("_near", F.coalesce(F.sum(cost).over(within), zero))
    joined = near.join(sums, near["_stretch"].eqNullSafe(sums["_stretch"]) & near[by].eqNullSafe(sums[by]))
    spent = sums["_before"] + near["_near"]
    return joined.select(*[near[c] for c in jobs.columns], spent.alias("spent_before"), (spent <= cap).alias("runs"))
