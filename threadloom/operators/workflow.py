"""Which rows are wanted, which of them can be made next, and which have to be made again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.operators.curation import failed
from threadloom.operators.routing import CUT_END, gave_up, over_budget
from threadloom.operators.steps import hash_sample, step_id
from threadloom.session import materialize

STEP = ["chain", "kind", "k"]


def wanted_rows(steps: DataFrame, produced: DataFrame, per_mille: int = 300) -> DataFrame:
    """(chain, kind, k, variant): every step ``clean``, and ``base_prev`` for sampled ones that another producer's output
    of the step before exists for. ``produced`` holds that producer's good steps."""
    clean = steps.select(*STEP, F.lit("clean").alias("variant"))
    before = produced.select("chain", "kind", (F.col("k") + 1).cast("int").alias("k")).distinct()
    name = F.concat_ws("-", "chain", "kind", F.col("k").cast("string"))
    sampled = steps.where((F.col("k") >= 1) & hash_sample(name, per_mille)).join(before, STEP, "left_semi")
    return clean.unionByName(sampled.select(*STEP, F.lit("base_prev").alias("variant")))


def row_name(variant: str = "variant") -> Column:
    """Id of a wanted row."""
    tail = F.when(F.col(variant) == "base_prev", "b").otherwise("")
    return step_id(F.col("chain"), F.col("kind"), F.col("k"), tail)


def previous_outputs(rows: DataFrame, output: str) -> DataFrame:
    """(chain, kind, k, previous): each step with the output of the step before it, null if there is none."""
    own = rows.select(*STEP)
    before = rows.select("chain", "kind", (F.col("k") + 1).cast("int").alias("k"), F.col(output).alias("previous"))
    return own.join(before, STEP, "left")


def ready_rows(wanted: DataFrame, rows: DataFrame, produced: DataFrame) -> DataFrame:
    """Wanted rows that aren't good and weren't given up, and whose previous output is there.

    ``rows`` has one row an id (id, chain, kind, k, ``__failed__``, attempts); a clean row needs the clean row before
    it, a ``base_prev`` row the other producer's output of that step.
    """
    settled = rows.where(~failed() | gave_up()).select("id")
    open_ = wanted.withColumn("id", row_name()).join(settled, "id", "left_anti")
    good = rows.where(~failed()).select(F.col("id").alias("before"))
    named = open_.withColumn("before", step_id(F.col("chain"), F.col("kind"), F.col("k") - 1, F.lit("")))
    first = named.where("k = 0")
    clean = named.where("k > 0 AND variant = 'clean'").join(good, "before", "left_semi")
    ready = produced.select("chain", "kind", (F.col("k") + 1).cast("int").alias("k")).distinct()
    other = named.where("k > 0 AND variant = 'base_prev'").join(ready, STEP, "left_semi")
    return first.unionByName(clean).unionByName(other.select(*first.columns)).select("id", *STEP, "variant")


def remaining(wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """(kind, todo, given_up): wanted rows still to be made, and those that aren't tried again."""
    state = rows.select("id", failed().alias("bad"), gave_up().alias("gone"), F.lit(True).alias("there"))
    at = wanted.withColumn("id", row_name()).join(state, "id", "left")
    gone = F.coalesce("gone", F.lit(False))
    return at.groupBy("kind").agg(
        F.count_if(~gone & (F.col("there").isNull() | F.col("bad"))).alias("todo"), F.count_if(gone).alias("given_up")
    )


def cut_unmarked(text: str = "summary") -> Column:
    """Rows of before stops were recorded count as cut if they end without a closing mark."""
    return (F.coalesce(F.col(text), F.lit("")) != "") & ~F.col(text).rlike(CUT_END)


def invalidated(rows: DataFrame, pointer: str = "previous_from", rounds: int = 200) -> DataFrame:
    """(id, reason): rows to be made again: ``failed``, ``over_budget``, or ``stale``, made from one of these or from a row
    that isn't there, directly or through others.

    ``rows`` has one row an id; a pointer is null or an id of these rows. Each round follows the pointers one step, as many
    rounds as the longest chain of pointers; it raises if ``rounds`` don't do.
    """
    state = materialize(
        rows.select("id", F.col(pointer).alias("p"), F.when(failed(), "failed").when(over_budget(), "over_budget").alias("reason")), "rows"
    )
    absent = state.where("p IS NOT NULL").join(state.select(F.col("id").alias("p")), "p", "left_anti").select("id")
    bad = state.where("reason IS NOT NULL").select("id", "reason")
    orphans = absent.join(bad, "id", "left_anti").select("id", F.lit("stale").alias("reason"))
    bad = materialize(bad.unionByName(orphans), "bad")
    fresh = bad
    for _ in range(rounds):
        reached = state.join(fresh.select(F.col("id").alias("p")), "p", "left_semi").join(bad, "id", "left_anti")
        fresh = materialize(reached.select("id", F.lit("stale").alias("reason")), "stale")
        if fresh.isEmpty():
            return bad
        bad = materialize(bad.unionByName(fresh), "bad")
    raise RuntimeError(f"pointers did not settle in {rounds} rounds")


def upsert_invalidated(old: DataFrame, new: DataFrame, pointer: str = "previous_from") -> DataFrame:
    """Upsert where old rows count as failed if they are invalidated: a good new row always takes their place."""
    from threadloom.operators.maintenance import upsert

    stale = invalidated(old, pointer)
    viewed = old.join(stale, "id", "left").withColumn("__failed__", F.when(failed(), F.col("`__failed__`")).otherwise(F.col("reason")))
    return upsert(viewed.select(*old.columns), new)


def todo_ids(wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """Wanted ids without a good row."""
    return wanted.select("id").distinct().join(rows.where(~failed()).select("id"), "id", "left_anti")


def run_passes(wanted: DataFrame, rows: DataFrame, produce: Callable[[DataFrame], DataFrame], on_pass: Callable[[DataFrame], None] | None = None, passes: int = 4) -> DataFrame:
    """Produce what is missing until a pass adds nothing good, ``passes`` times at most: what still fails stays to be
    asked for again. ``on_pass`` sees the rows of each pass."""
    from threadloom.operators.maintenance import upsert

    for _ in range(passes):
        todo = materialize(todo_ids(wanted, rows), "todo")
        if todo.isEmpty():
            break
        made = materialize(produce(todo), "made")
        if on_pass:
            on_pass(made)
        rows = materialize(upsert(rows, made.select(*rows.columns)), "rows")
        if made.where(~failed()).isEmpty():
            break
    return rows
