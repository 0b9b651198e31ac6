"""Which chains and rows take part, and in which order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.operators.curation import failed


def load_chains(chains: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Good chains, restricted to ids (id) if given; raises if none is left or an id stands twice."""
    good = chains.where(~failed())
    if ids is not None:
        good = good.join(ids.select("id").distinct(), "id", "left_semi")
    if good.isEmpty():
        raise ValueError("no chains selected")
    twice = good.groupBy("id").count().where("count > 1").select("id").limit(1).collect()
    if twice:
        raise ValueError(f"chain id {twice[0].id} stands twice")
    return good


def select_chains(sources: list[DataFrame], ids: DataFrame | None = None, extras: list[DataFrame] | None = None, order: str = "received_at") -> DataFrame:
    """The good chains of several sources, restricted to ids if given, then those of the extras, which aren't; the first of
    each id wins. One aggregation on the id, so repeats cost no skew."""
    parts = []
    for place, source in enumerate([*sources, *(extras or [])]):
        good = source.where(F.col("id").isNotNull() & ~failed())
        if ids is not None and place < len(sources):
            good = good.join(ids.select("id").distinct(), "id", "left_semi")
        parts.append(good.withColumn("source", F.lit(place)))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    rank = F.struct("source", order)
    return every.groupBy("id").agg(F.min_by(F.struct(*every.columns), rank).alias("r")).select("r.*")


def first_chains(chains: DataFrame, n: int, order: str = "id") -> DataFrame:
    """The first n by an order: a top-n, no global sort."""
    return chains.orderBy(order).limit(n)


def only(rows: DataFrame, kind: str | None = None, categories: list[str] | None = None, ids: DataFrame | None = None) -> DataFrame:
    """Rows of a kind, of categories and of ids (chain), each if given."""
    if kind is not None:
        rows = rows.where(F.col("kind") == kind)
    if categories is not None:
        rows = rows.where(F.col("category").isin(categories))
    if ids is not None:
        rows = rows.join(ids.select("chain").distinct(), "chain", "left_semi")
    return rows


def with_chain(rows: DataFrame, chains: DataFrame) -> DataFrame:
    """Rows whose chain exists."""
    return rows.join(chains.select(F.col("id").alias("chain")).distinct(), "chain", "left_semi")


def without_chains(chains: DataFrame, used: list[DataFrame]) -> DataFrame:
    """Chains that no row (chain) of the given tables uses."""
    for rows in used:
        chains = chains.join(rows.select(F.col("chain").alias("id")).distinct(), "id", "left_anti")
    return chains


def plan_order(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """rows with ``place``, their place in the plan (id, place), unplanned ones after all others: the key to sort by, then id."""
    return rows.join(plan.select("id", "place"), "id", "left").withColumn("place", F.coalesce("place", F.lit(10**9)))


def text_order(column: str) -> Column:
    """Groups in the order of their names as text, so 10 stands before 2."""
    return F.col(column).cast("string")
