"""Splits that keep related records together.

Method: records that share an entity are linked in a star around the least record of the entity. Hash-to-min: in each
round every node sends its cluster to the cluster's minimum and that minimum to all members, until nothing changes;
then the least node of a component holds it whole and every other node holds only that minimum. Weighted rendezvous
hashing gives each component one of the splits.

Clusters are rows (node, member), never arrays, so a component or an entity with a third of all records is never
gathered in one task: minima are aggregated before the shuffle, and both sides of each join come straight from a
shuffle, which lets adaptive execution split a hot key. Rounds are tables in the shared folder.

Defined cases: null, blank and placeholder names link nobody; records without names are components of their own; rows
written twice count once; an empty table has no components.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.session import drop_materialized, materialize

#: Names that name nobody (fixed values).
NOBODY = ["", "user", "guest", "unknown", "n/a"]
_INVISIBLE = dict.fromkeys([0x200B, 0x2060, 0xFEFF, 0x180E], " ")


@F.pandas_udf(T.StringType())
def name_key(names: pd.Series) -> pd.Series:
    """Names without regard to case, to composed or decomposed accents and to kind, number and place of spaces."""

    def key(name: str | None) -> str | None:
        if name is None:
            return None
        folded = unicodedata.normalize("NFC", unicodedata.normalize("NFD", name).casefold())
        return " ".join(folded.translate(_INVISIBLE).split())

    return names.map(key, na_action="ignore")


def human_names(chains: DataFrame) -> DataFrame:
    """Distinct (id, name): the keys of the humans of each chain."""
    role = F.lower(F.regexp_replace(F.coalesce("p.role", F.lit("")), r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    people = (
        chains.where("id IS NOT NULL")
        .select("id", F.explode("peers").alias("p"))
        .where(F.col("p.name").isNotNull() & (role != "assistant"))
        .select("id", F.col("p.name").alias("name"))
        .distinct()
    )
    return people.select("id", name_key("name").alias("name")).where(~F.col("name").isin(NOBODY)).distinct()


def star_edges(membership: DataFrame, node: str, entity: str) -> DataFrame:
    """(a, b), a < b: every node of an entity with the entity's least node; entities of one node have no edge."""
    least = materialize(
        membership.groupBy(entity).agg(F.min(node).alias("a"), F.max(node).alias("z")).where("a < z").drop("z"), "least"
    )
    return (
        membership.join(least, entity)
        .where(F.col("a") < F.col(node))
        .select("a", F.col(node).alias("b"))
        .distinct()
    )


def hash_to_min(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(root, member) of each component of two or more nodes, the root included, from edges (a, b)."""
    forth = edges.select(F.col("a").alias("v"), F.col("b").alias("u"))
    back = edges.select(F.col("b").alias("v"), F.col("a").alias("u"))
    loops = forth.select("v", F.col("v").alias("u")).union(back.select("v", F.col("v").alias("u")))
    clusters = materialize(forth.union(back).union(loops).distinct(), "clusters")
    before = None
    for _ in range(max_rounds):
        minima = materialize(clusters.groupBy("v").agg(F.min("u").alias("m")), "minima")
        sent = clusters.join(minima, "v")
        following = materialize(
            sent.select(F.explode(F.array(F.struct(F.col("m").alias("v"), "u"), F.struct(F.col("u").alias("v"), F.col("m").alias("u")))).alias("x"))
            .select("x.*")
            .distinct(),
            "clusters",
        )
        now = following.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("h")
        ).first()
        drop_materialized(clusters)
        drop_materialized(minima)
        clusters = following
        if before == now:
            return clusters.where("v <= u").select(F.col("v").alias("root"), F.col("u").alias("member"))
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def chain_components(chains: DataFrame) -> DataFrame:
    """(root, member) of each group of two or more chains with humans in common, tied directly or through others."""
    return hash_to_min(star_edges(materialize(human_names(chains), "names"), "id", "name"))


def assign_splits(
    members: DataFrame, components: DataFrame, node: str, stratum: str, weights: dict[str, float], rounds: int = 5, seed: str = "s1"
) -> DataFrame:
    """(node, stratum, root, split): one split for all nodes of a component.

    ``members`` has (node, stratum); nodes in no component are their own. A component prefers the split with the least
    -ln(hash) / weight. The weights are those asked for, corrected per stratum in a few rounds so that the shares of
    nodes come as near to them as the groups allow; a component too large for a split's share of its stratum never
    takes it. The corrections are one small row per stratum and split, joined, not collected.
    """
    names = sorted(weights)
    total = sum(weights.values())
    share = {s: weights[s] / total for s in names}
    nodes = members.select(node, F.coalesce(stratum, F.lit("")).alias("stratum")).groupBy(node).agg(F.min("stratum").alias("stratum"))
    rooted = materialize(
        nodes.join(components.select(F.col("member").alias(node), "root"), node, "left").select(
            node, "stratum", F.coalesce("root", node).alias("root")
        ),
        "rooted",
    )
    # A component counts in the stratum where it has most nodes.
    sizes = (
        rooted.groupBy("root", "stratum")
        .agg(F.count("*").alias("n"))
        .groupBy("root")
        .agg(F.sum("n").alias("n"), F.max_by("stratum", F.struct(F.col("n"), F.col("stratum"))).alias("stratum"))
    )
    pulls = [
        (-F.log((F.pmod(F.xxhash64(F.lit(seed), F.lit(s), "root"), F.lit(1 << 40)) + F.lit(0.5)) / F.lit(float(1 << 40)))).alias(f"pull_{s}")
        for s in names
    ]
    sizes = materialize(sizes.select("root", "stratum", "n", *pulls), "sizes")
    strata = sizes.groupBy("stratum").agg(F.sum("n").alias("all"))
    state = strata.select("stratum", "all", *[F.lit(share[s]).alias(f"w_{s}") for s in names])
    state = materialize(state.coalesce(1), "weights")
    largest = max(names, key=lambda s: (share[s], s))

    def choose(state: DataFrame) -> DataFrame:
        at = sizes.join(state, "stratum")
        options = [
            F.struct(
                F.when((F.col("n") > F.lit(share[s]) * F.col("all")) & F.lit(s != largest), F.lit(float("inf")))
                .otherwise(F.col(f"pull_{s}") / F.col(f"w_{s}"))
                .alias("cost"),
                F.lit(s).alias("split"),
            )
            for s in names
        ]
        return at.select("root", "stratum", "n", "all", F.array_min(F.array(*options))["split"].alias("split"))

    for _ in range(rounds):
        got = choose(state).groupBy("stratum").agg(*[F.sum(F.when(F.col("split") == s, F.col("n")).otherwise(0)).alias(f"got_{s}") for s in names])
        # Half a step on a log scale; a split that got nothing counts as half a node.
        state = materialize(
            state.join(got, "stratum")
            .select(
                "stratum",
                "all",
                *[
                    (F.col(f"w_{s}") * F.pow(F.lit(share[s]) * F.col("all") / F.greatest(F.col(f"got_{s}"), F.lit(0.5)), F.lit(0.7))).alias(f"w_{s}")
                    for s in names
                ],
            )
            .coalesce(1),
            "weights",
        )
    chosen = materialize(choose(state).select("root", "split"), "chosen")
    return rooted.join(chosen, "root").select(node, "stratum", "root", "split")


def split_chains(chains: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """(chain, category, root, split) of every chain, human peers in common always in one split."""
    weights = weights or {"train": 0.8, "valid": 0.1, "test": 0.1}
    known = chains.where("id IS NOT NULL")
    return assign_splits(known.select("id", "category"), chain_components(chains), "id", "category", weights).select(
        F.col("id").alias("chain"), F.col("stratum").alias("category"), "root", "split"
    )


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
