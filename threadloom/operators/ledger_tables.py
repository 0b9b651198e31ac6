"""The ledgers of chains, typed or as delivered JSON, as related flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators.shred import entities, shred_columns, shred_json
from threadloom.session import materialize

CHILDREN = ["peers", "facts", "changes", "distractors"]


def ledger_nodes(chains: DataFrame, chain_raw: DataFrame, labels: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, nodes): each distinct ledger once, its chain, and its stored adjacency table.

    A ledger received again with the same content is one record, so a chain that was delivered any number of times
    costs one shred. ``labels`` limits which scalars are stored.
    """
    typed = (
        chains.where(F.col("id").isNotNull())
        .select(F.col("id").alias("chain"), *CHILDREN)
        .withColumn("doc", F.xxhash64(F.lit("typed"), "chain", F.to_json(F.struct(*CHILDREN))))
        .dropDuplicates(["doc"])
    )
    raw = (
        chain_raw.where(F.col("chain").isNotNull() & F.col("payload").isNotNull())
        .select("chain", "payload", F.xxhash64(F.lit("json"), "chain", "payload").alias("doc"))
        .dropDuplicates(["doc"])
    )
    nodes = shred_columns(typed, "doc", CHILDREN).unionByName(shred_json(raw, "doc", "payload"))
    if labels is not None:
        nodes = nodes.where((F.col("kind") != "scalar") | F.col("label").isin(CHILDREN + labels))
    nodes = materialize(nodes, "nodes")
    records = typed.select("doc", "chain").unionByName(raw.select("doc", "chain"))
    return records, nodes


def child_positions(chains: DataFrame, chain_raw: DataFrame) -> DataFrame:
    """(chain, child, pos, old_pos, new_pos): every non-null child with its place, changes tied to their facts.

    A change's facts are the first of its chain with an equal id (as text); -1 where none has it. Chains without a
    ledger, null arrays and unreadable payloads have no rows; rows are distinct.
    """
    records, nodes = ledger_nodes(chains, chain_raw, ["id", "fact_id", "superseded_by"])
    rows = materialize(
        entities(nodes, CHILDREN, ["id", "fact_id", "superseded_by"]).join(records, "doc"), "children"
    )
    first = (
        rows.where("label = 'facts' AND id IS NOT NULL").groupBy("doc", "id").agg(F.min("pos").alias("first_pos"))
    )
    old = first.select("doc", F.col("id").alias("fact_id"), F.col("first_pos").alias("old_pos"))
    new = first.select("doc", F.col("id").alias("superseded_by"), F.col("first_pos").alias("new_pos"))
    changes = (
        rows.where("label = 'changes'")
        .join(old, ["doc", "fact_id"], "left")
        .join(new, ["doc", "superseded_by"], "left")
        .select("chain", "label", "pos", "old_pos", "new_pos")
    )
    others = rows.where("label <> 'changes'").select(
        "chain", "label", "pos", F.lit(None).cast("int").alias("old_pos"), F.lit(None).cast("int").alias("new_pos")
    )
    return (
        others.unionByName(changes)
        .select(
            "chain",
            F.col("label").alias("child"),
            "pos",
            F.coalesce("old_pos", F.lit(-1)).alias("old_pos"),
            F.coalesce("new_pos", F.lit(-1)).alias("new_pos"),
        )
        .distinct()
    )


def child_table(chains: DataFrame, chain_raw: DataFrame, child: str, fields: list[str]) -> DataFrame:
    """The flat table of one kind of child: chain, pos and its scalar fields as text; rows are distinct.

    A lone string stands for the element's text (facts, distractors) or name (peers).
    """
    scalar_as = next((f for f in ("text", "name") if f in fields), None)
    records, nodes = ledger_nodes(chains, chain_raw)
    found = entities(nodes, [child], fields, scalar_as).join(records, "doc")
    return found.select("chain", "pos", *fields).distinct()
