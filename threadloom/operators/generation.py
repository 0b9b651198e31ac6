"""Plans and fixtures for generated conversations: everything follows from ids and hashes, nothing is random."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def category_sequence(spark: SparkSession, weights: dict[str, int]) -> DataFrame:
    """(place, category): each category as often as its weight, spread evenly."""
    return sequence_of(spark.createDataFrame(sorted(weights.items()), "category string, w int"))


def sequence_of(rows: DataFrame) -> DataFrame:
    """The same from a table (category, w) of small weights: the sequence is as long as their sum."""
    each = rows.select("category", F.explode(F.expr("sequence(0, w - 1)")).alias("i"), "w").withColumn("at", (F.col("i") + F.lit(0.5)) / F.col("w"))
    from pyspark.sql.window import Window

    return each.select((F.row_number().over(Window.orderBy("at", "category")) - 1).alias("place"), "category")


def weights_of(rows: DataFrame, column: str, parts: int = 20) -> DataFrame:
    """(category, w): the shares of a column's values, in ``parts``, rounded up, so the weights' sum is bounded by ``parts``
    and the number of values."""
    counted = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("category")).agg(F.count("*").alias("n"))
    total = F.broadcast(counted.agg(F.sum("n").alias("all")))  # one row
    return counted.crossJoin(total).select("category", F.ceil(F.col("n") * parts / F.col("all")).cast("int").alias("w"))


def plan(spark: SparkSession, n: int, weights: dict[str, int], themes: list[str], sizes: tuple[int, ...] = (60, 80, 100, 120)) -> DataFrame:
    """(id, category, theme, n_messages) of n conversations: category by sequence, the rest by hash of the id."""
    sequence = category_sequence(spark, weights)
    total = sum(weights.values())
    ids = spark.range(n).select("id", (F.col("id") % total).cast("int").alias("place"))
    digits = lambda salt: F.substring(F.md5(F.concat(F.lit(salt), F.col("id").cast("string"))), 1, 7)
    pick = lambda salt, m: F.conv(digits(salt), 16, 10).cast("int") % m
    listed, lengths = F.array(*[F.lit(t) for t in themes]), F.array(*[F.lit(s) for s in sizes])
    return ids.join(F.broadcast(sequence), "place").select(  # as long as the weights' sum
        F.format_string("c%08d", "id").alias("id"),
        "category",
        F.get(listed, pick("theme", len(themes)).cast("int")).alias("theme"),
        F.get(lengths, pick("size", len(sizes)).cast("int")).alias("n_messages"),
    )


def mock_chains(planned: DataFrame, per_block: int = 2, peers: int = 2) -> DataFrame:
    """(id, category, peers, messages, facts, changes, distractors) with facts verbatim in their messages, so that every
    chain can be scored: each block of 20 states ``per_block`` numbers, the first of every later block takes the place of
    the first of the block before, and one number is stated nowhere. Two to four peers speak in turn."""
    names = f"array('Ann', 'Ben', 'Cleo', 'Dov')[(i - 1) % {peers}]"
    n = "n_messages"
    told = f"(i - 1) % 20 < {per_block}"
    message = (
        f"transform(sequence(1, {n}), i -> named_struct('seq', i, 'peer', {names}, 'text', "
        f"CASE WHEN {told} THEN concat('note ', i, ' of ', theme, ' is ', i * 7, ' boxes') ELSE concat('message ', i) END))"
    )
    fact = (
        f"transform(filter(sequence(1, {n}), i -> {told}), i -> named_struct('id', concat('f', i), "
        "'text', concat(i * 7, ' boxes'), 'first_seq', i, 'kind', 'number'))"
    )
    change = (
        f"transform(filter(sequence(1, {n}), i -> i > 20 AND (i - 1) % 20 = 0), i -> named_struct('fact_id', concat('f', i - 20), "
        "'superseded_by', concat('f', i), 'seq', i))"
    )
    return planned.select(
        "id",
        "category",
        F.expr(f"transform(sequence(1, {peers}), i -> named_struct('name', {names}, 'role', 'user', 'bio', cast(null AS string)))").alias("peers"),
        F.expr(message).alias("messages"),
        F.expr(fact).alias("facts"),
        F.expr(change).alias("changes"),
        F.expr(f"array(named_struct('text', concat({n} * 7 + 1, ' boxes')))").alias("distractors"),
    )
