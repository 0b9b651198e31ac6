"""Structured Streaming: resumable merging of row files, appended logs, and blocks counted per chain."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from threadloom.operators.maintenance import upsert
from threadloom.session import drop_materialized, materialize
from threadloom.sources.tables import path_exists


def stream_table(spark: SparkSession, path: str, schema, files_per_trigger: int = 4) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def merge_stream(rows: DataFrame, target: str, checkpoint: str, key: str = "id", order: str = "row_id", parts: int = 64) -> None:
    """Merge a stream of rows into a Parquet table that is divided into ``parts`` by the hash of the key (column ``_part``).

    A batch reads and rewrites only the parts its keys fall into. Merging a batch again changes nothing, so a batch that
    broke off is simply run again.
    """

    def merge(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
        new = materialize(batch, "batch")
        touched = [r._part for r in new.select(part.alias("_part")).distinct().collect()]  # at most ``parts``
        if not touched:
            return
        old = spark.createDataFrame([], batch.schema)
        if path_exists(spark, target):
            stored = spark.read.schema(T.StructType([*batch.schema.fields, T.StructField("_part", T.IntegerType())])).parquet(target)
            old = stored.where(F.col("_part").isin(touched)).drop("_part")
        merged = materialize(upsert(old, new, key, order).withColumn("_part", part), "merged")
        writer = merged.repartition("_part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("_part").parquet(target)
        drop_materialized(new)
        drop_materialized(merged)

    rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def append_log(rows: DataFrame, target: str, checkpoint: str) -> None:
    """Append a stream of records to a Parquet log, each once."""
    rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(
        availableNow=True
    ).start(target).awaitTermination()


def count_blocks(messages: DataFrame, size: int = 20) -> DataFrame:
    """(chain, k, messages) as each block of ``size`` messages of a chain fills up: state is one count a chain."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen = state.get[0] if state.exists else 0
        before = seen
        for batch in batches:
            seen += len(batch)
        state.update((seen,))
        done = range(before // size, seen // size)
        yield pd.DataFrame({"chain": [key[0]] * len(done), "k": list(done), "messages": [size] * len(done)})

    return messages.groupBy("chain").applyInPandasWithState(
        step, "chain string, k int, messages int", "seen long", "append", GroupStateTimeout.NoTimeout
    )
