"""Data-set sinks, manifests and batch results."""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_dataset(rows: DataFrame, path: str, split: str = "split") -> None:
    """One folder a split; a reader of one split reads only its files."""
    rows.write.mode("overwrite").partitionBy(split).parquet(path)


def write_training_sets(sft: DataFrame, dpo: DataFrame, splits: DataFrame, path: str) -> None:
    """The four data sets, {sft, dpo} by {train, eval}, as JSON lines in ``path/<set>/split=<split>``.

    ``splits``: (chain, split). Rows of a chain that has no split are left out; only ``train`` and ``eval`` are written.
    """
    known = splits.where("split IN ('train', 'eval')").select("chain", F.col("split").alias("_split"))
    for name, rows in (("sft", sft), ("dpo", dpo)):
        placed = rows.drop("split").join(known, "chain").withColumnRenamed("_split", "split")
        placed.write.mode("overwrite").partitionBy("split").option("ignoreNullFields", "false").json(f"{path}/{name}")


def read_harness(spark: SparkSession, path: str, row_schema: str) -> DataFrame:
    """The rows of harness results, files of one object {summary, rows} each, with the file they came from."""
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file"), F.from_json("value", f"struct<rows: array<struct<{row_schema}>>>").alias("v")
    )
    return files.select("file", F.explode("v.rows").alias("r")).where("r IS NOT NULL").select("file", "r.*")


def chat_response(body: str) -> list:
    """content, reasoning, finish_reason, error of a chat response in JSON; no choice is an error."""
    v = F.try_parse_json(body)
    get = lambda p: F.try_variant_get(v, p, "string")
    first = "$.choices[0]"
    none = F.try_variant_get(v, first, "variant").isNull()
    return [
        F.coalesce(get(f"{first}.message.content"), F.lit("")).alias("content"),
        F.coalesce(F.when(get(f"{first}.message.reasoning") != "", get(f"{first}.message.reasoning")), get(f"{first}.message.reasoning_content"), F.lit("")).alias("reasoning"),
        get(f"{first}.finish_reason").alias("finish_reason"),
        F.when(none, F.substring(F.concat(F.lit("no choices: "), F.coalesce(get("$.error"), F.col(body), F.lit(""))), 1, 320)).alias("error"),
    ]


def write_summary(aggregate: DataFrame, path: str) -> None:
    """An aggregate as JSON lines, nulls kept."""
    aggregate.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def write_manifest(spark: SparkSession, folder: str, kind: str, data: dict) -> str:
    """A manifest as one small JSON file named by time and kind; returns its path."""
    path = f"{folder}/{time.strftime('%Y%m%d-%H%M%S')}-{kind}.json"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(json.dumps(data, ensure_ascii=False).encode()))
    out.close()
    return path


def newest_manifest(spark: SparkSession, folder: str, kind: str | None = None) -> DataFrame:
    """The last manifest of a folder by file name, one row (file, body)."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter=f"*{'-' + kind if kind else ''}.json")
    named = files.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("body"))
    return named.agg(F.max(F.struct("file", "body")).alias("m")).select("m.*").where("file IS NOT NULL")


def batch_results(spark: SparkSession, path: str) -> DataFrame:
    """(id, text, error) of batch results in JSON lines; broken lines are skipped, refusals and errors told apart."""
    lines = spark.read.text(path).select(F.try_parse_json("value").alias("v")).where("v IS NOT NULL")
    get = lambda p, t="string": F.try_variant_get("v", p, t)
    kind = get("$.result.type")
    blocks = F.try_variant_get("v", "$.result.message.content", "array<struct<type:string,text:string>>")
    text = F.array_join(F.transform(F.filter(blocks, lambda b: b["type"] == "text"), lambda b: b["text"]), "")
    refused = get("$.result.message.stop_reason") == "refusal"
    error = (
        F.when(kind != "succeeded", F.coalesce(get("$.result.error.message"), kind))
        .when(refused, "refusal")
        .when(kind.isNull(), "no result")
    )
    return lines.select(get("$.custom_id").alias("id"), F.when(error.isNull(), text).alias("text"), error.alias("error"))


def join_results(metas: DataFrame, results: DataFrame) -> DataFrame:
    """Every asked id with its result, or the error that there is none."""
    return metas.join(results, "id", "left").withColumn(
        "error", F.when(F.col("text").isNull() & F.col("error").isNull(), "no result for this id").otherwise(F.col("error"))
    )
