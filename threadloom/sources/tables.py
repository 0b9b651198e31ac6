"""Parquet and JSON-lines tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.session import ship


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """A Parquet table (one file or a folder of files) of a data directory."""
    ship(spark)
    return spark.read.parquet(f"{base}/{name}.parquet")


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str, malformed: str = "FAILFAST") -> DataFrame:
    """JSON lines under an explicit schema. A missing path is an empty table; blank lines are skipped.

    ``malformed``: FAILFAST raises on a broken line, DROPMALFORMED skips it (the rule for batch results).
    """
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", malformed).json(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """Full overwrite, null fields kept so that a reader sees every key."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_text_keys(spark: SparkSession, path: str) -> DataFrame:
    """Each JSON line with the array of its top-level keys: tells an absent key from a null one."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.col("value").alias("line"), F.json_object_keys("value").alias("keys"))
