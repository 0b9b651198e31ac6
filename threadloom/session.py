"""Session defaults and the shared folder in which lineage is cut."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int = 8, memory: str = "8g", name: str = "threadloom") -> SparkSession:
    """A single-JVM session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(cores))
    builder = builder.config("spark.driver.memory", memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once a context: they need not find it on their own path."""
    context = spark.sparkContext
    if getattr(context, "_threadloom_shipped", False):
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="threadloom-")) / "threadloom.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    context.addPyFile(str(target))
    context._threadloom_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, else (a local master only) a temporary one.

    The session's own setting is read first and never replaced.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if where:
        return where.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    where = tempfile.mkdtemp(prefix="threadloom-", dir=os.environ.get("TMPDIR"))
    where = f"file://{where}"
    spark.conf.set("spark.checkpoint.dir", where)
    return where


def materialize(df: DataFrame, tag: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back.

    This cuts lineage without depending on an executor's own disk, computes the plan once (an eager
    ``checkpoint()`` runs its input twice) and keeps the copy columnar. The folder is deleted when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def drop_materialized(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`materialize` that nothing will read again."""
    spark = df.sparkSession
    for parent in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if shared_dir(spark).split(":", 1)[-1].lstrip("/") in parent:
            path = spark._jvm.org.apache.hadoop.fs.Path(parent)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Within it the shuffle files of a query are deleted as soon as it ends, not when the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
