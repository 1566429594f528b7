"""Tables in the folder that driver and executors share: they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; one of our own only where it is
    unset and all run on one machine, as in tests."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/tidemark/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: lineage is cut, and lost executors lose nothing."""
    spark = df.sparkSession
    path = fresh(spark, name)
    before = spark.conf.get(CLEANUP, None)
    try:
        spark.conf.set(CLEANUP, "true")  # shuffle files of this write go as soon as it is over
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables made by ``table`` that nothing reads any more."""
    for df in tables:
        remove(df.sparkSession, df._tidemark_path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)

