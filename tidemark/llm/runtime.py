"""What the jobs of this subpackage need of storage."""

from __future__ import annotations

import ctypes
import gc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.storage import drop, fresh, remove, shared_folder, table

__all__ = ["drop", "fresh", "give_back", "read", "remove", "row_key", "shared_folder", "table"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key() -> Column:
    """What a document is known by where ids may be null or repeated: a 64-bit hash of ``doc_id`` and ``text``."""
    return F.xxhash64("doc_id", "text")


def give_back() -> None:
    """Return memory that a fit on the driver has freed to the system, where the C library can."""
    import pyarrow as pa  # native operators do not need it

    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
