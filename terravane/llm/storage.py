"""Where the corpus operators keep what is cut from its lineage, and how large their Arrow batches are."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..functions.storage import discard, shared_dir, written

__all__ = ["discard", "parts", "shared_dir", "small_batches", "written"]


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "4m") -> None:
    """Bounds the rows and the bytes of whole texts in one Arrow batch, from now on; results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
