"""Hits as a stream: each place once, with a watermark to bound what is remembered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.discover import HIT


def hit_stream(spark: SparkSession, path: str, files_each: int = 100) -> DataFrame:
    """New JSON files of hits (discover.HIT with ts TIMESTAMP) as they come."""
    return spark.readStream.schema(f"{HIT}, ts TIMESTAMP").option("maxFilesPerTrigger", files_each).json(path)


def new_places(hits: DataFrame, delay: str = "1 day") -> DataFrame:
    """Each place id once within the delay, as it is first seen."""
    return hits.selectExpr("place.id AS place_id", "place.displayName.text AS name", "keyword", "ts").filter("place_id is not null").withWatermark("ts", delay).dropDuplicatesWithinWatermark(["place_id"])
