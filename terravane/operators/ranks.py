"""Ranks and quantiles of many columns at once, without a window over all rows in one task.

Values are counted, the counts are dealt into ranges of (measure, value), and running counts are put together from the
ranges' totals, of which there are a few for each partition, and from windows inside the ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.storage import written


def long_form(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """(key, measure, value): the values of cols that are not null."""
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("measure"), F.col(f"`{c}`").cast("double").alias("value")) for c in cols)))
    return df.select(F.col(key).alias("key"), cells.alias("c")).select("key", "c.measure", "c.value").filter("value is not null and not isnan(value)")


def running_counts(values: DataFrame) -> DataFrame:
    """(measure, value, n, before, total): how many rows hold a value, how many a smaller one, how many there are."""
    spark = values.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = values.groupBy("measure", "value").agg(F.count("*").alias("n"))
    ranged = written(counts.repartitionByRange(parts, "measure", "value").withColumn("part", F.spark_partition_id()), "ranges")
    by = W.partitionBy("measure").orderBy("part")
    offsets = ranged.groupBy("measure", "part").agg(F.sum("n").alias("in_part")).withColumns({"offset": F.sum("in_part").over(by.rowsBetween(W.unboundedPreceding, 0)) - F.col("in_part"), "total": F.sum("in_part").over(W.partitionBy("measure"))})
    inside = F.sum("n").over(W.partitionBy("measure", "part").orderBy("value").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")
    return ranged.withColumn("inside", inside).join(offsets, ["measure", "part"]).select("measure", "value", "n", (F.col("inside") + F.col("offset")).alias("before"), "total")


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """df with a column of numbers from 0 in the order of some columns that tell its rows apart: rows are sorted by ranges,
    counted by range, and numbered inside; no task holds them all."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()), "numbered")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))  # a row for each range
    offsets = sizes.select("_part", (F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")).alias("_offset"))
    inside = F.row_number().over(W.partitionBy("_part").orderBy(*order)) - 1
    return ranged.withColumn("_inside", inside).join(F.broadcast(offsets), "_part").withColumn(name, F.col("_inside") + F.col("_offset")).drop("_part", "_inside", "_offset")


def percentile_of(counts: DataFrame) -> DataFrame:
    """(measure, value, pct): mean rank of a value's rows by the number of rows."""
    return counts.select("measure", "value", ((F.col("before") + (F.col("n") + 1) / F.lit(2.0)) / F.col("total")).alias("pct"))


def percentiles(df: DataFrame, key: str, cols: Sequence[str], stored: bool = False) -> DataFrame:
    """key with one column for each of cols: the percentile rank of its value (ties share their mean rank, nulls are not
    ranked and stay null). Rows with equal keys share a row. stored: df only reads a table, so reading it twice is cheap."""
    values = long_form(df, key, cols) if stored else written(long_form(df, key, cols), "values")
    ranked = values.join(percentile_of(running_counts(values)), ["measure", "value"])
    wide = ranked.groupBy("key").pivot("measure", list(cols)).agg(F.max("pct"))
    return df.select(F.col(key).alias("key")).distinct().join(wide, "key", "left").withColumnRenamed("key", key)


def quantiles(values: DataFrame, points: Sequence[float]) -> DataFrame:
    """(measure, point, value): exact quantiles with linear interpolation."""
    counts = running_counts(values)
    at = counts.withColumn("point", F.explode(F.array(*map(F.lit, points)))).withColumn("_p", F.col("point") * (F.col("total") - 1))
    held = lambda k: (F.col("before") <= k) & (k < F.col("before") + F.col("n"))
    lo, hi = F.floor("_p"), F.ceil("_p")
    ends = at.groupBy("measure", "point").agg(F.max(F.when(held(lo), F.col("value"))).alias("_lo"), F.max(F.when(held(hi), F.col("value"))).alias("_hi"), F.first("_p").alias("_p"))
    return ends.select("measure", "point", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("_p") - F.floor("_p"))).alias("value"))
