"""Weekly opening hours as intervals on a ring of 10,080 minutes (Sunday 00:00 is 0)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DAY, WEEK = 24 * 60, 7 * 24 * 60
LEAST_MINUTES = 60  # open for so long in a window counts
# Windows in hours of a day, beyond 24 into the next one.
WINDOWS = {"open_morning": (6, 10), "open_evening": (16, 20), "open_night": (20, 26)}


def _minute(point: Column) -> Column:
    part = lambda name: F.coalesce(point[name], F.lit(0))
    return part("day") * DAY + part("hour") * 60 + part("minute")


def intervals(df: DataFrame, key: str, periods: str = "periods") -> DataFrame:
    """(key, s, e): disjoint intervals of the weeks before, of, and after, in which a place is open. A period without an
    opening is skipped; one without a closing stands for the whole week."""
    p = df.select(key, F.explode(periods).alias("p")).filter(F.col("p.open").isNotNull())
    s = F.when(F.col("p.close").isNull(), 0).otherwise(_minute(F.col("p.open")))
    e = F.when(F.col("p.close").isNull(), WEEK).otherwise(_minute(F.col("p.close")))
    raw = p.select(key, s.alias("s"), e.alias("e")).select(key, "s", F.when(F.col("e") <= F.col("s"), F.col("e") + WEEK).otherwise(F.col("e")).alias("e"))
    copies = raw.select(key, F.explode(F.array(*(F.struct((F.col("s") + k).alias("s"), (F.col("e") + k).alias("e")) for k in (-WEEK, 0, WEEK)))).alias("i")).select(key, "i.s", "i.e").distinct()
    by = W.partitionBy(key).orderBy("s", "e")
    last = F.max("e").over(by.rowsBetween(W.unboundedPreceding, -1))
    opens = F.coalesce((F.col("s") > last).cast("int"), F.lit(1))
    numbered = copies.withColumn("_o", opens).withColumn("_i", F.sum("_o").over(by.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.groupBy(key, "_i").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("_i")


def hours_features(df: DataFrame, key: str, periods: str = "periods") -> DataFrame:
    """(key, hours_known, days_open, open_days, open_morning, open_evening, open_night) for each row of df, whose key is
    unique. Shares are of the 7 days; open_days is a mask, Sunday first; without periods hours are not known."""
    spans = {"day": (0, 24), **WINDOWS}
    minutes = lambda d, lo, hi: F.sum(F.greatest(F.lit(0), F.least(F.col("e"), F.lit(d * DAY + hi * 60)) - F.greatest(F.col("s"), F.lit(d * DAY + lo * 60))))
    open_ = intervals(df, key, periods).groupBy(key).agg(*((minutes(d, *span) >= LEAST_MINUTES).cast("int").alias(f"{name}_{d}") for name, span in spans.items() for d in range(7)))
    days = lambda name: [F.coalesce(F.col(f"{name}_{d}"), F.lit(0)) for d in range(7)]
    known = F.coalesce(F.size(periods) > 0, F.lit(False))
    share = lambda name: F.when(F.col("_known"), sum(days(name)[1:], days(name)[0]) / F.lit(7))
    return df.select(key, known.alias("_known")).join(open_, key, "left").select(
        key, F.col("_known").cast("int").alias("hours_known"), share("day").alias("days_open"),
        F.when(F.col("_known"), F.concat(*(c.cast("string") for c in days("day")))).otherwise("").alias("open_days"), *(share(w).alias(w) for w in WINDOWS))


def describe_hours(lines: Column) -> Column:
    return F.coalesce(F.array_join(lines, " | "), F.lit(""))
