"""Mergeable quantile summaries of grouped numbers, from exact ranks.

1. Equal values of a group and batch become one cell with a count. The cells are range-sorted over the cluster and written;
   ranks inside a partition come from windows, those before it from the partitions' totals. A hot group lies in many
   partitions, and no task holds all cells of one.
2. A batch keeps evenly spaced order statistics: each cell that holds one of the ranks ceil(j n / size), the first, and
   LEAST cells evenly spaced among the distinct values, for groups where few values hold nearly all rows. A point knows
   how many rows are at most its value (`lo`) and how many are smaller (`hi`).
3. Summaries are merged without the rows: between two points of a batch the number of its rows is only known to lie
   between their bounds, so the bounds of a value are sums over the batches of the bounds that hold there. The result is
   thinned to evenly spaced points again. A group of many batches is merged in rounds of a bounded number of them.
4. The answer for a rank is the point whose bounds leave the least possible rank error.

Error: between neighbouring points of a batch lie fewer than n / size rows, so that an answer of a batch is off by fewer
than n / size ranks, one of a merged summary by at most 2 n / size + 1, and each further round adds n / size. A
summary of at most `size` distinct values is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .storage import parts, written

#: The batch of a merged summary.
WHOLE = -1
#: A summary keeps so many points at least, or all distinct values.
LEAST = 10
_SO_FAR = (W.unboundedPreceding, W.currentRow)
_FROM_HERE = (W.currentRow, W.unboundedFollowing)


def exact_ranks(cells: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Exact ranks of the values of each batch, and of each group; both are written tables.

    (keys, batch, x, before, upto, n, place, values): how many rows of the batch are smaller, at most as large, how many
    there are, and the value's place among how many distinct values; (keys, x, before, upto, n) for whole groups.
    cells: keys, batch (int, not negative), x (long) and the number of rows, `cell`; none of them null."""
    cells = cells.groupBy(*keys, "batch", "x").agg(F.sum("cell").alias("cell"))
    # one partition has all batches of a value, and partitions follow each other in the order of the values
    dealt = cells.repartitionByRange(parts(cells.sparkSession), *keys, "x").withColumn("part", F.spark_partition_id())
    dealt = written(dealt, "cells")

    def placed(ranked: DataFrame, group: list[str]) -> DataFrame:
        """Adds what lies in the partitions before, and the totals: rows of few numbers for each group and partition."""
        by = W.partitionBy(*group)
        earlier = lambda c: F.sum(c).over(by.orderBy("part").rowsBetween(*_SO_FAR)) - F.col(c)
        totals = dealt.groupBy(*group, "part").agg(F.sum("cell").alias("rows"), F.count("*").alias("cells"))
        sums = {"n": F.sum("rows").over(by), "values": F.sum("cells").over(by)}
        ranked = ranked.join(totals.withColumns({"rows": earlier("rows"), "cells": earlier("cells"), **sums}), [*group, "part"])
        return ranked.withColumns({c: F.col("rows") + F.col(c) for c in ("before", "upto")})

    own = W.partitionBy(*keys, "batch", "part").orderBy("x").rowsBetween(*_SO_FAR)
    upto = F.sum("cell").over(own)
    each = dealt.withColumns({"upto": upto, "before": upto - F.col("cell"), "nth": F.count("*").over(own)})
    each = placed(each, [*keys, "batch"]).withColumn("place", F.col("cells") + F.col("nth"))
    each = written(each.select(*keys, "batch", "x", "before", "upto", "n", "place", "values"), "ranks")

    all_of = W.partitionBy(*keys, "part").orderBy("x")
    smaller = F.coalesce(F.sum("cell").over(all_of.rangeBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = {"upto": F.sum("cell").over(all_of.rangeBetween(*_SO_FAR)), "before": smaller, "last": F.lag("x").over(all_of)}
    whole = dealt.withColumns(sums).filter("last is null or last < x")  # a value that several batches hold stands once
    return each, written(placed(whole, [*keys]).select(*keys, "x", "before", "upto", "n"), "whole-ranks")


def summarise(ranks: DataFrame, size: int) -> DataFrame:
    """(keys, batch, x, lo, hi, n): the points that each batch of exact_ranks keeps, size + LEAST + 1 of them at most."""
    ahead = F.expr(f"({size}L * upto) div n > ({size}L * before) div n")
    kept = ranks.filter(ahead | (F.col("before") == 0) | _spread())
    return kept.drop("place", "values").withColumnRenamed("upto", "lo").withColumnRenamed("before", "hi")


def _spread():
    """LEAST of the distinct values by their places, or all if there are fewer."""
    return F.expr(f"({LEAST}L * place) div values > ({LEAST}L * (place - 1)) div values")


def _merged_once(points: DataFrame, group: list[str], size: int) -> DataFrame:
    """One summary for each group, of all its batches: (group, x, lo, hi, n)."""
    own = W.partitionBy(*group, "batch").orderBy("x")
    steps = points.select(
        *group,
        "x",
        (F.col("lo") - F.lag("lo", 1, 0).over(own)).alias("rise"),
        (F.coalesce(F.lead("hi").over(own), "n") - F.col("hi")).alias("fall"),
        F.when(F.lag("lo").over(own).isNull(), F.col("n")).otherwise(0).alias("rows"),
    )
    values = steps.groupBy(*group, "x").agg(F.sum("rise").alias("rise"), F.sum("fall").alias("fall"), F.sum("rows").alias("rows"))
    by = W.partitionBy(*group).orderBy("x")
    bounds = values.withColumns(
        {
            "n": F.sum("rows").over(W.partitionBy(*group)),
            "lo": F.sum("rise").over(by.rowsBetween(*_SO_FAR)),
            "above": F.sum("fall").over(by.rowsBetween(*_FROM_HERE)),
            "place": F.row_number().over(by),
            "values": F.count("*").over(W.partitionBy(*group)),
        }
    )
    step = F.expr(f"({size}L * lo) div n")
    thinned = bounds.withColumn("step", step).withColumn("last", F.lag("step", 1, -1).over(by))
    return thinned.filter((F.col("step") > F.col("last")) | _spread()).select(*group, "x", "lo", (F.col("n") - F.col("above")).alias("hi"), "n")


def merge(points: DataFrame, keys: Sequence[str], size: int, fan_in: int = 64) -> DataFrame:
    """(keys, batch -1, x, lo, hi, n): the summary of each group, from its batches' summaries alone.

    A round merges about fan_in summaries of a group into one, so that what meets in a task is bounded."""
    while True:
        most = points.groupBy(*keys).agg(F.count_distinct("batch").alias("m")).agg(F.max("m")).first()[0] or 0
        if most <= fan_in:
            break
        bundle = F.pmod(F.xxhash64("batch"), F.lit(-(-most // fan_in))).cast("int").alias("bundle")
        some = points.select("*", bundle)
        # a bundle of twice the usual number is no harm; one that stays alone only waits
        points = written(_merged_once(some, [*keys, "bundle"], size).withColumnRenamed("bundle", "batch"), "bundles")
    return _merged_once(points, [*keys], size).withColumn("batch", F.lit(WHOLE).cast("int"))


def answers(points: DataFrame, keys: Sequence[str], quantiles: int, least_rows: int) -> DataFrame:
    """(keys, batch, i, n, target, points, answer, lo, hi) for i in 1 .. quantiles - 1, of summaries of least_rows rows or
    more: target is ceil(i n / quantiles), the answer the point of the least possible rank error max(target - lo,
    hi + 1 - target), of two the smaller. lo grows with x and hi does not fall, so that the best point is the last one
    where the first of these errors is the larger one or the next point; answers never fall from i to i + 1."""
    by = W.partitionBy(*keys, "batch").orderBy("x")
    middle = F.col("lo") + F.col("hi") + 1
    around = {"middle": middle, "last": F.lag(middle).over(by), "next": F.lead(middle).over(by), "points": F.count("*").over(W.partitionBy(*keys, "batch"))}
    twice = lambda i: 2 * F.ceil(i * F.col("n") / F.lit(quantiles))

    def beside(i):
        first = (F.col("middle") >= twice(i)) & (F.col("last").isNull() | (F.col("last") < twice(i)))
        return first | ((F.col("middle") < twice(i)) & (F.col("next").isNull() | (F.col("next") >= twice(i))))

    asked = F.filter(F.sequence(F.lit(1), F.lit(quantiles - 1)), beside)
    near = points.filter(F.col("n") >= least_rows).withColumns(around).withColumn("i", F.explode(asked))
    near = near.withColumn("target", F.expr(f"(i * n + {quantiles - 1}) div {quantiles}"))
    worst = F.greatest(F.col("target") - F.col("lo"), F.col("hi") + 1 - F.col("target"))
    best = near.groupBy(*keys, "batch", "i", "n", "target", "points").agg(F.min(F.struct(worst.alias("worst"), "x", "lo", "hi")).alias("best"))
    return best.select(*keys, "batch", "i", "n", "target", "points", F.col("best.x").alias("answer"), "best.lo", "best.hi")


def quantile_report(
    rows: DataFrame,
    keys: Sequence[str],
    size: int = 256,
    quantiles: int = 4,
    least_rows: int = 20,
    allowed: float = 0.02,
    count: str | None = None,
) -> DataFrame:
    """One row for each summary of least_rows rows or more and each i in 1 .. quantiles - 1: keys, batch, i, n, target,
    exact_x, points, answer, n_below, n_upto, rank_error, within.

    rows: keys, batch (int, not negative) and x (long); count names a column that says how many rows a row stands for.
    Rows with a null among these are left out. There is a summary of each batch, and one of each group from its batches'
    summaries (batch -1); exact_x, n_below and n_upto come from the exact ranks and check the answers. Rows that repeat
    count each; an empty table gives no rows; other columns are not read."""
    cells = rows.select(*keys, "batch", "x", (F.col(count) if count else F.lit(1)).cast("long").alias("cell")).dropna()
    each, whole = exact_ranks(cells, keys)
    of_batches = written(summarise(each, size), "summaries")
    of_all = merge(of_batches, keys, size)
    asked = F.sequence(F.lit(1), F.lit(quantiles - 1))
    target = lambda i: F.ceil(i * F.col("n") / F.lit(quantiles))
    here = F.filter(asked, lambda i: (target(i) > F.col("before")) & (target(i) <= F.col("upto")))
    exact = lambda ranks, group: ranks.filter(F.col("n") >= least_rows).select(*group, F.explode(here).alias("i"), F.col("x").alias("exact_x"))

    # the points of a batch are rows of its ranks; those of a group know bounds only, and are looked up
    batch_told = answers(of_batches, keys, quantiles, least_rows).join(exact(each, [*keys, "batch"]), [*keys, "batch", "i"])
    batch_told = batch_told.withColumnRenamed("hi", "n_below").withColumnRenamed("lo", "n_upto")
    counts = whole.filter(F.col("n") >= least_rows).select(*keys, F.col("x").alias("answer"), F.col("before").alias("n_below"), F.col("upto").alias("n_upto"))
    told = answers(of_all, keys, quantiles, least_rows).drop("lo", "hi").join(counts, [*keys, "answer"]).join(exact(whole, keys), [*keys, "i"])
    found = batch_told.unionByName(told)
    error = F.greatest(F.lit(0), F.col("n_below") + 1 - F.col("target"), F.col("target") - F.col("n_upto"))
    found = found.withColumn("rank_error", error)
    within = 1000 * F.col("rank_error") <= round(1000 * allowed) * F.col("n")
    columns = "n", "target", "exact_x", "points", "answer", "n_below", "n_upto", "rank_error"
    return found.select(*keys, "batch", "i", *columns, within.alias("within"))


def decimal_crc(number: str):
    """crc32 of a number in decimal; null counts as an empty text."""
    return F.crc32(F.coalesce(F.col(number).cast("string"), F.lit("")).cast("binary"))


def cents(money: str):
    """floor(100 money + 0.5) as a long; null where money is null, not finite, or beyond 9e13."""
    return F.when(F.abs(money) < 9e13, F.floor(F.lit(100.0) * F.col(money) + F.lit(0.5)))
