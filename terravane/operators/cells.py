"""Counts, sums and nearest points within radii from sums of grid cells, so that few pairs of points are ever made.

Points are summed by cells of a fraction of the radius. Of the cells around a site those wholly inside its circle count as
a whole; only points of cells on its rim are paired with the site and measured.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geo import CELL_M, EARTH_M, cells_in_reach, grid_cell, grid_row, haversine, reach_of, row_cells

MOST_PARTS = 8
DEGREE_M = EARTH_M * math.pi / 180


#: So many points at most are broadcast; the number is known before.
FEW_POINTS = 200_000


def density(points: DataFrame, radius_m: float) -> tuple[int, float]:
    """How many points there are, and how many in a square of the radius, as the mean point has them: where most points are
    matters."""
    y, x = grid_cell(F.col("lat"), F.col("lng"), radius_m)
    of_cell = points.groupBy(y.alias("y"), x.alias("x")).agg(F.count("*").alias("n"))
    total, squares = of_cell.agg(F.sum("n"), F.sum(F.col("n") * F.col("n").cast("double"))).first()
    return (total, squares / total) if total else (0, 0.0)


def _met(around: DataFrame, points: DataFrame, n_points: int, on) -> DataFrame:
    """Cells around sites joined with what stands in them. A site's cells are many more bytes than Spark expects of an
    exploded row, so that they are never to be the broadcast side."""
    return around.join(F.broadcast(points) if n_points <= FEW_POINTS else points.hint("merge"), on)


def parts_of_radius(dense: float) -> int:
    """Cells to a radius. About 4 k^2 cells are looked at for each site, and 8 / k of its square's points are on the rim; a
    cell costs as much as some points, so that the cube root of a part of the density balances both."""
    return int(min(MOST_PARTS, max(1, round((dense / 3) ** (1 / 3)))))


def gridded(points: DataFrame, size_m: float) -> DataFrame:
    y, x = grid_cell(F.col("lat"), F.col("lng"), size_m)
    return points.filter("lat is not null and lng is not null").withColumns({"_y": y, "_x": x})


def cells_around(sites: DataFrame, radius_m: float, k: int) -> DataFrame:
    """(place_id, lat, lng, _y, _x, near2, far2): the cells of radius_m / k around each site that may hold points within
    radius_m, anywhere on the globe, with squares of a lower and an upper bound of those points' distances.

    Bounds are flat: a degree of longitude is as wide as at the pole-ward or equator-ward end of the circle, and what the
    curve of great circles changes stays below (radius / earth)^2."""
    size = radius_m / k
    high, lat, lng = size / CELL_M, F.col("lat"), F.col("lng")
    arc = 1.01 * radius_m / DEGREE_M
    narrow = DEGREE_M * F.cos(F.radians(F.least(F.abs(lat) + arc, F.lit(90.0))))
    broad = DEGREE_M * F.cos(F.radians(F.greatest(F.abs(lat) - arc, F.lit(0.0))))
    slack = 1 + (radius_m / EARTH_M) ** 2 + 1e-9

    def degrees(c, low, width):
        """Between a coordinate and the interval (low, low + width): least and most degrees."""
        below, above = low - c, c - (low + width)
        return F.greatest(below, above, F.lit(0.0)), F.greatest(-below, -above)

    rows = sites.select("place_id", "lat", "lng").filter("lat is not null and lng is not null")
    # the work grows with the cells, not with the bytes of the sites
    rows = rows.repartition(int(sites.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    up = F.explode(F.sequence(F.lit(-k), F.lit(k)))
    rows = rows.select("*", narrow.alias("_n"), broad.alias("_b"), reach_of(lat, radius_m).alias("_l"), grid_row(lat, size).alias("_cy"), up.alias("_dy"))
    rows = rows.select("place_id", "lat", "lng", "_n", "_b", "_l", (F.col("_cy") + F.col("_dy")).alias("_y"))
    least, most = degrees(lat, F.col("_y") * high - 90, F.lit(high))
    rows = rows.withColumns({"_ny": F.pow(least * DEGREE_M, F.lit(2)), "_fy": F.pow(most * DEGREE_M, F.lit(2)), "_m": row_cells(F.col("_y"), size)})
    rows = rows.withColumn("_ux", F.explode(cells_in_reach(lng, F.col("_l"), F.col("_m"))))
    wide = 360 / F.col("_m")
    least, most = degrees(lng, F.col("_ux") * wide - 180, wide)
    near2 = (F.col("_ny") + F.pow(least * F.col("_n"), F.lit(2))) / slack**2
    far2 = (F.col("_fy") + F.pow(most * F.col("_b"), F.lit(2))) * slack**2
    rows = rows.withColumns({"near2": near2, "far2": far2, "_x": F.pmod("_ux", "_m")}).filter(F.col("near2") <= radius_m**2)
    return rows.select("place_id", "lat", "lng", "_y", "_x", "near2", "far2")


def radius_sums(sites: DataFrame, points: DataFrame, radius_m: float, k: int, n_points: int) -> DataFrame:
    """(place_id, _key, value): the sum of the weights _w of the points (lat, lng, _key, _w) within radius_m (inclusive) of
    each site, for each _key (null is one); no row where there are none. Points at one place and of one key are one. A
    circle's inner cells meet sums, its rim meets points, in one join."""
    places = points.groupBy("lat", "lng", "_key").agg(F.sum("_w").alias("_w"))
    spots = gridded(places, radius_m / k).withColumnsRenamed({"lat": "lat2", "lng": "lng2"}).withColumn("_whole", F.lit(False))
    sums = spots.groupBy("_y", "_x", "_key").agg(F.sum("_w").alias("_w")).withColumn("_whole", F.lit(True))
    held = spots.unionByName(sums, allowMissingColumns=True)
    around = cells_around(sites, radius_m, k).withColumn("_whole", F.col("far2") <= radius_m**2)
    met = _met(around.drop("near2", "far2"), held, n_points, ["_y", "_x", "_whole"])
    inside = F.col("_whole") | (haversine(F.col("lat"), F.col("lng"), F.col("lat2"), F.col("lng2")) <= radius_m)
    return met.filter(inside).groupBy("place_id", "_key").agg(F.sum("_w").alias("value"))


def nearest_points(sites: DataFrame, points: DataFrame, radius_m: float, most: int, order: list[str], k: int, n_points: int) -> DataFrame:
    """Of each site and _key the nearest points within radius_m (inclusive), `most` at most: place_id, the points' columns
    (lat2 and lng2 their coordinates), d, and pos from 1 by d and then `order` (columns of points).

    Cells are taken from the inside outwards until they surely hold `most` points: the distance where they do bounds the
    search, so that a site among many points is paired with some dozens of them. The last ranking keeps the first of each
    task before it shuffles."""
    spots = gridded(points, radius_m / k)
    counts = spots.groupBy("_y", "_x", "_key").agg(F.count("*").alias("n"))
    around = cells_around(sites, radius_m, k)
    met = _met(around, counts, n_points, ["_y", "_x"])
    outwards = W.partitionBy("place_id", "_key").orderBy("far2", "_y", "_x").rowsBetween(W.unboundedPreceding, 0)
    sure = met.withColumn("sure", F.sum("n").over(outwards))
    bound = F.min(F.when(F.col("sure") >= most, F.col("far2"))).over(W.partitionBy("place_id", "_key"))
    sure = sure.withColumn("bound2", F.least(F.coalesce(bound, F.lit(radius_m**2)), F.lit(radius_m**2)))
    near = sure.filter(F.col("near2") <= F.col("bound2")).select("place_id", "lat", "lng", "_y", "_x", F.col("_key").alias("_k"), "bound2")
    named = spots.withColumnsRenamed({"lat": "lat2", "lng": "lng2"})
    same = (near["_y"] == named["_y"]) & (near["_x"] == named["_x"]) & near["_k"].eqNullSafe(named["_key"])
    pairs = _met(near, named, n_points, same).drop("_y", "_x", "_k")
    pairs = pairs.withColumn("d", haversine(F.col("lat"), F.col("lng"), F.col("lat2"), F.col("lng2")))
    pairs = pairs.filter((F.col("d") <= radius_m) & (F.col("d") * F.col("d") <= F.col("bound2") * (1 + 1e-9)))
    first = W.partitionBy("place_id", "_key").orderBy("d", *order)
    return pairs.withColumn("pos", F.row_number().over(first)).filter(F.col("pos") <= most).drop("bound2", "lat", "lng")
