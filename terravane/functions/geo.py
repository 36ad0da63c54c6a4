"""Distances, projections, tiles, and the grid that turns a radius join into an equi-join."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0  # mean radius, for great circles
FLAT_M = 111_320.0  # metres in a degree, for flat polygon geometry
CELL_M = 111_000.0  # not above a degree of the great circle (111,194.9 m), so that a cell is never narrower than the radius


def haversine(lat1, lng1, lat2, lng2) -> Column:
    """Great-circle metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lng2 - lng1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def to_metres(lat, lng, lat0, lng0) -> tuple[Column, Column]:
    """Flat (x, y) in metres from an origin."""
    return (lng - lng0) * FLAT_M * F.cos(F.radians(lat0)), (lat - lat0) * FLAT_M


def to_degrees(x, y, lat0, lng0) -> tuple[Column, Column]:
    """(lat, lng) of a flat point, to 6 places."""
    return F.round(lat0 + y / FLAT_M, 6), F.round(lng0 + x / (FLAT_M * F.cos(F.radians(lat0))), 6)


def half_sizes(radius_m, lat) -> tuple[Column, Column]:
    """Half height and width in degrees of the box round a circle; the cosine is taken as 0.1 at least."""
    return F.lit(radius_m) / FLAT_M, F.lit(radius_m) / (FLAT_M * F.greatest(F.cos(F.radians(lat)), F.lit(0.1)))


def tiles(spark: SparkSession, south: float, north: float, west: float, east: float, step: float) -> DataFrame:
    """(tile, south, west, north, east): a grid over a box, its outer edges exact; tiles are made by the executors."""
    rows = max(1, math.ceil(round((north - south) / step, 9)))
    cols = max(1, math.ceil(round((east - west) / step, 9)))
    i, j = F.floor(F.col("tile") / cols), F.col("tile") % cols
    edge = lambda low, high, k, n: F.when(k == n, F.lit(high)).otherwise(F.round(F.lit(low) + k * step, 6))
    return spark.range(rows * cols).withColumnRenamed("id", "tile").select(
        "tile", edge(south, north, i, rows).alias("south"), edge(west, east, j, cols).alias("west"), edge(south, north, i + 1, rows).alias("north"), edge(west, east, j + 1, cols).alias("east"))


def grid_tile(lat, lng, south: float, north: float, west: float, east: float, step: float) -> tuple[Column, Column]:
    """The tile of tiles() that holds a point (null outside), and its box (south, west, north, east)."""

    def along(x, low: float, high: float) -> tuple[Column, Column, Column]:
        n = max(1, math.ceil(round((high - low) / step, 9)))
        edge = lambda k: F.when(k == n, F.lit(high)).when(k == 0, F.lit(low)).otherwise(F.round(F.lit(low) + k * step, 6))
        near = F.floor((x - low) / step)  # at an edge the division may be off by one
        at = F.greatest(F.least(near + (x >= edge(near + 1)).cast("int") - (x < edge(near)).cast("int"), F.lit(n - 1)), F.lit(0))
        return F.when((x >= low) & (x <= high), at), edge(at), edge(at + 1)

    i, s, n = along(lat, south, north)
    j, w, e = along(lng, west, east)
    cols = max(1, math.ceil(round((east - west) / step, 9)))
    return (i * cols + j).cast("long"), F.struct(s.alias("south"), w.alias("west"), n.alias("north"), e.alias("east"))


def quadrant_path(lat, lng, box, depth: int) -> Column:
    """The quadrants that a point falls into, one digit a level, halving the box as subdivide does."""

    def halve(a, _):
        y, x = (a["south"] + a["north"]) / 2, (a["west"] + a["east"]) / 2
        up, right = lat >= y, lng >= x
        digit = (F.when(up, 2).otherwise(0) + F.when(right, 1).otherwise(0)).cast("string")
        half = F.when(up, y).otherwise(a["south"]), F.when(right, x).otherwise(a["west"]), F.when(up, a["north"]).otherwise(y), F.when(right, a["east"]).otherwise(x)
        return F.struct(*(v.cast("double").alias(k) for k, v in zip(("south", "west", "north", "east"), half, strict=True)), F.concat(a["path"], digit).alias("path"))

    if not depth:
        return F.lit("")
    start = F.struct(*(box[k].cast("double").alias(k) for k in ("south", "west", "north", "east")), F.lit("").alias("path"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(depth)), start, halve, lambda a: a["path"])


def subdivide(df: DataFrame) -> DataFrame:
    """Each tile's four quadrants, south-west first; column quadrant is 0 to 3."""
    lat, lng = (F.col("south") + F.col("north")) / 2, (F.col("west") + F.col("east")) / 2
    s, w, n, e = (F.col(c) for c in ("south", "west", "north", "east"))
    box = lambda a, b, c, d: F.struct(a.alias("south"), b.alias("west"), c.alias("north"), d.alias("east"))
    rest = [c for c in df.columns if c not in ("south", "west", "north", "east", "quadrant")]
    return df.select(*rest, F.posexplode(F.array(box(s, w, lat, lng), box(s, lng, lat, e), box(lat, w, n, lng), box(lat, lng, n, e))).alias("quadrant", "q")).select(*rest, "quadrant", "q.*")


def rectangle_json(south, west, north, east) -> Column:
    """A request's location restriction."""
    corner = lambda lat, lng: F.struct(lat.alias("latitude"), lng.alias("longitude"))
    return F.to_json(F.struct(F.struct(corner(south, west).alias("low"), corner(north, east).alias("high")).alias("rectangle")))


def grid_row(lat: Column, size_m: float) -> Column:
    """The row of cells that a latitude lies in, counted from the south pole; rows are size_m high and a little more."""
    return F.floor((lat + 90) * (CELL_M / size_m))


def row_cells(row: Column, size_m: float) -> Column:
    """How many cells go round the globe in a row: each is size_m wide at least, and a row at a pole has one."""
    high = size_m / CELL_M
    edge = F.greatest(F.abs(row * high - 90), F.abs((row + 1) * high - 90))  # the side nearer to a pole
    return F.greatest(F.floor(360 * F.cos(F.radians(F.least(edge, F.lit(90.0)))) * (CELL_M / size_m)), F.lit(1))


def reach_of(lat: Column, radius_m: float) -> Column:
    """Degrees of longitude to either side that a circle covers; 180 where a pole is in it."""
    sine = math.sin(min(radius_m / EARTH_M, math.pi / 2))
    cosine = F.cos(F.radians(lat))
    return F.when(cosine > sine * (1 + 1e-9), F.degrees(F.asin(sine / cosine)) * (1 + 1e-9) + 1e-9).otherwise(180.0)


def cells_in_reach(lng: Column, reach: Column, cells: Column) -> Column:
    """The cells of a row that longitudes within reach lie in, each once, as numbers that go on over the antimeridian:
    modulo `cells` they are the row's, and times the width of a cell they are degrees east of -180."""
    at = lambda x: F.floor((x + 180) * cells / 360)
    low, high, here = at(lng - reach), at(lng + reach), at(lng)
    all_round = high - low + 1 >= cells
    low = F.when(all_round, here - F.floor((cells - 1) / 2)).otherwise(low)
    return F.sequence(low, F.when(all_round, low + cells - 1).otherwise(high))


def grid_cell(lat: Column, lng: Column, size_m: float) -> tuple[Column, Column]:
    """(row, cell) of a point."""
    row = grid_row(lat, size_m)
    cells = row_cells(row, size_m)
    return row, F.pmod(F.floor((lng + 180) * cells / 360), cells)


def radius_pairs(left: DataFrame, right: DataFrame, radius_m: float) -> DataFrame:
    """All pairs of rows within radius_m (inclusive) with their distance d, anywhere on the globe; both sides have lat and
    lng, other column names must differ. The globe is cut into rows of cells as high and at least as wide as the radius.
    The right side is copied to the cells that its circles can reach, in its row and the two beside it (about nine; at a
    pole the few of those rows), then joined on the cell: an equi-join that is shuffled and that adaptive execution splits for
    skew. The copies are many more bytes than Catalyst expects of an exploded row, so that they are never broadcast. Rows
    without coordinates have no pairs.

    The work grows with the pairs, not with the bytes of the points, so the left side is dealt evenly over
    spark.sql.shuffle.partitions tasks first; latitudes that are too far apart are left out before the sines."""
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    y, x = grid_cell(F.col("lat"), F.col("lng"), radius_m)
    l = left.filter("lat is not null and lng is not null").repartition(parts).withColumns({"_y": y, "_x": x})
    r = right.filter("lat is not null and lng is not null").withColumnsRenamed({"lat": "lat2", "lng": "lng2"})
    r = r.withColumn("_y", F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda d: grid_row(F.col("lat2"), radius_m) + d)))
    r = r.withColumn("_m", row_cells(F.col("_y"), radius_m))
    r = r.withColumn("_x", F.explode(cells_in_reach(F.col("lng2"), reach_of(F.col("lat2"), radius_m), F.col("_m"))))
    r = r.withColumn("_x", F.pmod("_x", "_m")).drop("_m")
    close = F.abs(F.col("lat") - F.col("lat2")) <= radius_m / CELL_M
    pairs = l.join(r.hint("merge"), ["_y", "_x"]).filter(close).withColumn("d", haversine(F.col("lat"), F.col("lng"), F.col("lat2"), F.col("lng2")))
    return pairs.filter(F.col("d") <= radius_m).drop("_y", "_x")
