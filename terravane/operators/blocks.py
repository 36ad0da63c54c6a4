"""Sums and nearest points within radii where many points are dense, from blocks of sites and the points around them.

Sites stand in one tile, points are copied to the tiles that they can reach, and Spark brings both together: a site is
shuffled once, however many points surround it. How wide tiles are follows from the share of the sites in one, not from
their number, so that a point has as many copies in a large table as in a small one alike. Inside a block points are sorted
by thin rows and by longitude. What a circle surely holds of a row is one range, summed from running totals; only points at the ends of the
ranges are measured. A circle among n points costs about the square root of n.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geo import EARTH_M, cells_in_reach, grid_cell, grid_row, reach_of, row_cells
from ..functions.storage import written

#: Of one block: points, sites, listed points of sites, and pairs of sites and rows (or points) at once.
MOST_POINTS, MOST_SITES, MOST_LISTED, AT_ONCE = 1 << 20, 1 << 17, 2_500_000, 1 << 21
FEW_SITES, BLOCKS = 1000, 64  # a block may have so many sites, or this part of them all
WIDEST, THINNEST = 4.0, 1 / 8  # tiles, in radii
MOST_ROWS = 1024
MOST_KEYS = 16
CHUNKS = 1 << 12
STEP = 4  # from one radius of a search to the next


def crowd(df: DataFrame, size_m: float) -> tuple[int, int]:
    """How many rows have a place, and how many at most stand in one tile."""
    y, x = grid_cell(F.col("lat"), F.col("lng"), size_m)
    tiles = df.filter("lat is not null and lng is not null").groupBy(y.alias("y"), x.alias("x")).agg(F.count("*").alias("n"))
    total, most = tiles.agg(F.sum("n"), F.max("n")).first()
    return total or 0, most or 0


class Tiling(NamedTuple):
    """Tiles of `wide` radii, and into how many parts the sites and the points of a tile are dealt."""

    wide: float
    s_parts: int
    p_parts: int
    slots: int


def copies(wide: float) -> float:
    """How many tiles of `wide` radii a point reaches, on the whole."""
    return (1 + 2 / wide) ** 2


def tiling(sites: DataFrame, points: DataFrame, radius_m: float, most_sites: int | None = None) -> Tiling:
    """Where a tile as wide as the radius has more than a block's sites, tiles are thinner, since the sites of one place meet
    fewer points than parts of a whole tile do; where it has few, tiles are wider. Sites that stand too close for that
    are dealt into parts."""
    size, most_sites = max(radius_m, 1.0), most_sites or MOST_SITES
    (n_sites, sites_most), (n_points, points_most) = crowd(sites, size), crowd(points, size)
    sites_most, points_most = max(sites_most, 1), max(points_most, 1)
    aim = max(1.0, min(most_sites / 1.5, max(FEW_SITES, n_sites / BLOCKS)))
    parts = lambda most: math.ceil(most / (1.5 * aim))
    wide, s_parts = 1.0, parts(sites_most)
    if sites_most > aim:
        thin = max(THINNEST, math.sqrt(aim / sites_most))
        less = parts(max(crowd(sites, size * thin)[1], 1))
        if copies(thin) * less < copies(1) * s_parts:
            wide, s_parts = thin, less
    else:  # four times as many blocks, and not so many points in one
        wide = max(1.0, min(WIDEST, math.sqrt(aim / 4 / sites_most), math.sqrt(MOST_POINTS / 4 / points_most) - 2))
    p_parts = math.ceil((max(wide, 1) + 2) ** 2 * points_most / MOST_POINTS)
    s_parts = min(s_parts, max(1, CHUNKS // p_parts))
    return Tiling(wide, s_parts, p_parts, math.ceil(n_sites * p_parts / 5000 + copies(wide) * n_points * s_parts / 200_000) + 1)


def dealt(sites: DataFrame, points: DataFrame, radius_m: float, by: tuple[str, str] | None = None, plan: Tiling | None = None):
    """Both sides with a tile and the number of the block that holds it: a site's tile has all points within radius_m, each
    once. Sites and points of a crowded tile are dealt into several, each part of the one meeting each of the other.
    `by` names a column of either side; rows of unlike values never meet, so that they may stand in different blocks."""
    by, (wide, s_parts, p_parts, slots) = by or (), plan or tiling(sites, points, radius_m)
    size, arc = max(radius_m, 1.0) * wide, math.degrees(radius_m / EARTH_M) * (1 + 1e-9) + 1e-9

    def blocked(df: DataFrame, *extra: str) -> DataFrame:
        tile = (F.col("_y").cast("long") * (1 << 26) + F.col("_x").cast("long")) * CHUNKS + F.col("_sc") * p_parts + F.col("_pc")
        df = df.withColumn("_tile", tile.cast("long")).drop("_y", "_x", "_sc", "_pc")
        return df.withColumn("_slot", F.pmod(F.xxhash64("_tile", *extra), F.lit(slots)))

    part_of = lambda n, *c: F.pmod(F.xxhash64(*c), F.lit(n)) if n > 1 else F.lit(0).cast("long")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))) if n > 1 else F.lit(0).cast("long")
    y, x = grid_cell(F.col("lat"), F.col("lng"), size)
    s = sites.filter("lat is not null and lng is not null").withColumns({"_y": y, "_x": x, "_sc": part_of(s_parts, "place_id"), "_pc": every(p_parts)})
    p = points.filter("lat is not null and lng is not null").withColumn("_pc", part_of(p_parts, "lat", "lng"))
    p = p.withColumn("_y", F.explode(F.sequence(grid_row(F.col("lat") - arc, size), grid_row(F.col("lat") + arc, size))))
    p = p.withColumn("_m", row_cells(F.col("_y"), size))
    p = p.withColumn("_x", F.explode(cells_in_reach(F.col("lng"), reach_of(F.col("lat"), radius_m), F.col("_m"))))
    p = p.withColumn("_x", F.pmod("_x", "_m")).drop("_m").withColumn("_sc", every(s_parts))
    return blocked(s, *by[:1]), blocked(p, *by[1:])


def _numbers(table: pa.Table, name: str, kind=float) -> np.ndarray:
    return table.column(name).to_numpy().astype(kind, copy=False)


def _metres(lat1, lng1, lat2, lng2) -> np.ndarray:
    a = np.sin(np.radians(lat2 - lat1) / 2) ** 2 + np.cos(np.radians(lat1)) * np.cos(np.radians(lat2)) * np.sin(np.radians(lng2 - lng1) / 2) ** 2
    return 2 * EARTH_M * np.arcsin(np.sqrt(np.minimum(1.0, a)))


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the ranges [first, last), and which range each is of."""
    n = np.maximum(last - first, 0)
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + first[of], of


class Rows:
    """Points (lat, lng; tile: a number from 0) by rows of a part of a radius, sorted by longitude in each."""

    def __init__(self, tile, lat, lng, s_tile, s_lat, s_lng, radius_m: float, rows: int):
        self.s_tile, self.s_lat, self.s_lng, self.radius_m = s_tile, s_lat, s_lng, radius_m
        self.arc = math.degrees(min(radius_m / EARTH_M, math.pi)) * (1 + 1e-9) + 1e-12
        self.high = 2 * self.arc / rows
        n = int(s_tile.max()) + 1
        row_of = lambda c: np.floor((c + 90) / self.high).astype(np.int64)
        low = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(low, s_tile, row_of(s_lat - self.arc))
        self.low, self.s_row, self.reach = low, row_of(s_lat - self.arc), rows + 2
        self.many = int((self.s_row - low[s_tile]).max()) + self.reach
        self.middle = np.zeros(n)
        self.middle[s_tile] = s_lng
        at = row_of(lat) - low[tile]
        held = np.flatnonzero((at >= 0) & (at < self.many))
        x = self._east(lng[held], tile[held])
        self.west, self.wide = (float(x.min()), max(float(np.ptp(x)), 1e-9)) if len(x) else (0.0, 1.0)
        key = (tile[held] * self.many + at[held]) + self._part(x)
        order = np.argsort(key, kind="stable")
        self.key, self.index = key[order], held[order]
        self.lat, self.lng = lat[self.index], lng[self.index]

    def _east(self, lng, tile):
        return (lng - self.middle[tile] + 180) % 360 - 180

    def _part(self, x):
        """From 0.01 to 0.99 along a row; rounding is far below the slack of ranges."""
        return np.clip(0.01 + 0.98 * (x - self.west) / self.wide, 0.005, 0.995)

    def ranges(self, some: np.ndarray, inner: bool):
        """Of sites and rows (arrays of both dimensions): ranges [a, d) of the sorted points that hold all points within the
        radius, and [b, c) in them that hold no others."""
        lat, tile = self.s_lat[some][:, None], self.s_tile[some]
        row = self.s_row[some][:, None] + np.arange(self.reach)
        base = tile[:, None] * self.many + (row - self.low[tile][:, None])
        south = row * self.high - 90
        off = np.maximum(np.maximum(south - lat, lat - south - self.high) - 1e-12, 0)
        far = np.maximum(lat - south, south + self.high - lat) + 1e-12
        ends = np.cos(np.radians(np.clip(south, -90, 90))), np.cos(np.radians(np.clip(south + self.high, -90, 90)))
        sine2, mid = math.sin(min(self.radius_m / EARTH_M, math.pi) / 2) ** 2, np.cos(np.radians(lat))
        with np.errstate(divide="ignore", invalid="ignore"):
            out = (sine2 * (1 + 1e-9) + 1e-22 - np.sin(np.radians(off) / 2) ** 2) / np.maximum(mid * np.minimum(*ends), 1e-300)
        slack = 1e-8 * self.wide + 1e-11
        reach = np.where(out < 0, -1.0, 2 * np.degrees(np.arcsin(np.sqrt(np.clip(out, 0, 1)))) + slack)
        x = self._east(self.s_lng[some], tile)[:, None]
        round_it = np.abs(x) + reach >= 180  # over the far meridian, or round a pole: the whole row
        find = lambda z: np.searchsorted(self.key, base + self._part(z))
        a = np.where(round_it, np.searchsorted(self.key, base), find(x - reach))
        d = np.where(round_it, np.searchsorted(self.key, base + 1), np.searchsorted(self.key, base + self._part(x + reach), "right"))
        d = np.where(reach < 0, a, np.maximum(a, d))
        if not inner:
            return a, d, d, d
        widest = np.where((south < 0) & (south + self.high > 0), 1.0, np.maximum(*ends))
        within = (sine2 * (1 - 1e-9) - 1e-22 - np.sin(np.radians(np.minimum(far, 180)) / 2) ** 2) / np.maximum(mid * widest, 1e-300)
        sure = 2 * np.degrees(np.arcsin(np.sqrt(np.clip(within, 0, 1)))) - slack
        whole = (within > 0) & (sure > 0) & ~round_it
        b = np.where(whole, np.clip(np.searchsorted(self.key, base + self._part(x - sure), "right"), a, d), d)
        c = np.where(whole, np.clip(find(x + sure), b, d), d)
        return a, b, c, d

    def measured(self, some, first, last) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(site, sorted point, metres) of the points of ranges, by site, that are within the radius."""
        point, of = _spread(first.ravel(), last.ravel())
        site = some[of // first.shape[1]]
        d = _metres(self.s_lat[site], self.s_lng[site], self.lat[point], self.lng[point])
        near = d <= self.radius_m
        return site[near], point[near], d[near]


def _by_few(n: int, each: int) -> Iterator[np.ndarray]:
    step = max(1, AT_ONCE // max(each, 1))
    for a in range(0, n, step):
        yield np.arange(a, min(n, a + step))


def _tiles(sites: pa.Table, points: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tiles of sites and of points as numbers from 0, and which points stand in a site's tile."""
    known, s_tile = np.unique(_numbers(sites, "_tile", np.int64), return_inverse=True)
    tile = _numbers(points, "_tile", np.int64)
    at = np.minimum(np.searchsorted(known, tile), len(known) - 1)
    held = np.flatnonzero(known[at] == tile)
    return s_tile, at[held], held


def _sums(s_tile, s_lat, s_lng, tile, lat, lng, key, weight, n_keys: int, radius_m: float, wide: float):
    """(sums, counts) by site and key; tiles are `wide` radii wide."""
    finite = np.isfinite(weight)
    sums, counts = np.zeros((len(s_lat), n_keys)), np.zeros((len(s_lat), n_keys))
    for part, inner in ((finite, True), (~finite, False)):  # what is not a number cannot go into running totals
        if not part.any():
            continue
        dense = part.sum() / ((wide + 2) ** 2 * len(np.unique(tile[part])))
        rows = int(min(MOST_ROWS, max(1, round(math.sqrt(1.3 * dense)))))
        block = Rows(tile[part], lat[part], lng[part], s_tile, s_lat, s_lng, radius_m, rows)
        k, w = key[part][block.index], weight[part][block.index]
        one = [np.concatenate([[0.0], np.cumsum(np.where(k == i, w, 0.0))]) for i in range(n_keys)] if inner else []
        n = [np.concatenate([[0], np.cumsum(k == i)]) for i in range(n_keys)] if inner else []
        for some in _by_few(len(s_lat), block.reach + int(8 * dense / rows)):
            a, b, c, d = block.ranges(some, inner)
            for i in range(len(one)):
                sums[some, i] += (one[i][c] - one[i][b]).sum(axis=1)
                counts[some, i] += (n[i][c] - n[i][b]).sum(axis=1)
            site, point, _ = block.measured(some, np.hstack([a, c]), np.hstack([b, d]))
            at = (site - some[0]) * n_keys + k[point]
            size = len(some) * n_keys
            sums[some] += np.bincount(at, w[point], size).reshape(-1, n_keys)
            counts[some] += np.bincount(at, minlength=size).reshape(-1, n_keys)
    return sums, counts


def radius_sums(sites: DataFrame, points: DataFrame, radius_m: float) -> DataFrame:
    """(place_id, _key, value): the sum of the weights _w of the points (lat, lng, _key, _w) within radius_m (inclusive) of
    each site, for each _key (null is one); no row where there are none. Points at one place and of one key are one."""
    places = points.groupBy("lat", "lng", "_key").agg(F.sum("_w").alias("_w"))
    plan = tiling(sites, places, radius_m)
    s, p = dealt(sites.select("place_id", "lat", "lng"), places, radius_m, plan=plan)
    kind = T.StructType([sites.select("place_id").schema[0], points.select("_key").schema[0], T.StructField("value", T.DoubleType())])

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [pa.table({"place_id": left.column("place_id").slice(0, 0), "_key": right.column("_key").slice(0, 0), "value": pa.array([], pa.float64())})]
        if len(left) and len(right):
            left = left.sort_by([("_tile", "ascending"), ("lat", "ascending")])
            s_tile, tile, held = _tiles(left, right)
            s_lat, s_lng = _numbers(left, "lat"), _numbers(left, "lng")
            lat, lng, w = (_numbers(right, c)[held] for c in ("lat", "lng", "_w"))
            names = pc.unique(right.column("_key"))
            key = pc.index_in(right.column("_key"), names).to_numpy()[held].astype(np.int64)
            for first in range(0, len(names), MOST_KEYS):
                of = np.flatnonzero((key >= first) & (key < first + MOST_KEYS))
                if len(of):
                    many = min(MOST_KEYS, len(names) - first)
                    sums, counts = _sums(s_tile, s_lat, s_lng, tile[of], lat[of], lng[of], key[of] - first, w[of], many, radius_m, plan.wide)
                    site, k = np.nonzero(counts)
                    parts.append(pa.table({"place_id": left.column("place_id").take(site), "_key": names.take(k + first), "value": sums[site, k]}))
        return pa.concat_tables(parts)

    found = s.groupBy("_slot").cogroup(p.groupBy("_slot")).applyInArrow(add, kind)
    return found.groupBy("place_id", "_key").agg(F.sum("value").alias("value"))


def _levels(sites: DataFrame, points: DataFrame, radius_m: float, most: int) -> DataFrame:
    """(place_id, lat, lng, _wanted, _level): for each site and key the least level whose radius (radius_m / STEP^level: the highest
    level) surely holds `most` points, as the site's own cell of that level does; 0 where none does."""
    spots = points.filter("lat is not null and lng is not null")
    highest = max(0, math.ceil(math.log(max(radius_m, 1.0), STEP)) - 1)
    keys = points.select(F.col("_key").alias("_wanted")).distinct()
    out = sites.select("place_id", "lat", "lng").filter("lat is not null and lng is not null").join(F.broadcast(keys), F.lit(True)).withColumn("_level", F.lit(0))
    # a cell is hardly higher and wider than its size but near a pole
    for level in range(1, highest + 1):
        size = radius_m / STEP**level / 2.2
        y, x = grid_cell(F.col("lat"), F.col("lng"), size)
        full = spots.groupBy(y.alias("_py"), x.alias("_px"), F.col("_key").alias("_pk")).agg(F.count("*").alias("_n")).filter(F.col("_n") >= most).drop("_n")
        if full.isEmpty():
            break
        same = (F.col("_y") == F.col("_py")) & (F.col("_x") == F.col("_px")) & F.col("_wanted").eqNullSafe(F.col("_pk")) & (row_cells(F.col("_y"), size) > 100)
        met = out.withColumns({"_y": y, "_x": x}).join(full, same, "left")
        out = met.select("place_id", "lat", "lng", "_wanted", F.when(F.col("_py").isNotNull(), level).otherwise(F.col("_level")).alias("_level"))
    return out


def nearest_points(sites: DataFrame, points: DataFrame, radius_m: float, most: int, order: list[str]) -> DataFrame:
    """Of each site and _key the nearest points within radius_m (inclusive), `most` at most: place_id, the points' columns
    (lat2 and lng2 their coordinates), d, and pos from 1 by d and then `order` (columns of points).

    A site is searched with the radius of its level only, which surely holds enough."""
    plain = [{"lat2": "lat", "lng2": "lng"}.get(c, c) for c in order]
    # of points at one place no more than the first can be on any list
    first = W.partitionBy("lat", "lng", "_key").orderBy(*plain)
    points = points.withColumn("_nth", F.row_number().over(first)).filter(F.col("_nth") <= most).drop("_nth")
    levelled = written(_levels(sites, points, radius_m, most), "levels")
    named = [T.StructField({"lat": "lat2", "lng": "lng2"}.get(f.name, f.name), f.dataType) for f in points.schema]
    kind = T.StructType([sites.select("place_id").schema[0], *named, T.StructField("d", T.DoubleType()), T.StructField("pos", T.IntegerType())])
    out = None
    for level in sorted(r[0] for r in levelled.select("_level").distinct().collect()):
        some = levelled.filter(F.col("_level") == level).drop("_level")
        found = _nearest_of(some, points, radius_m / STEP**level, most, plain, kind)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else sites.sparkSession.createDataFrame([], kind)


def _nearest_of(sites: DataFrame, points: DataFrame, radius_m: float, most: int, order: list[str], kind: T.StructType) -> DataFrame:
    names = [f.name for f in points.schema]
    s, p = dealt(sites, points, radius_m, ("_wanted", "_key"), tiling(sites, points, radius_m, min(MOST_SITES, max(1, MOST_LISTED // most))))

    def pick(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [_listed(left.slice(0, 0), right.slice(0, 0), np.zeros(0), np.zeros(0, np.int32))]
        for key in pc.unique(left.column("_wanted")).to_pylist() if len(right) else ():
            of = lambda t, c: t.filter(pc.is_null(t.column(c)) if key is None else pc.equal(t.column(c), key))  # noqa: B023, E731
            mine, near = of(left, "_wanted").sort_by([("_tile", "ascending"), ("lat", "ascending")]), of(right, "_key")
            if not len(near):
                continue
            near = near.take(pc.sort_indices(near, [(c, "ascending") for c in order], null_placement="at_start"))
            s_tile, tile, held = _tiles(mine, near)
            if len(held):
                parts += [_listed(mine.take(site), near.take(held[point]), d, pos) for site, point, d, pos in nearest(s_tile, _numbers(mine, "lat"), _numbers(mine, "lng"), tile, _numbers(near, "lat")[held], _numbers(near, "lng")[held], radius_m, most)]
        return pa.concat_tables(parts)

    def _listed(left: pa.Table, right: pa.Table, d, pos) -> pa.Table:
        columns = [left.column("place_id"), *(right.column(c) for c in names), pa.array(d, pa.float64()), pa.array(pos, pa.int32())]
        return pa.table(columns, names=kind.names)

    return s.groupBy("_slot").cogroup(p.groupBy("_slot")).applyInArrow(pick, kind)


def nearest(s_tile, s_lat, s_lng, tile, lat, lng, radius_m: float, most: int):
    """(site, point, metres, pos) of the `most` nearest points of each site within radius_m, those that come first at one
    distance: radii grow until each circle holds enough."""
    left, radius = np.arange(len(s_lat)), radius_m / 16
    while len(left):
        known, own = np.unique(s_tile[left], return_inverse=True)
        at = np.minimum(np.searchsorted(known, tile), len(known) - 1)
        held = np.flatnonzero(known[at] == tile)
        if not len(held):
            return
        block = Rows(at[held], lat[held], lng[held], own, s_lat[left], s_lng[left], radius, 10)
        missing = []
        for some in _by_few(len(left), block.reach + 4 * most):
            a, _, _, d = block.ranges(some, False)
            for few in np.array_split(np.arange(len(some)), min(len(some), 1 + int((d - a).sum()) // (2 * AT_ONCE))):
                site, point, far = block.measured(some[few], a[few], d[few])
                point = block.index[point]
                enough = np.bincount(site - some[few[0]], minlength=len(few)) >= most if radius < radius_m else np.ones(len(few), bool)
                missing.append(some[few][~enough])
                full = enough[site - some[few[0]]]
                site, point, far = site[full], point[full], far[full]
                by = np.lexsort((point, far, site))
                site, point, far = site[by], point[by], far[by]
                starts = np.flatnonzero(np.concatenate([[True], site[1:] != site[:-1]])) if len(site) else np.zeros(0, int)
                pos = np.arange(len(site)) - np.repeat(starts, np.diff(np.append(starts, len(site)))) + 1
                kept = pos <= most
                yield left[site[kept]], held[point[kept]], far[kept], pos[kept]
        left = left[np.concatenate(missing)] if missing else left[:0]
        radius = min(radius_m, 2 * radius)
