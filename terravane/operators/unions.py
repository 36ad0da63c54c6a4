"""The area of a union of rings inside circles: the union is made once, on tiles of a grid, and serves all sites.

Tiles are a part of the largest radius high and wide, in degrees. What the rings cover of a tile is kept as trapezoids that do
not overlap. Sites are taken together by windows of tiles; of the tiles around a site those wholly inside its circle count
by running totals of their rows, and only trapezoids of tiles on the rim are cut by the circle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import polygons as P
from ..functions.geo import FLAT_M
from ..functions.storage import written
from .blocks import _numbers, _spread

TILES = 16  # to the largest radius
MOST_SITES = 5000  # of a window
AT_ONCE = 1 << 19  # trapezoids cut at once
PIECE = "ty long, tx long, area double, piece array<double>"


def _size(radius: float) -> float:
    return radius / FLAT_M / TILES


def _wide(lat, radius: float):
    """Degrees of longitude to either side that a circle reaches; the cosine is taken as 0.1 at least."""
    return F.lit(radius / FLAT_M) / F.greatest(F.cos(F.radians(lat)), F.lit(0.1))


def _window(radius: float) -> tuple:
    """The squares of sites as wide as the radius."""
    return tuple(F.floor(F.col(c) / (radius / FLAT_M)).cast("long") for c in ("lat", "lng"))


def _parts(df: DataFrame) -> int:
    """Geometry is long work on few bytes: its tasks are not to be put together by size."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def windows_of(sites: DataFrame, radius: float) -> DataFrame:
    """(by, bx, parts, y0, y1, x0, x1): squares that hold sites, into how many parts they are dealt, and the tiles (both ends
    included) that their sites' circles reach."""
    size, (by, bx) = _size(radius), _window(radius)
    reach = radius / FLAT_M
    of = sites.filter("lat is not null and lng is not null").groupBy(by.alias("by"), bx.alias("bx"))
    wide = F.max(_wide(F.col("lat"), radius))
    tile = lambda c, off: F.floor((c + off) / size).cast("long")
    found = of.agg(
        F.ceil(F.count("*") / F.lit(MOST_SITES)).cast("int").alias("parts"), F.min("lat").alias("s"), F.max("lat").alias("n"), F.min("lng").alias("w"), F.max("lng").alias("e"), wide.alias("wide"))
    ends = {"y0": tile(F.col("s"), -reach) - 1, "y1": tile(F.col("n"), reach) + 1, "x0": tile(F.col("w"), -F.col("wide")) - 1, "x1": tile(F.col("e"), F.col("wide")) + 1}
    return written(found.select("by", "bx", "parts", *(c.alias(k) for k, c in ends.items())), "windows")


def _held(windows: DataFrame) -> DataFrame:
    rows = windows.withColumn("ty", F.explode(F.sequence("y0", "y1")))
    return rows.withColumn("tx", F.explode(F.sequence("x0", "x1"))).drop("y0", "y1", "x0", "x1")


def tiles_of(windows: DataFrame) -> DataFrame:
    """(ty, tx): the tiles of all windows, each once."""
    return _held(windows).select("ty", "tx").distinct()


def pieces(tiled: DataFrame, size: float, most: int) -> DataFrame:
    """PIECE: what the rings of (ty, tx, ring) cover of each tile, in square degrees and as trapezoids (see covered), six
    numbers each in degrees from the tile's corner. Tiles that nothing covers are left out."""

    def cover(table: pa.Table) -> pa.Table:
        table = table.sort_by([("ty", "ascending"), ("tx", "ascending")])
        ty, tx = (_numbers(table, c, np.int64) for c in ("ty", "tx"))
        lists = table.column("ring").combine_chunks()
        ends = np.concatenate([[0], np.cumsum(np.nan_to_num(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64))])
        corners = lists.flatten()
        lng, lat = (corners.field(c).to_numpy(zero_copy_only=False) if len(corners) else np.zeros(0) for c in ("lng", "lat"))
        starts = np.flatnonzero(np.concatenate([[True], (ty[1:] != ty[:-1]) | (tx[1:] != tx[:-1])])) if len(ty) else np.zeros(0, int)
        rows = []
        for a, b in zip(starts, np.append(starts[1:], len(ty)), strict=True):
            south, west = ty[a] * size, tx[a] * size
            local = np.column_stack([lng[ends[a] : ends[b]] - west, lat[ends[a] : ends[b]] - south]) * FLAT_M
            cuts = ends[a : b + 1] - ends[a]
            high = np.array([((tx[a] + 1) * size - west), ((ty[a] + 1) * size - south)]) * FLAT_M
            n = np.diff(cuts)
            some = np.flatnonzero(n > 0)
            if not len(some):
                continue
            box = [f.reduceat(local, cuts[some], axis=0) for f in (np.minimum, np.maximum)]
            # rings that may fill the tile come first: where one does, the others are not looked at
            may = ((box[0] <= 0) & (box[1] >= high)).all(axis=1) & (n[some] <= 5)
            rings = []
            for i in some[np.argsort(~may, kind="stable")]:
                s = P.ring(local[cuts[i] : cuts[i + 1]])
                if len(s):
                    rings.append(s)
                    if len(s) == 4 and P.fills(s, [(0, 0), (0, high[1]), (high[0], 0), high]):
                        rings = [s]
                        break
            t = P.covered(rings, np.zeros(2), high, most) / FLAT_M
            area = float(((t[:, 1] - t[:, 0]) * ((t[:, 4] - t[:, 2]) + (t[:, 5] - t[:, 3]))).sum() / 2)
            if area > 0:
                rows.append((int(ty[a]), int(tx[a]), area, t.ravel()))
        ty, tx, area, piece = zip(*rows, strict=True) if rows else ((), (), (), ())
        return pa.table({"ty": pa.array(ty, pa.int64()), "tx": pa.array(tx, pa.int64()), "area": pa.array(area, pa.float64()), "piece": pa.array(piece, pa.list_(pa.float64()))})

    near = lambda c: F.floor(F.col(c) / 4)
    grouped = tiled.withColumns({"_gy": near("ty"), "_gx": near("tx")}).repartition(_parts(tiled), "_gy", "_gx").groupBy("_gy", "_gx")
    return grouped.applyInArrow(lambda t: cover(t.select(["ty", "tx", "ring"])), PIECE)


class Tiles:
    """The pieces of a window: sums along its rows, and where the trapezoids of each tile stand."""

    def __init__(self, ty, tx, area, piece, many, size: float):
        self.size, self.y0, self.x0 = size, int(ty.min()), int(tx.min())
        self.rows, self.cols = int(ty.max()) - self.y0 + 1, int(tx.max()) - self.x0 + 1
        at = (ty - self.y0) * self.cols + (tx - self.x0)
        order = np.argsort(at)
        whole, n = np.zeros(self.rows * self.cols), np.zeros(self.rows * self.cols, np.int64)
        whole[at], n[at] = area, many
        self.sums = np.hstack([np.zeros((self.rows, 1)), np.cumsum(whole.reshape(self.rows, self.cols), axis=1)])
        self.last = np.cumsum(n)
        self.first = self.last - n
        starts = np.cumsum(many) - many
        taken, of = _spread(starts[order], (starts + many)[order])
        corner = np.stack([tx, ty], axis=1)[order][of] * size
        self.piece = piece[taken] + corner[:, [0, 0, 1, 1, 1, 1]]

    def areas(self, lat, lng, radius: float) -> np.ndarray:
        """Square metres in circles; the plane is flat around each site."""
        out, size = np.zeros(len(lat)), self.size
        k = FLAT_M * np.cos(np.radians(lat))
        reach = 2 * math.ceil(radius / FLAT_M / size) + 3
        row = np.floor((lat - radius / FLAT_M) / size).astype(np.int64)[:, None] - 1 + np.arange(reach + 1)
        south = (row * size - lat[:, None]) * FLAT_M
        north = ((row + 1) * size - lat[:, None]) * FLAT_M
        near, far = np.maximum(np.maximum(south, -north) - 1e-6, 0), np.maximum(np.abs(south), np.abs(north)) + 1e-6
        sure = radius * math.cos(math.pi / P.SIDES) - 1e-6
        outer, inner = np.sqrt(np.maximum(radius**2 - near**2, 0)) + 1e-6, np.sqrt(np.maximum(sure**2 - far**2, 0)) - 1e-6
        column = lambda metres, f: np.clip(f((lng[:, None] + metres / np.maximum(k, 1e-6)[:, None]) / size) - self.x0, 0, self.cols).astype(np.int64)
        a, d = column(-outer, np.floor), column(outer, lambda z: np.floor(z) + 1)
        known = (near <= radius) & (row >= self.y0) & (row < self.y0 + self.rows)
        d = np.where(known, d, a)
        b, c = column(-inner, np.ceil), column(inner, np.floor)
        whole = known & (inner > 0) & (c > b)
        b, c = np.where(whole, b, d), np.where(whole, c, d)
        at = np.where(known, row - self.y0, 0)
        out += (self.sums[at, c] - self.sums[at, b]).sum(axis=1) * FLAT_M * k
        base = at * self.cols
        tile, of = _spread(np.hstack([base + a, base + c]).ravel(), np.hstack([base + b, base + d]).ravel())
        site = of // (2 * a.shape[1])
        many = self.last[tile] - self.first[tile]
        for some in np.array_split(np.arange(len(tile)), 1 + int(many.sum()) // AT_ONCE):
            number, of = _spread(self.first[tile[some]], self.last[tile[some]])
            who, p = site[some][of], self.piece[number]
            x, y = (p[:, [0, 1, 1, 0]] - lng[who, None]) * k[who, None], (p[:, [2, 3, 5, 4]] - lat[who, None]) * FLAT_M
            out += np.bincount(who, P.quads_in_circle(x, y, radius), len(lat))
        return out


def areas(sites: DataFrame, windows: DataFrame, found: DataFrame, size: float, radii: Sequence[int]) -> DataFrame:
    """(place_id, r, value): square metres that the pieces cover of each site's circles; no row for sites beside none."""
    by, bx = _window(float(max(radii)))
    known = windows.select("by", "bx", "parts")
    at = sites.filter("lat is not null and lng is not null").select("place_id", "lat", "lng", by.alias("by"), bx.alias("bx")).join(known, ["by", "bx"])
    at = at.select("place_id", "lat", "lng", "by", "bx", F.pmod(F.xxhash64("place_id"), F.col("parts")).cast("int").alias("part"))
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    held = _held(windows).join(found, ["ty", "tx"]).select("by", "bx", "ty", "tx", "area", "piece", every)
    kind = sites.select("place_id").schema.add("r", "integer").add("value", "double")

    def measure(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [pa.table({"place_id": left.column("place_id").slice(0, 0), "r": pa.array([], pa.int32()), "value": pa.array([], pa.float64())})]
        if len(left) and len(right):
            piece = right.column("piece").combine_chunks()
            many = pc.list_value_length(piece).to_numpy(zero_copy_only=False).astype(np.int64) // 6
            tiles = Tiles(_numbers(right, "ty", np.int64), _numbers(right, "tx", np.int64), _numbers(right, "area"), piece.flatten().to_numpy(zero_copy_only=False).reshape(-1, 6), many, size)
            lat, lng = _numbers(left, "lat"), _numbers(left, "lng")
            for r in radii:
                value = np.concatenate([tiles.areas(lat[i : i + 1000], lng[i : i + 1000], float(r)) for i in range(0, len(lat), 1000)])
                parts.append(pa.table({"place_id": left.column("place_id"), "r": pa.array(np.full(len(value), r), pa.int32()), "value": value}))
        return pa.concat_tables(parts)

    key = ["by", "bx", "part"]
    at, held = (df.repartition(_parts(sites), *key).groupBy(*key) for df in (at, held))
    return at.cogroup(held).applyInArrow(measure, kind)
