"""What lies around each site: counts, sums, lists, land area and campuses within radii.

Counts and sums come from sums of cells of a size for each radius (see cells), as long facts (place_id, col, value); columns
are made by one pivot at the end.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import polygons as P
from ..functions.geo import FLAT_M, radius_pairs
from ..functions.storage import written
from ..functions.text import blank, half_even, slug
from . import blocks, campuses, shares, unions
from .cells import FEW_POINTS, MOST_PARTS, density, nearest_points, parts_of_radius, radius_sums
from .ranks import numbered

MOST_ITEMS = 50
MOST_SITES, SQUARE_PARTS = 4096, 4096  # of a part of a square of sites, and parts of a square
ITEM = "name STRING, metres INT, extra DOUBLE, lat DOUBLE, lng DOUBLE"


def _pois(pois: DataFrame, weight: str | None, feature: str | None = None) -> DataFrame:
    pick = lambda c, kind: F.col(c).cast(kind) if c in pois.columns else F.lit(None).cast(kind)
    return pois.select("lat", "lng", pick("name", "string").alias("_name"), (F.col("ord") if "ord" in pois.columns else F.lit(None).cast("long")).alias("_ord"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_w"), (slug(F.col("category")) if "category" in pois.columns else F.lit(None).cast("string")).alias("_cat"), (F.col(feature) if feature else F.lit(None).cast("string")).alias("_feature"))


def _keyed(p: DataFrame, keys) -> DataFrame:
    return p.select("lat", "lng", keys.alias("_key"), F.coalesce("_w", F.lit(0.0)).alias("_w"))


def _by_cells(n: int, dense: float) -> bool:
    """Are points so few and sparse that cells, broadcast, leave few pairs for each site; else blocks of points do."""
    return n <= FEW_POINTS and dense <= 3 * MOST_PARTS**3


def _sums(sites: DataFrame, points: DataFrame, radii: Sequence[int]) -> DataFrame:
    """(place_id, _key, _r, value) of the points within each radius; each radius has cells or tiles of its own size."""
    top = max(radii)
    n, dense = density(points, float(top))
    parts = {r: parts_of_radius(dense * (r / top) ** 2) for r in radii}
    by_cells = _by_cells(n, dense)
    each = [(radius_sums(sites, points, float(r), parts[r], n) if by_cells else blocks.radius_sums(sites, points, float(r))).withColumn("_r", F.lit(r)) for r in radii]
    out = each[0]
    for more in each[1:]:
        out = out.unionByName(more)
    return out


def radius_measures(sites: DataFrame, pois: DataFrame, radii: Sequence[int], name: str, weight: str | None = None) -> DataFrame:
    """(place_id, col, value) for every site: <name>_<r>, and <name>_<category>_<r> for each category of pois. Value is the
    number of points within r (inclusive), or the sum of their weights; 0 where there are none."""
    p = _pois(pois, weight)
    has_categories = "category" in pois.columns
    cats = F.array(F.lit("\0"), F.col("_key")) if has_categories else F.array(F.lit("\0"))
    found = _sums(sites, _keyed(p, F.col("_cat")), radii).select("place_id", "_r", "value", F.explode(cats).alias("_cat"))
    found = found.groupBy("place_id", "_cat", "_r").agg(F.sum("value").alias("value"))
    if has_categories:
        cats = p.select("_cat").distinct().agg(F.sort_array(F.collect_set("_cat")).alias("_cats"))
        # every site with every category of the file: categories are the columns of the result
        grid = sites.select("place_id").join(F.broadcast(cats), F.lit(True)).select("place_id", F.explode(F.array_append("_cats", "\0")).alias("_cat"))
    else:
        grid = sites.select("place_id", F.lit("\0").alias("_cat"))
    grid = grid.select("*", F.explode(F.array(*map(F.lit, radii))).alias("_r")).join(found, ["place_id", "_cat", "_r"], "left")
    col = F.concat_ws("_", F.lit(name), F.nullif(F.col("_cat"), F.lit("\0")), F.col("_r").cast("string"))
    return grid.select("place_id", col.alias("col"), F.coalesce("value", F.lit(0.0)).alias("value"))


def layer_measures(sites: DataFrame, points: DataFrame, features: Sequence[str], radii: Sequence[int]) -> DataFrame:
    """(place_id, col, value): counts of the points of several features (long table: feature, lat, lng)."""
    p = _pois(points.filter(F.col("feature").isin(*features)), None, "feature")
    found = _sums(sites, _keyed(p, F.col("_feature")), radii)
    cells = F.explode(F.array(*map(F.lit, features))).alias("_key")
    grid = sites.select("place_id", cells).select("*", F.explode(F.array(*map(F.lit, radii))).alias("_r")).join(found, ["place_id", "_key", "_r"], "left")
    return grid.select("place_id", F.concat_ws("_", "_key", F.col("_r").cast("string")).alias("col"), F.coalesce("value", F.lit(0.0)).alias("value"))


def nearest_items(sites: DataFrame, pois: DataFrame, radii: Sequence[int], name: str, weight: str | None = None, most: int = MOST_ITEMS) -> DataFrame:
    """(place_id, col, pos, name, metres, extra, lat, lng): for each site and column of radius_measures the nearest points,
    at most `most`, in order of distance, then of ord (or name and place). A smaller radius has the first of the largest's."""
    p = _pois(pois, weight)
    cats = F.array(F.lit("\0"), F.col("_cat")) if "category" in pois.columns else F.array(F.lit("\0"))
    points = p.select("lat", "lng", "_ord", "_name", "_w", F.explode(cats).alias("_key"))
    top = float(max(radii))
    n, dense = density(points, top)
    order = ["_ord", "_name", "lat2", "lng2"]
    near = nearest_points(sites, points, top, most, order, parts_of_radius(dense), n) if _by_cells(n, dense) else blocks.nearest_points(sites, points, top, most, order)
    rows = near.withColumn("_r", F.explode(F.array(*map(F.lit, radii)))).filter(F.col("d") <= F.col("_r"))
    col = F.concat_ws("_", F.lit(name), F.nullif(F.col("_key"), F.lit("\0")), F.col("_r").cast("string"))
    return rows.select("place_id", col.alias("col"), "pos", blank(F.col("_name")).alias("name"), F.rint("d").cast("int").alias("metres"), (F.col("_w") if weight else F.lit(None).cast("double")).alias("extra"), F.round("lat2", 6).alias("lat"), F.round("lng2", 6).alias("lng"))


def pivot_wide(sites: DataFrame, facts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """sites' place_id with one column for each name; null where there is no fact."""
    wide = facts.filter(F.col("col").isin(*columns)).groupBy("place_id").pivot("col", list(columns)).agg(F.max("value"))
    return sites.select("place_id").join(wide, "place_id", "left")


def ring_cells(rings: DataFrame, radius: float) -> tuple[DataFrame, DataFrame, list[int]]:
    """Where rings stand, however large they are: a written table of the rings with a key `_rid` and their boxes, rows
    (_level, _y, _x, _rid, box) of which each ring has four at most, and the levels in use (about thirty at most).

    A ring stands in the cells of the level whose cells are as wide as its box widened by the radius."""
    step = max(radius / FLAT_M, 1e-6)
    corner = lambda f, k: f(F.transform("ring", lambda p: p[k]))
    box = {"_s": corner(F.array_min, "lat"), "_n": corner(F.array_max, "lat"), "_wst": corner(F.array_min, "lng"), "_e": corner(F.array_max, "lng")}
    boxed = rings.select("ring_id", "name", "ring").withColumns(box).filter("_s is not null and _wst is not null")
    narrow = F.greatest(F.cos(F.radians(F.greatest(F.abs("_s"), F.abs("_n")) + step)), F.lit(0.1))
    boxed = boxed.withColumn("_wide", F.lit(step) / narrow)
    size = F.greatest(F.col("_n") - F.col("_s") + 2 * step, F.col("_e") - F.col("_wst") + 2 * F.col("_wide"))
    level = F.greatest(F.ceil(F.log2(size / (2 * step))), F.lit(0)).cast("int")
    boxed = written(boxed.withColumns({"_level": level, "_rid": F.monotonically_increasing_id()}), "rings")
    cells = lambda lo, hi: F.explode(F.sequence(_cell(lo, F.col("_level"), step), _cell(hi, F.col("_level"), step)))
    where = boxed.select("_level", "_rid", "_s", "_n", "_wst", "_e", "_wide")
    where = where.withColumn("_y", cells(F.col("_s") - step, F.col("_n") + step))
    where = where.withColumn("_x", cells(F.col("_wst") - F.col("_wide"), F.col("_e") + F.col("_wide")))
    return boxed, where, sorted(r[0] for r in boxed.select("_level").distinct().collect())


def _cell(c, level, step: float):
    return F.floor(c / (F.lit(2 * step) * F.pow(F.lit(2.0), level))).cast("long")


def _ring_pairs(sites: DataFrame, rings: DataFrame, radius: float, key: Sequence[str] = ("place_id",)) -> tuple[DataFrame, DataFrame]:
    """(place_id or another key, lat, lng, _rid, box) of sites and rings whose boxes come within radius, and the table of the rings: sites
    stand in one cell of each level in use, and an equi-join on cells brings keys together, not outlines."""
    boxed, where, levels = ring_cells(rings, radius)
    step = max(radius / FLAT_M, 1e-6)
    level = F.explode(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>")).alias("_level")
    # the work grows with the pairs, not with the bytes of the sites
    at = sites.select(*key, "lat", "lng").repartition(_parts(sites)).select("*", level)
    at = at.withColumns({"_y": _cell(F.col("lat"), F.col("_level"), step), "_x": _cell(F.col("lng"), F.col("_level"), step)})
    inside = (F.col("lat") >= F.col("_s") - step) & (F.col("lat") <= F.col("_n") + step) & (F.col("lng") >= F.col("_wst") - F.col("_wide")) & (F.col("lng") <= F.col("_e") + F.col("_wide"))
    return at.join(where, ["_level", "_y", "_x"]).filter(inside).drop("_level", "_y", "_x"), boxed


def _near_rings(sites: DataFrame, rings: DataFrame, radius: float) -> DataFrame:
    """(place_id, lat, lng, ring_id, name, ring) of sites and rings whose boxes come within radius."""
    pairs, boxed = _ring_pairs(sites, rings, radius)
    shapes = boxed.select("_rid", "ring_id", blank(F.col("name")).alias("name"), "ring")
    return pairs.select("place_id", "lat", "lng", "_rid").join(shapes, "_rid").drop("_rid")


def _parts(df: DataFrame) -> int:
    """Geometry is long work on few bytes: its tasks are not to be put together by size."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _local(row_ring, lat: float, lng: float) -> np.ndarray:
    k = FLAT_M * np.cos(np.radians(lat))
    return P.ring([((p["lng"] - lng) * k, (p["lat"] - lat) * FLAT_M) for p in row_ring])


def _degrees(x: float, y: float, lat: float, lng: float) -> tuple[float, float]:
    return round(lat + y / FLAT_M, 6), round(lng + x / (FLAT_M * np.cos(np.radians(lat))), 6)


def hectares(rings, lat: float, lng: float, radii: Sequence[int]) -> dict[int, float]:
    """Hectares of the union of the rings (lists of lng and lat) inside each circle, to 2 places."""
    shapes = [s for r in rings if len(s := _local(r, lat, lng))]
    near = {r: [s for s in shapes if P.distance(s) <= r] for r in radii}
    return {r: round(P.union_area(some, P.circle(r)) / 10_000, 2) for r, some in near.items()}


def repaired_rings(rings: DataFrame) -> DataFrame:
    """(ring_id, name, part, hole, hectares, ring): each ring as simple rings, filled where it was by the even-odd rule;
    a ring that crosses itself has several parts, one without area none. Parts are in order of their size, holes
    (hole = true) have negative areas. hectares is flat, to 4 places. Rings that are null or empty have no parts."""

    def repair(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in found:
            rows = []
            for m in g.itertuples(index=False):
                if m.ring is None or not len(m.ring):
                    continue
                lat, lng = m.ring[0]["lat"], m.ring[0]["lng"]
                k = FLAT_M * np.cos(np.radians(lat))
                corners = [((p["lng"] - lng) * k, (p["lat"] - lat) * FLAT_M) for p in m.ring]
                own = {(round(x * 1e6), round(y * 1e6)): p for (x, y), p in zip(corners, m.ring, strict=True)}  # as given
                parts = P.simple_rings(corners)
                for i, part in enumerate(sorted(parts, key=lambda r: (-abs(P.signed_area(r)), r.min(axis=0).tolist()))):
                    back = [own.get((round(x * 1e6), round(y * 1e6)), {"lng": lng + x / k, "lat": lat + y / FLAT_M}) for x, y in part]
                    ha = P.signed_area(part) / 10_000
                    rows.append((m.ring_id, m.name, i, ha < 0, round(ha, 4), back))
            yield pd.DataFrame(rows, columns=["ring_id", "name", "part", "hole", "hectares", "ring"])

    kind = rings.schema["ring_id"].dataType.simpleString()
    schema = f"ring_id {kind}, name string, part int, hole boolean, hectares double, ring array<struct<lng:double,lat:double>>"
    return rings.select("ring_id", F.col("name").cast("string").alias("name"), "ring").mapInPandas(repair, schema)


def _upright() -> Column:
    """Is a ring an upright rectangle of four corners, closed or not."""
    p = [F.get("ring", F.lit(i)) for i in range(5)]
    same = lambda c, i, j: p[i][c] == p[j][c]
    turns = lambda a, b: same(a, 0, 1) & same(b, 1, 2) & same(a, 2, 3) & same(b, 3, 0)
    closed = (F.size("ring") == 4) | ((F.size("ring") == 5) & same("lat", 0, 4) & same("lng", 0, 4))
    return F.coalesce(closed & (turns("lat", "lng") | turns("lng", "lat")) & (F.col("_n") > F.col("_s")) & (F.col("_e") > F.col("_wst")), F.lit(False))


def _squares(sites: DataFrame, rings: DataFrame, radius: float, fine: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sites by squares of a part of the radius, and the rings that a circle round any place of a square can reach: sites with
    _block, (_block, _rid, box), and the table of the rings. Crowded squares are dealt into several blocks, each of which
    has all of the square's rings."""
    size = max(radius / FLAT_M, 1e-6) / fine
    square = {c: F.floor(F.col(x) / size).cast("long") for c, x in (("_by", "lat"), ("_bx", "lng"))}
    at = sites.filter("lat is not null and lng is not null").withColumns(square)
    dealt = F.least(F.ceil(F.count("*") / F.lit(MOST_SITES)), F.lit(SQUARE_PARTS)).alias("_dealt")
    known = written(at.groupBy("_by", "_bx").agg(dealt).withColumn("_first", F.monotonically_increasing_id() * SQUARE_PARTS), "squares")
    spots = known.withColumns({"lat": (F.col("_by") + 0.5) * size, "lng": (F.col("_bx") + 0.5) * size})
    pairs, boxed = _ring_pairs(spots, rings, radius + size / 2 * FLAT_M + 0.01, ("_first", "_dealt"))
    off = lambda low, high, c: F.greatest(F.col(low) - F.col(c) - size / 2, F.col(c) - size / 2 - F.col(high), F.lit(0.0)) * FLAT_M
    narrow = F.cos(F.radians(F.least(F.abs("lat") + size, F.lit(90.0))))
    east, north = off("_wst", "_e", "lng") * narrow, off("_s", "_n", "lat")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_dealt").cast("long") - 1)).alias("_part")
    near = pairs.filter(east * east + north * north <= (radius + 0.01) ** 2).select("_first", "_rid", "_s", "_n", "_wst", "_e", every)
    near = near.withColumn("_block", F.col("_first") + F.col("_part")).drop("_first", "_part")
    at = at.join(known, ["_by", "_bx"]).withColumn("_block", F.col("_first") + F.pmod(F.xxhash64("place_id"), F.col("_dealt")))
    return at.drop("_by", "_bx", "_first", "_dealt"), near, boxed


def ring_metres(sites: DataFrame, rings: DataFrame, radius: float) -> DataFrame:
    """(place_id, ring_id, metres): the rings that meet a site's circle, and how far they are (0: the site is inside).

    Upright rectangles meet the sites of a square by a join, which only brings the rows of the result out of a task; the outlines
    of other rings are joined to their sites."""
    radius = float(radius)

    def far(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in found:
            shapes = _shapes(g)
            d = shapes.distances()
            near = d <= radius
            at = pa.array(shapes.which[near])
            yield pa.RecordBatch.from_arrays([g.column("place_id").take(at), g.column("ring_id").take(at), pa.array(np.rint(d[near]).astype(np.int32))], names=["place_id", "ring_id", "metres"])

    at, near, boxed = _squares(sites.select("place_id", "lat", "lng"), rings, radius, 4)
    kinds = boxed.withColumn("_upright", _upright())
    boxes = near.join(kinds.filter("_upright").select("_rid", "ring_id"), "_rid").drop("_rid").repartition(4 * _parts(sites), "_block")
    at = at.withColumn("_k", F.cos(F.radians("lat"))).repartition(4 * _parts(sites), "_block")  # once for all pairs of a site
    off = lambda low, high, c: F.when(F.col(c) < F.col(low), F.col(low) - F.col(c)).when(F.col(c) > F.col(high), F.col(c) - F.col(high)).otherwise(0.0) * FLAT_M
    d = F.sqrt(F.pow(off("_wst", "_e", "lng") * F.col("_k"), 2) + F.pow(off("_s", "_n", "lat"), 2))
    found = at.join(boxes.hint("merge"), "_block").filter(d <= radius).select("place_id", "ring_id", F.rint(d).cast("int").alias("metres"))
    schema = sites.select("place_id").schema.add("ring_id", rings.schema["ring_id"].dataType).add("metres", "integer")
    others = kinds.filter(~F.col("_upright")).select("ring_id", "name", "ring")
    return found.unionByName(_near_rings(sites, others, radius).mapInArrow(far, schema))


def _shapes(g: pa.RecordBatch) -> P.Ragged:
    """The rings of a batch (lat, lng, ring), each flat around its site."""
    ring, lat, lng = g.column("ring"), *(g.column(c).to_numpy() for c in ("lat", "lng"))
    n = pc.fill_null(pc.list_value_length(ring), 0).to_numpy()
    corners = ring.flatten()
    k = FLAT_M * np.cos(np.radians(lat))
    at = lambda c, middle, unit: (pc.struct_field(corners, c).to_numpy(zero_copy_only=False) - np.repeat(middle, n)) * unit
    return P.Ragged(at("lng", lng, np.repeat(k, n)), at("lat", lat, FLAT_M), n)


def land_area(sites: DataFrame, rings: DataFrame, radii: Sequence[int], name: str, per_tile: int = 24) -> DataFrame:
    """(place_id, col, value): <name>_ha_<r>, hectares of the union of the rings inside the circle, to 2 places.

    The union is made once for all sites, tile by tile (see unions): a box with more than per_tile rings that none of them
    fills is cut into four. A site adds up tiles inside its circle and measures what the rim cuts."""
    radii, top = list(radii), float(max(radii))
    size = top / FLAT_M / unions.TILES
    windows = unions.windows_of(sites, top)
    tiles = unions.tiles_of(windows).withColumns({"lat": (F.col("ty") + 0.5) * size, "lng": (F.col("tx") + 0.5) * size})
    outlines = rings.select(F.lit(None).cast("long").alias("ring_id"), F.lit(None).cast("string").alias("name"), "ring").distinct()
    pairs, boxed = _ring_pairs(tiles, outlines, size * FLAT_M, ("ty", "tx"))
    pieces = unions.pieces(pairs.select("ty", "tx", "_rid").join(boxed.select("_rid", "ring"), "_rid"), size, per_tile)
    found = unions.areas(sites, windows, written(pieces, "pieces"), size, radii)
    found = found.groupBy("place_id", "r").agg(half_even(F.max("value") / 10_000, 2).alias("value")).withColumn("col", F.concat(F.lit(f"{name}_ha_"), F.col("r").cast("string")))
    grid = sites.select("place_id", F.explode(F.array(*(F.lit(f"{name}_ha_{r}") for r in radii))).alias("col"))
    return grid.join(found.drop("r"), ["place_id", "col"], "left").select("place_id", "col", F.coalesce("value", F.lit(0.0)).alias("value"))


def area_items(sites: DataFrame, rings: DataFrame, radii: Sequence[int], name: str, most: int = MOST_ITEMS) -> DataFrame:
    """Each ring's own hectares inside the circle (0.01 or more), the largest first; extra is the hectares.

    A block of sites meets all rings around it in one task (see shares), which only lists what is asked for."""
    radii = list(radii)

    def known(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """What does not depend on the site: whether a ring crosses itself, and a place inside it."""
        for g in batches:
            rows = []
            for m in g.itertuples(index=False):
                lat, lng = m.ring[0]["lat"], m.ring[0]["lng"]
                s = _local(m.ring, lat, lng)
                rows.append((m.rid, m.upright or P.simple(s), *(_degrees(*P.point_inside(s), lat, lng) if len(s) else (None, None))))
            yield pd.DataFrame(rows, columns=["_rid", "_simple", "_lat", "_lng"]).astype({"_lat": float, "_lng": float})

    kind = f"place_id STRING, col STRING, pos INT, {ITEM}"
    names = [c.split()[0] for c in kind.split(", ")]

    def listed(left: pa.Table, right: pa.Table) -> pa.Table:
        of = lambda t, c, at: t.column(c).take(pa.array(at))
        ids = [("_block", "ascending"), ("ring_id", "ascending"), ("_rid", "ascending")]
        left, right = left.sort_by("_block").combine_chunks(), right.take(pc.sort_indices(right, ids, null_placement="at_start")).combine_chunks()
        block, first = np.unique(left.column("_block").to_numpy(), return_index=True)
        ends, around = np.append(first[1:], len(left)), right.column("_block").to_numpy()
        tables = [pa.table([pa.array([], t) for t in (pa.string(), pa.string(), pa.int32(), pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.float64())], names=names)]
        for a, b, low, high in zip(first, ends, np.searchsorted(around, block), np.searchsorted(around, block, "right"), strict=True):
            mine, near = left.slice(a, b - a), right.slice(low, high - low)
            (lat, lng), some = (mine.column(c).to_numpy() for c in ("lat", "lng")), _rings_of(near)
            for r in radii:
                for site, ring, pos, share in shares.largest(lat, lng, some, float(r), most):
                    metres = np.rint(shares.metres(some, ring, lat[site], lng[site])).astype(np.int32)
                    tables.append(pa.table([of(mine, "place_id", site), pa.repeat(f"{name}_ha_{r}", len(site)), pos, of(near, "name", ring), metres, share / 100, of(near, "_lat", ring), of(near, "_lng", ring)], names=names))
        return pa.concat_tables(tables)

    each = sites.select(F.col("place_id").cast("string").alias("place_id"), "lat", "lng").distinct()
    at, near, boxed = _squares(each, rings, float(max(radii)), 2)
    boxed = boxed.withColumn("_upright", _upright())
    inside = boxed.select(F.col("_rid").alias("rid"), F.col("_upright").alias("upright"), "ring").repartition(_parts(sites)).mapInPandas(known, "_rid long, _simple boolean, _lat double, _lng double")
    outline = F.when(~F.col("_upright"), F.col("ring")).alias("ring")
    shapes = boxed.select("_rid", F.col("ring_id").cast("long").alias("ring_id"), blank(F.col("name")).alias("name"), "_upright", outline).join(inside, "_rid")
    slots = max(4 * _parts(sites), at.count() // 2048)  # a few blocks go together where sites are few
    slotted = lambda df: df.withColumn("_slot", F.pmod(F.xxhash64("_block"), F.lit(slots))).repartition(4 * _parts(sites), "_slot").groupBy("_slot")
    return slotted(at).cogroup(slotted(near.join(written(shapes, "shapes"), "_rid"))).applyInArrow(listed, kind)


def _rings_of(t: pa.Table) -> shares.Rings:
    ring = t.column("ring").combine_chunks()
    corners = ring.flatten()
    numbers = lambda a: a.to_numpy(zero_copy_only=False)
    n = numbers(pc.fill_null(pc.list_value_length(ring), 0)).astype(np.int64)
    return shares.Rings(*(numbers(t.column(c).combine_chunks()) for c in ("_s", "_n", "_wst", "_e", "_upright", "_simple")), *(numbers(pc.struct_field(corners, c)) for c in ("lat", "lng")), n)


def campus_items(sites: DataFrame, rings: DataFrame, nodes: DataFrame, radii: Sequence[int], name: str) -> DataFrame:
    """(place_id, col, pos, name, metres, extra, lat, lng): institutions within each radius, nearest first. Rings that touch
    the circle are joined where they overlap or share a border, anew for each radius; a node (lat, lng, name) within the
    radius counts unless it lies in such a ring or within a metre of one."""
    radii, top = list(radii), float(max(radii))
    shapes = _near_rings(sites, rings, top).select("place_id", "lat", "lng", F.col("ring_id").alias("ord"), "name", "ring", F.lit(None).cast("double").alias("d"), F.lit(None).cast("double").alias("lat2"), F.lit(None).cast("double").alias("lng2"))
    points = radius_pairs(sites.select("place_id", "lat", "lng"), nodes.select("lat", "lng", blank(F.col("name")).alias("name"), F.xxhash64("lat", "lng", "name").alias("ord")), top)
    points = points.select("place_id", "lat", "lng", "ord", "name", F.lit(None).cast(rings.schema["ring"].dataType).alias("ring"), "d", "lat2", "lng2")

    def merge(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("ord", kind="stable")
        lat, lng, pid = g.lat.iloc[0], g.lng.iloc[0], g.place_id.iloc[0]
        shapes = [(m.name, s) for m in g[g.ring.notna()].itertuples(index=False) if len(s := _local(m.ring, lat, lng))]
        k = FLAT_M * np.cos(np.radians(lat))
        nodes = [(m.name, m.d, m.lat2, m.lng2, ((m.lng2 - lng) * k, (m.lat2 - lat) * FLAT_M)) for m in g[g.ring.isna()].itertuples(index=False)]
        rows = []
        for r in radii:
            hit = [(n, s) for n, s in shapes if P.distance(s) <= r]
            items = []
            for part in P.groups([s for _, s in hit]):
                labels = list(dict.fromkeys(hit[i][0] for i in part if hit[i][0]))
                nearest = min(part, key=lambda i: P.distance(hit[i][1]))
                items.append((" / ".join(labels), int(round(P.distance(hit[nearest][1]))), *_degrees(*P.point_inside(hit[part[0]][1]), lat, lng)))
            # only a ring whose box, wider by a metre and a bit, holds the node can be within a metre of it
            low, high = (np.array([f(s, axis=0) for _, s in hit]).reshape(-1, 2) for f in (np.min, np.max))
            for n, d, a, b, xy in nodes:
                if d <= r and not any(P.distance(hit[i][1], xy) <= 1 for i in np.flatnonzero(((low - 1.01 <= xy) & (high + 1.01 >= xy)).all(axis=1))):
                    items.append((n, int(round(d)), a, b))
            items.sort(key=lambda x: x[1])
            rows += [(pid, f"{name}_{r}", i, n, d, None, a, b) for i, (n, d, a, b) in enumerate(items, 1)]
        return pd.DataFrame(rows, columns=["place_id", "col", "pos", "name", "metres", "extra", "lat", "lng"]).astype({"extra": float})

    return shapes.unionByName(points).repartition(_parts(sites), "place_id").groupBy("place_id").applyInPandas(merge, f"place_id STRING, col STRING, pos INT, {ITEM}")


def campus_measures(sites: DataFrame, rings: DataFrame, nodes: DataFrame, radii: Sequence[int], name: str) -> DataFrame:
    """(place_id, col, value): the number of institutions that campus_items lists, without a row for each site and ring or
    node (see campuses)."""
    top = float(max(radii))
    outer = campuses.outer_rings(rings, _ring_pairs)
    apart, near, beside = campuses.sorted_nodes(nodes.select("lat", "lng", "name"), outer, top, _ring_pairs)
    col = F.concat(F.lit(f"{name}_"), F.col("r").cast("string")).alias("col")
    found = radius_measures(sites, apart, radii, name).select("place_id", "col", F.col("value").cast("double"))
    found = found.unionByName(campuses.border_counts(sites, near, beside, radii).select("place_id", col, "value"))
    for r in radii:
        found = found.unionByName(campuses.ring_groups(sites, outer, float(r), _ring_pairs).select("place_id", F.lit(f"{name}_{r}").alias("col"), "value"))
    return found.groupBy("place_id", "col").agg(F.sum("value").alias("value"))


def place_dictionary(items: DataFrame) -> DataFrame:
    """(name, lat, lng, n, place): each place that item lists point into, how often, and its number from 0 by its first
    appearance in the order of sites, columns and positions. Names and coordinates that are null are values like others."""
    first = F.min(F.struct("place_id", "col", "pos")).alias("_first")
    seen = items.groupBy("name", "lat", "lng").agg(F.count("*").alias("n"), first)
    return numbered(seen.select("name", "lat", "lng", "n", "_first.*"), ["place_id", "col", "pos"], "place").select("name", "lat", "lng", "n", "place")


def items_json(items: DataFrame, most: int = MOST_ITEMS) -> DataFrame:
    """(place_id, items): a map from column to its list of items, as JSON."""
    lists = items.filter(F.col("pos") <= most).groupBy("place_id", "col").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "name", "metres", "extra", "lat", "lng"))), lambda x: F.struct(x["name"], x["metres"], x["extra"], x["lat"], x["lng"])).alias("list"))
    return lists.groupBy("place_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("col", "list"))))).alias("items"))
