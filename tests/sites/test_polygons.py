import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terravane.functions import polygons as P
from terravane.operators import surround

RINGS = "ring_id long, name string, ring array<struct<lng:double,lat:double>>"


def box(lat, lng, south, west, north, east):
    """A rectangle given by metres from a place."""
    a, b = 1 / surround.FLAT_M, 1 / (surround.FLAT_M * math.cos(math.radians(lat)))
    return [{"lng": lng + x * b, "lat": lat + y * a} for x, y in ((west, south), (east, south), (east, north), (west, north))]


def test_clip_box_equals_slabs():
    rng = random.Random(4)
    circle = P.circle(100.0)
    for _ in range(60):
        x0, x1 = sorted(rng.uniform(-130, 130) for _ in range(2))
        y0, y1 = sorted(rng.uniform(-130, 130) for _ in range(2))
        got = P.clip_box(circle, np.array([x0, y0]), np.array([x1, y1]))
        want = P.union_area([np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1)])], circle)
        assert abs(P.signed_area(got) if len(got) else 0.0) == pytest.approx(want, abs=1e-6)


def test_a_ring_stands_in_four_cells_at_most(spark):
    rng = random.Random(1)
    rows = []
    for i in range(300):
        lat, lng, half = rng.uniform(-60, 60), rng.uniform(-150, 150), 10 ** rng.uniform(0, 6)
        rows.append((i, None, box(lat, lng, -half, -half * rng.random(), half, half)))
    boxed, where, levels = surround.ring_cells(spark.createDataFrame(rows, RINGS), 1000.0)
    assert boxed.count() == 300 and len(levels) > 5
    assert max(r["n"] for r in where.groupBy("_rid").agg(F.count("*").alias("n")).collect()) <= 4


def test_rings_of_all_sizes_meet_their_sites(spark):
    """Pairs by cells equal pairs by boxes, from a few metres to hundreds of kilometres."""
    rng = random.Random(7)
    places = [(f"s{i}", 13 + rng.gauss(0, 0.5), 101 + rng.gauss(0, 0.5)) for i in range(80)]
    rings = []
    for i in range(120):
        lat, lng, half = 13 + rng.gauss(0, 0.5), 101 + rng.gauss(0, 0.5), 10 ** rng.uniform(1, 5.3)
        rings.append((i % 100, "r", box(lat, lng, -half, -half, half * rng.random(), half)))  # some ids repeat
    rings += [(900, "none", None), (901, "empty", [])]
    sites = spark.createDataFrame([*places, ("nowhere", None, 1.0)], "place_id string, lat double, lng double")
    got = sorted((r.place_id, r.ring_id) for r in surround.ring_metres(sites, spark.createDataFrame(rings, RINGS), 2000).collect())
    want = []
    for p, lat, lng in places:
        for i, _, ring in rings[:120]:
            if P.distance(surround._local(ring, lat, lng)) <= 2000:
                want.append((p, i))
    assert got == sorted(want) and len(want) > 500
    assert surround.ring_metres(sites, spark.createDataFrame([], RINGS), 2000).count() == 0


@pytest.mark.parametrize("per_tile", [10_000, 7, 1])
def test_area_does_not_depend_on_tiles(spark, per_tile):
    """A site among 400 rings, of which some repeat and overlap, in one tile, in 64 and in 400."""
    rng = random.Random(3)
    lat, lng, rings = 13.0, 101.0, []
    for i in range(400):
        y, x, h, w = rng.gauss(0, 700), rng.gauss(0, 700), rng.uniform(5, 90), rng.uniform(5, 90)
        rings.append((i, None, box(lat, lng, y - h, x - w, y + h, x + w)))
    rings += [(1000 + i, None, rings[i][2]) for i in range(60)] + [(2000, None, box(lat, lng, 900, -3000, 1200, 3000))]
    sites = spark.createDataFrame([("a", lat, lng), ("b", lat + 0.01, lng), ("far", 20.0, lng)], "place_id string, lat double, lng double")
    got = {(r.place_id, r.col): r.value for r in surround.land_area(sites, spark.createDataFrame(rings, RINGS), (500, 1500), "ind", per_tile).collect()}
    outlines = [[p.values() for p in r] for _, _, r in rings]
    assert len(outlines) == len(rings)
    want = {("far", "ind_ha_500"): 0.0, ("far", "ind_ha_1500"): 0.0}
    for p, y in (("a", lat), ("b", lat + 0.01)):
        for r, ha in surround.hectares([r for _, _, r in rings], y, lng, (500, 1500)).items():
            want[p, f"ind_ha_{r}"] = ha
    assert got == pytest.approx(want, abs=0.011)


def test_trapezoids_are_the_union_of_rings_in_a_box():
    """Of rings that cross themselves and others, whole and cut into smaller boxes; their parts in circles add up too."""
    rng = random.Random(1)
    low, high = np.zeros(2), np.full(2, 100.0)
    box = np.array([(0, 0), (100, 0), (100, 100), (0, 100)], float)
    for _ in range(60):
        rings = [P.ring([(rng.uniform(-50, 150), rng.uniform(-50, 150)) for _ in range(rng.choice([3, 4, 5, 7]))]) for _ in range(rng.randrange(1, 8))]
        want = P.union_area(rings, box)
        for t in (P.trapezoids([r for r in rings if len(r)], low, high), P.covered([r for r in rings if len(r)], low, high, 2, 4)):
            assert ((t[:, 1] - t[:, 0]) * (t[:, 4] - t[:, 2] + t[:, 5] - t[:, 3]) / 2).sum() == pytest.approx(want, abs=1e-6)
            x, y = t[:, [0, 1, 1, 0]] - 37, t[:, [2, 3, 5, 4]] - 55
            for r in (20.0, 60.0, 300.0):
                inside = sum(P.union_area([np.column_stack(c)], P.circle(r)) for c in zip(x, y, strict=True)) if len(x) < 40 else None
                assert inside is None or P.quads_in_circle(x, y, r).sum() == pytest.approx(inside, abs=1e-6)


def test_no_ring_is_shuffled_once_for_each_site(spark):
    """The union is made on tiles: twenty times the sites bring no more rows of rings and tiles together, and no more pieces."""
    from terravane.operators import unions

    rng = random.Random(2)
    rings = spark.createDataFrame([(i, None, box(13.0, 101.0, y - 90, x - 90, y + 90, x + 90)) for i in range(200) for x, y in [(rng.uniform(-900, 900), rng.uniform(-900, 900))]], RINGS)
    pieces = []
    for n in (50, 1000):
        places = [("edge", 12.99, 100.99), ("other", 13.01, 101.01)] + [(f"s{i}", 13 + rng.uniform(-0.01, 0.01), 101 + rng.uniform(-0.01, 0.01)) for i in range(n)]
        windows = unions.windows_of(spark.createDataFrame(places, "place_id string, lat double, lng double"), 1500.0)
        tiles = unions.tiles_of(windows)
        size = 1500 / surround.FLAT_M / unions.TILES
        spots = tiles.withColumns({"lat": (F.col("ty") + 0.5) * size, "lng": (F.col("tx") + 0.5) * size})
        pairs, boxed = surround._ring_pairs(spots, rings, size * surround.FLAT_M, ("ty", "tx"))
        found = unions.pieces(pairs.select("ty", "tx", "_rid").join(boxed.select("_rid", "ring"), "_rid"), size, 24).collect()
        pieces.append((pairs.count(), sorted((r.ty, r.tx, round(r.area, 15)) for r in found)))
    assert pieces[0] == pieces[1] and 0 < pieces[0][0] < 200 * 50


def even_odd_area(p):
    """By the middles of a fine grid over integer corners."""
    p = np.asarray(p, float)
    (x0, y0), (x1, y1) = p.min(axis=0), p.max(axis=0)
    xs, ys = (np.arange(x0, x1) + 0.5), (np.arange(y0, y1) + 0.5)
    return sum(P.contains(p, (x, y)) for x in xs for y in ys)


def crosses_itself(r):
    a, b = r, np.roll(r, -1, axis=0)
    for i in range(len(r)):
        for j in range(i + 1, len(r)):
            d, e, g = b[i] - a[i], b[j] - a[j], a[j] - a[i]
            det = d[0] * e[1] - d[1] * e[0]
            if abs(det) > 1e-9:
                t, u = (g[0] * e[1] - g[1] * e[0]) / det, (g[0] * d[1] - g[1] * d[0]) / det
                if 1e-6 < t < 1 - 1e-6 and 1e-6 < u < 1 - 1e-6:
                    return True
    return len({tuple(np.round(p, 5)) for p in r}) < len(r)


SHAPES = {
    "square": ([(0, 0), (4, 0), (4, 4), (0, 4)], [16]),
    "clockwise": ([(0, 4), (4, 4), (4, 0), (0, 0)], [16]),
    "bow": ([(0, 0), (4, 4), (4, 0), (0, 4)], [4, 4]),
    "spike": ([(0, 0), (4, 0), (9, 0), (4, 0), (4, 4), (0, 4)], [16]),
    "inner spike": ([(0, 0), (4, 0), (4, 4), (2, 4), (2, 1), (2, 4), (0, 4)], [16]),
    "repeats": ([(0, 0), (0, 0), (4, 0), (4, 4), (4, 4), (4, 4), (0, 4), (0, 0)], [16]),
    "line": ([(0, 0), (4, 0), (2, 0)], []),
    "twice": ([(0, 0), (4, 0), (4, 4), (0, 4)] * 2, []),
    "touches itself": ([(0, 0), (8, 0), (8, 8), (4, 0), (0, 8)], [16, 16]),
    "hole at a corner": ([(0, 0), (8, 0), (8, 8), (0, 8), (0, 0), (2, 4), (4, 2)], [64, -6]),
    "star": ([(0, -10), (6, 9), (-10, -3), (10, -3), (-6, 9)], None),
}


@pytest.mark.parametrize("name", list(SHAPES))
def test_simple_rings(name):
    p, want = SHAPES[name]
    got = P.simple_rings(p)
    assert not any(crosses_itself(r) for r in got)
    if want is not None:
        assert sorted(round(P.signed_area(r), 6) for r in got) == sorted(want)
    else:
        assert len(got) == 5 and sum(map(P.signed_area, got)) == pytest.approx(P.union_area([np.array(p, float)]))


def test_random_rings_keep_their_even_odd_area():
    rng = random.Random(5)
    for n in range(3, 14):
        for axis_parallel in (False, True):
            p = [(rng.randrange(12), rng.randrange(12)) for _ in range(n)]
            if axis_parallel:
                p = [c for a, b in zip(p, p[1:] + p[:1]) for c in (a, (b[0], a[1]))]
            got = P.simple_rings(p)
            assert not any(crosses_itself(r) for r in got)
            total = sum(map(P.signed_area, got))
            if axis_parallel:
                assert total == pytest.approx(even_odd_area(p))
            elif len({*p}) > 2 and abs(P.signed_area(np.array(p, float))) > 1e-9:
                assert total == pytest.approx(P.union_area([np.array(p, float)]), abs=1e-4)


def test_repaired_rings(spark):
    bow = [{"lng": 101.0 + x / 1000, "lat": 13.0 + y / 1000} for x, y in ((0, 0), (1, 1), (1, 0), (0, 1), (0, 0))]
    rows = [(1, "bow", bow), (2, None, box(13.0, 101.0, 0, 0, 100, 100)), (3, "none", None), (4, "empty", []), (5, "line", bow[:2])]
    got = surround.repaired_rings(spark.createDataFrame(rows, RINGS)).collect()
    assert sorted((r.ring_id, r.part, r.hole) for r in got) == [(1, 0, False), (1, 1, False), (2, 0, False)]
    square = next(r for r in got if r.ring_id == 2)
    assert square.hectares == 1.0 and {(p.lng, p.lat) for p in square.ring} == {(p["lng"], p["lat"]) for p in rows[1][2]}
