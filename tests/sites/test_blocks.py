import math
import random

import pytest
from pyspark.sql import functions as F

from terravane.operators import blocks, cells, surround
from tests.sites.test_cells import POINTS, metres, scene

SITES = "place_id string, lat double, lng double"


@pytest.mark.parametrize("lat, crowded", [(13.0, False), (13.0, True), (-47.0, False), (68.0, True), (0.0, False), (89.97, False), (-89.99, True)])
def test_sums_equal_all_pairs(spark, lat, crowded, monkeypatch):
    """In one block and in many, across the antimeridian and the poles."""
    if crowded:
        monkeypatch.setattr(blocks, "MOST_POINTS", 2000)
        monkeypatch.setattr(blocks, "MOST_SITES", 9)
    sites, points = scene(3, lat, 60, 900, 0.03)
    s, p = spark.createDataFrame(sites, SITES), spark.createDataFrame(points, POINTS)
    for radius in (700.0, 4000.0):
        got = {(r.place_id, r._key): r.value for r in blocks.radius_sums(s, p, radius).collect()}
        want = {}
        for i, a, b in sites[:-1]:
            for c, d, key, w in points[:-1]:
                if metres(a, b, c, d) <= radius:
                    want[i, key] = want.get((i, key), 0.0) + w
        assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x], abs=1e-9) for x in want)


def test_sums_of_many_keys_and_of_what_is_no_number(spark):
    sites, points = scene(5, 13.0, 20, 400, 0.01)
    points = [(a, b, f"k{i % 40}", float("inf") if i == 7 else w) for i, (a, b, _, w) in enumerate(points[:400])]
    s, p = spark.createDataFrame(sites, SITES), spark.createDataFrame(points, POINTS)
    got = {(r.place_id, r._key): r.value for r in blocks.radius_sums(s, p, 900.0).collect()}
    want = {}
    for i, a, b in sites[:-1]:
        for c, d, key, w in points:
            if metres(a, b, c, d) <= 900:
                want[i, key] = want.get((i, key), 0.0) + w
    assert got.keys() == want.keys() and got == pytest.approx(want) and float("inf") in want.values()


@pytest.mark.parametrize("lat, most, spread", [(13.0, 5, 0.02), (13.0, 50, 0.02), (-60.0, 1, 0.02), (13.0, 10_000, 0.02), (89.98, 5, 0.02), (0.0, 20, 0.003)])
def test_nearest_equal_all_pairs(spark, lat, most, spread):
    sites, points = scene(most, lat, 40, 700, spread)
    points = points[:-1] + [(*points[5][:2], "a", 1.0)] * 60 + points[-1:]
    named = [(a, b, key, w, i) for i, (a, b, key, w) in enumerate(points)]
    s, p = spark.createDataFrame(sites, SITES), spark.createDataFrame(named, POINTS + ", ord int")
    got = sorted((r.place_id, str(r._key), r.pos, r.ord) for r in blocks.nearest_points(s, p, 3000.0, most, ["ord"]).collect())
    want = []
    for i, a, b in sites[:-1]:
        for key in ("a", "b", None):
            near = sorted((metres(a, b, c, d), o) for c, d, x, _, o in named[:-1] if x == key and metres(a, b, c, d) <= 3000)
            want += [(i, str(key), pos, o) for pos, (_, o) in enumerate(near[:most], 1)]
    assert got == sorted(want)


def test_a_site_is_shuffled_once_however_dense_the_points(spark):
    """By cells a site was as many rows as cells surround it (over 250 among dense points), by blocks it is one."""
    sites, points = scene(9, 13.0, 50, 6000, 0.01)
    s, p = spark.createDataFrame(sites, SITES), spark.createDataFrame(points, POINTS)
    n, dense = cells.density(p, 1500.0)
    assert not surround._by_cells(cells.FEW_POINTS + 1, dense) and not surround._by_cells(n, 1e6)
    left, right = blocks.dealt(s, p, 1500.0)
    assert left.count() == 50 and right.count() <= 9.5 * n


def test_few_points_are_measured(spark):
    """Of the points in a circle's box less than a tenth are measured."""
    sites, points = scene(9, 13.0, 50, 20_000, 0.01)
    import numpy as np

    sites, points = np.array([x[1:] for x in sites[:-1]]), np.array([x[:2] for x in points[:20_000]])
    block = blocks.Rows(np.zeros(len(points), int), *points.T, np.zeros(len(sites), int), *sites.T, 1500.0, 50)
    a, b, c, d = block.ranges(np.arange(len(sites)), True)
    held = [sum(metres(*s, *p) <= 1500 for p in points[:500]) for s in sites[:5]]
    assert ((b - a) + (d - c)).sum() < 0.1 * (d - a).sum() and sum(held) > 0


def test_a_point_has_no_more_copies_where_all_is_denser(spark):
    """In a table ten times as dense points are copied as often: parts of a tile would each have had all of its points."""

    def copies(n):
        at = lambda k, x: F.lit(x) + F.pmod(F.xxhash64("id", F.lit(k)), F.lit(100_000)) / 1e6
        places = lambda k: spark.range(n).select(F.concat(F.lit(k), "id").alias("place_id"), at(f"{k}a", 13.0).alias("lat"), at(f"{k}b", 100.9).alias("lng"))
        left, right = blocks.dealt(places("s"), places("p").drop("place_id"), 2500.0)
        return left.count() / n, right.count() / n

    few, many = copies(80_000), copies(800_000)
    assert few[0] == many[0] == 1 and many[1] < 1.05 * few[1] < 40


@pytest.mark.parametrize("lat, wide, parts", [(13.0, 0.3, 1), (89.9, 0.3, 2), (-60.0, 3.0, 2)])
def test_thin_and_wide_tiles_equal_all_pairs(spark, lat, wide, parts, monkeypatch):
    """Tiles thinner and wider than the radius, whole and in parts, across the antimeridian and beside a pole."""
    monkeypatch.setattr(blocks, "tiling", lambda *_: blocks.Tiling(wide, parts, parts, 3))
    width, draw = 0.06 / math.cos(math.radians(lat)), random.Random(7).random
    place = lambda: (lat + 0.06 * draw(), (179.99 + width * draw() + 180) % 360 - 180)
    sites, points = [(f"s{i}", *place()) for i in range(200)], [(*place(), "ab"[i % 2], draw()) for i in range(600)]
    s, p = spark.createDataFrame(sites, SITES), spark.createDataFrame(points, POINTS)
    got = {(r.place_id, r._key): r.value for r in blocks.radius_sums(s, p, 2000.0).collect()}
    want = {}
    for i, a, b in sites:
        for c, d, key, w in points:
            if metres(a, b, c, d) <= 2000:
                want[i, key] = want.get((i, key), 0.0) + w
    assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x], abs=1e-9) for x in want)
