import math
import random

import numpy as np
import pytest

from terravane.functions import polygons as P
from terravane.operators import surround

RINGS = "ring_id long, name string, ring array<struct<lng:double,lat:double>>"
SITES = "place_id string, lat double, lng double"


def outline(corners):
    return [{"lng": x, "lat": y} for x, y in corners]


def mixed(rng, n, spread):
    """Upright rectangles, open and closed, in both directions and from any corner, and every fifth another ring."""
    rings = []
    for i in range(n):
        y, x, h, w = 13 + rng.gauss(0, spread), 101 + rng.gauss(0, spread), 10 ** rng.uniform(-5, -2), 10 ** rng.uniform(-5, -2)
        p = [(x - w, y - h), (x + w, y - h), (x + w, y + h), (x - w, y + h)]
        if i % 5 == 0:  # a corner is moved, or lacks
            p = p[:3] if i % 2 else [*p[:3], (x, y + h / 2)]
        turn = rng.randrange(len(p))
        p = p[turn:] + p[:turn]
        p = p[::-1] if rng.random() < 0.5 else p
        rings.append((i - i % 7 // 6, f"r{i % 3}" if i % 4 else None, outline([*p, p[0]] if rng.random() < 0.5 else p)))
    return [*rings, (9000, "none", None), (9001, "empty", []), (9002, "line", outline([(101.0, 13.0), (101.001, 13.0), (101.001, 13.0), (101.0, 13.0)]))]


def far(ring, lat, lng):
    """Metres from a place, by edges."""
    s = surround._local(ring, lat, lng)
    return P.distance(s) if len(s) else math.inf


@pytest.mark.parametrize("most_sites", [4096, 5])
def test_outlines_of_rectangles_never_meet_sites(spark, monkeypatch, most_sites):
    """Sites in whole and in dealt squares; only rings that are no upright rectangles go the way of outlines."""
    monkeypatch.setattr(surround, "MOST_SITES", most_sites)
    asked, near_rings = [], surround._near_rings
    monkeypatch.setattr(surround, "_near_rings", lambda s, r, m: asked.append(r.count()) or near_rings(s, r, m))
    rng = random.Random(11)
    rings = mixed(rng, 150, 0.01)
    places = [(f"s{i}", 13 + rng.gauss(0, 0.008), 101 + rng.gauss(0, 0.008)) for i in range(120)] + [("north", 85.0, 101.0), ("nowhere", None, 101.0)]
    got = sorted(tuple(r) for r in surround.ring_metres(spark.createDataFrame(places, SITES), spark.createDataFrame(rings, RINGS), 800).collect())
    want = [(p, i, int(np.rint(d))) for p, lat, lng in places if lat is not None for i, _, ring in rings if ring if (d := far(ring, lat, lng)) <= 800]
    assert got == sorted(want) and len(want) > 2000
    assert asked == [30 + 1]  # every fifth, and the line


def test_squares_bring_each_site_all_its_rings_once(spark, monkeypatch):
    monkeypatch.setattr(surround, "MOST_SITES", 3)
    rng = random.Random(5)
    rings = [(i, None, outline([(x, y), (x + 0.0001, y), (x + 0.0001, y + 0.0001), (x, y + 0.0001)])) for i in range(60) for x, y in [(rng.choice([-0.02, 100.99, 101.01]) + rng.random() / 50, rng.choice([-0.01, 60.0]) + rng.random() / 50)]]
    places = [(f"s{i}", rng.choice([-0.01, 60.0]) + rng.random() / 50, rng.choice([-0.02, 100.99, 101.01]) + rng.random() / 50) for i in range(90)]
    at, near, boxed = surround._squares(spark.createDataFrame(places, SITES), spark.createDataFrame(rings, RINGS), 1000.0, 2)
    assert at.count() == 90 and at.groupBy("_block").count().agg({"count": "max"}).first()[0] < 30
    met = near.join(boxed.select("_rid", "ring_id"), "_rid").join(at, "_block").select("place_id", "ring_id")
    pairs = [tuple(r) for r in met.collect()]
    assert len(pairs) == len(set(pairs))
    assert {(p, i) for p, lat, lng in places for i, _, ring in rings if far(ring, lat, lng) <= 1000} <= set(pairs)
