import random

import numpy as np
import pytest
from test_squares import RINGS, SITES, far, mixed, outline

from terravane.functions import polygons as P
from terravane.operators import shares, surround


@pytest.mark.parametrize("radius", [100.0, 0.5, 20_000.0])
def test_boxes_in_circle_equal_slabs(radius):
    rng = np.random.default_rng(3)
    x, y, w, h = (rng.uniform(-1.3, 1.3, 400), rng.uniform(-1.3, 1.3, 400), 10 ** rng.uniform(-3, 0.5, 400), 10 ** rng.uniform(-3, 0.5, 400))
    box = [x - w, x + w, y - h, y + h]
    box[0][:20], box[3][10:40], box[1][50:60] = np.minimum(box[1][:20] - 0.1, 0), np.maximum(box[2][10:40] + 0.1, 0), np.maximum(box[0][50:60] + 0.1, 1)
    a, b, c, d = (v * radius for v in box)
    got = P.boxes_in_circle(a, b, c, d, radius)
    want = [P.union_area([np.array([(p, r), (q, r), (q, s), (p, s)])], P.circle(radius)) for p, q, r, s in zip(a, b, c, d, strict=True)]
    assert got == pytest.approx(want, rel=1e-9, abs=1e-9 * radius**2)


def listed(places, rings, radii, most):
    """Each ring measured by slabs."""
    out = []
    for p, lat, lng in places:
        for r in radii:
            shares_of = []
            for i, name, ring in rings:
                if ring and (d := far(ring, lat, lng)) <= r:
                    ha = P.union_area([surround._local(ring, lat, lng)], P.circle(r)) / 10_000
                    if ha >= 0.01:
                        shares_of.append((-round(ha, 2), i, name or "", int(np.rint(d))))
            out += [(p, f"ind_ha_{r}", pos, name, m, -ha, i) for pos, (ha, i, name, m) in enumerate(sorted(shares_of)[:most], 1)]
    return sorted(out)


@pytest.mark.parametrize(("most", "most_sites"), [(50, 4096), (4, 6)])
def test_lists_equal_all_shares(spark, monkeypatch, most, most_sites):
    """Rectangles, other rings, rings that cross themselves, and rectangles of one size whose ids are in no order."""
    monkeypatch.setattr(surround, "MOST_SITES", most_sites)
    monkeypatch.setattr(shares, "MOST_CORNERS", most_sites * 10)
    rng = random.Random(21)
    rings = [r for r in mixed(rng, 60, 0.006) if r[2]]
    spot = lambda: (101 + rng.gauss(0, 0.002), 13 + rng.gauss(0, 0.002))
    rings += [(0, "even", outline([(x, y), (x + 2**-10, y), (x + 2**-10, y + 2**-10), (x, y + 2**-10)])) for x, y in (tuple(round(v * 2**20) / 2**20 for v in spot()) for _ in range(25))]
    rings += [(0, "bow", outline([(x, y), (x + 0.003, y + 0.002), (x + 0.003, y), (x, y + 0.004)])) for x, y in (spot() for _ in range(6))]
    ids = rng.sample(range(1000), len(rings))
    rings = [(i, name, ring) for i, (_, name, ring) in zip(ids, rings, strict=True)]
    places = [(f"s{i}", 13 + rng.gauss(0, 0.004), 101 + rng.gauss(0, 0.004)) for i in range(24)]
    some = [*places, places[3], ("nowhere", None, 101.0)]
    found = surround.area_items(spark.createDataFrame(some, SITES), spark.createDataFrame(rings, RINGS), (300, 800), "ind", most)
    place = {tuple(surround._degrees(*P.point_inside(surround._local(r, r[0]["lat"], r[0]["lng"])), r[0]["lat"], r[0]["lng"])): i for i, _, r in rings if len(surround._local(r, r[0]["lat"], r[0]["lng"]))}
    got = sorted((r.place_id, r.col, r.pos, r.name, r.metres, r.extra, place[r.lat, r.lng]) for r in found.collect())
    want = listed(places, rings, (300, 800), most)
    assert got == want and {"even", "bow"} <= {r[3] for r in want}


def test_few_rings_are_measured_and_no_share_is_sorted_twice(spark, monkeypatch):
    """Of 6,000 rings in reach the lists of 50 cost a part only, and lists leave their tasks as they are."""
    rng = np.random.default_rng(8)
    y, x, h, w = 13 + rng.uniform(-0.02, 0.02, 6000), 101 + rng.uniform(-0.02, 0.02, 6000), rng.uniform(2e-4, 2e-3, 6000), rng.uniform(2e-4, 2e-3, 6000)
    rings = shares.Rings(y - h, y + h, x - w, x + w, np.ones(6000, bool), np.ones(6000, bool), np.zeros(0), np.zeros(0), np.zeros(6000, np.int64))
    asked, real = [], shares.hectares
    monkeypatch.setattr(shares, "hectares", lambda *a: asked.append(len(a[1])) or real(*a))
    for radius, part in ((500.0, 0.2), (1500.0, 0.05)):
        asked.clear()
        lat, lng = 13 + rng.uniform(-0.003, 0.003, 300), 101 + rng.uniform(-0.003, 0.003, 300)
        found = sum(len(site) for site, *_ in shares.largest(lat, lng, rings, radius, 50))
        assert found == 300 * 50 and sum(asked) < part * 300 * 6000
    frame = lambda rows, kind: spark.createDataFrame(rows, kind)
    lists = surround.area_items(frame([("s", 13.0, 101.0)], SITES), frame([(1, "a", outline([(101.0, 13.0), (101.001, 13.0), (101.001, 13.001), (101.0, 13.001)]))], RINGS), (500,), "ind")
    assert "Window" not in lists._jdf.queryExecution().optimizedPlan().toString() and lists.count() == 1


def test_lists_of_nothing(spark):
    ring = (1, "a", outline([(101.0, 13.0), (101.001, 13.0), (101.001, 13.001), (101.0, 13.001)]))
    items = lambda places, rings: surround.area_items(spark.createDataFrame(places, SITES), spark.createDataFrame(rings, RINGS), (500,), "ind")
    assert items([("s", 13.0, 101.0), ("far", 40.0, 101.0)], [ring]).count() == 1
    assert items([("s", 13.0, 101.0)], []).count() == 0 and items([], [ring]).count() == 0
