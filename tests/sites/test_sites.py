import io
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terravane.functions import geo, polygons, text
from terravane.operators import components, dedupe, discover, hours, metering, ranks, report, score, surround
from terravane.plans import config, stages
from terravane.sources import files, ingest, osm

SITES = "place_id string, name string, lat double, lng double"


@pytest.fixture(scope="module")
def five(spark):
    return spark.createDataFrame([(f"p_{i}", f"Market {i}", 13.0 + 0.01 * i, 101.0) for i in range(1, 6)], SITES)


def test_tiles_and_quadrants(spark):
    t = geo.tiles(spark, 12.55, 13.62, 100.78, 101.62, 0.1)
    rows = t.collect()
    assert len(rows) == 99 and min(r.south for r in rows) == 12.55 and max(r.north for r in rows) == 13.62 and max(r.east for r in rows) == 101.62
    q = geo.subdivide(spark.createDataFrame([(0, 0.0, 0.0, 2.0, 2.0)], "tile int, south double, west double, north double, east double")).collect()
    assert [(r.south, r.west) for r in q] == [(0, 0), (0, 1), (1, 0), (1, 1)]
    assert json.loads(t.select(geo.rectangle_json(F.col("south"), F.col("west"), F.col("north"), F.col("east")).alias("j")).first().j)["rectangle"]["low"]["latitude"] == 12.55


def test_haversine(spark):
    d = spark.range(1).select(geo.haversine(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0)).alias("d")).first().d
    assert d == pytest.approx(111_195, rel=1e-3)


def test_radius_pairs_at_high_latitude_equals_brute_force(spark):
    rng = random.Random(1)
    pts = [(i, rng.uniform(59.9, 60.1), rng.uniform(10, 10.3)) for i in range(200)]
    a, b = spark.createDataFrame(pts, "i int, lat double, lng double"), spark.createDataFrame(pts, "j int, lat double, lng double")

    def d(p, q):
        x, y = map(math.radians, (p[1], q[1]))
        return 2 * 6371000 * math.asin(math.sqrt(math.sin((y - x) / 2) ** 2 + math.cos(x) * math.cos(y) * math.sin(math.radians(q[2] - p[2]) / 2) ** 2))

    assert {(r.i, r.j) for r in geo.radius_pairs(a, b, 900.0).collect()} == {(p[0], q[0]) for p in pts for q in pts if d(p, q) <= 900}


PERIODS = "place_id string, periods array<struct<open:struct<day:int,hour:int,minute:int>,close:struct<day:int,hour:int,minute:int>>>"


def test_hours(spark):
    rows = [
        ("weekend", [((6, 16, 0), (6, 22, 0)), ((0, 16, 0), (0, 22, 0))]), ("over", [((6, 18, 0), (0, 2, 0))]), ("monday", [((1, 5, 0), (1, 9, 30))]), ("always", [((0, 0, 0), None)]),
        ("none", None), ("empty", []), ("friday", [((5, 17, 0), (5, 20, 30))]), ("late", [((1, 9, 45), (1, 14, 0))]), ("skipped", [(None, (1, 2, 0)), ((2, 8, 0), (2, 9, 0))]),
    ]
    got = {r.place_id: r for r in hours.hours_features(spark.createDataFrame(rows, PERIODS), "place_id").collect()}
    assert got["weekend"].days_open == got["weekend"].open_evening == got["weekend"].open_night == 2 / 7 and got["weekend"].open_morning == 0
    assert got["over"].days_open == 2 / 7 and got["over"].open_night == 1 / 7 and got["over"].open_days == "1000001"
    assert got["monday"].open_morning == 1 / 7
    assert got["always"].days_open == got["always"].open_morning == got["always"].open_night == 1
    assert got["none"].hours_known == got["empty"].hours_known == 0 and got["none"].open_evening is None and got["none"].open_days == ""
    assert got["friday"].open_evening == 1 / 7 and got["friday"].open_night == 0 and got["friday"].open_days == "0000010"
    assert got["late"].open_morning == 0 and got["skipped"].open_days == "0010000"
    assert spark.range(1).select(text.day_letters(F.lit("1000001")).alias("d")).first().d == "อา ส"


def test_discover_rules_and_reviews(spark):
    rules = discover.KeepRules(("lodging",), "^(?:ตลาด|walking street)", "สาขา|branch", "market|plaza", ("market",))
    rows = [("a", "ตลาดนัด A", "store"), ("b", "Walking Street Guest House", "lodging"), ("c", "7-11 สาขาตลาด", "market"), ("d", "ก๋วยเตี๋ยว ตลาดเก่า", "market"), ("e", "Night Plaza ตลาด", "market"), ("f", "Shop", None), ("g", None, "market")]
    df = discover.keep_rules(spark.createDataFrame(rows, "place_id string, name string, primary_type string"), rules)
    got = {r.place_id: (r.keep, r.note) for r in df.collect()}
    assert {k: v[0] for k, v in got.items()} == {"a": 1, "b": 0, "c": 0, "d": 0, "e": 1, "f": 0, "g": 1}
    assert got["b"][1] == "not a market: lodging" and got["f"][1] == "not a market type: (none)"
    review = spark.createDataFrame([("a", "0", "", 1), ("a", "1", "yes", 2), ("b", "1", "", 3), ("zzz", "0", "", 4), ("d", "?", "seen", 5)], "place_id string, keep string, note string, ord long")
    after = {r.place_id: (r.keep, r.note) for r in discover.apply_review(df, review).collect()}
    assert after["a"] == (1, "yes") and after["b"] == (1, "not a market: lodging") and after["d"] == (0, "seen") and len(after) == 7
    assert discover.apply_review(df, None) is df
    old = spark.createDataFrame([("f", 1, 0, "mine"), ("e", 0, 1, "no"), ("d", 0, 0, "same"), ("a", None, 1, "blank")], "place_id string, keep int, keep_auto int, note string")
    carried = {r.place_id: (r.keep, r.is_new) for r in discover.carry_over(df, old).collect()}
    assert carried["f"] == (1, 0) and carried["e"] == (0, 0) and carried["d"] == (0, 0) and carried["a"] == (1, 0) and carried["g"] == (1, 1)
    assert {r.keep for r in discover.carry_over(df, old.drop("keep_auto")).filter("place_id = 'f'").collect()} == {0}
    keeps = spark.createDataFrame([("a", "1.0"), ("b", "0"), ("c", None), ("d", "0.0")], "place_id string, keep string")
    assert [r.place_id for r in discover.kept_sites(keeps).orderBy("place_id").collect()] == ["a", "c"] and discover.excluded_sites(keeps).count() == 2


def plain_tiles(points, box, step, depth, full):
    """Every tile visited, by counting the points of each box anew."""
    south, north, west, east = box
    rows, cols = (max(1, math.ceil(round((b - a) / step, 9))) for a, b in ((south, north), (west, east)))
    edge = lambda low, high, k, n: high if k == n else low if k == 0 else round(low + k * step, 6)
    out = []

    def visit(tile, path, s, w, n, e):
        here = [(a, b) for a, b in points if s <= a and w <= b and (a < n or n == north == a) and (b < e or e == east == b)]
        state = "leaf" if len(here) < full else "split" if len(path) < depth else "capped"
        out.append((tile, path, len(path), s, w, n, e, len(here), state))
        if state == "split":
            y, x = (s + n) / 2, (w + e) / 2
            for q, (p, r, t, u) in enumerate(((s, w, y, x), (s, x, y, e), (y, w, n, x), (y, x, n, e))):
                visit(tile, path + str(q), p, r, t, u)

    for i in range(rows):
        for j in range(cols):
            visit(i * cols + j, "", edge(south, north, i, rows), edge(west, east, j, cols), edge(south, north, i + 1, rows), edge(west, east, j + 1, cols))
    return sorted(out)


@pytest.mark.parametrize("depth", [0, 1, 4])
def test_adaptive_tiles(spark, depth):
    rng = random.Random(depth)
    box = (13.0, 13.25, 100.9, 101.1)
    points = [(13.0 + rng.random() * 0.05, 100.9 + rng.random() * 0.05) for _ in range(260)] + [(13.17, 101.05)] * 70  # at one place
    points += [(13.1, 100.95), (13.2, 101.0), (13.25, 101.1), (13.0, 101.1), (13.25, 100.9), (13.05, 100.925)]  # on edges
    rows = [*points, (None, 101.0), (13.1, None), (12.9, 101.0), (13.26, 101.0), (13.1, 101.2)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "lat double, lng double, tile string")
    got = discover.adaptive_tiles(df, *box, 0.1, depth, full=30)
    want = plain_tiles(points, box, 0.1, depth, 30)
    assert sorted(map(tuple, got.collect())) == want
    assert sum(r[7] for r in want if r[8] != "split") == len(points) and (depth < 4 or any(r[8] == "capped" for r in want))
    assert discover.adaptive_tiles(df.limit(0), *box, 0.1, depth).filter("n > 0 or state <> 'leaf'").count() == 0


def test_counts_sums_and_lists(spark, five):
    pois = spark.createDataFrame([(13.01, 101.0, "ปั๊ม", "A"), (13.011, 101.0, "mall!", "B"), (13.03, 101.0, None, "C"), (13.5, 101.0, "ปั๊ม", "D")], "lat double, lng double, category string, name string")
    got = {(r.place_id, r.col): r.value for r in surround.radius_measures(five, pois, (500, 3000), "seven").collect()}
    assert got["p_1", "seven_500"] == 2 and got["p_1", "seven_3000"] == 3 and got["p_1", "seven_ปั๊ม_500"] == 1 and got["p_5", "seven_500"] == 0 and got["p_3", "seven_other_500"] == 1
    assert len(got) == 5 * 2 * 4
    work = spark.createDataFrame([("A", 13.01, 101.0, 50000.0), ("B", 13.02, 101.0, 0.0), ("C", 14.0, 101.0, 9000.0)], "name string, lat double, lng double, workers double")
    sums = {(r.place_id, r.value) for r in surround.radius_measures(five, work, (3000,), "estate", "workers").collect()}
    assert {("p_1", 50000.0), ("p_3", 50000.0), ("p_5", 0.0)} <= sums
    items = surround.nearest_items(five, pois, (500, 3000), "seven")
    n = {(r.place_id, r.col): r["n"] for r in items.groupBy("place_id", "col").agg(F.count("*").alias("n")).collect()}
    assert all(n.get(k, 0) == v for k, v in got.items())
    first = json.loads(surround.items_json(items).filter("place_id = 'p_1'").first()["items"])
    assert first["seven_500"][0] == {"name": "A", "metres": 0, "lat": 13.01, "lng": 101.0}
    wide = surround.pivot_wide(five, surround.radius_measures(five, pois, (500,), "seven"), ["seven_ปั๊ม_500", "seven_500"])
    assert wide.filter("place_id = 'p_1'").first()["seven_ปั๊ม_500"] == 1


def square(lat, lng, half_m):
    a, b = half_m / 111_320, half_m / (111_320 * math.cos(math.radians(lat)))
    return [{"lng": lng + x * b, "lat": lat + y * a} for x, y in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))]


RINGS = "ring_id long, name string, ring array<struct<lng:double,lat:double>>"


def test_land_area(spark):
    site = spark.createDataFrame([("p", 13.0, 101.0), ("q", 14.0, 101.0)], "place_id string, lat double, lng double")
    small = spark.createDataFrame([(1, "x", square(13.0, 101.0, 100))], RINGS)
    area = lambda rings, radii: {(r.place_id, r.col): r.value for r in surround.land_area(site, rings, radii, "ind").collect()}
    assert area(small, (500,)) == {("p", "ind_ha_500"): 4.0, ("q", "ind_ha_500"): 0.0}
    big = spark.createDataFrame([(1, "x", square(13.0, 101.0, 1000)), (2, "y", square(13.0, 101.0, 1000))], RINGS)
    got = area(big, (500, 5000))
    assert got["p", "ind_ha_500"] == pytest.approx(math.pi * 500**2 / 1e4, rel=0.01) and got["p", "ind_ha_5000"] == pytest.approx(400, rel=1e-3)
    items = surround.area_items(site, big, (5000,), "ind").collect()
    assert [round(r.extra) for r in items] == [400, 400] and {r.metres for r in items} == {0}


def test_campuses(spark):
    c = lambda y, x: (13.0 + y / 111_320, 101.0 + x / (111_320 * math.cos(math.radians(13.0))))
    box = lambda x0, x1: [{"lat": c(y, x)[0], "lng": c(y, x)[1]} for x, y in ((x0, -50), (x1, -50), (x1, 50), (x0, 50))]
    rings = spark.createDataFrame([(1, "U", box(0, 100)), (2, "U", box(100, 200)), (3, "Far", box(2500, 2600))], RINGS)
    nodes = spark.createDataFrame([(*c(0, 50), "inner"), (*c(0, 1001), "college")], "lat double, lng double, name string")
    site = spark.createDataFrame([("p", 13.0, 101.0)], "place_id string, lat double, lng double")
    got = {r.col: r.value for r in surround.campus_measures(site, rings, nodes, (500, 1500, 3000), "campus").collect()}
    assert got == {"campus_500": 1, "campus_1500": 2, "campus_3000": 3}
    second = surround.campus_items(site, rings, nodes, (1500,), "campus").filter("pos = 2").first()
    assert second.name == "college" and abs(second.metres - 1001) <= 2


def test_union_area_against_sampling():
    rng = np.random.default_rng(5)
    for _ in range(12):
        rings = [polygons.ring(rng.uniform(-100, 100, (rng.integers(3, 7), 2))) for _ in range(3)]
        disc = polygons.circle(80)
        pts = rng.uniform(-100, 100, (20000, 2))
        inside = np.array([any(len(r) and polygons.contains(r, p) for r in rings) and polygons.contains(disc, p) for p in pts[:6000]])
        assert polygons.union_area(rings, disc) == pytest.approx(inside.mean() * 40000, abs=1500)
    assert polygons.union_area([polygons.circle(10)]) == pytest.approx(abs(polygons.signed_area(polygons.circle(10))))
    assert not polygons.joined(polygons.ring([(0, 0), (1, 0), (1, 1), (0, 1)]), polygons.ring([(1, 1), (2, 1), (2, 2), (1, 2)]))


def test_dedupe(spark):
    rows = [(1, "a", "ตลาดนัดวัด", 13.0, 101.0, 10, 4.0), (2, "b", "Other", 13.0002, 101.0, 30, 3.0), (3, "c", "Wat Night Market", 13.005, 101.0, None, None), (4, "d", "wat market", 13.006, 101.0, None, 5.0), (5, "e", "Alone", 13.1, 101.0, 0, 2.0)]
    got = {r.place_id: r for r in dedupe.dedupe(spark.createDataFrame(rows, "ord long, place_id string, name string, lat double, lng double, reviews long, rating double")).collect()}
    assert set(got) == {"b", "c", "e"}
    assert got["b"].reviews == 40 and got["b"].rating == 3.25 and got["b"].dup_names == "ตลาดนัดวัด" and got["b"].dup_count == 1
    assert got["c"].reviews is None and got["c"].dup_ids == "d" and got["e"].rating == 2.0


def test_place_dictionary_by_first_appearance(spark):
    rng = random.Random(6)
    rows = [(f"s{rng.randrange(30)}", rng.choice("xyz"), i, rng.choice(["a", "b", None, "c d"]), rng.choice([1.0, 2.0, None]), float(rng.randrange(9)), 5, None) for i in range(500)]
    df = spark.createDataFrame(rng.sample(rows, 500), "place_id string, col string, pos int, name string, lat double, lng double, metres int, extra double").repartition(7)
    want: dict = {}
    count: dict = {}
    for p, c, pos, *place, _, _ in sorted(rows, key=lambda r: r[:3]):
        want.setdefault(tuple(place), len(want))
        count[tuple(place)] = count.get(tuple(place), 0) + 1
    got = {(r.name, r.lat, r.lng): (r.place, r.n) for r in surround.place_dictionary(df).collect()}
    assert got == {k: (v, count[k]) for k, v in want.items()} and len(want) > 90


def test_letters_bound_the_matching_ratio(spark):
    from difflib import SequenceMatcher

    rng = random.Random(8)
    words = ["", *("".join(rng.choice("abcกข1") for _ in range(rng.randint(1, 9))) for _ in range(45))]
    df = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string")
    rows = df.select("a", "b", text.shared_letters(F.col("a"), F.col("b")).alias("n"), text.may_be_similar(F.col("a"), F.col("b")).alias("may")).collect()
    for r in rows:
        assert r.n == sum(min(r.a.count(c), r.b.count(c)) for c in set(r.a))
        assert r.may or not r.a or not r.b or SequenceMatcher(None, r.a, r.b).ratio() < 0.6
    assert 0.1 < sum(r.may for r in rows) / len(rows) < 0.9


def test_similar_names(spark):
    from difflib import SequenceMatcher

    words = ["tide", "diet", "watpho", "wat", "", "abcdef", "abcxyz", "bangsaen", "bangsan"]
    df = spark.createDataFrame([(a, b) for a in words for b in words], "a string, b string").select("a", "b", text.similar_names(F.col("a"), F.col("b")).alias("s"))
    for r in df.collect():
        want = bool(r.a and r.b) and ((len(r.a) >= 3 and len(r.b) >= 3 and (r.a in r.b or r.b in r.a)) or SequenceMatcher(None, r.a, r.b).ratio() >= 0.6)
        assert r.s == want, r


def test_ranks(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 3.0), ("d", 9.0), ("e", None)], "place_id string, v double")
    got = {r.place_id: r.v for r in ranks.percentiles(df, "place_id", ["v"]).collect()}
    assert got == {"a": 0.25, "b": 0.625, "c": 0.625, "d": 1.0, "e": None}
    q = ranks.quantiles(ranks.long_form(spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 4, 10])], "place_id long, v double"), "place_id", ["v"]), [0.0, 0.25, 0.5, 0.9, 1.0])
    assert {r.point: round(r.value, 6) for r in q.collect()} == {0.0: 1, 0.25: 1.75, 0.5: 3, 0.9: 8.2, 1.0: 10}


def test_score(spark, five):
    df = five.withColumns({"n": F.substring("place_id", 3, 1).cast("int")}).withColumns({"reviews": F.col("n") * 10, "rating": 4 + F.col("n") % 10 / 10, "conv": F.col("n").cast("double"), "none": F.lit(None).cast("double")})
    pillars = {"m": score.Pillar({"reviews": 1}, 2, "M", "top"), "s": score.Pillar({"conv": 1, "none": 1}, 1, "S"), "x": score.Pillar({"absent": 1}, 1)}
    said = []
    out = score.score(score.with_ratings(df), pillars, 30, {}, log=said.append).orderBy("rank").collect()
    assert [r.place_id for r in out] == ["p_5", "p_4", "p_3", "p_2", "p_1"] and out[0].score == out[0].pillar_m == 100.0
    assert sum(r.profile == "top" for r in out) == 2 and out[0].why == "top, S" and out[0].tier == "A" and len(said) == 3
    with pytest.raises(ValueError):
        score.score(df, {"x": score.Pillar({"absent": 1}, 1)}, log=said.append)
    b = score.with_ratings(spark.createDataFrame([("a", 5.0, 2), ("b", 3.4, 100), ("c", None, 5)], "place_id string, rating double, reviews long")).collect()
    assert b[0].rating_adj == pytest.approx((30 * 4.2 + 2 * 5) / 32, abs=1e-6) and b[2].rating_adj is None
    signs = {"m": score.Pillar({"conv": -1, "reviews": 1}, 1)}
    assert all(r.score == 0 for r in score.score(score.with_ratings(df), signs, log=said.append).collect())


def test_report(spark):
    df = spark.createDataFrame([(str(i), f"N{i % 7}", float(i), float(i * i), 0 if i % 4 else i, i % 3) for i in range(40)], "place_id string, name string, a double, b double, z long, dup_count int").withColumns({"dup_names": F.lit(""), "dup_ids": F.lit("")})
    said = report.quality_report(df, raw_count=50)
    assert "40 sites of 50 listings" in said and "| a | b | 1 |" in said and "| z |" in said
    assert report.measure_columns(df) == ["a", "b", "z"]


def test_metering(spark):
    got = metering.usage(spark.createDataFrame([("m", "s", 3)], "month string, sku string, n long"), spark.createDataFrame([("s", 3), ("t", 5)], "sku string, cap long"), "m")
    assert {tuple(r) for r in got.collect()} == {("s", 3, 3, 0, False), ("t", 0, 5, 5, True)} and "3 / 3" in " ".join(metering.usage_lines(got)[0].split())
    plan = metering.estimate(99, 8, 400, {k: [1] for k in "abc"}, {"aggregate": 5000})
    assert (plan["search_min"], plan["search_max"], plan["aggregate"], plan["free_sites"]) == (792, 2376, 1200, 1666)


XML = """<osm><node id="1" lat="13.001" lon="101.0"><tag k="amenity" v="school"/><tag k="name:en" v="S"/></node><node id="2" lat="20" lon="101.0"><tag k="amenity" v="school"/></node>
<node id="11" lat="12.999" lon="100.999"/><node id="12" lat="12.999" lon="101.001"/><node id="13" lat="13.001" lon="101.001"/><node id="14" lat="13.001" lon="100.999"/>
<way id="21"><nd ref="11"/><nd ref="12"/><nd ref="13"/><nd ref="14"/><nd ref="11"/><tag k="landuse" v="industrial"/></way><way id="22"><nd ref="11"/><nd ref="12"/><nd ref="13"/></way><way id="23"><nd ref="11"/><nd ref="14"/><nd ref="13"/></way>
<relation id="31"><member type="way" ref="22" role="outer"/><member type="way" ref="23" role="outer"/><tag k="type" v="multipolygon"/><tag k="amenity" v="university"/></relation></osm>"""


def test_extract(spark):
    assert osm.parse_filter('nwr["shop"="mall"]') == osm.TagFilter("nwr", "shop", "mall")
    with pytest.raises(ValueError):
        osm.parse_filter('node["a"~"b"]')
    rows = list(osm.extract(io.BytesIO(XML.encode()), {"south": 12.9, "north": 13.1, "west": 100.9, "east": 101.1}, {"school": ['nwr["amenity"="school"]']}, {"ind": ['way["landuse"="industrial"]']}, {"campus": ['nwr["amenity"="university"]']}))
    df = osm.layers(spark, rows)
    assert osm.point_layer(df).count() == 1 and osm.point_layer(df).first().name == "S" and osm.ring_layer(df, "ind").count() == 1 and osm.ring_layer(df, "campus", "campus").count() == 1
    assert osm.has_features(df, ["school", "ind"]) and not osm.has_features(df, ["other"])
    tags = spark.createDataFrame([({"amenity": "school"}, "n"), ({"amenity": "x"}, "n"), ({"amenity": "school"}, "w")], "t map<string,string>, k string")
    assert [r.m for r in tags.select(osm.tags_match(F.col("t"), F.col("k"), [osm.TagFilter("n", "amenity", "school")]).alias("m")).collect()] == [True, False, False]
    assert osm.parse_counts([{"type": "count", "tags": {"total": "7"}}, {"type": "count", "tags": {"total": "2"}}], ["a", "b"]) == {"a": 7, "b": 2}
    assert len(osm.rings_of([{"type": "way", "geometry": [{"lat": y, "lon": x} for x, y in ((0, 0), (1, 0), (1, 1), (0, 0))]}])) == 1


def _varint(x):
    x &= (1 << 64) - 1
    out = b""
    while x > 127:
        out, x = out + bytes([x & 127 | 128]), x >> 7
    return out + bytes([x])


def _zig(x):
    return x << 1 if x >= 0 else (-x << 1) - 1


def _field(number, value):
    return _varint(number << 3) + _varint(value) if isinstance(value, int) else _varint(number << 3 | 2) + _varint(len(value)) + value


def _delta(xs):
    return b"".join(_varint(_zig(x - y)) for x, y in zip(xs, [0, *xs[:-1]], strict=True))


def _binary_extract(xml, pack):
    """The elements of an XML extract in the binary format: the first node alone, the others dense."""
    found = list(osm.elements(io.BytesIO(xml.encode())))
    words = sorted({"", *(w for _, _, t, _ in found for kv in t.items() for w in kv), *(r for k, _, _, c in found if k == "relation" for _, _, r in c)})
    at = {w: i for i, w in enumerate(words)}
    keys = lambda t: _field(2, b"".join(_varint(at[k]) for k in t)) + _field(3, b"".join(_varint(at[v]) for v in t.values()))
    fixed = lambda v, offset: round((v * 1e9 - offset) / 1000)
    nodes = [(i, t, fixed(y, -5000), fixed(x, 7000)) for k, i, t, (x, y) in (f for f in found if f[0] == "node")]
    i, t, y, x = nodes[0]
    alone = _field(1, _field(1, _zig(i)) + keys(t) + _field(8, _zig(y)) + _field(9, _zig(x)))
    some = nodes[1:]
    pairs = b"".join(b"".join(_varint(at[k]) + _varint(at[v]) for k, v in t.items()) + b"\0" for _, t, _, _ in some)
    dense = _field(2, _field(1, _delta([n[0] for n in some])) + _field(8, _delta([n[2] for n in some])) + _field(9, _delta([n[3] for n in some])) + _field(10, pairs))
    ways = b"".join(_field(3, _field(1, i) + keys(t) + _field(8, _delta(c))) for k, i, t, c in found if k == "way")
    kinds = {"node": 0, "way": 1, "relation": 2}
    relations = b"".join(_field(4, _field(1, i) + keys(t) + _field(8, b"".join(_varint(at[r]) for _, _, r in c)) + _field(9, _delta([m for _, m, _ in c])) + _field(10, b"".join(_varint(kinds[m]) for m, _, _ in c))) for k, i, t, c in found if k == "relation")
    block = _field(1, b"".join(_field(1, w.encode()) for w in words)) + b"".join(_field(2, g) for g in (alone, dense, ways, relations)) + _field(17, 1000) + _field(19, -5000) + _field(20, 7000)
    out = b""
    for name, body in ((b"OSMHeader", b""), (b"OSMData", block)):
        blob = pack(body)
        header = _field(1, name) + _field(3, len(blob))
        out += len(header).to_bytes(4, "big") + header + blob
    return out


def test_binary_extract_equals_xml(tmp_path):
    import zlib

    rules = ({"south": 12.9, "north": 13.1, "west": 100.9, "east": 101.1}, {"school": ['nwr["amenity"="school"]']}, {"ind": ['way["landuse"="industrial"]']}, {"campus": ['nwr["amenity"="university"]']})
    want = list(osm.extract(io.BytesIO(XML.encode()), *rules))
    whole = list(osm.elements(io.BytesIO(XML.encode())))
    for i, pack in enumerate((lambda b: _field(1, b), lambda b: _field(2, len(b)) + _field(3, zlib.compress(b)))):
        path = tmp_path / f"x{i}.osm.pbf"
        path.write_bytes(_binary_extract(XML, pack))
        assert list(osm.extract(path, *rules)) == want and len(want) >= 3
        for a, b in zip(osm.elements(path), whole, strict=True):
            assert a[:3] == b[:3] and (a[3] == b[3] if a[0] != "node" else a[3] == pytest.approx(b[3], abs=1e-6))
    (tmp_path / "cut.pbf").write_bytes(path.read_bytes()[:-5])
    with pytest.raises(ValueError):
        list(osm.elements(tmp_path / "cut.pbf"))


class Answers:
    def __init__(self, *answers):
        self.answers, self.asked = list(answers), []

    def request(self, method, url, **more):
        self.asked.append((method, url, more))
        status, body = self.answers.pop(0) if len(self.answers) > 1 else self.answers[0]
        return type("R", (), {"status_code": status, "text": body, "json": lambda self: json.loads(body)})()


def test_ingest(tmp_path):
    quiet = {"sleep": lambda s: None}
    client = ingest.Places(Answers((429, "{}"), (200, '{"count": "12"}'), (200, "{}")), ingest.Cache(tmp_path / "c"), "k", most_calls=2, **quiet)
    assert client.count(1, 2, 500, ["a"]) == 12 and client.count(1, 2, 500, ["a"]) == 12 and client.count(1, 2, 600, ["a"]) == 0
    assert client.usage() == [("places_aggregate", 2, 1)]
    with pytest.raises(ingest.OverBudget):
        client.count(1, 2, 700, ["a"])
    site = [type("S", (), {"place_id": f"p{i}", "lat": 1.0 + i, "lng": 2.0})() for i in range(3)]
    bad = ingest.Places(Answers((400, '{"error": {"message": "no"}}')), ingest.Cache(tmp_path / "d"), "k", **quiet)
    assert [v for *_, v in ingest.count_rows(site, bad, {"f": (["t"], [500, 900])}, log=lambda _: None)] == [None] * 6 and len(bad.session.asked) == 1
    with pytest.raises(ingest.ServiceError):
        ingest.count_rows(site, ingest.Places(Answers((403, "x")), ingest.Cache(tmp_path / "e"), "k", **quiet), {"f": (["t"], [500])}, log=lambda _: None)
    ledger = ingest.Ledger(tmp_path / "l.json", {"place_details_enterprise": 1})
    some = ingest.Places(Answers((200, '{"rating": 4.5, "regularOpeningHours": {"weekdayDescriptions": ["a", "b"]}}')), ingest.Cache(tmp_path / "f"), "k", ledger=ledger, **quiet)
    rows = ingest.detail_rows(site, some, log=lambda _: None)
    assert len(rows) == 1 and rows[0]["reviews"] == 0 and rows[0]["hours_text"] == "a | b" and ledger.remaining("place_details_enterprise") == 0 and len(ledger.rows()) == 1
    guard, calls = ingest.Breaker(), []
    assert [guard.attempt(lambda: calls.append(1) or 1 / 0) for _ in range(20)] == [None] * 20 and len(calls) == 5
    assert ingest.specs({"a": ["x"], "b": {"types": ["y"], "radii_m": [9]}}, [5]) == {"a": (["x"], [5]), "b": (["y"], [9])}
    pages = ingest.Places(Answers((200, '{"places": [1], "nextPageToken": "n"}'), (200, '{"places": [2]}')), ingest.Cache(tmp_path / "g"), "k", **quiet)
    assert pages.search_tile("q", {}) == ([1, 2], False)


def test_files_and_pages(spark, tmp_path):
    (tmp_path / "p.csv").write_text("Name , LATITUDE,Lon,Workers\nA,13.0,101.0,5\nB,,101.0,7\nC,13.1,101.1,x\n", "utf-8-sig")
    pts = files.read_points(spark, f"file://{tmp_path}/p.csv", "Workers")
    assert {(r.name, r.workers) for r in pts.collect()} == {("A", 5.0), ("C", 0.0)}
    assert files.read_points(spark, f"file://{tmp_path}/none.csv", log=lambda _: None) is None
    with pytest.raises(SystemExit, match="discover"):
        files.read_sites(spark, f"file://{tmp_path}/none.csv")
    (tmp_path / "keep.csv").write_text('place_id,keep,note\na,0,"x, y"\na,1,\n', "utf-8-sig")
    review = files.read_review(spark, f"file://{tmp_path}/keep.csv")
    assert review.count() == 2 and {r.note for r in review.collect()} == {"x, y", None}
    files.write_csv(spark.createDataFrame([("a", "0000011")], "place_id string, open_days string"), str(tmp_path / "d.csv"))
    assert (tmp_path / "d.csv").read_bytes().startswith(b"\xef\xbb\xbf") and files.read_csv(spark, f"file://{tmp_path}/d.csv", files.DETAILS).first().open_days == "0000011"
    ranked = spark.createDataFrame([(1, "p", "</script><b>", 13.0, 101.0, 80.5, float("nan"))], "rank long, place_id string, name string, lat double, lng double, score double, conv double")
    items = spark.createDataFrame([("p", "conv", 1, "x", 5, None, 13.0, 101.0)], "place_id string, col string, pos int, name string, metres int, extra double, lat double, lng double")
    data = files.payload(ranked, ["conv"], {"m": score.Pillar({"conv": 1}, 1)}, items)
    assert data["sites"][0]["items"] == {"conv": [[0, 5]]} and data["places"] == [["x", 13.0, 101.0]] and [f["key"] for f in data["features"]] == ["reviews", "rating", "conv"]
    assert "</script><b>" not in files.page(data) and "NaN" not in files.page(data) and "&lt;b&gt;" in files.map_page(ranked)
    known = {"conv": ("Shops", "shops", "n", 1), "conv_store": ("Stores", "shops", "n", 1), "ind_ha": ("Land", "work", "rai", 6.25)}
    assert files.feature_info("conv_store_gas_500", known, {})["label"] == "Stores · gas" and files.feature_info("ind_ha_1500", known, {})["scale"] == 6.25 and files.feature_info("odd_9", known, {}) == {"label": "odd", "group": "other", "unit": "", "scale": 1, "radius": 9}
    assert files.feature_source("ind_ha_5", {}, [], ["ind"], [], []) == {"src": "area"} and files.feature_source("seven_gas_5", {}, [], [], [], ["seven"]) == {"src": "file"}


def test_stages(spark, tmp_path):
    cfg = {
        "area": {"address_must_contain": ["Chon"]}, "discover": {"name_must_match": "market", "market_types": ["market"]}, "surroundings": {"source": "osm", "radii_m": [500], "osm_filters": {"school": []}},
        "scoring": {"pillars": {"m": {"measures": {"reviews": 1}, "weight": 1, "tag": "known"}, "s": {"measures": {"school_500": 1}, "weight": 1}}},
    }
    place = lambda i: (f"p{i}", (f"Market {'ABCDEFGH'[i] * 4}",), "Chonburi", (13.0 + i / 100, 101.0), ["market"], "market", "OPERATIONAL", "u")
    hits = spark.createDataFrame([("k1", i, place(i)) for i in range(4)] + [("k2", 9, place(1))], discover.HIT)
    sites = stages.discovered(cfg, hits)
    assert {r.place_id: r.keywords for r in sites.collect()}["p1"] == "k1|k2"
    details = stages.enriched(spark.createDataFrame([(f"p{i}", 4.0, 10 * i, "CLOSED_TEMPORARILY" if i == 3 else "", None) for i in range(4)], "place_id string, rating double, reviews long, business_status_now string, periods array<struct<open:struct<day:int,hour:int,minute:int>,close:struct<day:int,hour:int,minute:int>>>"))
    layers = osm.layers(spark, [("point", "school", "S", 13.02, 101.0, None)])
    around, items = stages.surroundings(cfg, sites, layers)
    out = stages.ranked(cfg, stages.features(cfg, sites, details, around), log=lambda _: None)
    rows = out.orderBy("rank").collect()
    assert [r.place_id for r in rows][0] == "p2" and len(rows) == 3 and items.count() == 1
    assert stages.filtered(out, least_reviews=10).count() == 2 and "kept by type" in stages.review_text(sites)
    with pytest.raises(ValueError):
        stages.surroundings({"surroundings": {"source": "x", "radii_m": [1]}}, sites)
    (tmp_path / ".env").write_text('A_KEY="x y"\n# c\nB_KEY=1 # n\n')
    config.load_env(str(tmp_path / ".env"))
    import os

    assert os.environ["A_KEY"] == "x y" and os.environ["B_KEY"] == "1"


def test_stages_from_the_services(spark, tmp_path, monkeypatch):
    """Search, details and counts through a client; full boxes are searched in quarters."""
    import terravane.__main__ as cli

    asked = []

    class Client:
        def search_tile(self, text, rectangle):
            box = rectangle["rectangle"]
            asked.append(box["high"]["latitude"] - box["low"]["latitude"])
            place = {"id": f"p{len(asked)}", "displayName": {"text": f"Market {len(asked)}"}, "location": {"latitude": 13, "longitude": 101.0 + len(asked)}, "formattedAddress": "Chonburi", "primaryType": "market", "more": 1}
            return [place], len(asked) == 1

        fetched = None

        def details(self, place_id):
            return {"rating": 4, "regularOpeningHours": {"periods": [{"open": {"day": 1, "hour": 6, "minute": 0}, "close": {"day": 1, "hour": 11, "minute": 0}}]}}

        def count(self, lat, lng, radius, types):
            return radius

        def usage(self):
            return [("text_search_pro", len(asked), 0)]

    monkeypatch.setattr(cli, "service", lambda *a: Client())
    monkeypatch.setattr(cli.stages, "session", lambda: spark)
    cfg = {
        "area": {"bbox": {"south": 13.0, "north": 13.1, "west": 101.0, "east": 101.1}, "tile_deg": 0.1, "max_subdivide_depth": 1, "address_must_contain": []}, "discover": {"keywords": ["market"], "market_types": ["market"]},
        "surroundings": {"source": "google_aggregate", "radii_m": [500], "google_types": {"school": ["school"]}},
    }
    args = type("Args", (), {"max_calls": 10, "extract": None, "sites": 1})
    for stage in ("discover", "enrich", "surround"):
        cli.run(stage, cfg, str(tmp_path), args)
    assert [round(x, 3) for x in asked] == [0.1, 0.05, 0.05, 0.05, 0.05]
    read = lambda name: spark.read.parquet(f"{tmp_path}/{name}")
    assert read("sites").count() == 5 and {r.lat for r in read("sites").collect()} == {13.0}
    assert [r.hours_known for r in read("details").collect()] == [1] * 5 and [r.school_500 for r in read("surroundings").collect()] == [500.0] * 5


def test_components(spark):
    got = {r.node: r.root for r in components.components(spark.createDataFrame([(5, 4), (4, 3), (9, 8), (1, 1)], "a long, b long")).collect()}
    assert got == {3: 3, 4: 3, 5: 3, 8: 8, 9: 8}


def test_stream_of_hits(spark, tmp_path):
    from terravane.streaming.hits import hit_stream, new_places

    (tmp_path / "a.json").write_text("\n".join(json.dumps({"keyword": "k", "seq": i, "place": {"id": f"p{i % 3}", "displayName": {"text": "n"}}, "ts": f"2026-01-01T00:00:0{i}Z"}) for i in range(6)))
    q = new_places(hit_stream(spark, f"file://{tmp_path}")).writeStream.format("memory").queryName("places").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.place_id for r in spark.table("places").collect()) == ["p0", "p1", "p2"]


def test_text(spark):
    rows = spark.createDataFrame([("--A b/ปั๊ม!",), ("🙂",), (None,)], "s string").select(text.slug(F.col("s")).alias("s")).collect()
    assert [r.s for r in rows] == ["a_b_ปั๊ม", "other", "other"]
    d = spark.createDataFrame([("12 Si Racha",), ("อำเภอ ปลวกแดง",), ("Klaeng District",), (None,)], "a string").select(text.district(F.col("a")).alias("d")).collect()
    assert [r.d for r in d] == ["ศรีราชา", "ปลวกแดง", "Klaeng", text.NO_DISTRICT]
    t = spark.createDataFrame([({"name": "", "name:th": "ก"},), ({"x": "y"},)], "t map<string,string>").select(text.label_name(F.col("t")).alias("n")).collect()
    assert [r.n for r in t] == ["ก", ""]
