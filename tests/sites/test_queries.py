import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events clients client_changes".split()
SITE_QUERIES = __import__("terravane.plans.site_queries", fromlist=["QUERIES"]).QUERIES


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(rows):
    return sorted(repr(tuple(None if v is None or v != v else v for v in r)) for r in rows)


@pytest.mark.parametrize("name", list(SITE_QUERIES))
def test_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r[c] for c in sorted(df.columns)) for r in df.collect()]
    if name not in entry.oracle_sql():
        assert rows
        return
    found = duck.sql(entry.oracle_sql()[name])
    at = sorted(range(len(found.columns)), key=lambda i: found.columns[i])
    assert sorted(df.columns) == sorted(found.columns)
    assert plain(rows) == plain([tuple(r[i] for i in at) for r in found.fetchall()])


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "rank" and df.count() > 0


def test_campus_count_has_every_part(spark):
    from math import cos, radians

    from terravane.functions.geo import haversine
    from terravane.operators import surround
    from terravane.plans import site_queries as q

    sites, parts, rings = q.sites(spark, SF), q.shops(spark, SF), q._rings(spark, SF)
    value = lambda df: {(r.place_id, r.col): r.value for r in df.collect()}
    got = value(q.campus_count(spark, SF))
    alone = value(surround.campus_measures(sites, rings, parts.limit(0).select("lat", "lng", "name"), (1500, 3000), "campus"))
    boxes = [([p.lat for p in r.ring], [p.lng for p in r.ring]) for r in rings.collect()]
    d = sites.select("place_id", F.col("lat").alias("a"), F.col("lng").alias("b")).crossJoin(parts.select("lat", "lng")).withColumn("d", haversine(F.col("a"), F.col("b"), F.col("lat"), F.col("lng")))
    want = dict(alone)
    for r in d.filter("d <= 3000").collect():
        k = surround.FLAT_M
        off = lambda x, side: max(min(side) - x, x - max(side), 0) * k
        if all((off(r.lat, y) ** 2 + (off(r.lng, x) * cos(radians(r.a))) ** 2) ** 0.5 > 1 for y, x in boxes):
            for m in (1500, 3000):
                want[r.place_id, f"campus_{m}"] += r.d <= m
    assert got == want and sum(want.values()) > 5 * sum(alone.values())
