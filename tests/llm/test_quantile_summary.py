import random
import zlib
from collections import defaultdict

import duckdb
import pytest


from terravane.llm import queries
from terravane.llm.quantile_summary import LEAST, cents, decimal_crc, exact_ranks, merge, quantile_report, summarise

SCHEMA = "grp string, batch int, x long, grp_n string"


def rows_of(seed, n=3000):
    """A group with two thirds of the rows, one with a third of its rows at one value, small groups, ties and repeats."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        grp = rng.choice(["hot", "hot", "hot", "flat", f"g{i % 40}"])
        x = 7 if grp == "flat" and rng.random() < 0.9 else int(rng.gauss(0, 400)) if grp == "hot" else rng.randrange(300)
        out.append((grp, rng.randrange(4), x, "clash"))
    return out


def check(report, rows, size, quantiles, least):
    held = defaultdict(list)
    for grp, batch, x, *_ in rows:
        if None not in (grp, batch, x):
            held[grp, batch].append(x)
            held[grp, -1].append(x)
    got = {(r.grp, r.batch, r.i): r for r in report.collect()}
    assert set(got) == {(*k, i) for k, v in held.items() if len(v) >= least for i in range(1, quantiles)}
    for (grp, batch, i), r in got.items():
        xs = sorted(held[grp, batch])
        target = -(-i * len(xs) // quantiles)
        below, upto = sum(x < r.answer for x in xs), sum(x <= r.answer for x in xs)
        error = max(0, below + 1 - target, target - upto)
        assert (r.n, r.target, r.exact_x, r.n_below, r.n_upto, r.rank_error) == (len(xs), target, xs[target - 1], below, upto, error)
        assert xs[0] <= r.answer <= xs[-1] and r.within == (1000 * error <= 20 * len(xs))
        assert min(LEAST, len(set(xs))) <= r.points <= min(len(set(xs)), size + LEAST + 2)
        assert error <= (2 * len(xs) / size + 1 if batch < 0 else len(xs) / size)
        assert i == 1 or got[grp, batch, i - 1].answer <= r.answer
    return got


@pytest.mark.parametrize("size", [8, 64, 256])
def test_equals_brute_force(spark, size):
    rows = rows_of(size)
    df = spark.createDataFrame(rows, SCHEMA)
    found = check(quantile_report(df, ["grp"], size), rows, size, 4, 20)
    assert size < 256 or all(r.within for r in found.values())
    assert any(r.points > LEAST for r in found.values())


def test_few_distinct_values_are_all_kept(spark):
    rows = [("a", i % 2, 0, "") for i in range(5000)] + [("a", 0, v, "") for v in range(1, 9)]
    found = check(quantile_report(spark.createDataFrame(rows, SCHEMA), ["grp"], 4), rows, 4, 4, 20)
    assert {r.points for k, r in found.items() if k[1] == -1} == {9}


def test_nulls_and_empty(spark):
    rows = [(None, 0, 1, "")] * 30 + [("a", None, 1, "")] * 30 + [("a", 0, None, "")] * 30 + [("a", 1, v, "") for v in range(25)]
    check(quantile_report(spark.createDataFrame(rows, SCHEMA), ["grp"]), rows, 256, 4, 20)
    assert quantile_report(spark.createDataFrame([], SCHEMA), ["grp"]).collect() == []


def test_merging_in_rounds(spark):
    """Rounds of two summaries: bounds hold, and each round adds n / size at most."""
    rng = random.Random(5)
    rows = [("a", rng.randrange(11), int(rng.gauss(0, 900)), "") for _ in range(6000)]
    size = 128
    cells = spark.createDataFrame(rows, SCHEMA).selectExpr("grp", "batch", "x", "1L as cell")
    points = summarise(exact_ranks(cells, ["grp"])[0], size)
    xs = sorted(r[2] for r in rows)
    merged = merge(points, ["grp"], size, fan_in=2).collect()
    assert len(merged) <= size + LEAST + 2 and max(p.x for p in merged) == xs[-1] and min(p.x for p in merged) == xs[0]
    for p in merged:
        below, upto = sum(x < p.x for x in xs), sum(x <= p.x for x in xs)
        assert p.n == len(xs) and p.lo <= upto and p.hi >= below and p.hi - p.lo <= 5 * len(xs) / size


def test_cents_and_crc(spark):
    money = [None, float("nan"), float("inf"), -0.005, 1.005, -286.29, 3e14]
    df = spark.createDataFrame([(m, i or None) for i, m in enumerate(money)], "money double, id long")
    got = df.select(cents("money"), decimal_crc("id"), "id").collect()
    assert [r[0] for r in got][:3] == [None] * 3 and got[3][0] == 0 and got[5][0] == -28629 and got[6][0] is None
    assert [r[1] for r in got] == [zlib.crc32(str(r.id or "").encode()) for r in got]


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    c = duckdb.connect()
    for t in ("clicks", "sale_lines", "items"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = c.execute(queries.SQL["op13_quantile_summary"])
    names = [d[0] for d in want.description]
    df = queries.op13_quantile_summary(spark, sf).select(*names)
    got, rows = df.collect(), want.fetchall()
    assert sorted(map(tuple, got)) == sorted(rows) and len(rows) > 100 and all(r.within for r in got)
