import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from terravane.llm import importance, queries
from terravane.llm.textbatch import one_text

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, n=2):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return w, [" ".join(w[i : i + k]) for k in range(1, n + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, n, buckets, percent, least):
    def counts(texts):
        out = [0] * buckets
        for t in texts:
            for f in features(t, n)[1]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = counts(x for _, x in docs), counts(target)
    gains = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, text in docs:
        w, f = features(text, n)
        weight = sum(gains[zlib.crc32(x.encode()) % buckets] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w) >= least))
    drawn = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    k = percent * len(drawn) // 100
    return sorted([(*r[:4], p) for p, r in enumerate(drawn[:k], 1)] + [(*r[:4], None) for r in drawn[k:]] + [(*r[:4], None) for r in rows if not r[4]], key=repr)


def texts(seed, n):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "Été", "ÀB", "x1", "żółw", "a", "LONG" * 40, "語"] + [f"w{i}" for i in range(60)]
    return [" ".join(rng.choices(words, k=rng.randrange(60))) for _ in range(n)]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_buckets(n):
    rng = random.Random(n)
    for text in ["", "one", " A  b\tC ", *texts(n, 20), "q" * 5000 + " z " + "é" * 700, "".join(chr(rng.randrange(32, 900)) for _ in range(2000))]:
        got, owner = importance.feature_buckets(one_text(text), n, 997)
        assert sorted(got.tolist()) == sorted(zlib.crc32(f.encode()) % 997 for f in features(text, n)[1])
        assert not owner.any()


@pytest.mark.parametrize("percent", [0, 25, 99, 100])
def test_equals_brute_force(spark, percent):
    docs = list(enumerate(texts(1, 300))) + [(5, "again " * 30), (None, None), (None, "null id " * 20), (None, "null id " * 20), (7, ""), (400, "é " * 5000)]
    docs += [(500, "same words here again and again " * 5)] * 40  # rows that repeat
    target = [*texts(2, 20), None, "w1 w2 " * 50]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"row": F.lit(1), "score": F.lit("x"), "k0": F.lit(None)}).repartition(5)
    aim = spark.createDataFrame([(t, 1) for t in target], "text string, doc_id long")
    got = importance.resample(df, aim, percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and {t for _, t in got.dtypes} == {"bigint"}
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, target, 2, 10_000, percent, 20)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    one = spark.createDataFrame([(1, "a b " * 20)] * 4, "doc_id long, text string")
    assert importance.resample(none, one).collect() == []
    assert sorted(map(tuple, importance.resample(one, none).collect()), key=repr) == brute([(1, "a b " * 20)] * 4, [], 2, 10_000, 25, 20)


def test_kth_key(spark):
    rng = random.Random(3)
    big = (1 << 63) - 1
    rows = [(rng.choice([-big - 1, -5, 0, 3, big]), rng.choice([rng.randrange(10), rng.randrange(-big, big)])) for _ in range(500)]
    df = spark.createDataFrame(rows, "a long, b long")
    for bits, k in ((12, 1), (3, 77), (12, 250), (16, 500)):
        assert tuple(importance.kth_key(df, [F.col("a"), F.col("b")], k, bits)) == sorted(rows)[k - 1]


def test_gains_of_an_array():
    own, target = np.array([0, 5, 9]), np.array([4, 0, 0])
    want = [math.floor(1000 * math.log((t + 1) * 17 / ((s + 1) * 7))) for s, t in zip(own.tolist(), target.tolist())]
    assert importance.bucket_gains(own, target).tolist() == want


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = c.execute(queries.SQL["op12_resample"])
    names = [d[0] for d in want.description]
    got = queries.op12_resample(spark, sf).select(*names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr)
