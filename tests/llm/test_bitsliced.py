import math
import random

import numpy as np
import pytest

from terravane.llm.bitsliced import Block, top_k_products


def brute(cands, queries, k):
    def whole(v):
        return None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(1024 * x) for x in v]

    out = []
    seen = {}
    for i, v in queries:
        if i is not None and whole(v) is not None:
            seen[i] = min(seen.get(i, whole(v)), whole(v))
    for i, q in seen.items():
        scores = sorted((-sum(a * b for a, b in zip(q, w)), j) for j, v in cands if j is not None and j != i and (w := whole(v)) is not None)
        out += [(i, r, j, -s) for r, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("drop", [0, 3, 6])
def test_block_holds_the_best(drop):
    rng = np.random.default_rng(drop)
    x = rng.integers(-600, 600, (777, 9))
    x[100:160] = x[5]  # ties
    index = Block(x, drop)
    for _ in range(30):
        q = rng.integers(-400, 400, 9)
        s = x @ q
        assert set(np.flatnonzero(s >= np.sort(s)[-10])) <= set(index.top(q, 10).tolist())


def test_equals_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(6)], 1) for i in range(400)]
    rows += [(400 + i, list(rows[3][1]), 1) for i in range(30)]  # copies
    rows += [(7, rows[7][1], 1), (7, rows[8][1], 2), (None, rows[1][1], 0), (500, None, 0), (600, [0.1, None, 0.0, 0.0, 0.0, 0.0], 0), (700, [float("nan")] * 6, 0), (800, [float("inf")] * 6, 0), (900, [0.5, 0.1], 0), (1000, [], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    queries = df.filter("vec_id % 100 = 0 or vec_id = 7")
    got = top_k_products(df, queries, block=100, query_block=3)
    want = brute(rows, [r for r in rows if r[0] is not None and (r[0] % 100 == 0 or r[0] == 7)], 10)
    assert sorted(map(tuple, got.collect())) == want
    assert top_k_products(df.limit(0), queries).count() == 0 and top_k_products(df, queries.limit(0)).count() == 0
    assert top_k_products(df.filter("vec_id in (0, 1)"), df.filter("vec_id = 0")).count() == 1


def test_too_large_components_are_refused(spark):
    rows = spark.createDataFrame([(0, [1e18, 1.0]), (1, [1e18, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits|overflow|OVERFLOW"):
        top_k_products(rows, rows).collect()
    large = spark.createDataFrame([(0, [2.0**19, 1.0]), (1, [2.0**19, 2.0])], "vec_id long, embedding array<double>")
    want = (1024 * 2**19) ** 2 + 1024 * 2048
    assert [(r.query_id, r.vec_id, r.score) for r in top_k_products(large, large).orderBy("query_id").collect()] == [(0, 1, want), (1, 0, want)]
