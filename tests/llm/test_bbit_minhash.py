import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from terravane.llm import bbit_minhash as bbit
from terravane.llm import queries

SPACE = re.compile("[^\x20\x09-\x0d]+")


def shingles(text, n=3):
    w = SPACE.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(rows, per_cent=85):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i] = root[root[i]]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            inter = len(a & sets[j])
            if inter and 100 * inter >= per_cent * (len(a) + len(sets[j]) - inter):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least.setdefault(find(i), []).append(key)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return sorted(((key, len(s), least[find(i)], key == least[find(i)]) for i, ((key, _), s) in enumerate(zip(rows, sets))), key=repr)


def family(rng, size, words, most):
    """Copies of one text with up to `most` words changed, on both sides of the threshold."""
    base = [rng.choice("abcdefghijkl") + str(rng.randrange(400)) for _ in range(words)]
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randrange(most + 1)):
            w[rng.randrange(words)] = f"x{rng.randrange(9)}"
        out.append(" ".join(w))
    return out


def run(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"key": F.lit(1), "items": F.lit("x"), "id": F.lit(0)})
    got = bbit.near_duplicates(df.repartition(3), **more)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted(map(tuple, got.collect()), key=repr)


@pytest.mark.parametrize("block", [16, 1024])
def test_equals_brute_force(spark, block):
    """Blocks of 16 cut buckets and classes, so that hubs, parts of buckets and pairs of blocks are all met."""
    rng = random.Random(block)
    texts = []
    for size, words, most in ((150, 120, 6), (40, 60, 9), (30, 300, 25), (3, 40, 1)):
        texts += family(rng, size, words, most)
    texts += [texts[5]] * 20 + [t.upper() for t in texts[:3]]  # copies, and copies in another case
    texts += ["", None, "  \t", "one", "one two", "One  TWO", "one two", "a b c", "b a c", "z " * 900, "z " * 50]
    rng.shuffle(texts)
    rows = [(i * 3 % 1009, t) for i, t in enumerate(texts)]
    got = run(spark, rows, block=block)
    assert got == brute(rows)
    assert 20 < sum(1 for r in got if not r[3]) < len(rows) - 20


def test_chains_join_through_other_classes(spark):
    """Texts that resemble each other in a chain, whose ends share little."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[8 * i : 8 * i + 200])) for i in range(25)]
    assert run(spark, rows, block=4) == brute(rows)
    assert {r[2] for r in brute(rows)} == {0}


def test_threshold_is_exact(spark):
    """17 of 20 shingles are 85 %; 16 of 19 are not."""
    a = " ".join(f"w{i}" for i in range(22))
    b = " ".join(f"w{i}" for i in range(19))
    c = " ".join(f"w{i}" for i in range(18))
    rows = [(1, a), (2, b), (3, c + " w99")]
    assert [len(shingles(t)) for _, t in rows] == [20, 17, 17]
    assert run(spark, rows) == brute(rows)


def test_nulls_repeats_and_empty(spark):
    long = " ".join(f"v{i}" for i in range(300))
    rows = [(None, long), (None, long), (7, long + " more"), (None, "alone here now"), (7, "other text of 7"), (8, None), (8, None), (9, ""), (None, None)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 32, (40, 140), dtype=np.uint64)
    values[1] = values[0]
    values[2, :70] = values[0, :70]
    for bits in (1, 2, 4, 8):
        marks = bbit.packed(values, bits)
        agree = bbit.agreeing(marks, marks, bits, 140)
        low = values & np.uint64((1 << bits) - 1)
        assert np.array_equal(agree, (low[:, None, :] == low[None, :, :]).sum(axis=2))
        assert bbit.similarity(int(agree[0, 1]), 140, bits) == 1 and abs(bbit.similarity(agree[0, 3:], 140, bits).mean()) < 0.05
        assert abs(bbit.similarity(int(agree[0, 2]), 140, bits) - 0.5) < 0.15
    assert 0.6 < bbit.least_similarity(140, 4, 0.85, 1e-7) < 0.75


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    want = c.execute(queries.SQL["op11_bbit_minhash"])
    names = [d[0] for d in want.description]
    got = queries.op11_bbit_minhash(spark, sf).select(*names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr)
