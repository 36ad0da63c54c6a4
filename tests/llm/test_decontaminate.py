import random
import time
from itertools import combinations

import numpy as np
import pytest

from terravane.llm.decontaminate import MASKS, best_overlap as fast_overlap, find_contamination, masks_of


def prose(rng, n):
    return [rng.choice(["the", "of", "and", "to"]) if rng.random() < 0.3 else "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def test_finds_what_brute_force_finds(spark):
    rng = random.Random(6)
    items = [(i, prose(rng, rng.randint(12, 50))) for i in range(12)] + [(50, prose(rng, 6)), (51, prose(rng, 3))]
    docs = []
    for i in range(80):
        words = prose(rng, rng.randint(20, 150))
        if i % 2:
            part = list(rng.choice(items)[1])
            for _ in range(len(part) // 8 if i % 4 == 1 else 0):
                part[rng.randrange(len(part))] = "changed"
            at = rng.randrange(len(words))
            words[at:at] = part
        docs.append((i, words))
    frame = spark.createDataFrame([(i, " ".join(w).upper() + "." if i % 3 else ", ".join(w), "x") for i, w in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(i, " ".join(w), 1) for i, w in items], "item_id long, text string, doc_id int")
    got = {(r.doc_id, r[1]): r.n_match for r in find_contamination(frame.drop("item_id"), bench).collect()}
    want = {(d, i): m for d, w in docs for i, x in items if (m := best_by_rule(w, x, 10, 0.8)) is not None}
    assert got == want and len(want) >= 36
    # by a Bloom filter that is far too small, the same
    again = {(r.doc_id, r[1]): r.n_match for r in find_contamination(frame.drop("item_id"), bench, block_words=300, few_seeds=0).collect()}
    assert again == want


def test_odd_input(spark):
    passage = " ".join(prose(random.Random(1), 30))
    docs = spark.createDataFrame([(1, None), (2, ""), (3, passage), (3, passage), (None, passage), (5, "pad " * 30000 + passage), (6, "clean words only")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, passage), (2, None), (3, ""), (None, passage)], "item_id long, text string")
    got = sorted((r.doc_id or -1, r.item_id or -1, r.doc_start) for r in find_contamination(docs, bench).collect())
    assert got == sorted((d, i, s) for d, s in ((3, 0), (3, 0), (-1, 0), (5, 30000)) for i in (1, -1))
    assert find_contamination(docs, bench.limit(0)).count() == 0 and find_contamination(docs.limit(0), bench).count() == 0


def some_span(doc, item, least, similar):
    """Whether any span of any diagonal counts, by the documented rule alone."""
    need = min(least, -(-similar * len(item) // 1))
    for diagonal in range(-len(item) + 1, len(doc)):
        a, b = max(0, diagonal), max(0, -diagonal)
        same = [doc[a + i] == item[b + i] for i in range(min(len(doc) - a, len(item) - b))]
        for begin in range(len(same)):
            m = 0
            for end in range(begin + 1, len(same) + 1):
                m += same[end - 1]
                if m >= need and m >= similar * (end - begin):
                    return True
    return False


def test_substitutions_near_the_ends(spark):
    rng = random.Random(8)
    items, docs = [], []
    for i, (n, changed) in enumerate([(15, (3, 11)), (20, (3, 8, 13, 17)), (16, (2, 13)), (20, (2, 3, 12, 17)), (12, (2, 9)), (15, (1, 3, 7, 11, 13))]):
        item = [f"w{i}x{k}" for k in range(n)]
        items.append((i, item))
        around = prose(rng, 12)
        docs.append((i, around + [w if k not in changed else "changed" for k, w in enumerate(item)] + around))
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    rows = find_contamination(frame, bench).collect()
    want = {(d, i) for d, w in docs for i, x in items if some_span(w, x, 10, 0.8)}
    assert {(r.doc_id, r.item_id) for r in rows} == want and want == {(i, i) for i in range(5)}
    for r in rows:
        span = zip(docs[r.doc_id][1][r.doc_start : r.doc_start + r.n_words], items[r.item_id][1][r.item_start : r.item_start + r.n_words], strict=True)
        assert sum(a == b for a, b in span) == r.n_match >= max(10, 0.8 * r.n_words)


def test_masks_cover_every_way_to_change_a_fifth():
    for n in range(10, 20):
        seeds = [sum(1 << (p + o) for p in mask) for mask in MASKS for o in range(n - mask[-1])]
        for changed in combinations(range(n), n // 5):
            bad = sum(1 << x for x in changed)
            assert any(s & bad == 0 for s in seeds), (n, changed)
    for n in range(5, 10):
        seeds = [sum(1 << (p + o) for p in mask) for mask, at in masks_of(n) for o in at]
        assert all(any(s >> x & 1 == 0 for s in seeds) for x in range(n))


def best_by_rule(doc, item, least, similar):
    """Most matches of any span of any diagonal that counts by the documented rule, or None."""
    need, best = min(least, -(-similar * len(item) // 1)), None
    for diagonal in range(-len(item) + 1, len(doc)):
        a, b = max(0, diagonal), max(0, -diagonal)
        same = [doc[a + i] == item[b + i] for i in range(min(len(doc) - a, len(item) - b))]
        for begin in range(len(same)):
            m = 0
            for end in range(begin + 1, len(same) + 1):
                m += same[end - 1]
                if m >= need and m >= similar * (end - begin) - 1e-9 and (best is None or m > best):
                    best = m
    return best


def test_every_overlap_of_the_rule_is_found(spark):
    """Items of 1 to 25 words with up to a fifth of their words changed, whichever these are."""
    rng = random.Random(21)
    items, docs = [], []
    for i, n in enumerate([*range(1, 26), 15, 20]):
        item = [f"w{i}x{k}" for k in range(n)]
        items.append((i, item))
        changed = {25: (4, 6, 8), 26: (8, 9, 10, 11)}.get(i) or rng.sample(range(n), n // 5)
        part = ["changed" if k in changed else w for k, w in enumerate(item)]
        docs.append((i, (prose(rng, 9) if i % 2 else []) + part + (prose(rng, 9) if i % 3 else [])))
        docs.append((100 + i, prose(rng, 5) + item[: n // 2] + prose(rng, 5)))
    frame = spark.createDataFrame([(i, " ".join(w)) for i, w in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.n_match for r in find_contamination(frame, bench).collect()}
    want = {(d, i): m for d, w in docs for i, x in items if (m := best_by_rule(w, x, 10, 0.8)) is not None}
    assert got == want and {(i, i) for i in range(27)} <= set(want)


def test_items_of_few_words_and_the_best_span(spark):
    docs = spark.createDataFrame([(1, "The capital of France is Paris, so the capital of France is it"), (2, "a x capital b")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "capital of france is"), (2, "capital of france is paris"), (3, "capital"), (4, "x capital"), (5, "of capital")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.doc_start, r.n_match, r.similarity) for r in find_contamination(docs, bench).collect()}
    assert got == {(1, 1): (1, 4, 1.0), (1, 2): (1, 5, 1.0), (1, 3): (1, 1, 1.0), (2, 3): (2, 1, 1.0), (2, 4): (1, 2, 1.0)}
    item = [f"w{i}" for i in range(30)]
    part = item[:10] + ["changed", "twice"] + item[12:17] + ["other"] * 13
    docs = spark.createDataFrame([(1, " ".join(part))], "doc_id long, text string")
    row = find_contamination(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).first()
    assert (row.n_words, row.n_match) == (17, 15)


def test_hot_passage_in_time(spark):
    """A passage of 13 words in 100 items and 300 documents: all 30,000 pairs overlap and are told."""
    shared = " ".join(f"hot{i}" for i in range(13))
    docs = spark.range(300).selectExpr("id AS doc_id", f"concat('a', id, ' {shared} b', id) AS text")
    bench = spark.range(100).selectExpr("id AS item_id", f"concat('c', id, ' {shared} d', id) AS text")
    rows = find_contamination(docs, bench)
    assert rows.filter("n_match = 13 AND doc_start = 1 AND item_start = 1").count() == 30_000


@pytest.mark.parametrize("n", [1, 2])
def test_a_megabyte_of_few_words(n):
    words = np.arange(1, n + 1, dtype=np.uint64)
    doc, item = np.resize(words, 200_000), np.resize(words, 300)
    began = time.perf_counter()
    got = fast_overlap(doc, item, np.arange(-299, 200_000), 10, 0.8)
    assert got == (300, 300, 0, 0) and time.perf_counter() - began < 20


def test_repeated_words_and_rows(spark):
    docs = spark.createDataFrame([(1, "so " * 30000), (2, "a b " * 15000), (2, "a b " * 15000), (3, "so so")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "so " * 300), (2, "a b " * 100), (2, "a b " * 100)], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.n_match, r.doc_start) for r in find_contamination(docs, bench).collect())
    assert got == [(1, 1, 300, 0)] + [(2, 2, 200, 0)] * 4
