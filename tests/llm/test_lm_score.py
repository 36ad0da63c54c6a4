import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from terravane.llm import lm_score as L


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def corpus():
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5))) for _ in range(300)]
    follow = {w: rng.sample(words, 3) for w in words}
    rows = []
    for i in range(260):
        w, text = rng.choice(words), []
        for _ in range(rng.randrange(60)):
            text.append(w.upper() if rng.random() < 0.1 else w)
            w = rng.choice(follow[w]) if rng.random() < 0.8 else rng.choice(words)
        rows.append((i, rng.choice([" ", "\n", "\t\x0b "]).join(text)))
    return [*rows, (1000, None), (1001, ""), (1002, "new word never seen"), rows[0], rows[0], (None, "a b"), (1003, "long " * 30000)]


@pytest.mark.parametrize("options", [{}, {"most_broadcast": 0, "most_frequent": 40}, {"most_frequent": 0}, {"most_words": 0, "most_frequent": 60}, {"most_words": 0, "most_frequent": 0}])
def test_base_is_exact_and_every_way_agrees(spark, options):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in rows], "doc_id long, text string, score double")
    got = L.score_texts(docs, **options).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    counts = Counter(t for i, x in rows if not held(i) for t in tokens(x))
    n, v = sum(counts.values()), len(counts)
    want = sorted((-1 if i is None else i, held(i), len(tokens(x)), sum(counts[t] > 0 for t in tokens(x)), n, round(sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens(x)), 6)) for i, x in rows)
    have = sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    assert have == want
    # the pairs of this language help where it was not seen
    unseen = [r for r in got if r.held_out and r.n_tokens > 20]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen) and all(r.score <= 0 for r in got)
    usual = {(r.doc_id, r.n_tokens): r.score for r in L.score_texts(docs).collect()}
    assert all(math.isclose(usual[r.doc_id, r.n_tokens], r.score, rel_tol=1e-9) for r in got)


@pytest.mark.parametrize("options", [{}, {"most_words": 0, "most_frequent": 30, "group_grams": 50, "most_lines": 400}])
def test_score_equals_plain_dictionaries(spark, options):
    """With so many bits that the filter never errs, a score is that of quantised counts in dictionaries."""
    rows = corpus()
    docs = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    got = {(r.doc_id, r.n_tokens): r.score for r in L.score_texts(docs, bits_each=80.0, **options).collect()}
    words, starts, pairs = Counter(), 0, Counter()
    for i, x in rows:
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            t = tokens(x)
            words.update(t)
            pairs.update(zip(["<start>", *t], t))
            starts += 1
    below = sum(words.values()) + 0.5 * (len(words) + 1)

    def read(n):  # the middle of the counts that share n's level
        if not n:
            return 0.0
        q = math.floor(math.log(n) / math.log(1.5) + 1e-9)
        same = [m for m in range(max(1, n // 2), 2 * n + 2) if math.floor(math.log(m) / math.log(1.5) + 1e-9) == q]
        return (same[0] + same[-1]) / 2

    for i, x in rows:
        want, before = 0.0, "<start>"
        for t in tokens(x):
            context = read(starts if before == "<start>" else words[before])
            p = (read(words[t]) + 0.5) / below
            want += math.log10((min(read(pairs[before, t]), max(context, 1.0)) + 500 * p) / (context + 500))
            before = t
        assert math.isclose(got[i, len(tokens(x))], want, rel_tol=1e-9), (i, x)


def test_filter_reads_back_counts():
    rng = np.random.default_rng(0)
    hashes = rng.integers(0, 1 << 63, 20000).astype(np.uint64)
    counts = rng.geometric(0.3, 20000) ** 3
    parts = {g: L.build(hashes[hashes % np.uint64(7) == g], counts[hashes % np.uint64(7) == g], 1.5, 10) for g in range(7)}
    f = L.Filter(parts.items(), {g: len(x) for g, x in parts.items()}, 7)
    q = L.quantise(counts, 1.5)
    read = f.count(hashes)
    assert (read >= q).all() and (read == q).mean() > 0.96
    strange = f.count(rng.integers(0, 1 << 63, 20000).astype(np.uint64))
    assert (strange > 0).mean() < 0.04
    value = L.levels(1.5)
    assert np.abs(value[q] / counts - 1).max() < 0.35 and value[0] == 0 and value[1] == 1


def test_empty_table(spark):
    assert L.score_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
