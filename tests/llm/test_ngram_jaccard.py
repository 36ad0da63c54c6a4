import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from terravane.llm import ngram_jaccard as J
from terravane.operators.components import components


def shingles(text, n=5):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, t=Fraction(4, 5)):
    sets = [shingles(x) for _, x in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if (rows[i][1] or "") == (rows[j][1] or "") or (sets[i] and sets[j] and len(sets[i] & sets[j]) >= t * union):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        least[r] = d if least.get(r) is None else least[r] if d is None else min(d, least[r])
    return Counter((d, least[find(i)], links[i]) for i, (d, _) in enumerate(rows))


def corpus(seed, groups=12, edits=6):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 4)))
    shared = [word() for _ in range(30)]
    texts = []
    for g in range(groups):
        base = [word() for _ in range(rng.randint(6, 120))] + (shared if g % 3 == 0 else [])
        for _ in range(rng.choice([1, 2, 5, 25])):
            copy = list(base)
            for _ in range(rng.randrange(edits)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += [texts[0]] * 9 + [None, "", "", "?!", "one", "One!", "two words", "a b c d", "A b, c d."]
    rng.shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[4]), (None, None)]


@pytest.mark.parametrize("block", [1024, 8])
def test_equals_brute_force(spark, block):
    rows = corpus(3)
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, class_id int")
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in J.similar_groups(docs, block=block).collect())
    assert got == brute(rows)


def test_empty_and_long(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert J.similar_groups(docs).count() == 0
    long = " ".join(f"w{i % 977}x{i}" for i in range(30000))
    rows = [(1, long), (2, long + " end"), (3, "other text of five words"), (4, long)]
    got = Counter((r.doc_id, r.class_id, r.n_links) for r in J.similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == brute(rows)


def test_posterior_bound():
    rng = np.random.default_rng(0)
    for n in (14, 70, 140):
        m = J.least_matches(n, 0.8, 1e-3)
        draws = rng.beta(m + 1, n - m + 1, 400_000)
        below = rng.beta(m, n - m + 2, 400_000)
        assert (draws >= 0.8).mean() > 0.7e-3 and (below >= 0.8).mean() < 1.4e-3


def test_components_of_random_graphs(spark):
    rng = random.Random(8)
    edges = [(a, a + 1) for a in range(100, 160)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in list(root)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
