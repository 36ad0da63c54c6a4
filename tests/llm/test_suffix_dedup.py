import random
from collections import defaultdict

import numpy as np

from terravane.llm import suffix_dedup as S
from terravane.llm.textbatch import one_text


def brute(rows, least):
    """Union of all windows of `least` words that another document holds too, grown to maximal spans."""
    docs = {(i, t or "") for i, t in rows}
    where = defaultdict(set)
    for d in docs:
        w = d[1].split()
        for a in range(len(w) - least + 1):
            where[tuple(w[a : a + least])].add((d, a))
    covered = defaultdict(set)
    for places in where.values():
        if len({d for d, _ in places}) > 1:
            for d, a in places:
                covered[d].update((a + x, a + x + 1) for x in range(least))
    out = []
    for d, cells in covered.items():
        start = last = None
        for a, b in sorted(cells):
            if a != last:
                if start is not None:
                    out.append((d[0], start, last))
                start = a
            last = b
        out.append((d[0], start, last))
    return sorted(out, key=str)


def prose(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(n)]


def test_equals_brute_force(spark):
    rng = random.Random(7)
    shared = [prose(rng, n) for n in (50, 55, 64, 90, 200, 49, 30)]
    rows = []
    for i in range(120):
        words = prose(rng, rng.randint(10, 150))
        if i % 2:
            at = rng.randrange(len(words))
            words[at:at] = rng.choice(shared)
        if i % 10 == 0:
            words += rng.choice(shared)
        rows.append((i, " ".join(words)))
    rows += [(500, rows[3][1]), (501, rows[3][1] + " tail"), (7, rows[7][1]), (None, None), (502, ""), (None, rows[5][1]), (503, "same " * 400), (504, "x " + "same " * 300), (505, " ".join(prose(rng, 60) * 3)), (506, " ".join(prose(rng, 20000)))]
    got = sorted(((r.doc_id, r.span_start, r.span_end) for r in S.repeated_spans(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, uid int")).collect()), key=str)
    assert got == brute(rows, 50)
    assert any(i == 500 for i, _, _ in got) and not any(i == 505 for i, _, _ in got)


def test_minimisers_cover_every_window():
    rng = random.Random(1)
    w = one_text(" ".join(prose(rng, 900)))
    places = S.minimisers(w, 50)
    assert max(np.diff(places)) <= S.WINDOW and places[0] < S.WINDOW and len(places) < 900 * 0.09
    inner = one_text(" ".join(prose(rng, 40)) + " " + " ".join(w.low[w.starts[100] : w.ends[299]].tobytes().decode().split()))
    mine = {p - 40 + 100 for p in S.minimisers(inner, 50) if p >= 40}
    assert {p for p in places if 132 <= p < 262} <= mine


def test_neighbours_across_partitions_and_empty(spark):
    rng = random.Random(3)
    common = prose(rng, 70)
    rows = [(i, " ".join(prose(rng, 40) + common + prose(rng, 40))) for i in range(30)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 16)
    try:
        got = sorted((r.doc_id, r.span_start, r.span_end) for r in S.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == [(i, 40, 110) for i in range(30)]
    assert S.repeated_spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_result_does_not_depend_on_the_number_of_partitions(spark):
    rng = random.Random(11)
    shared = [prose(rng, n) for n in (52, 58, 66, 75)]
    rows = []
    for i in range(90):
        words = prose(rng, 30)
        for _ in range(2):
            part = list(rng.choice(shared))
            if i % 3 == 0:
                part[rng.randrange(len(part))] = "other"
            words += part + prose(rng, 5)
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (1, 3, 40):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(sorted((r.doc_id, r.span_start, r.span_end) for r in S.repeated_spans(docs).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] == found[2] and len(found[0]) > 60


def test_many_unlike_passages_around_one_hot_run(spark):
    """Hundreds of documents share 24 words; which 50 words any two share depends on what stands before and after."""
    rng = random.Random(13)
    core, before, after = prose(rng, 24), [prose(rng, 30) for _ in range(12)], [prose(rng, 30) for _ in range(12)]
    rows = []
    for i in range(300):
        head, tail = rng.choice(before), rng.choice(after)
        middle = head[rng.randrange(30) :] + core + tail[: rng.randrange(30)]
        rows.append((i, " ".join(prose(rng, 12) + middle + prose(rng, 12) + (middle if i % 7 == 0 else []))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for piece in (1 << 16, 40, 7):
        got = sorted(((r.doc_id, r.span_start, r.span_end) for r in S.repeated_spans(docs, piece=piece).collect()), key=str)
        assert got == brute(rows, 50) and len(got) > 100


def test_middle_copies_inside_one_document(spark):
    rng = random.Random(17)
    long = prose(rng, 120)
    rows = [(1, " ".join(sum((prose(rng, 3) + long for _ in range(4)), []))), (2, " ".join(prose(rng, 40) + long[30:90] + prose(rng, 40)))]
    got = sorted(((r.doc_id, r.span_start, r.span_end) for r in S.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute(rows, 50) and len(got) == 5
