import random
import re

from terravane.llm import license_scan as L


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def places(text):
    w = words(text)
    return [(i, label) for phrase, label in L.PHRASES for p in [phrase.split()] for i in range(len(w)) if w[i : i + len(p)] == p]


def test_base_places_equal_plain_search(spark):
    rng = random.Random(5)
    bits = ["under the MIT license", "Apache License, Version 2", "CC-BY-NC", "cc by", "under", "the", "mit", "license", "é", "版本", "2", "version", "nc", "apache"]
    texts = [" ".join(rng.choice(bits) for _ in range(rng.randrange(25))) for _ in range(300)] + [None, "", "cc", "under the mit license " * 3000]
    rows = [(i % 290, t, 1) for i, t in enumerate(texts)]  # some ids repeat
    got = L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, n_words int")).collect()
    want = sorted((i, len(words(t)), len(places(t)), *(lambda s: (min(s), max(s)) if s else (-1, -1))([a for a, _ in places(t)]), ",".join(sorted({b for _, b in places(t)}))) for i, t, _ in rows)
    have = sorted((r.doc_id, r.n_words, r.n_base, -1 if r.first_word is None else r.first_word, -1 if r.last_word is None else r.last_word, r.base_labels) for r in got)
    assert have == want
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) for r in got)


def test_notices_with_changed_words(spark):
    notice = L.NOTICES[0][0].split()
    changed = [w if i not in (4, 12) else "xx" for i, w in enumerate(notice)]
    longer = notice[:10] + ["put", "in"] + notice[10:]
    half = notice[: len(notice) // 2]
    rows = [(1, " ".join(notice)), (2, " ".join(["so"] * 7 + longer)), (3, " ".join(half)), (4, " ".join(changed)), (None, " ".join(notice))]
    got = {r.doc_id: r for r in L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].labels == "mit" and got[1].score == 1.0 and got[1].n_base == 0
    assert got[2].labels == "mit" and got[2].matches[0].start == 7
    assert got[3].labels == "" and 0.4 < got[3].score < 0.6
    assert got[None].labels == "mit"


def test_empty_table(spark):
    assert L.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_short_notice_many_times(spark):
    short, four, part = "all rights reserved", "creative commons attribution sharealike", "general public license"
    full, long = L.NOTICES[0][0], L.NOTICES[0][0].replace("free of charge", "free of charge free of charge")
    texts = [(short + "\n") * n for n in (1, 2, 3, 4, 50)] + [f"{short} 2024\n" * 6, (four + " ") * 5, f"{part} " * 6 + "gnu lesser general public license " + f"{part} " * 6, full + " " + full, long, "all rights " * 40]
    got = {r.doc_id: r for r in L.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i].labels for i in range(11)] == ["reserved"] * 6 + ["cc-by-sa", "lgpl", "mit", "mit", ""]
    assert [len(got[i].matches) for i in range(11)] == [1, 2, 3, 4, 50, 6, 5, 1, 2, 1, 0]
    assert [(m.start, m.length, m.covered) for m in got[5].matches] == [(4 * k, 3, 3) for k in range(6)]
    assert [(m.start, m.length) for m in got[6].matches] == [(4 * k, 4) for k in range(5)]
    assert got[9].matches[0].covered == len(full.split())


def test_whole_license_texts(spark):
    texts = L.license_texts()
    rng = random.Random(3)
    rows, want = [], []
    for i, (text, label) in enumerate(texts):
        w = text.split()
        changed = [x if k % 40 else x + "x" for k, x in enumerate(w)]  # one word in forty
        cases = [(text, True), ("Before it. " + text.upper() + " After it.", True), (" ".join(changed), True), (" ".join(w[: len(w) // 2]), False)]
        for k, (t, there) in enumerate(cases):
            rows.append((10 * i + k, t))
            want.append((10 * i + k, label, there))
    rows.append((-1, " ".join(rng.sample(" ".join(t for t, _ in texts).split(), 4000))))
    got = {r.doc_id: r for r in L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), notices=[]).collect()}
    for i, label, there in want:
        assert (label in got[i].labels.split(",")) == there, (i, label, got[i].labels)
    assert not {label for _, label in texts} & set(got[-1].labels.split(","))


def test_labels_and_score_lie_between_plain_bounds(spark):
    """A copy that stands whole gives its label, unless it is part of a longer match; a template whose words the document's trigrams cannot cover gives none,
    and no share is larger than what all trigrams of the document cover."""
    rng = random.Random(9)
    templates = [(p.split(), label) for p, label in [*L.PHRASES, *L.NOTICES]]
    texts = []
    for _ in range(250):
        parts = []
        for _ in range(rng.randrange(6)):
            w, _ = rng.choice(templates)
            a, b = sorted(rng.sample(range(len(w) + 1), 2)) if rng.random() < 0.5 else (0, len(w))
            parts += [x if rng.random() < 0.97 else "zz" for x in w[a:b]] + ["so"] * rng.choice([0, 0, 1, 6])
        texts.append(" ".join(parts))
    got = L.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), texts=[]).collect()
    for r in got:
        w = words(texts[r.doc_id])
        grams = {tuple(w[i : i + 3]) for i in range(len(w) - 2)}
        must, may, top = set(), set(), 0.0
        for p, label in templates:
            covered = {x for j in range(len(p) - 2) if tuple(p[j : j + 3]) in grams for x in (j, j + 1, j + 2)}
            top = max(top, len(covered) / len(p))
            if len(covered) >= 0.8 * len(p):
                may.add(label)
            alone = lambda i: not any(m.start <= i and i + len(p) <= m.start + m.length and m.length > len(p) for m in r.matches)  # noqa: B023, E731
            if any(w[i : i + len(p)] == p and alone(i) for i in range(len(w))):
                must.add(label)
        labels = set(filter(None, r.labels.split(",")))
        assert must <= labels <= may, (texts[r.doc_id], labels)
        assert 0 <= r.score <= top + 1e-12 and (r.score >= 0.8 or not labels) and (r.score > 0) == (top > 0)


def plain_islands(w, p, gap):
    """Hits (document's word, template's word) of one template, cut where diagonals lie more than gap apart."""
    at = {}
    for j in range(len(p) - 2):
        at.setdefault(tuple(p[j : j + 3]), []).append(j)
    hits = sorted((i - j, i, j) for i in range(len(w) - 2) for j in at.get(tuple(w[i : i + 3]), ()))
    islands = []
    for k, (d, i, j) in enumerate(hits):
        if not k or d - hits[k - 1][0] > gap:
            islands.append([])
        islands[-1].append((i, j))
    return islands


def plain_copies(hits, n, cover, most):
    """As copies_of, every cover counted anew."""
    size = lambda hs: len({x for _, j in hs for x in (j, j + 1, j + 2)})
    hits, out, left, r = sorted(hits), [], 0, 0
    while r < len(hits):
        while hits[left][0] + most < hits[r][0] + 3:
            left += 1
        r += 1
        if size(hits[left:r]) / n < cover:
            continue
        last = max(j for _, j in hits[left:r])
        while r < len(hits) and hits[r][1] > last and hits[r][0] + 3 <= hits[left][0] + most:
            last, r = hits[r][1], r + 1
        end = hits[r - 1][0] + 3
        out.append((hits[left][0], end - hits[left][0], size(hits[left:r])))
        while r < len(hits) and hits[r][0] < end:
            r += 1
        left = r
    return out


def plain_scan(text, templates, cover=0.8, gap=4):
    w, spans, score = words(text), [], 0.0
    for p, label, phrase in templates:
        for hits in plain_islands(w, p, 0 if phrase else gap):
            js = [j for _, j in hits]
            covered = {x for j in js for x in (j, j + 1, j + 2)}
            share, start, end = len(covered) / len(p), min(i for i, _ in hits), max(i for i, _ in hits) + 3
            score = max(score, min(1.0, share))
            if phrase:
                spans += [(label, start, end - start, len(p), True)] if len(covered) == len(p) else []
            elif share >= cover:
                one = end - start <= len(p) + 2 * gap and len(js) == len(set(js))
                spans += [(label, *x, False) for x in ([(start, end - start, len(covered))] if one else plain_copies(hits, len(p), cover, len(p) + 2 * gap))]
    inside = lambda a: any(b[2] > a[2] and b[1] <= a[1] and a[1] + a[2] <= b[1] + b[2] for b in spans)
    kept = sorted(x[:4] for x in spans if x[4] or not inside(x))
    return ",".join(sorted({x[0] for x in kept})), score, kept


def test_equals_brute_force(spark):
    """Labels, score and matches, whole license texts among them, some cut, changed, repeated or put in others."""
    rng = random.Random(12)
    whole = [t for t in L.license_texts() if len(t[0]) < 12000]
    templates = [(words(p), label, True) for p, label in L.PHRASES] + [(words(p), label, False) for p, label in [*L.NOTICES, *whole]]
    texts = []
    for _ in range(120):
        parts = []
        for _ in range(rng.randrange(5)):
            w, _, _ = rng.choice(templates)
            a, b = sorted(rng.sample(range(len(w) + 1), 2)) if rng.random() < 0.4 else (0, len(w))
            some = [x if rng.random() < 0.98 else "zz" for x in w[a:b]]
            parts += some * rng.choice([1, 1, 1, 2, 3]) + ["so"] * rng.choice([0, 0, 1, 6])
        texts.append(" ".join(parts))
    got = L.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), texts=whole).collect()
    for r in got:
        labels, score, spans = plain_scan(texts[r.doc_id], templates)
        assert (r.labels, [tuple(m) for m in r.matches]) == (labels, spans), r.doc_id
        assert abs(r.score - score) < 1e-12
    assert len({r.labels for r in got}) > 20


def test_a_license_has_its_own_label_only(spark):
    texts = dict((label, t) for t, label in L.license_texts())
    rows = [(i, texts[label]) for i, label in enumerate(sorted(texts))] + [(99, (texts["gpl-3"] + "\n") * 20), (98, texts["gpl-3"] + " all rights reserved")]
    got = {r.doc_id: r.labels for r in L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[99] == "gpl-3" and got[98] == "gpl-3,reserved"
    assert [got[i] for i, label in enumerate(sorted(texts)) if label.startswith(("gpl", "lgpl", "agpl"))] == [x for x in sorted(texts) if x.startswith(("gpl", "lgpl", "agpl"))]
