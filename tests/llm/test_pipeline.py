import random

import corpus_pipeline as P


def tables(spark, path):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgilmnorstu") for _ in range(rng.randint(1, 8)))
    prose = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    item = prose(30)
    rows = [(i, prose(rng.randint(30, 90))) for i in range(300)]
    rows += [(300 + i, " ".join(w.upper() + "!!" for w in prose(60).split())) for i in range(60)]
    rows += [(400, rows[0][1]), (401, rows[1][1] + " And more."), (402, prose(40) + " " + item), (403, prose(40) + ' token = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"')]
    labels = [(i, int(i < 300), 0) for i, _ in rows if i < 360 and rng.random() < 0.7]
    spark.createDataFrame([(i, t, "en", f"src{i % 5}", len(t)) for i, t in rows] + [(None, None, None, None, None), (0, rows[0][1], "en", "src0", 1)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def test_stages_take_effect(spark, tmp_path):
    tables(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for _, stage in P.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), docs.schema)
        assert docs.columns == P.COLUMNS
        kept.append({r.doc_id: r for r in docs.collect()})
    good, single, free, masked = kept
    assert sum(i in good for i in range(300)) >= 297 and sum(i in good for i in range(300, 360)) <= 3
    assert {400, 401} & set(single) == set() and {0, 1} <= set(single) and set(good) - set(single) <= {400, 401, None}
    assert set(single) - set(free) == {402}
    assert "[secret]" in masked[403].text and "9233A8" not in masked[403].text and masked[403].n_chars == len(masked[403].text)
    assert all(masked[i].text == free[i].text for i in free if i != 403)
    out = P.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} <= set(masked) and len(out) > 100


def test_one_of_each_group_keeps_every_group(spark, tmp_path):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(40))
    near = text(3) + " more"
    rows = [(None, text(0)), (None, text(1)), (None, text(1)), (5, text(2)), (5, text(3)), (3, near), (None, near), (7, text(4)), (7, text(4)), (8, text(4)), (9, None), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in P.one_of_each_group(spark, docs, str(tmp_path)).collect()), key=repr)
    assert got == sorted([(None, text(0)), (None, text(1)), (5, text(2)), (3, near), (7, text(4)), (9, None)], key=repr)


def test_decontaminated_decides_by_row(spark, tmp_path):
    passage = " ".join(f"item{i}" for i in range(30))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, "so " + passage), (None, "a clean text"), (4, "see " + passage), (4, "another clean text"), (5, passage), (5, passage), (6, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r.doc_id, r.text) for r in P.decontaminated(spark, docs, str(tmp_path)).collect()), key=repr)
    assert got == sorted([(None, "a clean text"), (4, "another clean text"), (6, None), (None, None)], key=repr)


def test_empty_tables(spark, tmp_path):
    rows = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
    docs = spark.createDataFrame([(1, "some words", "en", "s1", 10), (None, None, None, None, None)], rows)
    for _, stage in P.STAGES[:-1]:  # nothing to learn from and nothing to look for: no row goes
        assert stage(spark, docs, str(tmp_path)).count() == 2


def test_one_of_each_group_equals_brute_force(spark, tmp_path):
    """Groups by plain shingle sets, whatever the order and the partitions of the rows; of equal ids the least row."""
    rng = random.Random(11)
    base = [[f"w{k}x{rng.randrange(90)}" for _ in range(80)] for k in range(12)]
    rows = []
    for i in range(140):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 9])):
            w[rng.randrange(80)] = f"z{rng.randrange(5)}"
        rows.append((rng.choice([i, i, 7, None]), " ".join(w), rng.choice(["en", "de", None]), rng.choice(["a", "b"]), rng.randrange(3)))
    rows += [(500, rows[0][1], "de", "a", 2), (500, rows[0][1], "de", "a", 1), (-5, rows[1][1], None, "b", 9), (-5, rows[1][1], "en", "a", 0)]

    sets = [{tuple(w[i : i + 5]) for i in range(76)} for w in (t.split() for _, t, *_ in rows)]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i, row in enumerate(rows):
        groups.setdefault(find(i), []).append(row)
    nulls_first = lambda r: tuple((x is not None, x) for x in r)
    ids = sorted(str(min((r[0] for r in g if r[0] is not None), default=None)) for g in groups.values())
    seen = []
    for parts in (1, 7):
        docs = spark.createDataFrame(rng.sample(rows, len(rows)), "doc_id long, text string, lang string, source string, n_chars long").repartition(parts)
        got = [tuple(r) for r in P.one_of_each_group(spark, docs, str(tmp_path)).select("doc_id", "text", "lang", "source", "n_chars").collect()]
        assert sorted(str(r[0]) for r in got) == ids and len({find(rows.index(r)) for r in got}) == len(groups)
        assert all(r == min((x for x in rows if x[:2] == r[:2]), key=nulls_first) for r in got)
        seen.append(sorted(got, key=repr))
    assert seen[0] == seen[1]
