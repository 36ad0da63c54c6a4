import math
import random
import zlib

import numpy as np
import pyarrow as pa

from terravane.llm import quality as Q


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgilmnorstu") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(20, 120))]
        good = rng.random() < 0.75
        text = " ".join(words).capitalize() + "." if good else rng.choice([" | ".join(words), " ".join(w.upper() + "!!" for w in words), " ".join([words[0]] * 60)])
        rows.append((i, text, "en", "src0", 0.1))
        if rng.random() < 0.6:
            labels.append((i, int(good), 0))
    return rows, labels


def test_held_out_accuracy_and_odd_rows(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([*rows, (5000, None, None, None, None), (5001, "", None, None, None), (None, "a b", None, None, None), rows[0]], "doc_id long, text string, lang string, source string, score double")
    model = Q.fit_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert 0.55 < model.prior < 0.95
    got = Q.score_quality(docs, model).withColumn("held_out", Q.held_out("doc_id")).collect()
    assert len(got) == len(rows) + 4
    truth = dict((i, q) for i, q, _ in labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    assert len(held) > 100 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    blank = [r.score for r in got if r.doc_id in (5000, 5001)]
    assert blank[0] == blank[1]
    assert Q.score_quality(docs.limit(0), model).count() == 0


def test_labels_of_the_held_out_third_change_nothing(spark):
    rows, labels = corpus(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double")
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in labels]
    a, b = (Q.fit_quality(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, turned))
    assert np.array_equal(a.weights, b.weights)


def test_no_positive_labels_and_empty_tables(spark):
    docs = spark.createDataFrame(corpus(20)[0], "doc_id long, text string, lang string, source string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in Q.score_quality(docs, Q.fit_quality(docs, none)).collect()} == {0.5}
    Q.fit_quality(docs.limit(0), none)


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(0)
    p, u = rng.normal(2, 1, 3000), np.concatenate([rng.normal(2, 1, 2100), rng.normal(-2, 1, 900)])
    assert abs(Q.estimate_prior(p, u) - 0.7) < 0.05


def test_risk_is_not_fitted_below_zero():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (60, 5))
    model = Q.fit_pu(x[:20] + 1, x, 0.6)
    assert np.isfinite(model.weights).all() and 0.3 < model.score(x).mean() < 0.95


def test_features_do_not_depend_on_the_batch():
    texts = ["One two two.\nOne two two.", "", None, "ÉCOLE 12 !!", "a" * 5000]
    together = Q.features(pa.array(texts))
    alone = np.vstack([Q.features(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(together, alone) and together.shape[1] == Q.N_FEATURES


def test_risk_and_gradient_equal_plain_ones():
    """The risk by its formula, row by row, and the gradient by differences of it."""
    rng = np.random.default_rng(4)
    xp, xu = rng.normal(0.5, 1, (30, 4)), rng.normal(-0.2, 1, (50, 4))
    loss = lambda z: math.log1p(math.exp(-z))
    for bias, prior in ((0.1, 0.4), (-3.0, 0.95)):
        w = rng.normal(0, 0.5, 4)
        score = lambda x, v: float(x @ v[:4] + v[4])

        def parts(v, prior=prior):
            up = prior * sum(loss(score(x, v)) for x in xp) / len(xp)
            down = sum(loss(-score(x, v)) for x in xu) / len(xu) - prior * sum(loss(-score(x, v)) for x in xp) / len(xp)
            return up, down

        at = np.append(w, bias)
        positive, negative, gradient = Q.pu_risk(xp, xu, w, bias, prior)
        assert np.allclose([positive, negative], parts(at), atol=1e-9)
        target = (lambda v: sum(parts(v))) if negative >= 0 else (lambda v: -parts(v)[1])
        step = 1e-6 * np.eye(5)
        plain = [(target(at + d) - target(at - d)) / 2e-6 for d in step]
        assert np.allclose(gradient, plain, atol=1e-6)


def test_labels_with_clashing_names(spark):
    docs = spark.createDataFrame([(i, "word " * (i + 3)) for i in range(30)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, "other", "x") for i in range(0, 30, 2)], "doc_id long, quality int, text string, lang string")
    model = Q.fit_quality(docs, labels)
    assert Q.score_quality(docs, model).count() == 30
