"""Text quality by positive-unlabelled learning.

Trusted positives and unlabelled web text train a logistic model that minimises the non-negative unbiased risk
    pi * E_p[l(g, +)] + max(0, E_u[l(g, -)] - pi * E_p[l(g, -)])
with a class prior pi estimated from the same two samples: the least ratio of the shares of unlabelled texts and of
positives at or above a score (best-bin estimation), which is where negatives are rarest.
Inputs of a score come from the text alone: counts of byte classes and of their pairs, word lengths, repeated words
and repeated lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import small_batches
from .textbatch import NOT_SPACE, Words, slices, text_bytes, word_bounds, word_hashes

#: Byte classes: lower case, upper case, digit, space, line end, .,  ,  !  ?  other ASCII marks by kind, control, beyond ASCII.
_KINDS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".", ",", "!", "?", "|", "*#$%&@^~", "<>{}[]()/\\", "'\"`-_:;+="]
CLASS = np.full(256, len(_KINDS) + 1, np.int64)
CLASS[:128] = len(_KINDS)
for _i, _k in enumerate(_KINDS):
    CLASS[[ord(c) for c in _k]] = _i
N_CLASS = len(_KINDS) + 2
NOT_END = np.array([c not in (10, 13) for c in range(256)])
N_FEATURES = N_CLASS + N_CLASS * N_CLASS + 8 + 6


def _repeats(hashes: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """How many of each text's items stand in it before already."""
    key = hashes ^ (doc.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    distinct = np.unique(key, return_index=True)[1]
    return np.bincount(doc, minlength=n) - np.bincount(doc[distinct], minlength=n)


def features(texts: pa.Array) -> np.ndarray:
    """One row for each text; shares are drawn towards 0 in short texts. An empty text gets zeros."""
    data, offsets = text_bytes(texts)
    out = np.zeros((len(offsets) - 1, N_FEATURES), np.float32)
    for a, b in slices(offsets):
        out[a:b] = _features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
    return out


def _features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    n, size = len(offsets) - 1, np.diff(offsets)
    doc = np.repeat(np.arange(n), size)
    cls = CLASS[data]
    one = np.bincount(doc * N_CLASS + cls, minlength=n * N_CLASS).reshape(n, N_CLASS)
    inside = doc[:-1] == doc[1:] if len(doc) else np.zeros(0, bool)
    two = np.bincount((doc[:-1] * N_CLASS + cls[:-1])[inside] * N_CLASS + cls[1:][inside], minlength=n * N_CLASS**2).reshape(n, N_CLASS**2)
    words = Words(data, offsets, NOT_SPACE)
    length = words.ends - words.starts
    which = words.doc()
    lengths = np.bincount(which * 8 + np.minimum(np.log2(np.maximum(length, 1)), 7).astype(np.int64), minlength=n * 8).reshape(n, 8)
    ls, le, lat = word_bounds(data, offsets, NOT_END)
    lines = np.repeat(np.arange(n), np.diff(lat))
    repeated_lines = _repeats(word_hashes(data, ls, le), lines, n)
    n_words, n_lines = np.diff(words.at), np.diff(lat)
    again = (words.hashes[1:] == words.hashes[:-1]) & (which[1:] == which[:-1])
    share = np.sqrt
    return np.column_stack([
        share(one / (size + 20)[:, None]), share(two / (size + 20)[:, None]), share(lengths / (n_words + 4)[:, None]),
        _repeats(words.hashes, which, n) / (n_words + 20), repeated_lines / (n_lines + 3), np.bincount(which, length, minlength=n) / (n_words + 4) / 10,
        np.log1p(n_words) / 10, np.log1p(n_lines) / 10, np.bincount(which[1:][again], minlength=n) / (n_words + 10),
    ])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Model:
    """A logistic model of standardised features, held in three arrays."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, bias: float, prior: float) -> None:
        self.mean, self.scale, self.weights, self.bias, self.prior = mean, scale, weights, bias, prior

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias)


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1) -> float:
    """Best-bin estimate of the share of positives in the unlabelled, from scores of held-out rows."""
    p, u = np.sort(positive), np.sort(unlabelled)
    at = np.unique(p)
    over_p = 1 - np.searchsorted(p, at) / len(p)
    over_u = 1 - np.searchsorted(u, at) / len(u)
    slack = np.sqrt(np.log(4 / delta) / 2) * (1 / np.sqrt(len(p)) + 1 / np.sqrt(len(u)))
    best = np.argmin((over_u + slack) / np.maximum(over_p, 1e-9) + 1e9 * (over_p < 0.02))
    return float(np.clip(over_u[best] / max(over_p[best], 1e-9), 0.05, 0.98))


def pu_risk(xp, xu, w, bias, prior: float, decay: float = 0.0) -> tuple[float, float, np.ndarray]:
    """(positive part, negative part, gradient) of the unbiased risk with the logistic loss, at weights w and bias. Where
    the negative part is below 0, the gradient is that of its opposite alone, as the method says."""
    sp, su = _sigmoid(xp @ w + bias), _sigmoid(xu @ w + bias)
    low = 1e-12
    positive = -prior * np.log(sp + low).mean()
    negative = -np.log(1 - su + low).mean() + prior * np.log(1 - sp + low).mean()
    grad_p = prior * (sp - 1) / len(sp)  # of pi * E_p[l(g, +)]
    minus_u, minus_p = su / len(su), -prior * sp / len(sp)  # of E_u[l(g, -)] and -pi * E_p[l(g, -)]
    if negative < 0:
        grad_p, minus_u, minus_p = 0 * grad_p, -minus_u, -minus_p
    gradient = np.append((grad_p + minus_p) @ xp + minus_u @ xu + decay * w, (grad_p + minus_p).sum() + minus_u.sum())
    return positive, negative, gradient


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, rounds: int = 600, rate: float = 0.03, decay: float = 2e-3, seed: int = 3) -> Model:
    """Full-batch Adam on the non-negative risk with the logistic loss. Where the negative part of the risk falls below
    0, its gradient is turned round, as the method says."""
    both = np.vstack([positive, unlabelled]) if len(positive) + len(unlabelled) else np.zeros((1, N_FEATURES))
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    if not len(positive) or not len(unlabelled):
        return Model(mean, scale, np.zeros(both.shape[1]), 0.0, 0.5)
    if prior is None:
        fold = np.random.default_rng(seed)
        a, b = fold.random(len(positive)) < 0.5, fold.random(len(unlabelled)) < 0.5
        got_p, got_u = [], []
        for x, y in ((a, b), (~a, ~b)):
            if x.any() and y.any() and (~x).any() and (~y).any():
                part = fit_pu(positive[x], unlabelled[y], 0.5, rounds // 2, rate, decay, seed)
                got_p.append(part.score(positive[~x]))
                got_u.append(part.score(unlabelled[~y]))
        prior = estimate_prior(np.concatenate(got_p), np.concatenate(got_u)) if got_p else 0.5
    xp, xu = (np.clip((x - mean) / scale, -8, 8) for x in (positive, unlabelled))
    w, bias = np.zeros(xp.shape[1]), float(np.log(prior / (1 - prior)))
    m = v = np.zeros(len(w) + 1)
    for t in range(1, rounds + 1):
        _, _, g = pu_risk(xp, xu, w, bias, prior, decay)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    return Model(mean, scale, w, bias, prior)


def bounded_sample(docs: DataFrame, ids: DataFrame, id_col: str, text: str, most: int) -> np.ndarray:
    """Features of the texts of at most `most` of the ids: those with the smallest hashes, whatever their order. Of rows
    that share an id, the least text is taken. Only ids are sorted; the picked ones are broadcast, `most` at the most."""
    picked = ids.select(id_col).filter(F.col(id_col).isNotNull()).distinct().orderBy(F.xxhash64(id_col), id_col).limit(most)
    texts = docs.join(F.broadcast(picked), id_col).groupBy(id_col).agg(F.min(F.coalesce(F.col(text), F.lit(""))).alias("__t")).orderBy(id_col)
    found = [np.frombuffer(r.x, np.float32) for r in texts.select("__t").mapInArrow(_feature_rows, "x binary").collect()]
    return np.vstack(found).astype(np.float64) if found else np.zeros((0, N_FEATURES))


def _feature_rows(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in found:
        yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in features(batch.column(0))], pa.binary())], names=["x"])


def held_out(id_col: str, folds: int = 3, fold: int = 1):
    """crc32 of the id as text, modulo folds, is fold; never for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality", most_positive: int = 3000, most_unlabelled: int = 6000, fold: bool = True) -> Model:
    """A model fitted to at most most_positive texts that labels mark 1 and most_unlabelled other texts (documented
    bounds of the only sample drawn; rows with a null id are not learnt from). With fold, rows of the held-out third are not learnt from at all."""
    keep = ~held_out(id_col) if fold else F.lit(True)
    docs = docs.select(F.col(id_col), F.col(text)).filter(keep)
    good = labels.filter(keep & (F.col(label) == 1)).select(F.col(id_col)).distinct()
    known = docs.select(id_col).join(good, id_col, "left_semi")
    return fit_pu(bounded_sample(docs, known, id_col, text, most_positive), bounded_sample(docs, docs, id_col, text, most_unlabelled))


def score_quality(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs, each with score (0 to 1) and predicted (1 from a score of 0.5 on).

    A null text is scored as an empty one; rows that repeat are scored each; columns of docs named score or predicted
    give way. No row is dropped.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    at = kept.index(text)
    source = docs.select(*kept)

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(features(batch.column(at))), pa.float64())], names=[*kept, "score"])

    scored = source.mapInArrow(run, source.withColumn("score", F.lit(0.0)).schema)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
