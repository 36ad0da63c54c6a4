"""Secrets in whole texts: fixed rules, and two character Markov models compared by log-likelihood ratio.

One model is trained on samples labelled random, the other on samples labelled as ordinary identifiers. What the fixed
rules leave of a run of token characters is reported when the first explains it better than the second by at least
`least` nats in total; otherwise those sequences of its words are that reach as much by themselves.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .license_scan import license_texts
from .storage import small_batches

#: Fixed rules: kind, pattern, fewest characters of the last group (or of the match).
RULES = [
    ("assign", re.compile(r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 1, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]
#: A maximal run has the same matches of 24 or more as the rule for hex, and is found without stopping at each word.
LONG_HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ["assign", "access", "hex", "markov"]
#: Words of a run, and what joins them.
WORD = re.compile(r"[A-Za-z0-9]+|[+/_=-]+")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CODE = np.full(128, -1, np.int16)
CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))


def ordinary_words() -> list[str]:
    """Words of the license texts that come with the package: plain English that is the same everywhere."""
    return sorted({w for text, _ in license_texts() for w in re.findall("[a-z]{2,}", text.lower())})


def samples(n: int = 4000, seed: int = 7) -> list[tuple[str, bool]]:
    """Labelled samples: (string, is it random). Random ones are drawn over usual alphabets, ordinary ones are English
    words, put together the way paths, versions, titles and identifiers are. Fixed by the seed."""
    rng = np.random.default_rng(seed)
    words = ordinary_words()
    sets = [ALPHABET[:62], ALPHABET[:64], ALPHABET[:62] + "_-", "0123456789abcdef", ALPHABET[:26] + "0123456789", ALPHABET[26:62]]
    out = [("".join(rng.choice(list(sets[i % len(sets)]), int(rng.integers(16, 64)))), True) for i in range(n)]
    for i in range(n):
        some = [words[int(k)] for k in rng.integers(0, len(words), int(rng.integers(1, 7)))]
        if i % 5 == 0:
            some = [w + "s" if j % 2 else w for j, w in enumerate(some)]
        some = [some, [w.capitalize() for w in some], [w.upper() for w in some], some[:1] + [w.capitalize() for w in some[1:]]][i % 4]
        text = ("_", "-", "/", "", "_")[i % 5].join(some)
        out.append((text + (str(int(rng.integers(0, 3000))) if i % 3 == 0 else ""), False))
    return out


def train(labelled: Iterable[tuple[str, bool]], smooth: float = 0.5) -> np.ndarray:
    """log P(next | this, random) - log P(next | this, ordinary), with one more row for the first character."""
    n = len(ALPHABET)
    counts = np.full((2, n + 1, n), smooth)
    for text, is_random in labelled:
        codes = [CODE[ord(c)] for c in text if ord(c) < 128 and CODE[ord(c)] >= 0]
        for a, b in zip([n, *codes[:-1]], codes, strict=True):
            counts[int(is_random), a, b] += 1
    p = np.log(counts / counts.sum(axis=2, keepdims=True))
    return p[1] - p[0]


def ratio(text: str, model: np.ndarray) -> float:
    codes = CODE[np.frombuffer(text.encode(), np.uint8)]
    return float(model[len(ALPHABET), codes[0]] + model[codes[:-1], codes[1:]].sum())


def segments(part: str, model: np.ndarray, shortest: int, least: float) -> list[tuple[int, int]]:
    """The whole part if its ratio is at least `least`; else its best sequences of words and separators that reach it."""
    codes = CODE[np.frombuffer(part.encode(), np.uint8)]
    steps = np.concatenate([[model[len(ALPHABET), codes[0]]], model[codes[:-1], codes[1:]]])
    if steps.sum() >= least:
        return [(0, len(part))]
    out, begin, end, total, top = [], 0, 0, 0.0, 0.0
    for m in WORD.finditer(part):
        if total <= 0:
            begin, total, top = m.start(), 0.0, 0.0
        total += float(steps[m.start() : m.end()].sum())
        if total > top:
            top, end = total, m.end()
        if m.end() == len(part) or total <= 0 or top - total >= least:
            if top >= least:
                if end - begin >= shortest:
                    out.append((begin, end))
                total = 0.0
    return out


def spans_of(text: str, model: np.ndarray | None, shortest: int = 16, least: float = 12.0) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, sorted by start, then by the order of KINDS."""
    found = []
    for kind, pattern, group, fewest in RULES:
        for m in (LONG_HEX if kind == "hex" else pattern).finditer(text):
            if len(m[group]) >= fewest:
                found.append((kind, m.start(), m.end()))
    if model is not None:
        base: list[list[int]] = []  # what the rules found, without overlaps
        for _, a, b in sorted(found, key=lambda x: x[1:]):
            if base and a <= base[-1][1]:
                base[-1][1] = max(base[-1][1], b)
            else:
                base.append([a, b])
        i = 0
        for m in re.finditer(r"[A-Za-z0-9+/_=-]{%d,}" % shortest, text):
            at = m.start()
            while i < len(base) and base[i][1] <= at:
                i += 1
            while at < m.end():
                stop = min(m.end(), base[i][0]) if i < len(base) else m.end()
                if stop - at >= shortest:
                    found += [("markov", at + x, at + y) for x, y in segments(text[at:stop], model, shortest, least)]
                if i == len(base) or base[i][0] >= m.end():
                    break
                at = base[i][1]
                i += at <= m.end()  # one that ends beyond this run may reach into the next
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def joined(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan_secrets(docs: DataFrame, text: str = "text", model: np.ndarray | None = None, shortest: int = 16, least: float = 12.0, mask: str | None = None) -> DataFrame:
    """docs, each with secret_spans: array<struct<kind,start,end>> in code points of the whole text.

    model: from train(); by default trained from samples(). With `mask`, every span in the text column is replaced by
    that string (overlapping spans at once). A null text has no spans and stays null; rows that repeat are scanned
    each; a column named secret_spans in docs gives way. No row is dropped.
    """
    small_batches(docs.sparkSession)
    model = train(samples()) if model is None else model
    kept = [c for c in docs.columns if c != "secret_spans"]
    at = kept.index(text)
    source = docs.select(*kept)
    schema = source.withColumn("secret_spans", F.lit(None).cast("array<struct<kind:string,start:long,end:long>>")).schema
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            texts = batch.column(at).to_pylist()
            spans = [spans_of(t, model, shortest, least) if t else [] for t in texts]
            columns = list(batch.columns)
            if mask is not None:
                columns[at] = pa.array([masked(t, s, mask) if s else t for t, s in zip(texts, spans, strict=True)], columns[at].type)
            rows = pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans], kind)
            yield pa.RecordBatch.from_arrays([*columns, rows], names=[*kept, "secret_spans"])

    return source.mapInArrow(run, schema)


def masked(text: str, spans: Iterable[tuple[str, int, int]], mask: str) -> str:
    out, done = [], 0
    for _, a, b in spans:
        if a >= done:
            out += [text[done:a], mask]
        done = max(done, b)
    return "".join([*out, text[done:]])


def digest_columns(scanned: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the fixed rules' spans and all spans as a string."""
    spans = F.col("secret_spans")
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    count = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return scanned.withColumns({f"n_{k}": count(k) for k in KINDS} | {
        "base_sha256": F.sha2(F.array_join(F.transform(F.filter(spans, lambda s: s["kind"] != "markov"), line), ","), 256),
        "spans": F.array_join(F.transform(spans, line), ","),
    })
