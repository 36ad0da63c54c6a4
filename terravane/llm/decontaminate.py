"""Benchmark passages in documents, by spaced seeds.

A seed is the hash of the words at a mask's fixed positions; words at the other positions do not matter, so a few
substituted words leave seeds that still agree. The seeds of all documents are joined in Spark with those of the
benchmark's items; a Bloom filter of the items' seeds, of a bounded size, lets the scan send few others. A hit names a
diagonal of a document and an item, and each diagonal is verified on whole words.

Coverage: MASKS miss no way to change a fifth of the words of a span of 10 to 19 words (counted over all ways). A longer
span can be cut into such pieces, one of which has no more than a fifth changed, so no overlap of ten words or more is
lost. Items of 5 to 9 words have a mask for each word left out, those of 1 to 4 words are looked for whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lm_score import Filter, build, group_of
from .storage import small_batches, written
from .textbatch import Words, batches, gram_hash

#: Fixed positions that count; each mask leaves out others.
MASKS = ((0, 1, 2, 4, 5), (0, 1, 3, 6, 7), (0, 2, 3, 5, 8), (0, 1, 2, 5, 7))
#: So few seeds of items are broadcast as they are; more go into a Bloom filter.
FEW_SEEDS = 1 << 16
#: Equal seeds of one text at places this near each other are one run.
NEAR = 64
_FOUND = ["doc_start", "item_start", "n_words", "n_match", "item_words"]


def masks_of(n: int) -> list[tuple[tuple[int, ...], list[int] | None]]:
    """(mask, places) for items of n words; None: wherever it fits."""
    if n >= 10:
        return [(m, None) for m in MASKS]
    if n < 5:
        return [(tuple(range(n)), [0])]
    inner = [(tuple(i for i in range(n) if i != left), [0]) for left in range(1, n - 1)]
    return [(tuple(range(n - 1)), [0, 1]), *inner]


def _seed(words: Words, places: np.ndarray, mask: tuple[int, ...]) -> np.ndarray:
    return gram_hash(words.hashes, places, mask, zlib.crc32(repr(mask).encode()))


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of rows told by keys, the last a place: (sorted order, first and last index of each run of places no more than
    NEAR apart while the other keys stay). A run names all diagonals between, so text that repeats itself, word by word
    or by a short period, gives few rows."""
    order = np.lexsort(keys[::-1])
    new = np.diff(keys[-1][order]) > NEAR
    for k in keys[:-1]:
        new |= np.diff(k[order]) != 0
    first = np.flatnonzero(np.r_[True, new][: len(order)])
    return order, first, np.append(first[1:], len(order)) - 1


def item_seeds(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, item, first place, last place) of the items' seeds; equal seeds at near places are one."""
    found = []
    for n in np.unique(words.counts[words.counts > 0]).tolist() if len(words.counts) else ():
        items = np.flatnonzero(words.counts == n)
        for mask, fixed in masks_of(n):
            at = np.array(fixed if fixed is not None else range(n - mask[-1]), np.int64)
            places = (words.at[items][:, None] + at).ravel()
            found.append((_seed(words, places, mask), np.repeat(items, len(at)), np.tile(at, len(items))))
    if not found:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    h, item, place = (np.concatenate(x) for x in zip(*found, strict=True))
    order, first, last = _runs(h, item, place)
    return h[order][first], item[order][first], place[order][first], place[order][last]


def most_matches(same: np.ndarray, similar: float) -> tuple[int, int]:
    """(begin, end) of a shortest span with the most matches among all that agree in `similar` of their places or more."""
    part = Fraction(str(similar))
    sums = np.concatenate([[0], np.cumsum(np.where(same, part.denominator, 0) - part.numerator)])
    matches = np.concatenate([[0], np.cumsum(same)])
    ends = np.arange(len(sums))
    # the first place whose sum is not above the end's: no later one has more matches
    begins = np.searchsorted(-np.minimum.accumulate(sums), -sums, "left")
    got = matches - matches[begins]
    best = np.flatnonzero(got == got.max())
    at = best[np.argmin((ends - begins)[best])]
    begin, end = int(begins[at]), int(ends[at])
    inside = np.flatnonzero(same[begin:end])  # substituted words at its ends only lengthen it
    return (begin + int(inside[0]), begin + int(inside[-1]) + 1) if len(inside) else (begin, begin)


def best_overlap(doc, item, diagonals, least: int, similar: float, cells: int = 1 << 21):
    """(n_match, n_words, doc_start, item_start) of the span with the most matches among all that qualify on the diagonals
    (document's place less item's), the shorter and then the earlier one of two; or None.

    Diagonals whose words agree at the same places are tested once, all that are left at a time, those of more agreeing
    words first: one with no more of them than the best span has matches can only tie with it."""
    m, part = len(item), Fraction(str(similar))
    need = min(least, -(-part.numerator * m // part.denominator))
    best = None
    for i in range(0, len(diagonals), max(1, cells // m)):
        some = diagonals[i : i + max(1, cells // m)]
        at = some[:, None] + np.arange(m)
        same = (at >= 0) & (at < len(doc))
        same &= doc[np.clip(at, 0, len(doc) - 1)] == item
        rows = np.flatnonzero(same.sum(axis=1) >= need)
        if not len(rows):
            continue
        bits = np.ascontiguousarray(np.packbits(same[rows], axis=1))
        rows = rows[np.unique(bits.view(np.dtype((np.void, bits.shape[1]))).ravel(), return_index=True)[1]]
        agree = same[rows].sum(axis=1)
        for r, most in sorted(zip(rows.tolist(), agree.tolist(), strict=True), key=lambda x: (-x[1], x[0])):
            if best and most < best[0]:
                break
            a, b = most_matches(same[r], similar)
            n = int(same[r, a:b].sum())
            if n >= need:
                found = n, a - b, -int(some[r]) - a, -a
                best = found if best is None else max(best, found)
    return best and (best[0], -best[1], -best[2], -best[3])


class Known:
    """The seeds of a small benchmark, as a filter that passes no others."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.unique(np.append(hashes, np.uint64(0)))

    def count(self, hashes: np.ndarray, _: int) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return (self.hashes[at] == hashes).astype(np.int64)


def bloom(hashes: DataFrame, most_bytes: int, group_seeds: int = 1 << 18, bits_each: int = 96) -> Filter:
    """A Bloom filter of the hashes (a column hash), built by groups; where bits_each do not fit in most_bytes, fewer."""
    distinct = hashes.select("hash").distinct()
    n = distinct.count()
    groups = max(1, -(-n // group_seeds))
    each = min(bits_each, 8 * most_bytes / max(1, n))

    def add(table: pa.Table) -> pa.Table:
        segment = build(table["hash"].to_numpy().view(np.uint64), np.ones(table.num_rows, np.int64), 2.0, each)
        return pa.table({"group": table["group"].slice(0, 1), "segment": pa.array([segment.tobytes()], pa.binary())})

    parts = distinct.withColumn("group", group_of("hash", groups)).groupBy("group")
    parts = written(parts.applyInArrow(add, "group int, segment binary"), "seed-filter")
    sizes = {r.group: r.n // 8 for r in parts.select("group", F.octet_length("segment").alias("n")).collect()}
    return Filter(((r.group, np.frombuffer(r.segment, np.uint64)) for r in parts.toLocalIterator()), sizes, groups)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    least: int = 10,
    similar: float = 0.8,
    block_words: int = 5_000_000,
    few_seeds: int = FEW_SEEDS,
) -> DataFrame:
    """A row for each row of docs and item that overlap: id_col, item_col, doc_start, item_start, n_words, n_match,
    item_words, similarity (matches by words of the span).

    An overlap is a span of one diagonal whose words agree in `similar` of their places or more, with `least` words
    that agree (fewer for items too short to have them: `similar` of all their words). All spans of all diagonals that can
    qualify are compared, and the best of each pair is given: the most matches, then the shortest. Items of every length
    are searched for, those of 1 to 4 words whole; without words they overlap nothing. Null texts count as empty; rows of
    docs that repeat give their overlaps each; items that repeat too. Other columns are not read. An empty benchmark or
    table gives no rows.

    Broadcast are the items' seeds where there are few_seeds at most, else a Bloom filter of them of at most 12 bytes for
    each of block_words: a larger benchmark makes it less selective, not the result smaller.
    """
    spark = docs.sparkSession
    small_batches(spark)

    def itemised(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for a, b, w in batches(batch.column(2)):
                keep = np.flatnonzero(w.counts)
                words = [w.hashes[w.at[i] : w.at[i + 1]].tobytes() for i in keep]
                own = [c.slice(a, b - a).take(pa.array(keep)) for c in batch.columns[:2]]
                yield pa.RecordBatch.from_arrays([*own, pa.array(words, pa.binary())], names=["item", item_col, "words"])

    def seeded(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            words = _Loose([np.frombuffer(x, np.uint64) for x in batch.column(1).to_pylist()])
            h, item, p1, p2 = item_seeds(words)
            columns = h.view(np.int64), np.asarray(batch.column(0))[item], p1.astype(np.int32), p2.astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["hash", "item", "p1", "p2"])

    lines = benchmark.select(F.monotonically_increasing_id().alias("item"), F.col(item_col), F.col(item_text).alias("__text"))
    as_items = lines.select("item", item_col, F.lit(None).cast("binary").alias("words")).schema
    items = written(lines.mapInArrow(itemised, as_items), "items")
    seeds = items.select("item", "words").mapInArrow(seeded, "hash long, item long, p1 int, p2 int")
    seeds = written(seeds, "item-seeds")
    lengths = [r.n for r in items.select(F.least(F.octet_length("words") / 8, F.lit(10)).cast("int").alias("n")).distinct().collect()]
    masks = sorted({mask for n in lengths for mask, _ in masks_of(n)})
    if len(few := seeds.select("hash").limit(few_seeds + 1).collect()) <= few_seeds:
        known = Known(np.array([r.hash for r in few], np.int64).view(np.uint64))
    else:
        known = bloom(seeds, 12 * block_words)
    sent = spark.sparkContext.broadcast(known)

    def scanned(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in found:
            for a, b, w in batches(batch.column(2)):
                hits = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
                for mask in masks:
                    places = w.whole(mask[-1] + 1)
                    h = _seed(w, places, mask)
                    some = known.count(h, 1) > 0
                    hits.append((h[some], places[some]))
                h, place = (np.concatenate(x) for x in zip(*hits, strict=True))
                if not len(h):
                    continue
                doc = np.searchsorted(w.at, place, "right") - 1
                order, first, last = _runs(doc, h, place - w.at[doc])
                doc, h, place = doc[order], h[order], (place - w.at[doc])[order]
                own, n = np.unique(doc[first], return_counts=True)
                ends = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                runs = pa.StructArray.from_arrays(
                    [pa.array(h[first].view(np.int64)), pa.array(place[first].astype(np.int32)), pa.array(place[last].astype(np.int32))],
                    names=["hash", "d1", "d2"],
                )
                words = pa.array([w.hashes[w.at[i] : w.at[i + 1]].tobytes() for i in own], pa.binary())
                kept = [c.slice(a, b - a).take(pa.array(own)) for c in batch.columns[:2]]
                yield pa.RecordBatch.from_arrays([*kept, words, pa.ListArray.from_arrays(ends, runs)], names=["uid", id_col, "words", "runs"])

    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col), F.col(text).alias("__text"))
    runs = F.lit(None).cast("array<struct<hash:long,d1:int,d2:int>>").alias("runs")
    as_rows = rows.select("uid", id_col, F.lit(None).cast("binary").alias("words"), runs).schema
    passed = written(rows.mapInArrow(scanned, as_rows), "seed-hits")
    sent.destroy()  # nothing after the written table needs it
    # a hit of two runs names all diagonals from d1 - p2 to d2 - p1
    hits = passed.select("uid", F.explode("runs").alias("r")).select("uid", "r.*").join(seeds, "hash")
    span = F.struct((F.col("d1") - F.col("p2")).alias("lo"), (F.col("d2") - F.col("p1")).alias("hi"))
    by_pair = hits.groupBy("uid", "item").agg(F.collect_set(span).alias("diagonals"))
    named = by_pair.join(items.withColumnRenamed("words", "item_hashes"), "item")
    one = F.struct(F.col(item_col).alias("id"), "item_hashes", "diagonals")
    candidates = written(named.groupBy("uid").agg(F.collect_list(one).alias("items")), "seed-candidates")
    joined = passed.select("uid", id_col, "words").join(candidates, "uid").select(id_col, "words", "items")

    def verified(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            out = []
            for i, (words, items) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                doc = np.frombuffer(words, np.uint64)
                for x in items:
                    item = np.frombuffer(x["item_hashes"], np.uint64)
                    every = [np.arange(max(s["lo"], 1 - len(item)), min(s["hi"], len(doc) - 1) + 1) for s in x["diagonals"]]
                    got = best_overlap(doc, item, np.unique(np.concatenate(every)), least, similar)
                    if got:
                        out.append((i, x["id"], got[2], got[3], got[1], got[0], len(item)))
            if out:
                row, ids, *numbers = zip(*out, strict=True)
                kind = batch.column(2).type.value_type.field("id").type
                columns = [batch.column(0).take(pa.array(row)), pa.array(ids, kind), *(pa.array(x, pa.int32()) for x in numbers)]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, item_col, *_FOUND])

    numbers = [F.lit(0).cast("int").alias(c) for c in _FOUND]
    schema = docs.select(F.col(id_col)).schema
    for field in [*items.select(item_col).schema, *spark.range(0).select(*numbers).schema]:
        schema = schema.add(field.name, field.dataType, True)
    return joined.mapInArrow(verified, schema).withColumn("similarity", F.col("n_match") / F.col("n_words"))


class _Loose:
    """Word hashes of some texts, as Words has them."""

    def __init__(self, texts: list[np.ndarray]) -> None:
        self.hashes = np.concatenate([np.zeros(0, np.uint64), *texts])
        self.counts = np.array([len(x) for x in texts], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.counts)])
