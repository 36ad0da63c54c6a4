"""Passages that repeat across documents, from a sparse suffix array.

Only suffixes at minimiser positions are kept: places whose k-word hash is the least of some window of w such hashes, so
two documents that share w + k - 1 words keep the same places in them. A suffix is known by its first `right` words and by
the `left` words before it.

1. Suffixes whose first words occur in one document only are dropped (aggregation and join by hash).
2. Equal suffixes, which have equal words on both sides, are one member of the array; two documents' stand for them.
3. The others are sorted by their words over the whole cluster. Neighbours are compared word by word: common prefixes to
   the right give the intervals of suffixes that share so many words, and the same array sorted by the words before
   gives those that share so many to the left. A match of two documents is extended to both sides as far as some
   interval of the one lies in one of the other.
4. A run of suffixes that agree on their first words stays in one task up to a length that follows from the number of
   suffixes and tasks; a longer one is cut, and its pieces' windows of `least` words then meet by aggregation of hashes.

Spans are the union of all windows of `least` words that another document holds too. None is lost: the kept suffix in such
a window's first w words is the same in both documents, at the same place of the window. Words are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .storage import parts, small_batches, written
from .textbatch import Words, batches, gram_hash, mix, seeds

K, WINDOW = 6, 32
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def sliding(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """out[i]: the least (or largest) of x[i : i + width], of what there is of it."""
    pick, out, have = (np.minimum if least else np.maximum), x.copy(), 1
    while have < width:
        step = min(have, width - have)
        if step < len(out):
            out[:-step] = pick(out[:-step], out[step:])
        have += step
    return out


def minimisers(words: Words, least: int) -> np.ndarray:
    """Places of the kept suffixes of texts of `least` words or more."""
    n = len(words.hashes)
    if n < K:
        return np.zeros(0, np.int64)
    grams = np.full(n, _TOP)
    grams[: n - K + 1] = gram_hash(words.hashes, np.arange(n - K + 1), range(K), 3)
    end = np.repeat(words.at[1:], words.counts)
    full = (np.arange(n) + WINDOW - 1 + K <= end) & np.repeat(words.counts >= least, words.counts)
    low = np.where(full, sliding(grams, WINDOW, True), np.uint64(0))
    # the largest of the windows' minima over the windows that hold a place
    best = sliding(low[::-1], WINDOW, False)[::-1]
    return np.flatnonzero((best == grams) & (best > 0))


def around(words: Words, places: np.ndarray, left: int, right: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words from each place on and, backward, of those before it (0: none), and how many."""
    short = np.concatenate([words.hashes | np.uint64(1), np.zeros(1, np.uint64)])
    doc = np.searchsorted(words.at, places, "right") - 1
    after, before = words.at[doc + 1] - places, places - words.at[doc]
    i, j = np.arange(right), np.arange(1, left + 1)
    r = short[np.where(i < after[:, None], places[:, None] + i, len(short) - 1)]
    l = short[np.where(j <= before[:, None], places[:, None] - j, len(short) - 1)]
    return r, l, np.minimum(after, right), np.minimum(before, left)


def _anchors(text: pa.Array, uid: np.ndarray, least: int, key: int, most: int = 1 << 13):
    for a, b, w in batches(text, most=1 << 19):
        places = minimisers(w, least)
        doc = np.searchsorted(w.at, places, "right") - 1
        keep = w.at[doc + 1] - places >= key
        places, doc = places[keep], doc[keep]
        for s in range(0, len(places), most):  # a long text has many
            some = slice(s, s + most)
            yield w, places[some], uid[a:b][doc[some]], (places - w.at[doc])[some].astype(np.int64)


def _mark(uid: np.ndarray, pos: np.ndarray) -> np.ndarray:
    return mix(mix(uid.view(np.uint64)) + pos.astype(np.uint64))


def _binary(x: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(x.astype(">u8"))
    fixed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * x.shape[1]), len(x), [None, pa.py_buffer(data.tobytes())])
    return fixed.cast(pa.binary())


def window_hashes(right: np.ndarray, left: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each suffix and each l: the hash of the window of `least` words that begins l words to the left, and whether
    the text has all of them (0 is no word)."""
    n, most = len(right), left.shape[1]
    factors = seeds(least + most, 29)
    to_right = np.cumsum(right[:, :least] * factors[:least], axis=1, dtype=np.uint64)
    to_left = np.hstack([np.zeros((n, 1), np.uint64), np.cumsum(left * factors[least:], axis=1, dtype=np.uint64)])
    l = np.arange(most + 1)
    have = (right[:, least - 1 - l] != 0) & np.hstack([np.ones((n, 1), bool), left != 0])
    return mix(mix(to_right[:, least - 1 - l] + to_left) + l.astype(np.uint64)), have


def common_prefix(x: np.ndarray) -> np.ndarray:
    """How many words each row shares with the row before it, from the first on (0 for the first row; 0 is no word)."""
    out = np.zeros(len(x), np.int64)
    if len(x) > 1:
        unlike = (x[1:] != x[:-1]) | (x[1:] == 0)
        out[1:] = np.where(unlike.any(axis=1), unlike.argmax(axis=1), x.shape[1])
    return out


def shared_windows(right: np.ndarray, left: np.ndarray, uid: np.ndarray, least: int, hashed: bool):
    """Of suffixes in sorted order: (least l, largest l) of each one's windows of `least` words, l of them to the left,
    that another document has here (largest -1: none); and, if hashed, (row, l, hash) of windows that stand for all others
    where more suffixes may follow elsewhere: every one that only one document has here, one of each of two documents
    for the rest."""
    n, most = len(uid), left.shape[1]
    low, high, found = np.full(n, least), np.full(n, -1), [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    to_right, n_right, n_left = common_prefix(right), (right != 0).sum(axis=1), (left != 0).sum(axis=1)
    # the same suffixes by the words before them: neighbours there share the most to the left
    rows = np.ascontiguousarray(left.astype(">u8")).view(f"S{8 * most}").ravel()
    by_left = np.argsort(rows, kind="stable")
    to_left = common_prefix(left[by_left])
    hashes = window_hashes(right, left, least)[0] if hashed else None
    for l in range(most + 1):
        interval = np.cumsum(to_right < least - l)
        context = np.empty(n, np.int64)
        context[by_left] = np.cumsum(to_left < l)
        own = np.flatnonzero((n_right >= least - l) & (n_left >= l))
        if not len(own):
            continue
        own = own[np.lexsort((uid[own], context[own], interval[own]))]
        u = uid[own]
        first = np.flatnonzero(np.r_[True, (np.diff(interval[own]) != 0) | (np.diff(context[own]) != 0)])
        last = np.r_[first[1:], len(own)] - 1
        several = u[first] != u[last]
        each = np.repeat(several, last - first + 1)
        low[own[each]] = np.minimum(low[own[each]], l)
        high[own[each]] = l
        if hashed:
            send = np.concatenate([own[~each], own[first[several]], own[last[several]]])
            found.append((send, np.full(len(send), l), hashes[send, l]))
    return low, high, tuple(np.concatenate(x) for x in zip(*found, strict=True))


def repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    least: int = 50,
    most_bits: int = 1 << 29,
    piece: int = 1 << 15,
) -> DataFrame:
    """(id_col, span_start, span_end, n_words): the maximal spans of words, end exclusive, that lie in matches of `least`
    or more words with another document. At most `piece` suffixes are compared at a time, and fewer where that is more
    than four tasks' shares; results do not depend on it.

    A document is a row's id with its text: rows that repeat both are one document and alone repeat nothing, rows of one
    id with unlike texts are two. Null texts count as empty; texts of fewer than `least` words have no spans; a null id
    stays null; other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    small_batches(spark)
    right, left, key = least, WINDOW - 1, least - WINDOW + 1
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("uid", F.xxhash64("id", "text"))
    factors = seeds(left + right, 23)

    def run_key(r: np.ndarray) -> np.ndarray:
        return mix((r[:, :key] * factors[:key]).sum(axis=1, dtype=np.uint64))

    def keys(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for w, places, uid, pos in _anchors(batch.column(0), np.asarray(batch.column(1)), least, key):
                r, l, n_r, n_l = around(w, places, left, right)
                first = run_key(r)
                both = mix((np.hstack([r, l]) * factors).sum(axis=1, dtype=np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(first.view(np.int64)), pa.array(both.view(np.int64)), pa.array(uid), pa.array(pos), pa.array(n_l.astype(np.int32)), pa.array(n_r.astype(np.int32))], names=["key", "both", "uid", "pos", "l", "r"])

    anchors = written(source.select("text", "uid").mapInArrow(keys, "key long, both long, uid long, pos long, l int, r int"), "suffixes")
    # written before it is joined back: then adaptive execution can split a hot key's rows
    shared = written(anchors.groupBy("key").agg(F.min("uid").alias("lo"), F.max("uid").alias("hi")).filter("lo <> hi").select("key"), "shared-keys")
    kept = written(anchors.join(shared, "key", "left_semi"), "shared-suffixes")
    at = F.struct("uid", "pos", "l", "r")
    classes = written(kept.groupBy("key", "both").agg(F.min(at).alias("first"), F.max(at).alias("last")).withColumn("several", F.col("first.uid") != F.col("last.uid")), "suffix-classes")
    whole = kept.join(classes.filter("several").select("key", "both"), ["key", "both"], "left_semi").filter(F.col("l") + F.col("r") >= least)
    spans = whole.select("uid", (F.col("pos") - F.col("l")).alias("a"), (F.col("pos") + F.col("r")).alias("b"))

    # suffixes that may match another class; a bitmap of their places, of a bounded size, lets the second scan ship few
    # others. Two documents stand for a class of several, whose members repeat on all their words anyway
    many = written(classes.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key"), "keys-to-sort")
    meeting = written(classes.join(many, "key", "left_semi"), "classes-to-sort")
    two = meeting.filter("several").select(F.explode(F.array("first", "last")).alias("p"), "key").select("p.uid", "p.pos", "key")
    lone = kept.join(meeting.filter("not several").select("key", "both"), ["key", "both"], "left_semi").select("uid", "pos", "key")
    needed = written(two.unionByName(lone), "suffixes-to-sort")
    n_needed = needed.count()
    # runs of more suffixes than a piece are dealt over several tasks, all others stay whole
    piece = min(piece, max(1 << 12, 4 * n_needed // parts(spark)))
    long_runs = written(needed.groupBy("key").count().filter(F.col("count") > piece).select("key", F.lit(True).alias("cut")), "long-runs")
    bits = 1 << min(int(most_bits).bit_length() - 1, max(20, (16 * n_needed).bit_length()))

    def hashed(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            h = _mark(np.asarray(batch.column(0)), np.asarray(batch.column(1))) % np.uint64(bits)
            yield pa.RecordBatch.from_arrays([pa.array((h // 32768).astype(np.int64)), pa.array((h % 32768).astype(np.int64))], names=["bucket", "bit"])

    marks = needed.select("uid", "pos").mapInArrow(hashed, "bucket long, bit long").groupBy("bucket").agg(F.expr("bitmap_construct_agg(bit)").alias("bits")).collect()
    bitmap = np.zeros(bits // 8, np.uint8)
    for m in marks:
        bitmap[m.bucket * 4096 : m.bucket * 4096 + 4096] = np.frombuffer(m.bits, np.uint8)
    sent = spark.sparkContext.broadcast(bitmap)

    def contexts(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in found:
            for w, places, uid, pos in _anchors(batch.column(0), np.asarray(batch.column(1)), least, key):
                h = _mark(uid, pos) % np.uint64(bits)
                some = np.flatnonzero(table[(h >> np.uint64(3)).astype(np.int64)] >> (h & np.uint64(7)).astype(np.uint8) & 1)
                if len(some):
                    r, l, _, _ = around(w, places[some], left, right)
                    yield pa.RecordBatch.from_arrays([_binary(r), _binary(l), pa.array(uid[some]), pa.array(pos[some]), pa.array(run_key(r).view(np.int64))], names=["right", "left", "uid", "pos", "key"])

    def read(batch) -> tuple[np.ndarray, ...]:
        take = lambda c, n: np.frombuffer(b"".join(batch.column(c).to_pylist()), ">u8").reshape(-1, n).astype(np.uint64)
        uid, pos, cut = (batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
        return take(0, right), take(1, left), uid, pos, cut

    def matches(r, l, uid, pos, cut, whole: bool) -> pa.RecordBatch:
        """Matches among some suffixes; where not whole, also the windows to be met with those of other pieces, by hash."""
        low, high, (row, at, h) = shared_windows(r, l, uid, least, not whole)
        own = np.flatnonzero(high >= 0)
        a = np.concatenate([pos[own] - high[own], pos[row] - at])
        b = np.concatenate([pos[own] - low[own] + least, pos[row] - at + least])
        hashes = pa.chunked_array([pa.nulls(len(own), pa.int64()), pa.array(h.view(np.int64))]).combine_chunks()
        return pa.RecordBatch.from_arrays([pa.array(uid[np.concatenate([own, row])]), pa.array(a), pa.array(b), hashes], names=["uid", "a", "b", "hash"])

    def neighbours(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Suffixes in sorted order, piece by piece. Runs, which agree on the first `key` words, stay whole in a piece,
        but for the long ones: these are cut wherever a piece or a partition ends."""
        held, n = [], 0
        for batch in chain(found, [None]):
            if batch is not None and batch.num_rows:
                held.append(read(batch))
                n += batch.num_rows
            if not n or (batch is not None and n < piece):
                continue
            rows = tuple(np.concatenate(x) for x in zip(*held, strict=True))
            run = np.flatnonzero(np.r_[True, (rows[0][1:, :key] != rows[0][:-1, :key]).any(axis=1)])
            # the last run may go on, unless it is a long one
            stop = n if batch is None or rows[4][-1] else int(run[-1])
            done = tuple(x[:stop] for x in rows)
            for whole in (True, False):
                some = done[4] != whole
                if some.any():
                    yield matches(*(x[some] for x in done), whole)
            held, n = [tuple(x[stop:] for x in rows)], n - stop

    texts = written(source.select("text", "uid").mapInArrow(contexts, "right binary, left binary, uid long, pos long, key long"), "contexts")
    sent.destroy()  # nothing after the written table needs it
    line = texts.join(long_runs, "key", "left").select("right", "left", "uid", "pos", F.coalesce("cut", F.lit(False)).alias("cut"))
    run = F.substring("right", 1, 8 * key)
    line = line.repartitionByRange(parts(spark), run, F.when(F.col("cut"), F.concat("right", "left"))).sortWithinPartitions("right", "left")
    compared = written(line.mapInArrow(neighbours, "uid long, a long, b long, hash long"), "matches")
    open_ = compared.filter("hash is not null")
    met = open_.groupBy("hash").agg(F.min("uid").alias("lo"), F.max("uid").alias("hi")).filter("lo <> hi").select("hash")
    for found in (compared.filter("hash is null"), open_.join(met, "hash", "left_semi")):
        spans = spans.unionByName(found.select("uid", "a", "b"))
    by = W.partitionBy("uid").orderBy("a", "b")
    before = F.max("b").over(by.rowsBetween(W.unboundedPreceding, -1))
    merged = (
        spans.distinct()
        .withColumn("opens", F.coalesce(F.col("a") > before, F.lit(True)).cast("int"))
        .withColumn("island", F.sum("opens").over(by.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy("uid", "island")
        .agg(F.min("a").alias("span_start"), F.max("b").alias("span_end"))
    )
    ids = source.select("uid", "id").distinct()
    return merged.join(ids, "uid").select(F.col("id").alias(id_col), "span_start", "span_end", (F.col("span_end") - F.col("span_start")).alias("n_words"))
