"""Importance resampling towards a target's distribution of hashed n-grams, with an exact distributed draw.

1. Every run of 1 to n words is a feature; its crc32 names one of `buckets` buckets. The documents' and the target's features
   are counted by bucket, which gives an array of gains: log ratios of how common a bucket is in the target.
2. A document's weight is the mean gain over its features, looked up in that array; Gumbel noise from a hash of its id makes
   the k highest scores a draw without replacement.
3. The k-th key is found by radix selection: score and doc_id are cut into digits, and one aggregation a digit, over the
   rows that still agree with the digits found, tells the next one. Only counts of one digit's values reach the driver.
4. Only the rows up to that key are range-sorted and ranked, by partition offsets.

Broadcast are the gains alone: `buckets` numbers, whatever the input.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .storage import parts, small_batches, written
from .textbatch import Words, batches

#: Bytes of a word that are hashed column by column; the rest of a longer one is hashed on its own.
_SHORT = 48
_SIGN = -(1 << 63)


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = (c >> np.uint32(1)) ^ np.where(c & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return c


_TABLE = _crc_table()


def crc_after(state: np.ndarray, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """crc32 registers (before the final inversion) after the bytes low[start:end], from those in state."""
    order = np.argsort(starts - ends, kind="stable")
    c, at, size = state[order], starts[order], (ends - starts)[order]
    falling = -size
    for j in range(min(_SHORT, int(size[0]) if len(size) else 0)):
        m = int(np.searchsorted(falling, -j, "left"))  # words of more than j bytes
        c[:m] = _TABLE[(c[:m] ^ low[at[:m] + j]) & np.uint32(255)] ^ (c[:m] >> np.uint32(8))
    for i in range(int(np.searchsorted(falling, -_SHORT, "left"))):
        rest = low[at[i] + _SHORT : at[i] + size[i]].tobytes()
        c[i] = zlib.crc32(rest, int(c[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    out = np.empty_like(c)
    out[order] = c
    return out


def feature_buckets(words: Words, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of every run of 1 to n words, and the text that it stands in. Words of a run are joined by one space."""
    doc, starts, ends = words.doc(), words.starts, words.ends
    place = np.arange(len(starts))
    state = crc_after(np.full(len(starts), 0xFFFFFFFF, np.uint32), words.low, starts, ends)
    found, owner = [state], [doc]
    for k in range(1, n):
        runs = np.flatnonzero(doc[k:] == doc[: max(0, len(doc) - k)])  # k + 1 words of one text begin here
        head = state[np.searchsorted(place, runs)]
        spaced = _TABLE[(head ^ np.uint32(32)) & np.uint32(255)] ^ (head >> np.uint32(8))
        state, place = crc_after(spaced, words.low, starts[runs + k], ends[runs + k]), runs
        found.append(state)
        owner.append(doc[runs])
    return (~np.concatenate(found)) % np.uint32(buckets), np.concatenate(owner)


def bucket_counts(docs: DataFrame, text: str, n: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket. A task sends one row for each bucket it has met."""

    def counted(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in found:
            for _, _, w in batches(batch.column(0)):
                total += np.bincount(feature_buckets(w, n, buckets)[0], minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["bucket", "rows"])

    parts_of = docs.select(F.col(text).cast("string")).mapInArrow(counted, "bucket long, rows long")
    out = np.zeros(buckets, np.int64)
    for row in parts_of.groupBy("bucket").agg(F.sum("rows").alias("rows")).collect():  # `buckets` rows at most
        out[row.bucket] = row.rows
    return out


def bucket_gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) for each bucket."""
    s_all, t_all, b = float(own.sum()), float(target.sum()), float(len(own))
    ratios = ((float(t) + 1) * (s_all + b) / ((float(s) + 1) * (t_all + b)) for s, t in zip(own.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def kth_key(rows: DataFrame, columns: list[Column], k: int, bits: int = 12) -> list[int]:
    """The k-th smallest (k >= 1) of the composite keys made of some long columns without nulls; exact.

    One aggregation for each digit of `bits` bits that is not the same in all rows."""
    named = rows.select(*(c.bitwiseXOR(F.lit(_SIGN)).alias(f"c{i}") for i, c in enumerate(columns)))
    ends = named.agg(*(f(F.col(f"c{i}").bitwiseXOR(F.lit(_SIGN))) for i in range(len(columns)) for f in (F.min, F.max))).first()
    out = []
    for i in range(len(columns)):
        least, most = ends[2 * i] - _SIGN, ends[2 * i + 1] - _SIGN  # unsigned, in the order of the longs
        top = (least ^ most).bit_length()
        known = least >> top << top
        while top > 0:
            width = min(bits, top)
            top -= width
            digit = F.shiftrightunsigned(f"c{i}", top).bitwiseAND(F.lit((1 << width) - 1))
            for value, n in sorted(map(tuple, named.groupBy(digit.alias("digit")).count().collect())):  # 2**bits rows at most
                if k <= n:
                    break
                k -= n
            known |= value << top
            named = named.filter(digit == value)
        out.append(known + _SIGN)
    return out


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    n: int = 2,
    buckets: int = 10_000,
    percent: int = 25,
    least_words: int = 20,
    seed: str = "7",
) -> DataFrame:
    """One row for each row of docs: id_col, n_features, weight, score, rank (all long; rank null where not drawn).

    Of the N rows with at least least_words words, floor(percent N / 100) are drawn: the highest scores, ties to the smaller
    id (null ids last), further ties to fewer features, then in the order in which the scored rows were written. Null and
    empty texts have no features and weight 0; a null id is hashed as an empty one. Rows that repeat are scored and drawn
    each; an empty target makes all gains follow the smoothing alone; an empty table gives no rows. Of docs, only id_col
    (a whole number) and text are read, of target only text."""
    spark = docs.sparkSession
    small_batches(spark)
    gains = bucket_gains(bucket_counts(docs, text, n, buckets), bucket_counts(target, text, n, buckets))

    def weighed(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            columns = []
            for _, _, w in batches(batch.column(1)):
                bucket, owner = feature_buckets(w, n, buckets)
                size = np.bincount(owner, minlength=len(w.counts))
                total = np.bincount(owner, gains[bucket], len(w.counts)).astype(np.int64)  # exact below 2**53
                columns.append((w.counts, size, total // np.maximum(size, 1)))
            each = [np.concatenate(c).astype(np.int64) for c in zip(*columns, strict=True)] or [np.zeros(0, np.int64)] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, each)], names=["id", "n_words", "n_features", "weight"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    scored = source.mapInArrow(weighed, "id long, n_words long, n_features long, weight long")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    scored = scored.withColumn("score", F.col("weight") + noise).withColumn("row", F.monotonically_increasing_id())
    scored = written(scored, "scored")

    enough = scored.filter(F.col("n_words") >= least_words)
    k = percent * enough.count() // 100
    columns = "id", "n_features", "weight", "score"
    undrawn = F.lit(None).cast("long").alias("rank")
    if not k:
        return scored.select(*columns, undrawn).withColumnRenamed("id", id_col)
    # ascending keys: high scores first, then small ids
    keys = [F.bitwise_not("score"), F.coalesce("id", F.lit((1 << 63) - 1))]
    high, last_id = kth_key(enough, keys, k)
    upto = (keys[0] < high) | ((keys[0] == high) & (keys[1] <= last_id))
    chosen = (F.col("n_words") >= least_words) & upto
    order = [keys[0], keys[1], F.col("id").isNull(), F.col("n_features"), F.col("row")]
    names = [f"k{i}" for i in range(len(order))]
    sorted_rows = scored.filter(chosen).select("*", *(c.alias(a) for c, a in zip(order, names, strict=True)))
    dealt = sorted_rows.repartitionByRange(parts(spark), *names).withColumn("part", F.spark_partition_id())
    dealt = written(dealt, "drawn")
    totals = dealt.groupBy("part").agg(F.count("*").alias("n"))  # a row for each partition
    before = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n")
    inside = F.row_number().over(W.partitionBy("part").orderBy(*names))
    ranked = dealt.withColumn("inside", inside).join(totals.select("part", before.alias("before")), "part")
    place = F.col("inside") + F.col("before")
    ranked = ranked.select(*columns, F.when(place <= k, place).alias("rank"))  # rows that tie with the last one have no rank
    rest = scored.filter(~chosen).select(*columns, undrawn)
    return ranked.unionByName(rest).withColumnRenamed("id", id_col)
