"""Similarity join on word n-gram sets: Jaccard index at or above a threshold, with Bayesian candidate pruning.

1. Texts of the same words become one class member with a count, so copies are never paired.
2. Each distinct text gets MinHash bands. Texts that meet in a bucket compare their MinHash values some at a time, and a
   pair is dropped once the posterior probability (uniform prior) of reaching the threshold is below `tolerance`; of the
   pairs that are left a spanning forest leaves the task. A bucket of more than a block is chained to its least text
   instead. Connected components of these edges are the candidate groups: no pair that is left lies in two of them.
3. A group is cut into blocks; each pair of blocks is one task, which gets the texts' shingle hashes and MinHash values.
   There, pairs are pruned in the same way, and those that are left are verified exactly on their whole n-gram sets.
   Only counts and a spanning forest leave a task.

Recall: a pair at the threshold of 0.8 shares no band of 28 x 5 values with probability (1 - 0.8^5)^28 < 2e-5, and one
at 0.9 with 1e-11; pairs are verified against all texts of their group, not only against those that share a band.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from .storage import discard, small_batches, written
from .textbatch import Words, batches, gram_hash, mix, seeds


def set_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """n-gram hashes of all texts, in order of the texts, and where each text's begin. A text of 1 to n - 1 words has
    one, of all its words; a text without words has none."""
    places, hashes = words.grams(n)
    doc = np.searchsorted(words.at, places, "right") - 1
    for k in range(1, n):
        short = np.flatnonzero(words.counts == k)
        if len(short):
            hashes = np.concatenate([hashes, gram_hash(np.append(words.hashes, np.zeros(n, np.uint64)), np.arange(len(words.hashes) + n - k + 1), range(k), k)[words.at[short]]])
            doc = np.concatenate([doc, short])
    order = np.argsort(doc, kind="stable")
    return hashes[order], np.searchsorted(doc[order], np.arange(len(words.counts) + 1))


def signatures(hashes: np.ndarray, at: np.ndarray, n_values: int, piece: int = 1 << 14) -> np.ndarray:
    """n_values MinHash values (32 bits) of each text; a text without n-grams gets zeros."""
    full = np.flatnonzero(at[:-1] < at[1:])
    out = np.zeros((len(at) - 1, n_values), np.uint32)
    flip, factor = mix(seeds(n_values, 11)), seeds(n_values, 5)
    a = 0
    while a < len(full):  # pieces that fit in a processor's cache
        b = max(a + 1, int(np.searchsorted(at[full], at[full[a]] + piece, "right")))
        part, starts = hashes[at[full[a]] : at[full[b - 1] + 1]], at[full[a:b]] - at[full[a]]
        for i in range(n_values):
            out[full[a:b], i] = np.minimum.reduceat((part ^ flip[i]) * factor[i], starts) >> np.uint64(32)
        a = b
    return out


def least_matches(n: int, threshold: float, tolerance: float) -> int:
    """Fewest matches among n MinHash values for which P(similarity >= threshold | matches) >= tolerance.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), whose upper tail is a binomial sum."""
    total = 0.0
    for m in range(n + 1):
        total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= tolerance:
            return m
    return n


class Sets:
    """Distinct n-gram hashes of some texts, sorted, with their MinHash values."""

    def __init__(self, items: list[np.ndarray], values: np.ndarray) -> None:
        self.items, self.values = items, values
        self.sizes = np.array([len(x) for x in items], np.int64)


def surviving(a: np.ndarray, b: np.ndarray, pairs: np.ndarray, needs: list[tuple[int, int]]) -> np.ndarray:
    """The pairs (bool matrix) of rows of a and b that no comparison drops."""
    alive, done, count = pairs.copy(), 0, np.zeros(pairs.shape, np.uint16)
    for n, least in needs:
        if alive.mean() > 0.2:
            for i in range(done, n):
                count += a[:, i, None] == b[None, :, i]
            alive &= count >= least
        else:
            x, y = np.nonzero(alive)
            for s in range(0, len(x), 1 << 16):
                u, v = x[s : s + (1 << 16)], y[s : s + (1 << 16)]
                count[u, v] += (a[u, done:n] == b[v, done:n]).sum(axis=1, dtype=np.uint16)
            alive[x, y] = count[x, y] >= least
        done = n
        if not alive.any():
            break
    return alive


def overlaps(items: list[np.ndarray], left: np.ndarray, right: np.ndarray, width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of every left with every right set, from products of 0/1 matrices by column ranges."""
    out = np.zeros((len(left), len(right)), np.float64)
    every = np.concatenate([items[i] for i in np.union1d(left, right)])
    values, counts = np.unique(every, return_counts=True)
    shared = values[counts > 1]
    found = {}
    for i in np.union1d(left, right) if len(shared) else ():
        p = np.searchsorted(shared, items[i])
        found[int(i)] = p[(p < len(shared)) & (shared[np.minimum(p, len(shared) - 1)] == items[i])]
    for s in range(0, len(shared), width):
        def dense(side: np.ndarray) -> np.ndarray:
            m = np.zeros((len(side), min(width, len(shared) - s)), np.float32)
            for r, i in enumerate(side):
                p = found[int(i)]
                lo, hi = np.searchsorted(p, [s, s + width])
                m[r, p[lo:hi] - s] = 1
            return m

        x = dense(left)
        out += x @ (x if left is right else dense(right)).T
    return out


def linked(sets: Sets, left: np.ndarray, right: np.ndarray, threshold: float, needs: list[tuple[int, int]]) -> np.ndarray:
    """Bool matrix: which left and right texts reach the threshold exactly. With left is right, the upper triangle."""
    pairs = np.ones((len(left), len(right)), bool)
    if left is right:
        pairs = np.triu(pairs, 1)
    pairs &= (sets.sizes[left] > 0)[:, None] & (sets.sizes[right] > 0)[None, :]
    alive = surviving(sets.values[left], sets.values[right], pairs, needs)
    rows, cols = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
    if not len(rows):
        return alive
    t = Fraction(str(threshold))
    if left is right:
        rows = cols = np.union1d(rows, cols)
        inter = overlaps(sets.items, side := left[rows], side)
    else:
        inter = overlaps(sets.items, left[rows], right[cols])
    union = sets.sizes[left[rows]][:, None] + sets.sizes[right[cols]][None, :] - inter
    good = inter * t.denominator >= union * t.numerator
    alive[np.ix_(rows, cols)] &= good
    return alive


def _roots(n: int, edges: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least member of each one's component, for members 0 .. n - 1."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, edges[0], root[edges[1]])
        np.minimum.at(low, edges[1], root[edges[0]])
        low = np.minimum(low, low[low])
        if np.array_equal(low, root):
            return root
        root = low


def text_key(text: str):
    """128 bits that stand for a whole text (null: empty)."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))


def word_keys(words: Words) -> np.ndarray:
    """Two 64-bit sums for each text (texts x 2) that stand for its sequence of words."""
    place = (np.arange(len(words.hashes)) - np.repeat(words.at[:-1], words.counts)).astype(np.uint64)
    out = np.zeros((len(words.counts), 2), np.uint64)
    full = np.flatnonzero(words.counts)
    for i, (factor, step) in enumerate(zip(seeds(2, 31), seeds(2, 37), strict=True)):
        if len(full):
            out[full, i] = mix(np.add.reduceat(mix(words.hashes * factor + place * step), words.at[:-1][full]))
    return out


def _keys(texts: pa.Array, first: int, words: Words) -> list[bytes]:
    """16 bytes for each text: equal for texts of the same words, and for texts without words where they are equal."""
    sums = word_keys(words)
    whole = lambda i: hashlib.md5((texts[i].as_py() or "").encode()).digest()
    return [sums[i].tobytes() if n else whole(first + i) for i, n in enumerate(words.counts.tolist())]


def bucket_chains(bands: np.ndarray, keys: list[bytes], values: np.ndarray, needs: list[tuple[int, int]]) -> list[tuple]:
    """(key, key) edges of spanning forests: texts that share a bucket are joined where their MinHash values let them
    reach the threshold."""
    order = np.argsort(bands, kind="stable")
    edge = np.flatnonzero(np.r_[True, np.diff(bands[order]) != 0, True])
    size = np.diff(edge)
    out = []
    two = edge[:-1][size == 2]
    x, y = order[two], order[two + 1]  # buckets of two at once
    done, count = 0, np.zeros(len(x), np.int64)
    for n, least in needs:
        count += (values[x, done:n] == values[y, done:n]).sum(axis=1)
        live = count >= least
        x, y, count, done = x[live], y[live], count[live], n
    out += [(keys[i], keys[j]) for i, j in zip(x.tolist(), y.tolist(), strict=True)]
    for a, n in zip(edge[:-1][size > 2], size[size > 2], strict=True):
        some = order[a : a + n]
        alive = surviving(values[some], values[some], np.triu(np.ones((n, n), bool), 1), needs)
        roots = _roots(n, np.nonzero(alive))
        out += [(keys[some[i]], keys[some[r]]) for i, r in enumerate(roots.tolist()) if i != r]
    return out


def candidate_groups(texts: DataFrame, needs: list[tuple[int, int]], block: int) -> DataFrame:
    """(node, group): texts (key, values, bands) that may reach the threshold with another, by candidate group."""
    met = texts.select("key", F.explode("bands").alias("band"))
    # aggregates are written before they are joined back: then adaptive execution can split a hot bucket's rows
    counts = met.groupBy("band").agg(F.min("key").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    hubs = written(counts, "hubs")
    inside = written(met.join(hubs, "band"), "bucket-members")
    large = inside.filter((F.col("n") > block) & (F.col("key") != F.col("hub"))).selectExpr("key as a", "hub as b")
    small = inside.filter(F.col("n") <= block).select("key", "band").join(texts.select("key", "values"), "key")
    tasks = max(1, -(-inside.count() // (16 * block)))

    def pruned(table: pa.Table) -> pa.Table:
        keys = table["key"].to_pylist()
        values = np.frombuffer(b"".join(table["values"].to_pylist()), np.uint16).reshape(len(keys), -1)
        found = set(bucket_chains(table["band"].to_numpy(), keys, values, needs))
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    by_task = small.groupBy(F.pmod(F.xxhash64("band"), F.lit(tasks)).alias("task"))
    chains = by_task.applyInArrow(pruned, "a binary, b binary").unionByName(large)
    groups = written(components(chains, "candidates").withColumnRenamed("root", "group"), "groups")
    discard(hubs, inside)
    return groups


def similar_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    n: int = 5,
    threshold: float = 0.8,
    bands: int = 28,
    rows: int = 5,
    tolerance: float = 1e-6,
    step: int = 14,
    block: int = 1024,
    block_bytes: int = 8 << 20,
) -> DataFrame:
    """One row for each row of docs: id_col, class_id, n_links.

    Two rows are linked when their texts are equal or the Jaccard index of their sets of n-word shingles is at or above
    threshold; class_id is the smallest id in the connected component of the links (null ids count as largest), n_links
    the number of other rows linked directly. Texts of 1 to n - 1 words have one shingle, of all their words; texts
    without words are linked to equal texts only; null counts as empty. Rows that repeat are copies of each other.
    Other columns of docs are not read.

    Candidate groups are verified in blocks of about `block` texts or block_bytes of shingle hashes (a longer text is one
    block); results do not depend on them.
    """
    spark = docs.sparkSession
    small_batches(spark)
    n_values = bands * rows
    needs = [(m, least_matches(m, threshold, tolerance)) for m in range(step, n_values + 1, step)]
    salts = seeds(bands * rows, 17).reshape(bands, rows)
    of_row = F.xxhash64(F.col(id_col), F.col(text))
    source = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), of_row.alias("row"))

    def banded(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            keys, values, tables, size = [], [], [np.zeros((0, bands), np.int64)], []
            for a, _, w in batches(batch.column(1)):
                hashes, at = set_hashes(w, n)
                each = signatures(hashes, at, n_values)
                mixed = (each.astype(np.uint64).reshape(-1, bands, rows) * salts).sum(axis=2, dtype=np.uint64)
                band = mix(mixed + np.arange(bands, dtype=np.uint64)).view(np.int64)
                band[at[:-1] == at[1:]] = 0
                tables.append(band)
                keys += _keys(batch.column(1), a, w)
                values += [x.tobytes() for x in (each >> np.uint32(16)).astype(np.uint16)]
                size += np.diff(at).tolist()
            table = np.concatenate(tables)
            full = table.any(axis=1)
            ends = np.concatenate([[0], np.cumsum(full * bands)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(table[full].ravel()))
            columns = pa.array(keys, pa.binary()), pa.array(values, pa.binary()), lists, pa.array(size, pa.int64())
            names = ["id", "row", "key", "values", "bands", "grams"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], names=names)

    nothing = "cast(null as binary) as key", "cast(null as binary) as values", "cast(null as array<bigint>) as bands"
    members = written(source.mapInArrow(banded, source.selectExpr("id", "row", *nothing, "0L as grams").schema), "members")
    # a distinct sequence of words: how many rows hold it, the row that stands for it, its MinHash values and buckets
    found = members.groupBy("key").agg(
        F.count("*").alias("copies"),
        F.min("id").alias("least_id"),
        F.min("row").alias("row"),
        F.first("values").alias("values"),
        F.first("bands").alias("bands"),
        F.first("grams").alias("grams"),
    )
    texts = written(found, "texts")
    groups = candidate_groups(texts, needs, block)
    chosen = groups.withColumnRenamed("node", "key").join(texts.select("key", "row", "copies", "grams"), "key")

    def packed(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The texts' shingle hashes and MinHash values instead of the texts."""
        for batch in found:
            for a, b, w in batches(batch.column(0)):
                hashes, at = set_hashes(w, n)
                values = (signatures(hashes, at, n_values) >> np.uint32(16)).astype(np.uint16)
                own = pa.array(_keys(batch.column(0), a, w), pa.binary())
                items = pa.array([np.unique(hashes[x:y]).tobytes() for x, y in zip(at[:-1], at[1:], strict=True)], pa.binary())
                same = pa.compute.equal(own, batch.column(1).slice(a, b - a))  # else two rows share 64 bits by chance
                columns = [*(c.slice(a, b - a) for c in batch.columns[1:]), items, pa.array([x.tobytes() for x in values], pa.binary())]
                out = pa.RecordBatch.from_arrays(columns, names=["key", "group", "copies", "items", "values"])
                yield out.filter(same)

    joined = source.select("row", "text").join(chosen.select("row", "key", "group", "copies"), "row")
    schema = "key binary, group binary, copies long, items binary, values binary"
    sets = joined.select("text", "key", "group", "copies").mapInArrow(packed, schema).dropDuplicates(["key"])
    sets = written(sets, "shingle-sets")
    size = F.greatest(F.count("*") / F.lit(block), F.sum(F.octet_length("items")) / F.lit(block_bytes))
    sizes = written(sets.groupBy("group").agg(F.ceil(size).cast("int").alias("blocks"), size.alias("size")), "group-sizes")
    # small groups share tasks; the blocks of a large group meet pairwise
    packs = max(1, math.ceil(sizes.agg(F.sum("size")).first()[0] or 0))
    own = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    dealt = sets.join(sizes.select("group", "blocks"), "group").withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    task = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("group"), F.lit(packs))).otherwise(F.xxhash64("group"))
    pair = F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q")
    dealt = dealt.select(task.alias("task"), *pair, (F.col("blocks") > 1).alias("big"), "group", "own", "key", "copies", "items", "values")

    def verify(table: pa.Table) -> pa.Table:
        group, own_block = np.array(table["group"].to_pylist(), object), table["own"].to_numpy()
        keys, copies = table["key"].to_pylist(), table["copies"].to_numpy()
        p, q = table["p"][0].as_py(), table["q"][0].as_py()
        order = sorted(range(len(keys)), key=lambda i: (group[i], keys[i]))
        values = np.frombuffer(b"".join(table["values"].to_pylist()), np.uint16).reshape(len(keys), -1)
        sets = Sets([np.frombuffer(x, np.uint64) for x in table["items"].to_pylist()], values)
        links, roots = np.zeros(len(keys), np.int64), list(keys)
        a = 0
        while a < len(order):
            b = a
            while b < len(order) and group[order[b]] == group[order[a]]:
                b += 1
            some = np.array(order[a:b])
            left = some if p == q else some[own_block[some] == p]
            right = left if p == q else some[own_block[some] == q]
            x, y = np.nonzero(linked(sets, left, right, threshold, needs))
            np.add.at(links, left[x], copies[right[y]])
            np.add.at(links, right[y], copies[left[x]])
            place = np.zeros(len(keys), np.int64)
            place[some] = np.arange(len(some))
            for i, r in zip(some, _roots(len(some), (place[left[x]], place[right[y]])), strict=True):
                roots[i] = keys[some[r]]
            a = b
        columns = {"key": pa.array(keys, pa.binary()), "links": pa.array(links), "root": pa.array(roots, pa.binary())}
        return pa.table(columns | {"big": table["big"]})

    schema = "key binary, links long, root binary, big boolean"
    verified = written(dealt.groupBy("task", "big", "p", "q").applyInArrow(verify, schema), "verified")
    roots = verified.filter("not big").select("key", "root")
    large = verified.filter("big").select(F.col("key").alias("a"), F.col("root").alias("b"))
    if not large.isEmpty():
        roots = roots.unionByName(components(large, "classes").select(F.col("node").alias("key"), "root"))
    found = roots.join(verified.groupBy("key").agg(F.sum("links").alias("links")), "key", "left")
    n_links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    classed = texts.select("key", "copies", "least_id").join(found, "key", "left")
    classed = classed.select("key", "least_id", F.coalesce("root", "key").alias("root"), n_links.alias("n_links"))
    classed = written(classed, "classed")
    least = written(classed.groupBy("root").agg(F.min("least_id").alias("class_id")), "class-ids")
    discard(texts, groups, sets, sizes, verified)
    by_key = classed.join(least, "root").select("key", "class_id", "n_links")
    return members.select("id", "key").join(by_key, "key").select(F.col("id").alias(id_col), "class_id", "n_links")
