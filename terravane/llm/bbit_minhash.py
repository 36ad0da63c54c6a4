"""Near duplicates by b-bit MinHash: components of the links between documents of similar word-shingle sets.

1. Texts of the same words become one class member, so that copies are never paired. Each distinct text gets MinHash
   values: bands of whole values name buckets, and the low `bits` bits of each value are packed into a signature.
2. Texts that meet in a bucket compare signatures by bit counts. Of the b-bit values of two sets of similarity J about
   C + (1 - C) J agree, C = 2^-bits being chance; a pair is dropped where its corrected estimate is so low that a pair at
   the threshold falls there with probability `tolerance` at most. Pairs that are left form candidate groups, of which
   only a spanning forest leaves a task.
3. Every text is first checked, on the whole shingle sets, against the one earlier text that it resembles most. That joins
   nearly all of a group of near copies, with as many checks as texts.
4. Where a group still holds several classes, texts of different classes are compared, block by block: signatures first,
   then whole sets. Blocks hold one large class or several small ones, and two blocks of one class never meet.

A pair at the threshold of 0.85 shares none of 28 bands of 5 values with probability (1 - 0.85^5)^28 < 8e-8.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import ceil, comb

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import components
from .ngram_jaccard import _keys, _roots, overlaps, set_hashes, signatures
from .storage import discard, small_batches, written
from .textbatch import NOT_SPACE, batches, mix, seeds


def packed(values: np.ndarray, bits: int) -> np.ndarray:
    """The low `bits` bits (a power of two up to 32) of each value, packed into 64-bit numbers (texts x numbers)."""
    lanes = 64 // bits
    low = values.astype(np.uint64) & np.uint64((1 << bits) - 1)
    low = np.pad(low, ((0, 0), (0, -low.shape[1] % lanes))).reshape(len(low), -1, lanes)
    return (low << (np.arange(lanes, dtype=np.uint64) * np.uint64(bits))).sum(axis=2, dtype=np.uint64)


def agreeing(a: np.ndarray, b: np.ndarray, bits: int, n_values: int) -> np.ndarray:
    """How many of the n_values b-bit values agree, for every row of a with every row of b, by bit counts."""
    ones = np.uint64(sum(1 << i for i in range(0, 64, bits)))
    unlike = np.zeros((len(a), len(b)), np.int32)
    for i in range(a.shape[1]):
        x = a[:, i, None] ^ b[None, :, i]
        fold = bits // 2
        while fold:  # the lowest bit of a lane tells whether any of its bits differs
            x |= x >> np.uint64(fold)
            fold //= 2
        unlike += np.bitwise_count(x & ones)
    return n_values - unlike


def similarity(agree: np.ndarray | int, n_values: int, bits: int) -> np.ndarray | float:
    """The Jaccard index for which so many b-bit values agree, chance agreement taken out."""
    chance = 2.0**-bits
    return (agree / n_values - chance) / (1 - chance)


def least_similarity(n_values: int, bits: int, threshold: float, tolerance: float) -> float:
    """The lowest estimate that a pair at the threshold gets, but for `tolerance`."""
    p, below = 2.0**-bits + (1 - 2.0**-bits) * threshold, 0.0
    for m in range(n_values + 1):
        below += comb(n_values, m) * p**m * (1 - p) ** (n_values - m)
        if below > tolerance:
            return similarity(m, n_values, bits)
    return 1.0


def own_sets(hashes: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    return [np.unique(hashes[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]


def _binary(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, pa.binary())


def _numbers(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of equally many bytes as rows of 64-bit numbers."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint64).reshape(len(rows), -1)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    n: int = 3,
    threshold: str = "0.85",
    bands: int = 28,
    rows: int = 5,
    bits: int = 4,
    tolerance: float = 1e-7,
    block: int = 1024,
    block_bytes: int = 8 << 20,
) -> DataFrame:
    """One row for each row of docs: id_col, n_shingles, component_id, kept.

    Words are runs of characters other than white space, A-Z lower-cased. A row's set holds its distinct n-word shingles; of
    fewer words, all of them as one. Rows are linked when their sets' Jaccard index reaches the threshold (a decimal,
    compared exactly); component_id is the smallest id reachable. Rows without words, null texts included, have no
    shingles and are linked with nothing, not even each other. Null ids count as largest: a component of null ids alone
    has a null component_id, and kept is true where id and component_id agree or both are null, so that rows of one
    repeated id are kept or dropped together. An empty table gives no rows; other columns of docs are not read."""
    spark = docs.sparkSession
    small_batches(spark)
    n_values, limit = bands * rows, Fraction(threshold)
    lowest = least_similarity(n_values, bits, float(limit), tolerance)
    salts = seeds(n_values, 23).reshape(bands, rows)
    of_row = F.xxhash64(F.col(id_col), F.col(text))
    source = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), of_row.alias("row"))

    def signed(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            keys, marks, tables, size = [], [], [np.zeros((0, bands), np.int64)], []
            for a, _, w in batches(batch.column(1), NOT_SPACE):
                hashes, at = set_hashes(w, n)
                values = signatures(hashes, at, n_values)
                mixed = (values.astype(np.uint64).reshape(-1, bands, rows) * salts).sum(axis=2, dtype=np.uint64)
                tables.append(mix(mixed + np.arange(bands, dtype=np.uint64)).view(np.int64))
                keys += [k if c else None for k, c in zip(_keys(batch.column(1), a, w), w.counts.tolist(), strict=True)]
                marks += [x.tobytes() for x in packed(values, bits)]
                size += [len(x) for x in own_sets(hashes, at)]
            table = np.concatenate(tables)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(table) + 1, dtype=np.int32) * bands), pa.array(table.ravel()))
            columns = [batch.column(0), batch.column(2), _binary(keys), _binary(marks), lists, pa.array(size, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "row", "key", "mark", "bands", "shingles"])

    nothing = "cast(null as binary) as key", "cast(null as binary) as mark", "cast(null as array<bigint>) as bands"
    members = written(source.mapInArrow(signed, source.selectExpr("id", "row", *nothing, "0L as shingles").schema), "members")
    # of a sequence of words: the least id, the row that stands for it, its signature and buckets
    each = [F.min("id").alias("least_id"), F.min("row").alias("row"), F.first("mark").alias("mark"), F.first("bands").alias("bands")]
    texts = written(members.filter("key is not null").groupBy("key").agg(*each), "texts")

    def resembling(table: pa.Table) -> pa.Table:
        """For each text of a bucket's block the earlier one it resembles most, and a spanning forest of all pairs left."""
        keys, marks = np.array(table["key"].to_pylist(), object), _numbers(table["mark"])
        place = np.lexsort((np.array([k.hex() for k in keys]), table["sub"].to_numpy(), table["band"].to_numpy()))
        bucket = np.stack([table["band"].to_numpy()[place], table["sub"].to_numpy()[place]])
        edge = np.flatnonzero(np.r_[True, (bucket[:, 1:] != bucket[:, :-1]).any(axis=0), True])
        out = []
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            some = place[a:b]
            agree = agreeing(marks[some], marks[some], bits, n_values)
            left = np.triu(similarity(agree, n_values, bits) >= lowest, 1)
            best = np.where(left, agree, -1).argmax(axis=0)  # the first of the best
            roots = _roots(len(some), np.nonzero(left))
            for j in np.flatnonzero(left.any(axis=0)).tolist():
                out.append((keys[some[j]], keys[some[best[j]]], keys[some[roots[j]]], int(agree[best[j], j])))
        a, b, root, agree = zip(*set(out), strict=True) if out else ((), (), (), ())
        return pa.table({"key": _binary(a), "like": _binary(b), "root": _binary(root), "agree": pa.array(agree, pa.int32())})

    # aggregates are written before they are joined back: then adaptive execution can split a hot bucket's rows
    met = texts.select("key", F.explode("bands").alias("band"))
    hubs = written(met.groupBy("band").agg(F.min("key").alias("hub"), F.count("*").alias("n")).filter("n > 1"), "hubs")
    inside = written(met.join(hubs, "band"), "bucket-members")
    tasks = max(1, -(-inside.count() // (16 * block)))
    # a bucket of more texts than a block is compared in parts, and chained to its hub, so that its group stays whole
    sub = F.pmod(F.xxhash64("key"), F.ceil(F.col("n") / block)).cast("int").alias("sub")
    dealt = inside.select("key", "band", sub).join(texts.select("key", "mark"), "key")
    task = F.pmod(F.xxhash64("band", "sub"), F.lit(tasks)).alias("task")
    near = written(dealt.groupBy(task).applyInArrow(resembling, "key binary, like binary, root binary, agree int"), "resembling")
    chains = inside.filter((F.col("n") > block) & (F.col("key") != F.col("hub"))).selectExpr("key as a", "hub as b")
    edges = near.selectExpr("key as a", "like as b").unionByName(near.selectExpr("key as a", "root as b")).unionByName(chains)
    groups = written(components(edges, "candidates").withColumnRenamed("root", "group"), "groups")

    def sets_of(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for a, b, w in batches(batch.column(0), NOT_SPACE):
                own = pa.compute.equal(_binary(_keys(batch.column(0), a, w)), batch.column(1).slice(a, b - a))
                items = _binary([x.tobytes() for x in own_sets(*set_hashes(w, n))])
                columns = [*(c.slice(a, b - a) for c in batch.columns[1:]), items]
                out = pa.RecordBatch.from_arrays(columns, names=["key", "mark", "group", "items"])
                yield out.filter(own)  # else two rows share 64 bits by chance

    chosen = groups.withColumnRenamed("node", "key").join(texts.select("key", "row", "mark"), "key")
    with_text = source.select("row", "text").join(chosen, "row").select("text", "key", "mark", "group")
    sets = with_text.mapInArrow(sets_of, "key binary, mark binary, group binary, items binary").dropDuplicates(["key"])
    sets = written(sets, "shingle-sets")

    def linked(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
        inter = np.array([len(np.intersect1d(x, y, True)) for x, y in zip(left, right, strict=True)], np.int64)
        union = np.array([len(x) + len(y) for x, y in zip(left, right, strict=True)], np.int64) - inter
        return inter * limit.denominator >= union * limit.numerator

    def checked(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            sides = ([np.frombuffer(x, np.uint64) for x in batch.column(i).to_pylist()] for i in (2, 3))
            yield batch.select([0, 1]).filter(pa.array(linked(*sides)))

    # one check a text: against the one it resembles most
    best = near.groupBy("key").agg(F.min(F.struct((-F.col("agree")).alias("unlike"), "like")).alias("best"))
    probes = written(best.select(F.col("key").alias("a"), F.col("best.like").alias("b")), "probes")
    side = lambda s: sets.select(F.col("key").alias(s), F.col("items").alias(f"items_{s}"))
    pairs = probes.join(side("a"), "a").join(side("b"), "b").select("a", "b", "items_a", "items_b")
    sure = written(pairs.mapInArrow(checked, "a binary, b binary"), "linked")
    classes = written(components(sure, "classes").selectExpr("node as key", "root as class"), "class-members")

    # groups of several classes: all pairs of texts of different classes, block by block
    placed = written(sets.select("key", "group", F.octet_length("items").alias("size")).join(classes, "key", "left"), "placed")
    placed = placed.withColumn("class", F.coalesce("class", "key"))
    weight = F.greatest(F.count("*") / F.lit(block), F.sum("size") / F.lit(block_bytes))
    of_class = placed.groupBy("group", "class").agg(weight.alias("w"))
    of_group = of_class.groupBy("group").agg(F.count("*").alias("m"), F.sum("w").alias("total"), F.sum(F.when(F.col("w") < 1, F.col("w"))).alias("small"))
    of_class = written(of_class.join(of_group.filter("m > 1"), "group"), "open-classes")
    packs = max(1, ceil(of_class.filter("total <= 1").agg(F.sum("w")).first()[0] or 0))
    # groups of less than a block share blocks; else a class of a block or more has its own, and smaller ones share some
    single, alone = F.col("total") <= 1, F.col("w") >= 1
    pool = F.when(single, F.pmod(F.xxhash64("group"), F.lit(packs))).when(alone, F.xxhash64("class")).otherwise(F.pmod(F.xxhash64("class"), F.ceil("small")))
    several = F.when(alone, F.ceil("w")).otherwise(1).cast("int")
    cut = of_class.select("group", "class", several.alias("several"), pool.alias("pool"), alone.alias("alone"), single.alias("single"))
    nth = F.pmod(F.xxhash64("key"), F.col("several")).alias("nth")
    name = F.when(F.col("single"), F.xxhash64("single", "pool")).otherwise(F.xxhash64("group", "alone", "pool", nth)).alias("block")
    open_rows = placed.select("key", "group", "class").join(cut, ["group", "class"])
    open_rows = written(open_rows.select("key", "group", "class", "alone", "pool", "single", name), "open-texts")
    large = open_rows.filter("not single").select("group", "alone", "pool", "block").distinct()
    other = large.toDF("group", "alone_q", "pool_q", "q")
    meets = (F.col("block") <= F.col("q")) & ~(F.col("alone") & F.col("alone_q") & (F.col("pool") == F.col("pool_q")))
    meetings = large.join(other, "group").filter(meets).select(F.col("block").alias("p"), "q")
    meetings = meetings.unionByName(open_rows.filter("single").select(F.col("block").alias("p"), F.col("block").alias("q")).distinct())
    seats = meetings.select("p", "q", F.explode(F.array_distinct(F.array("p", "q"))).alias("block"))
    seated = open_rows.select("key", "group", "class", "block").join(sets.select("key", "mark", "items"), "key").join(seats, "block")

    def crossed(table: pa.Table) -> pa.Table:
        """A spanning forest of the links between texts of different classes in two blocks."""
        keys, marks = table["key"].to_pylist(), _numbers(table["mark"])
        items = [np.frombuffer(x, np.uint64) for x in table["items"].to_pylist()]
        own, kind, group = table["block"].to_numpy(), _numbers(table["class"])[:, 0], _numbers(table["group"])[:, 0]
        p, q = table["p"][0].as_py(), table["q"][0].as_py()
        left, right = np.flatnonzero(own == p), np.flatnonzero(own == q)
        alive = (kind[left][:, None] != kind[right][None, :]) & (group[left][:, None] == group[right][None, :])
        if p == q:
            alive = np.triu(alive)
        alive &= similarity(agreeing(marks[left], marks[right], bits, n_values), n_values, bits) >= lowest
        x, y = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        roots = np.arange(len(keys))
        if len(x):
            size = np.array([len(i) for i in items], np.int64)
            inter = overlaps(items, left[x], right[y])
            union = size[left[x]][:, None] + size[right[y]][None, :] - inter
            u, v = np.nonzero(alive[np.ix_(x, y)] & (inter * limit.denominator >= union * limit.numerator))
            roots = _roots(len(keys), (left[x[u]], right[y[v]]))
        moved = np.flatnonzero(roots != np.arange(len(keys))).tolist()
        return pa.table({"a": _binary([keys[i] for i in moved]), "b": _binary([keys[roots[i]] for i in moved])})

    more = written(seated.groupBy("p", "q").applyInArrow(crossed, "a binary, b binary"), "crossed")
    links = sure if more.isEmpty() else sure.unionByName(more)
    found = classes if more.isEmpty() else written(components(links, "linked-classes").selectExpr("node as key", "root as class"), "found")
    named = texts.select("key", "least_id").join(found, "key", "left").withColumn("class", F.coalesce("class", "key"))
    named = written(named, "classed")
    least = written(named.groupBy("class").agg(F.min("least_id").alias("component_id")), "component-ids")
    by_key = named.join(least, "class").select("key", "component_id")
    discard(texts, hubs, inside, near, groups, sets, probes, of_class, open_rows)
    labelled = members.select("id", "key", "shingles").join(by_key, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    labelled = labelled.select(F.col("id").alias(id_col), F.col("shingles").alias("n_shingles"), component.alias("component_id"))
    return labelled.withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
