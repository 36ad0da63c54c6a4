"""Exact top-k inner products over a bit-sliced index.

Components become integers floor(scale * x). A block of candidates keeps, for each dimension, one bitmap for each of the
upper bits of its (shifted) integers. For a query the slices are added with bitmap arithmetic, weighted by the bits of
the query's components, in a tree of carry-save adders; the sum's slices are then walked from the most significant one
downward to find the k largest sums. The lower bits that the slices leave out bound each sum's error; the rows that the
bound cannot decide are resolved by their exact integer products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


class Block:
    """A bit-sliced index of some vectors of integers (rows x dimensions), without the lowest `drop` bits."""

    def __init__(self, x: np.ndarray, drop: int) -> None:
        self.x, self.drop = x, drop
        self.low = x.min(axis=0) if len(x) else np.zeros(x.shape[1], np.int64)
        y = (x - self.low) >> drop
        self.bits = max(1, int(y.max(initial=0)).bit_length())
        pad = -len(x) % 64
        self.n, self.words = len(x), (len(x) + pad) // 64
        self.all = self._bitmap(np.ones(len(x), bool), pad)
        # slices[d, b]: bitmap of the rows whose component d has bit b
        self.slices = np.stack([np.stack([self._bitmap((y[:, d] >> b & 1).astype(bool), pad) for b in range(self.bits)]) for d in range(x.shape[1])])
        self.whole = self.slices ^ self.all

    @staticmethod
    def _bitmap(rows: np.ndarray, pad: int) -> np.ndarray:
        return np.packbits(np.pad(rows, (0, pad)), bitorder="little").view(np.uint64)

    def sum_slices(self, q: np.ndarray) -> list[np.ndarray]:
        """Slices of the sums of |q_d| * v_d, v_d being the sliced component or, where q_d < 0, its complement."""
        columns: dict[int, list[np.ndarray]] = {}
        for d, value in enumerate(q.tolist()):
            source = self.slices[d] if value >= 0 else self.whole[d]
            for i in range(abs(value).bit_length()):
                if abs(value) >> i & 1:
                    for b in range(self.bits):
                        columns.setdefault(i + b, []).append(source[b])
        out, w = [], 0
        while any(k >= w for k in columns):
            stack = columns.pop(w, [])
            while len(stack) >= 3:  # whole triples at once: a full adder keeps the sum here and carries to the next weight
                t = len(stack) // 3
                a, b, c = (np.stack(stack[i * t : (i + 1) * t]) for i in range(3))
                ab = a ^ b
                carry = (a & b) | (ab & c)
                stack = [*(ab ^ c), *stack[3 * t :]]
                columns.setdefault(w + 1, []).extend(carry)
            if len(stack) == 2:
                columns.setdefault(w + 1, []).append(stack[0] & stack[1])
                stack = [stack[0] ^ stack[1]]
            out.append(stack[0] if stack else np.zeros(self.words, np.uint64))
            w += 1
        return out

    def top(self, q: np.ndarray, k: int, skip: np.ndarray | None = None) -> np.ndarray:
        """Rows holding the k largest exact scores (with all ties of the last), and maybe more; skip: rows left out."""
        live = self.all if skip is None else self.all & ~self._bitmap(skip, self.words * 64 - self.n)
        if self._count(live) <= k:
            return self._rows(live)
        slices = self.sum_slices(q)
        sure, edge, value = np.zeros(self.words, np.uint64), live, 0
        for w in range(len(slices) - 1, -1, -1):
            high = edge & slices[w]
            if self._count(sure) + self._count(high) >= k:
                edge, value = high, value | 1 << w
            else:
                sure, edge = sure | high, edge & ~slices[w]
        # the k-th largest sum is `value`; an exact score is 2**drop * sum + rest, rest within [0, slack] up to a constant
        slack = int(np.abs(q).sum()) * ((1 << self.drop) - 1)
        least = value - -(-slack // (1 << self.drop))
        return self._rows(live & self._at_least(slices, max(0, least)))

    def _at_least(self, slices: list[np.ndarray], value: int) -> np.ndarray:
        if value >= 1 << len(slices):
            return np.zeros(self.words, np.uint64)
        more, same = np.zeros(self.words, np.uint64), self.all
        for w in range(len(slices) - 1, -1, -1):
            if value >> w & 1:
                same = same & slices[w]
            else:
                more, same = more | (same & slices[w]), same & ~slices[w]
        return more | same

    @staticmethod
    def _count(bitmap: np.ndarray) -> int:
        return int(np.bitwise_count(bitmap).sum())

    def _rows(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[: self.n])


def quantised(vectors: DataFrame, id_col: str, vector: str, scale: int) -> DataFrame:
    """(vec_id, q): floor(scale * x) of every component; vectors that are null or hold a null, NaN or infinity are left out."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(F.col(id_col).isNotNull() & F.col(vector).isNotNull() & fine).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("q"))


def top_k_products(candidates: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector: str = "embedding", scale: int = 1024, drop: int = 4, block: int = 16384, query_block: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k candidates with the largest integer inner products, without the
    candidates of the query's own id; ties go to the smaller vec_id.

    A vector that is null, or holds a null or non-finite component, takes no part, nor does a null id. Vectors of
    unlike lengths count as if filled up with zeros. Candidates that repeat stand in the result each; of queries that
    share an id, the one with the least vector is taken. Other columns are not read. Candidates and queries are dealt
    into blocks of about `block` and `query_block` rows, each pair of blocks is one group: a group's size does not
    depend on the data, and no side is broadcast. Components so large that a score might leave 64 bits are refused.
    """
    # a salt by row, so that rows of one id do not meet in one block
    c = quantised(candidates, id_col, vector, scale).withColumn("__row", F.monotonically_increasing_id())
    q = quantised(queries, id_col, vector, scale).groupBy("vec_id").agg(F.min("q").alias("q"))
    largest = F.max(F.coalesce(F.array_max(F.transform("q", lambda x: F.abs(x.cast("double")))), F.lit(0.0)))
    sizes = [df.agg(F.count("*"), largest, F.max(F.size("q"))).first() for df in (c, q)]
    (n, top, width), (n_queries, top_query, _) = sizes
    if n and n_queries and top * top_query * width >= 2**62:
        raise ValueError("components are too large: exact scores would not fit in 64 bits")
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-n_queries // query_block))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = c.select(F.pmod(F.xxhash64("vec_id", "__row"), F.lit(blocks)).cast("int").alias("cb"), numbers(query_blocks).alias("qb"), F.lit(False).alias("is_query"), "vec_id", "q")
    right = q.select(numbers(blocks).alias("cb"), F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int").alias("qb"), F.lit(True).alias("is_query"), "vec_id", "q")

    def run(table: pa.Table) -> pa.Table:
        is_query = np.asarray(table["is_query"].combine_chunks().to_numpy(zero_copy_only=False), bool)
        ids = table["vec_id"].to_numpy()
        lists = table["q"].combine_chunks()
        lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
        size = np.asarray(lists.value_lengths())
        x = np.zeros((len(ids), max(1, int(size.max(initial=0)))), np.int64)
        x[np.arange(x.shape[1]) < size[:, None]] = np.asarray(lists.flatten())
        cand, cand_ids = x[~is_query], ids[~is_query]
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(cand):
            index = Block(cand, drop)
            for query, own in zip(x[is_query], ids[is_query], strict=True):
                rows = index.top(query, k, cand_ids == own)
                score = cand[rows] @ query
                best = np.lexsort((cand_ids[rows], -score))[:k]
                out.append((np.full(len(best), own), cand_ids[rows][best], score[best]))
        columns = [np.concatenate([o[i] for o in out]) if out else np.zeros(0, np.int64) for i in range(3)]
        return pa.table([pa.array(v, pa.int64()) for v in columns], names=["query_id", "vec_id", "score"])

    found = left.unionByName(right).groupBy("cb", "qb").applyInArrow(run, "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
