"""Language-model scores of whole texts from a log-frequency Bloom filter.

Counts of words and of pairs of neighbouring words are quantised on a logarithmic scale, q = 1 + floor(log_base count),
and each n-gram enters the filter q times, as (n-gram, 1) .. (n-gram, q). A count is read back by probing (n-gram, 1),
(n-gram, 2), ... until one is missing, so it errs upward only, and rarely. A pair's probability is smoothed towards that
of the word: (c(h w) + kappa * p(w)) / (c(h) + kappa).

Counting: each batch of texts gives each of its n-grams once, and Spark adds them up by hash, with partial sums before
its shuffle. The number of groups follows from the number of distinct n-grams, so that a group holds a bounded number:
its task builds its segment of the filter and keeps the exact counts of its words. Segments are broadcast while they fit
in a bound, one for pairs and one for words; beyond it, pairs of tokens are sent to the segments instead, with equal
results: to that of the word, then to that of the word before, then to that of the pair; a group that is asked for much
is split. What the most frequent words read from the filter is known everywhere, so that only rarer ones are sent.
Words are known by 64-bit hashes: for a vocabulary of v words the chance of any two being taken for one is v^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quality import held_out
from .storage import small_batches, written
from .textbatch import NOT_SPACE, batches, mix

END, START = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E6C63D0876A9A47)
_PARTS = 4  # bits set for each entry, all inside one block of 512


def quantise(counts: np.ndarray, base: float) -> np.ndarray:
    return 1 + np.floor(np.log(np.maximum(counts, 1)) / np.log(base) + 1e-9).astype(np.int64)


def levels(base: float, n: int = 160) -> np.ndarray:
    """The count that a level stands for: the middle of the counts that are quantised to it; 0 for level 0."""
    low = np.ceil(base ** np.arange(n + 1.0) - 1e-9)
    return np.concatenate([[0.0], np.maximum(low[:-1], (low[:-1] + np.maximum(low[:-1], low[1:] - 1)) / 2)])


def _bits(hashes: np.ndarray, level: int, blocks: int | np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The block of each entry and its bits inside that."""
    m = mix(hashes + np.uint64(level * 0xD1342543DE82EF95 % (1 << 64)))
    at = mix(m + np.uint64(1))
    places = [(at >> np.uint64(9 * i)) & np.uint64(511) for i in range(_PARTS)]
    return (m % np.asarray(blocks, np.uint64)).astype(np.int64), places


def build(hashes: np.ndarray, counts: np.ndarray, base: float, bits_each: float) -> np.ndarray:
    """A segment: bits of all entries, as 64-bit words in blocks of 8."""
    q = quantise(counts, base)
    blocks = max(1, int(np.ceil(q.sum() * bits_each / 512)))
    out = np.zeros(blocks * 8, np.uint64)
    for level in range(1, int(q.max(initial=0)) + 1):
        block, places = _bits(hashes[q >= level], level, blocks)
        for place in places:
            np.bitwise_or.at(out, block * 8 + (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    return out


class Filter:
    """Segments by group, laid end to end. sizes: 64-bit words of each group's segment; they come one by one."""

    def __init__(self, segments: Iterable[tuple[int, np.ndarray]], sizes: Mapping[int, int], groups: int) -> None:
        size = np.array([sizes.get(g, 0) for g in range(groups)])
        self.blocks = size // 8
        self.first = np.concatenate([[0], np.cumsum(size)[:-1]])
        self.words = np.zeros(size.sum(), np.uint64)
        for g, segment in segments:
            self.words[self.first[g] : self.first[g] + size[g]] = segment
        self.groups = groups

    def count(self, hashes: np.ndarray, most: int = 1 << 30) -> np.ndarray:
        """Levels of the n-grams: how many probes in a row succeed, of `most` at the most."""
        out = np.zeros(len(hashes), np.int64)
        group = (hashes % np.uint64(self.groups)).astype(np.int64)
        live = np.flatnonzero(self.blocks[group] > 0)
        level = 1
        while len(live) and level <= most:
            h, g = hashes[live], group[live]
            block, places = _bits(h, level, self.blocks[g])
            first, hit = self.first[g] + block * 8, np.arange(len(live))
            for place in places:  # those that an earlier bit rejects are not looked at again
                bit = place[hit]
                word = self.words[first[hit] + (bit >> np.uint64(6)).astype(np.int64)]
                hit = hit[(word >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)]
            live = live[hit]
            out[live] = level
            level += 1
        return out


def sequences(words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts in order: each token (words, then an end), the one before it (at first a start), and its text."""
    n = words.counts + 1
    at = np.concatenate([[0], np.cumsum(n)])
    tokens = np.full(at[-1], END, np.uint64)
    doc = np.repeat(np.arange(len(n)), n)
    inner = np.ones(at[-1], bool)
    inner[at[1:] - 1] = False
    tokens[inner] = words.hashes
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[at[:-1]] = START
    return tokens, before, doc


def pair(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0xC6A4A7935BD1E995) + tokens)


def packed(grams: int, hashes: np.ndarray, groups: int, *more: np.ndarray) -> Iterator[tuple]:
    """(group, grams, bytes of the hashes, bytes of each other array) for each group that has any."""
    group = (hashes % np.uint64(groups)).astype(np.int64)
    order = np.argsort(group, kind="stable")
    edges = np.flatnonzero(np.diff(group[order], prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        some = order[a:b]
        yield (int(group[some[0]]), grams, hashes[some].tobytes(), *(x[some].tobytes() for x in more))


def _arrays(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, kind) for x in column.to_pylist()]) if len(column) else np.zeros(0, kind)


def counted(docs: DataFrame, text: str, slice_rows: int = 1 << 17) -> DataFrame:
    """(grams, hash, n): how often each word (grams 1; the start too) and each pair (grams 2) occurs. A batch of texts
    gives each n-gram once, and Spark adds them up, before and after its shuffle."""

    def count(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for _, _, w in batches(batch.column(0), NOT_SPACE, 4 << 20):
                tokens, before, _ = sequences(w)
                for grams, every in (
                    (1, np.concatenate([tokens, before[before == START]])),
                    (2, pair(before, tokens)),
                ):
                    hashes, n = np.unique(every, return_counts=True)
                    for i in range(0, len(hashes), slice_rows):
                        h = hashes[i : i + slice_rows].view(np.int64)
                        columns = np.full(len(h), grams, np.int32), h, n[i : i + slice_rows].astype(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["grams", "hash", "n"])

    each = docs.select(F.col(text)).mapInArrow(count, "grams int, hash long, n long")
    return written(each.groupBy("grams", "hash").agg(F.sum("n").alias("n")), "lm-counts")


def group_of(hash_col: str, groups: int):
    """The hash, taken as unsigned, modulo the number of groups."""
    low = F.pmod(F.col(hash_col), F.lit(groups).cast("long"))
    wrapped = F.pmod(low + F.lit((1 << 64) % groups), F.lit(groups).cast("long"))
    return F.when(F.col(hash_col) < 0, wrapped).otherwise(low).cast("int")


def train(counts: DataFrame, groups: Mapping[int, int], base: float, bits_each: float) -> DataFrame:
    """(grams, group, segment, hashes, counts): a table in the shared folder; hashes and counts of words only."""

    def add(table: pa.Table) -> pa.Table:
        hashes, n = table["hash"].to_numpy().view(np.uint64), table["n"].to_numpy()
        grams = table["grams"][0].as_py()
        own = (hashes != START) if grams == 1 else np.zeros(len(hashes), bool)  # the start is a context only
        return pa.table({
            "grams": pa.array([grams], pa.int32()),
            "group": pa.array([table["group"][0].as_py()], pa.int32()),
            "segment": pa.array([build(hashes, n, base, bits_each).tobytes()], pa.binary()),
            "hashes": pa.array([hashes[own].tobytes()], pa.binary()),
            "counts": pa.array([n[own].tobytes()], pa.binary()),
        })

    group = F.when(F.col("grams") == 1, group_of("hash", groups[1])).otherwise(group_of("hash", groups[2]))
    by_group = counts.select("grams", group.alias("group"), "hash", "n").groupBy("grams", "group")
    schema = "grams int, group int, segment binary, hashes binary, counts binary"
    return written(by_group.applyInArrow(add, schema), "lm-model")


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """(hash, n) of the words whose count reaches a threshold that at most `most` words reach, and of the start (whose
    count is given as 0: it is no token)."""
    words = counts.filter("grams = 1").select("hash", "n", F.floor(F.log(F.col("n").cast("double")) * 10).alias("bin"))
    start = F.col("hash") == F.lit(int(START.view(np.int64)))
    total, least = 0, 1 << 62
    for r in sorted(words.filter(~start).groupBy("bin").count().collect(), key=lambda r: -r.bin):
        total += r["count"]
        if total > most:
            break
        least = r.bin
    picked = words.filter(start | (F.col("bin") >= least))
    return picked.select("hash", F.when(start, 0).otherwise(F.col("n")).alias("n"))


def read_back(words: DataFrame, model: DataFrame, groups: int) -> DataFrame:
    """words with the level that the filter of words gives each."""

    def look(left: pa.Table, right: pa.Table) -> pa.Table:
        hashes, segment = left["hash"].to_numpy(), _arrays(right["segment"], np.uint64)
        level = np.zeros(len(hashes), np.int64)
        if len(hashes):
            g = left["group"][0].as_py()
            level = Filter([(g, segment)], {g: len(segment)}, groups).count(hashes.view(np.uint64))
        return pa.table({"hash": pa.array(hashes), "n": left["n"], "level": pa.array(level)})

    left = words.select("hash", "n", group_of("hash", groups).alias("group")).groupBy("group")
    right = model.filter("grams = 1").select("group", "segment").groupBy("group")
    return left.cogroup(right).applyInArrow(look, "hash long, n long, level long")


def segments(model: DataFrame, grams: int, groups: int) -> Filter:
    rows = model.filter(F.col("grams") == grams)
    sizes = {r.group: r.n // 8 for r in rows.select("group", F.octet_length("segment").alias("n")).collect()}
    found = rows.select("group", "segment").toLocalIterator()
    return Filter(((r.group, np.frombuffer(r.segment, np.uint64)) for r in found), sizes, groups)


def dealt(lines: DataFrame, most_bytes: int) -> tuple[DataFrame, DataFrame]:
    """lines with a salt, so that those of one group and salt hold about most_bytes of hashes, and (kind, group, salt)
    of all that there are: a group that is asked for much is split."""
    size = F.ceil(F.sum(F.octet_length("hashes")) / F.lit(most_bytes)).cast("int")
    salts = written(lines.groupBy("kind", "group").agg(F.greatest(size, F.lit(1)).alias("salts")), "lm-salts")
    salt = F.pmod(F.xxhash64("hashes", "owners"), F.col("salts")).cast("int")
    salted = lines.join(salts, ["kind", "group"]).withColumn("salt", salt)
    every = salts.select("kind", "group", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    return salted.drop("salts"), every


#: What a slice of texts sends: of a text (kind 0), or n-grams of some texts, packed by the group they go to.
_SENT = ["kind", "group", "uid", "id", "held_out", "n_tokens", "n_known", "base", "score", "hashes", "owners", "n", "more"]
_ADDED = "uid long, n_known long, base double, score double"
_LINE = "kind int, group int, hashes binary, owners binary, n binary, more binary"
WORD, LAST, AT_WORD, AT_CONTEXT = 1, 2, 3, 4  # kinds of lines: an exact count, a pair's level, a word's, a context's


def _lines(found: list[tuple]) -> list[pa.Array]:
    """kind, group, hashes, owners, n and more as columns."""
    kind, group, _, *binaries = zip(*found, strict=True) if found else ((),) * 7
    return [pa.array(kind, pa.int32()), pa.array(group, pa.int32()), *(pa.array(x, pa.binary()) for x in binaries)]


def score_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    folds: int = 5,
    fold: int = 1,
    base: float = 1.5,
    kappa: float = 500.0,
    bits_each: float = 10.0,
    most_broadcast: int = 128 << 20,
    most_words: int = 64 << 20,
    most_frequent: int = 1 << 20,
    group_grams: int = 1 << 18,
    most_lines: int = 8 << 20,
) -> DataFrame:
    """A row for each row of docs: id_col, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are lower-cased (A-Z) runs of characters other than the space and \\x09-\\x0D, then one end for each text.
    The model learns from the rows whose crc32(id as text) mod folds is not fold (a null id is learnt from). base_score
    is the add-a-half unigram score with exact counts; score is the sum of log10 of the smoothed pair probabilities that
    the filter gives. A null text counts as empty and has the end token only; rows that repeat are counted and scored
    each; other columns are not read; an empty table gives no rows.

    A group of the filter holds about group_grams n-grams, however many there are: their number follows from the counts.
    Exact counts of at most most_frequent words, the most frequent, are broadcast; the other words of the texts are sent
    to the groups that hold their counts. The filter of pairs is broadcast up to most_broadcast bytes, that of words (about
    12 bits for each distinct one) up to most_words. What is sent to one group is dealt over tasks of about most_lines
    bytes of hashes, each with a copy of the group's segment.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"), held_out(id_col, folds, fold).alias("held_out"))
    counts = counted(rows.filter(~F.col("held_out")).select("text"), "text")
    token = (F.col("grams") == 2) | (F.col("hash") != F.lit(int(START.view(np.int64))))
    sums = counts.filter(token).groupBy("grams").agg(F.count("*").alias("v"), F.sum("n").alias("n")).collect()
    distinct, total = {r.grams: r.v for r in sums}, {r.grams: r.n for r in sums}
    v, n_train = distinct.get(1, 0), total.get(1, 0)
    below = n_train + 0.5 * (v + 1)
    groups = {g: max(1, -(-distinct.get(g, 0) // group_grams)) for g in (1, 2)}
    model = train(counts, groups, base, bits_each)
    size = {r.grams: r.bytes for r in model.groupBy("grams").agg(F.sum(F.octet_length("segment")).alias("bytes")).collect()}
    words_routed = size.get(1, 0) > most_words
    routed = words_routed or size.get(2, 0) > most_broadcast
    picked = frequent(counts, most_frequent)
    picked = (read_back(picked, model, groups[1]) if words_routed else picked.withColumn("level", F.lit(0).cast("long"))).toArrow()
    common = picked["hash"].to_numpy().view(np.uint64)
    order = np.argsort(common)
    common, common_n, common_level = common[order], picked["n"].to_numpy()[order], picked["level"].to_numpy()[order]
    words_in = None if words_routed else segments(model, 1, groups[1])
    pairs_in = None if routed else segments(model, 2, groups[2])
    sent = spark.sparkContext.broadcast(((common, common_n, common_level), words_in, pairs_in))
    del picked, words_in, pairs_in
    value = levels(base)
    source = rows.select("id", "held_out", F.monotonically_increasing_id().alias("uid"), "text")
    kinds = "int", "int", "bigint", None, "boolean", "bigint", "bigint", "double", "double", "binary", "binary", "binary", "binary"
    none = [f"cast(null as {k or source.schema['id'].dataType.simpleString()}) as {c}" for c, k in zip(_SENT, kinds, strict=True)]
    schema = source.selectExpr(*none).schema

    def smooth(pairs: np.ndarray, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        return np.log10((np.minimum(value[pairs], np.maximum(context, 1.0)) + kappa * word) / (context + kappa))

    def asked(tokens, before, owner, context, word) -> list[tuple]:
        """Pairs of tokens on their way, packed by the group they go to: first that of the word, then that of the word
        before, then that of the pair; steps whose answer is known are left out."""
        first, second = np.isnan(word), ~np.isnan(word) & np.isnan(context)
        last = ~first & ~second
        out = [(AT_WORD, *x) for x in packed(1, tokens[first], groups[1], owner[first], before[first], context[first])]
        out += [(AT_CONTEXT, *x) for x in packed(1, before[second], groups[1], owner[second], tokens[second], word[second])]
        pairs = pair(before[last], tokens[last])
        return out + [(LAST, *x) for x in packed(2, pairs, groups[2], owner[last], context[last], word[last])]

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (common, common_n, common_level), words_in, pairs_in = sent.value
        for batch in found:
            for a, b, w in batches(batch.column(3), NOT_SPACE, 2 << 20):
                tokens, before, doc = sequences(w)
                n_docs = b - a
                uid = np.asarray(batch.column(2))[a:b]
                distinct, which = np.unique(np.concatenate([tokens, [START]]), return_inverse=True)
                start, which = which[-1], which[:-1]
                place = np.minimum(np.searchsorted(common, distinct), max(0, len(common) - 1))
                here = common[place] == distinct if len(common) else np.zeros(len(distinct), bool)
                exact = np.where(here, common_n[place], 0) if len(common) else np.zeros(len(distinct), np.int64)
                known = exact[which] > 0
                each = np.log10((exact + 0.5) / below)
                # counts as the filter has them; not a number where they must be asked for
                guess = np.where(here, value[common_level[place]], np.nan) if len(common) else np.full(len(distinct), np.nan)
                if words_in is not None:
                    guess = value[words_in.count(distinct)]
                word = ((guess + 0.5) / below)[which]
                context = np.concatenate([[guess[start]], guess[which][:-1]])
                context[np.flatnonzero(np.diff(doc, prepend=-1))] = guess[start]
                out = np.zeros(n_docs)
                if pairs_in is not None:
                    h, back = np.unique(pair(before, tokens), return_inverse=True)
                    out = np.bincount(doc, smooth(pairs_in.count(h)[back], context, word), minlength=n_docs)
                sums = [
                    pa.array((w.counts + 1).astype(np.int64)),
                    pa.array(np.bincount(doc[known], minlength=n_docs).astype(np.int64)),
                    pa.array(np.bincount(doc[known], each[which[known]], minlength=n_docs).astype(np.float64)),
                    pa.array(out),
                ]
                own = [batch.column(0).slice(a, n_docs), batch.column(1).slice(a, n_docs)]
                head = [pa.array(np.zeros(n_docs, np.int32)), pa.nulls(n_docs, pa.int32()), pa.array(uid), *own]
                yield pa.RecordBatch.from_arrays([*head, *sums, *(pa.nulls(n_docs, pa.binary()) for _ in range(4))], names=_SENT)
                # the rest of the words, once for each text
                rare = np.flatnonzero(~known)
                order = rare[np.lexsort((tokens[rare], doc[rare]))]
                same = (np.diff(doc[order]) == 0) & (np.diff(tokens[order]) == 0)
                first = np.flatnonzero(np.r_[True, ~same][: len(order)])
                n = np.diff(np.append(first, len(order)))
                owner, word_of = doc[order[first]], tokens[order[first]]
                lines = [(WORD, *x, None) for x in packed(1, word_of, groups[1], uid[owner], n.astype(np.uint32))]
                if pairs_in is None:
                    lines += asked(tokens, before, uid[doc], context, word)
                for i in range(0, len(lines), 1024):
                    kind, group, *binaries = _lines(lines[i : i + 1024])
                    gaps = pa.int64(), batch.column(0).type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()
                    yield pa.RecordBatch.from_arrays([kind, group, *(pa.nulls(len(kind), t) for t in gaps), *binaries], names=_SENT)

    def resolve(left: pa.Table, right: pa.Table) -> pa.Table:
        """What a group's words (or pairs) add to the texts that hold them."""
        hashes, owners = _arrays(left["hashes"], np.uint64), _arrays(left["owners"], np.int64)
        texts, who = np.unique(owners, return_inverse=True)
        if not len(hashes):
            added = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        elif left["kind"][0].as_py() == WORD:
            have, counts, n = _arrays(right["hashes"], np.uint64), _arrays(right["counts"], np.int64), _arrays(left["n"], np.uint32)
            order = np.argsort(have)
            have, counts = have[order], counts[order]
            place = np.minimum(np.searchsorted(have, hashes), max(0, len(have) - 1))
            c = np.where(have[place] == hashes, counts[place], 0) if len(have) else np.zeros(len(hashes), np.int64)
            known = np.bincount(who, n * (c > 0)).astype(np.int64)
            added = known, np.bincount(who, n * np.log10((c + 0.5) / below)), np.zeros(len(texts))
        else:
            g, segment = left["group"][0].as_py(), _arrays(right["segment"], np.uint64)
            level = Filter([(g, segment)], {g: len(segment)}, groups[2]).count(hashes)
            some = smooth(level, _arrays(left["n"], np.float64), _arrays(left["more"], np.float64))
            added = np.zeros(len(texts), np.int64), np.zeros(len(texts)), np.bincount(who, some)
        return pa.table([pa.array(x) for x in (texts, *added)], names=["uid", "n_known", "base", "score"])

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        """Pairs of tokens at a group of words: what its segment tells is added, and they are packed for the next one."""
        hashes, owners, other = (_arrays(left[c], t) for c, t in (("hashes", np.uint64), ("owners", np.int64), ("n", np.uint64)))
        lines: list[tuple] = []
        if len(hashes):
            g, segment, known = left["group"][0].as_py(), _arrays(right["segment"], np.uint64), _arrays(left["more"], np.float64)
            guess = value[Filter([(g, segment)], {g: len(segment)}, groups[1]).count(hashes)]
            if left["kind"][0].as_py() == AT_WORD:
                lines = asked(hashes, other, owners, known, (guess + 0.5) / below)
            else:
                lines = asked(other, hashes, owners, guess, known)
        return pa.table(_lines(lines), names=["kind", "group", "hashes", "owners", "n", "more"])

    def sent_to(lines: DataFrame, act, schema: str) -> DataFrame:
        """act on lines and on the groups they go to."""
        salted, every = dealt(lines, most_lines)
        of_words = F.array(*(F.lit(k) for k in (WORD, AT_WORD, AT_CONTEXT)))
        asked_by = F.when(F.col("grams") == 2, F.array(F.lit(LAST))).otherwise(of_words)
        there = model.select(F.explode(asked_by).alias("kind"), "group", "segment", "hashes", "counts").join(every, ["kind", "group"])
        by = "kind", "group", "salt"
        return salted.groupBy(*by).cogroup(there.groupBy(*by)).applyInArrow(act, schema)

    passed = written(source.mapInArrow(run, schema), "lm-passed")
    sent.destroy()  # nothing after the written table needs it
    one = passed.filter("kind = 0").select("uid", "id", "held_out", "n_tokens", "n_known", "base", "score")
    lines = passed.filter("kind > 0").select("kind", "group", "hashes", "owners", "n", "more")
    if words_routed:
        by_word = written(sent_to(lines.filter(F.col("kind") == AT_WORD), look_up, _LINE), "lm-words")
        at_context = lines.unionByName(by_word).filter(F.col("kind") == AT_CONTEXT)
        by_context = written(sent_to(at_context, look_up, _LINE), "lm-contexts")
        lines = lines.filter(F.col("kind") < AT_WORD).unionByName(by_word.filter(F.col("kind") == LAST)).unionByName(by_context)
    added = sent_to(lines, resolve, _ADDED)
    kind = rows.schema["id"].dataType.simpleString()
    gaps = f"cast(null as {kind}) as id", "cast(null as boolean) as held_out", "cast(null as bigint) as n_tokens"
    every = one.unionByName(added.selectExpr("uid", *gaps, "n_known", "base", "score")).groupBy("uid")
    return every.agg(
        F.max("id").alias(id_col),
        F.bool_or("held_out").alias("held_out"),
        F.max("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"),
        F.lit(int(n_train)).cast("long").alias("train_tokens"),
        F.sum("base").alias("base_score"),
        F.sum("score").alias("score"),
    ).drop("uid")
