"""Exact token counts of whole texts; huge ones are encoded in overlapping chunks that are spliced again.

A chunk's tokens are exact away from its cut ends only. Two neighbouring chunks are spliced inside their overlap at a
*stable boundary*: white space followed by an ASCII letter or digit, where both chunks end one token and begin another,
with the same token ids on `agree` tokens at either side (or up to the overlap's end). White space never lies inside a
pre-token, and neither normalisation nor merging crosses it, so what stands left of such a place is encoded alike
whatever follows. Where an overlap holds no such place, it is widened to twice its length, in the end to the whole text.
For the same reason a short text's tokens are those of its words, so that each distinct word is encoded once.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import small_batches

STABLE = re.compile(r"(?<=[ \t\n\r])[A-Za-z0-9]")
_LOADED: dict[str, object] = {}


def load(path: str):
    """A function from texts to the lists of (ids, offsets), and one from texts to numbers of tokens."""
    if path not in _LOADED:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)

            def spans(text: str) -> tuple[list[int], list[tuple[int, int]]]:
                pieces = model.encode(text, out_type="immutable_proto").pieces
                return [p.id for p in pieces], [(p.begin, p.end) for p in pieces]

            _LOADED[path] = spans, lambda texts: [len(x) for x in model.encode(texts, num_threads=1)], False
        else:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()

            def spans(text: str) -> tuple[list[int], list[tuple[int, int]]]:
                e = model.encode(text, add_special_tokens=False)
                return e.ids, e.offsets

            # offsets and stable places are only sound where white space is dropped between pre-tokens
            _LOADED[path] = spans, lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)], _drops_space(model)
    return _LOADED[path]


def _drops_space(model) -> bool:
    probe = "ab, cd 12"
    return [t for t in model.encode(probe, add_special_tokens=False).tokens] == [t for w in probe.split() for t in model.encode(w, add_special_tokens=False).tokens]


def splice(text: str, spans, chunk: int, overlap: int, agree: int = 4) -> int:
    """Tokens of a text encoded in chunks of `chunk` characters that overlap by `overlap` at first."""
    done, start, total = 0, 0, 0  # tokens before character `done` are counted; the current chunk starts at `start`
    ids, offs = spans(text[:chunk])
    end = min(chunk, len(text))
    while end < len(text):
        wide = overlap
        while True:
            if wide >= end - done:  # no stable place in all that is not yet counted: this chunk grows
                end = min(len(text), start + 2 * (end - start))
                ids, offs = spans(text[start:end])
                break
            begin = end - wide
            new_end = min(len(text), begin + chunk + wide)
            new_ids, new_offs = spans(text[begin:new_end])
            cut = _common(text, begin, end, start, ids, offs, new_ids, new_offs, agree)
            if cut is not None:
                at, left, right = cut
                total += left
                done, start, end = at, at, new_end
                ids, offs = new_ids[right:], [(a + begin - at, b + begin - at) for a, b in new_offs[right:]]
                break
            wide *= 2
    return total + len(ids)


def _common(text, begin, end, start, ids, offs, new_ids, new_offs, agree):
    """The stable boundary nearest to the overlap's middle: (place, tokens of the old before it, of the new before it)."""
    old = {a + start: i for i, (a, b) in enumerate(offs) if a + start >= begin}
    new = {a + begin: i for i, (a, b) in enumerate(new_offs) if a + begin < end}
    middle = (begin + end) / 2
    for m in sorted(STABLE.finditer(text, begin + 1, end), key=lambda m: abs(m.start() - middle)):
        at = m.start()
        if at in old and at in new:
            i, j = old[at], new[at]
            n = min(agree, i, j)
            after = min(agree, max(0, len(ids) - i - agree), len(new_ids) - j)
            if n and ids[i - n : i] == new_ids[j - n : j] and after and ids[i : i + after] == new_ids[j : j + after]:
                return at, i, j
    return None


class WordCounts:
    """Numbers of tokens of texts from those of their words, the parts between ASCII white space. Words of ordinary length
    are remembered, `most` of them at the most."""

    def __init__(self, counts, most: int = 1 << 20, longest: int = 64) -> None:
        self.counts, self.most, self.longest, self.known = counts, most, longest, {}

    def __call__(self, texts: list[str]) -> list[int]:
        words = [t.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for t in texts]
        here = {w for some in words for w in some}
        if len(self.known) > self.most:
            self.known = {}
        new = list(here - self.known.keys())
        for i in range(0, len(new), 256):
            self.known.update(zip(new[i : i + 256], self.counts(new[i : i + 256]), strict=True))
        out = [sum(map(self.known.__getitem__, some)) for some in words]
        for w in new:
            if len(w) > self.longest:
                del self.known[w]
        return out


def text_bytes(text: str):
    """Bytes of a text in UTF-8, of a null none: a column that needs no tokenizer."""
    return F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long")


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", limit: int = 2048, chunk: int = 1 << 15, overlap: int = 1 << 10) -> DataFrame:
    """docs with n_bytes, n_tokens and over_limit (n_tokens > limit).

    A null text counts as an empty one (0 bytes, 0 tokens); rows that repeat each keep their own row; columns of docs
    named like the new ones give way to them. Texts up to `chunk` characters are encoded whole, longer ones spliced, so
    memory is bounded by chunk (a longer run without any stable place is encoded as one). Tokenizers whose tokens may hold
    white space (byte-level BPE, sentencepiece) have no such places: their texts are encoded whole, however long.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in (text, "n_bytes", "n_tokens", "over_limit")]
    source = docs.select(*kept, text_bytes(text).alias("n_bytes"), F.coalesce(F.col(text), F.lit("")).alias("__text"))
    out = source.drop("__text").withColumn("n_tokens", F.lit(0).cast("long"))

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans, counts, spliced = load(tokenizer)
        if spliced:
            counts = WordCounts(counts)
        for batch in found:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            short = [t for t in texts if not spliced or len(t) <= chunk]
            quick = iter([n for i in range(0, len(short), 64) for n in counts(short[i : i + 64])])
            n = [splice(t, spans, chunk, overlap) if spliced and len(t) > chunk else next(quick) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(n, pa.int64())], names=[*kept, "n_bytes", "n_tokens"])

    return source.mapInArrow(run, out.schema).withColumn("over_limit", F.col("n_tokens") > limit)
