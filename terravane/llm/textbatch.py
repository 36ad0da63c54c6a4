"""Words, their hashes and n-grams of a batch of texts, computed on the UTF-8 bytes of an Arrow column.

A word is a maximal run of bytes of a class; both classes used here hold every byte of a multi-byte character or
none, so that byte runs are runs of code points. Hashes are 64 bits long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

ODD = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(ODD), -1, 1 << 64))

_BYTES = np.arange(256)
#: A-Z become a-z; all other bytes stay.
LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
#: After lower-casing: digits, a-z and everything beyond ASCII.
ALNUM = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
#: All but the space and \x09-\x0D.
NOT_SPACE = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers under which near inputs get far outputs (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * ODD + np.uint64(seed)) | np.uint64(1)


class _Powers:
    """Powers of ODD and of its inverse modulo 2**64, grown when a longer run asks for them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            n = max(n, 1 << 16)
            self.up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, ODD)]), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, INVERSE)]), dtype=np.uint64)
        return self.up, self.down


_POWERS = _Powers()


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts (null: empty) and where each text begins, with the end of the last."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    buffers = texts.buffers()
    if not len(texts) or buffers[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `most` bytes; a longer text stands alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, min(b, n)
        a = min(b, n)


def word_bounds(low: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First bytes and ends of the words, and the index of each text's first word (with the end of the last)."""
    if not len(low):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    m = is_word[low]
    first, last = m.copy(), m.copy()
    first[1:] &= ~m[:-1]
    last[:-1] &= ~m[1:]
    full = offsets[:-1] < offsets[1:]
    first[offsets[:-1][full]] = m[offsets[:-1][full]]
    last[offsets[1:][full] - 1] = m[offsets[1:][full] - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int = 1 << 18) -> np.ndarray:
    """A 64-bit hash of each word's bytes: a polynomial modulo 2**64 from prefix sums, then mixed."""
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        base = starts[a]
        b = max(a + 1, int(np.searchsorted(ends, base + most, "right")))
        piece = low[base : ends[b - 1]]
        up, down = _POWERS.of(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * up[: len(piece)], out=sums[1:])
        out[a:b] = (sums[ends[a:b] - base] - sums[starts[a:b] - base]) * down[starts[a:b] - base]
        a = b
    return mix(out)


class Words:
    """The words of some texts. at: the index of each text's first word, with the end of the last."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = ALNUM) -> None:
        self.low = LOWER[data]
        self.starts, self.ends, self.at = word_bounds(self.low, offsets, is_word)
        self.hashes = word_hashes(self.low, self.starts, self.ends)
        self.counts = np.diff(self.at)

    def doc(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def whole(self, k: int) -> np.ndarray:
        """Words at which k words of the same text stand."""
        limit = np.repeat(self.at[1:], self.counts)
        return np.flatnonzero(np.arange(len(self.hashes)) + k <= limit)

    def grams(self, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Places of the k-grams and their hashes."""
        places = self.whole(k)
        return places, gram_hash(self.hashes, places, range(k), seed)


def gram_hash(hashes: np.ndarray, places: np.ndarray, mask: range | tuple[int, ...], seed: int = 0) -> np.ndarray:
    """Hash of the words at the offsets in mask from each place."""
    span = mask[-1] + 1
    n = max(0, len(hashes) - span + 1)
    total = np.zeros(n, np.uint64)
    for factor, j in zip(seeds(len(mask), seed), mask, strict=True):
        total += hashes[j : j + n] * factor
    return mix(total if n == len(places) else total[places])


def batches(texts: pa.Array, is_word: np.ndarray = ALNUM, most: int = 1 << 20) -> Iterator[tuple[int, int, Words]]:
    """(first text, end, words) for slices of the texts that fit in a processor's cache."""
    data, offsets = text_bytes(texts)
    for a, b in slices(offsets, most):
        yield a, b, Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], is_word)


def one_text(text: str, is_word: np.ndarray = ALNUM) -> Words:
    data = np.frombuffer(text.encode(), np.uint8)
    return Words(data, np.array([0, len(data)]), is_word)
