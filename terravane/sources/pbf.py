"""Map extracts in the binary format of OpenStreetMap: blobs of delta-coded elements, read one block at a time."""

from __future__ import annotations

import lzma
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np

_MEMBER = ("node", "way", "relation")


def fields(data: memoryview) -> Iterator[tuple[int, int | memoryview]]:
    """(number, value) of a protocol buffer message: integers, or the bytes of anything longer."""
    at, end = 0, len(data)

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            if byte < 128:
                return out
            shift += 7

    while at < end:
        tag = varint()
        match tag & 7:
            case 0:
                yield tag >> 3, varint()
                continue
            case 1:
                size = 8
            case 2:
                size = varint()
            case 5:
                size = 4
            case wire:
                raise ValueError(f"wire type {wire} in a map extract")
        if at + size > end:
            raise ValueError("a map extract's message is cut short")
        yield tag >> 3, data[at : at + size]
        at += size


def packed(data: memoryview) -> np.ndarray:
    """A packed field of varints, as signed 64-bit integers."""
    raw = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(raw < 128)
    if not len(ends):
        return np.zeros(0, np.int64)
    raw = raw[: ends[-1] + 1]
    starts = np.r_[0, ends[:-1] + 1]
    shift = 7 * (np.arange(len(raw)) - np.repeat(starts, ends - starts + 1))
    return np.add.reduceat((raw & 127).astype(np.uint64) << shift.astype(np.uint64), starts).view(np.int64)


def zigzag(x):
    """Signed values of integers whose lowest bit is the sign."""
    if isinstance(x, int):
        return (x >> 1) ^ -(x & 1)
    u = x.view(np.uint64)
    return ((u >> np.uint64(1)) ^ (np.uint64(0) - (u & np.uint64(1)))).view(np.int64)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def blocks(file: BinaryIO) -> Iterator[memoryview]:
    """Unpacked data blocks of a file."""
    while head := file.read(4):
        header = dict(fields(memoryview(file.read(int.from_bytes(head, "big")))))
        blob = file.read(header[3])
        if len(blob) < header[3]:
            raise ValueError("a map extract is cut short")
        if bytes(header[1]) != b"OSMData":
            continue
        body = dict(fields(memoryview(blob)))
        if 1 in body:
            yield body[1]
        elif 3 in body:
            yield memoryview(zlib.decompress(body[3]))
        elif 4 in body:
            yield memoryview(lzma.decompress(body[4]))
        elif 7 in body:
            import zstandard

            yield memoryview(zstandard.ZstdDecompressor().decompress(bytes(body[7]), max_output_size=body.get(2, 0)))
        else:
            raise ValueError("a map extract's compression is not known")


def elements(file: BinaryIO) -> Iterator[tuple]:
    """(kind, id, tags, content) in the file's order. Content: (lng, lat) of a node, node ids of a way, (kind, id, role) of
    each member of a relation."""
    for block in blocks(file):
        words, groups, scale, lat0, lng0 = [], [], 100, 0, 0
        for number, value in fields(block):
            match number:
                case 1:
                    words = [bytes(w).decode("utf-8", "replace") for _, w in fields(value)]
                case 2:
                    groups.append(value)
                case 17:
                    scale = value
                case 19:
                    lat0 = signed(value)
                case 20:
                    lng0 = signed(value)
        for group in groups:
            for number, value in fields(group):
                if number == 2:
                    yield from _dense(dict(fields(value)), words, scale, lat0, lng0)
                elif number in (1, 3, 4):
                    body = dict(fields(value))
                    tags = {words[k]: words[v] for k, v in zip(packed(body.get(2, b"")), packed(body.get(3, b"")), strict=True)}
                    if number == 1:
                        yield "node", zigzag(body[1]), tags, (1e-9 * (lng0 + scale * zigzag(body[9])), 1e-9 * (lat0 + scale * zigzag(body[8])))
                    elif number == 3:
                        yield "way", signed(body[1]), tags, np.cumsum(zigzag(packed(body.get(8, b"")))).tolist()
                    else:
                        ids = np.cumsum(zigzag(packed(body.get(9, b"")))).tolist()
                        yield "relation", signed(body[1]), tags, [(_MEMBER[t], i, words[r]) for t, i, r in zip(packed(body.get(10, b"")), ids, packed(body.get(8, b"")), strict=True)]


def _dense(body: dict, words: list[str], scale: int, lat0: int, lng0: int) -> Iterator[tuple]:
    ids, lat, lng = (np.cumsum(zigzag(packed(body.get(i, b"")))) for i in (1, 8, 9))
    pairs, at = packed(body.get(10, b"")).tolist(), 0
    for i, y, x in zip(ids.tolist(), (1e-9 * (lat0 + scale * lat)).tolist(), (1e-9 * (lng0 + scale * lng)).tolist(), strict=True):
        tags = {}
        while at < len(pairs) and pairs[at]:
            tags[words[pairs[at]]] = words[pairs[at + 1]]
            at += 2
        at += 1
        yield "node", i, tags, (x, y)
