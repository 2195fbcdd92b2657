"""Runs of bytes (words, terms) of whole Arrow batches, found and hashed with numpy.

Which bytes belong to a run is a table of 256 flags. Work goes over runs in blocks of bytes, so a text
or a run of any length is taken whole while temporary arrays stay small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from riskloom.llm.words import buffer_of, mixed

BLOCK, BYTES = 1 << 19, 1 << 20
_CODES = np.arange(256)
LOWER = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)
_TABLE = np.random.default_rng(40).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = np.random.default_rng(41).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)


def without(separators: bytes) -> np.ndarray:
    """Table of the bytes that separate nothing."""
    return ~np.isin(_CODES, np.frombuffer(separators, np.uint8))


def parts(batches: Iterator[pa.RecordBatch], column: int, size: int = BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about `size` bytes in a column without nulls; a longer text comes alone."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(sizes) - 1) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def lowered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts with A-Z in lower case, and the offsets of each text."""
    raw, offsets = buffer_of(texts)
    return LOWER[raw], offsets


def bounds(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes that are `inside`; runs don't cross texts."""
    flags = inside[raw]
    edge = offsets[(offsets > 0) & (offsets < len(raw))]
    before = np.concatenate([[False], flags[:-1]])
    before[edge] = False
    after = np.concatenate([flags[1:], [False]])
    after[edge - 1] = False
    return np.flatnonzero(flags & ~before), np.flatnonzero(flags & ~after) + 1


def hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run."""
    out = np.empty(len(starts), np.uint64)
    size = ends - starts
    upto = np.cumsum(size)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + BLOCK, "right")))
        own = size[a:b]
        first = np.cumsum(own) - own
        place = np.arange(own.sum()) - np.repeat(first, own)
        value = _TABLE[raw[np.repeat(starts[a:b], own) + place]] * _PLACE[place & 255]
        if len(place) and place.max() > 255:
            value *= (2 * (place >> 8) + 1).astype(np.uint64)
        out[a:b] = np.add.reduceat(value, first)
        a = b
    return mixed(out + size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
