"""Words of whole Arrow batches as numpy arrays of hashes.

A word is a run of ASCII letters and digits and of non-ASCII characters; all other ASCII characters
separate words. Work goes over the batch's text buffer in blocks of bytes, so a word or a text of
any length is taken whole while temporary arrays stay small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK, BYTES = 1 << 19, 1 << 20
_CODES = np.arange(256)
IN_WORD = (_CODES >= 128) | np.isin(_CODES, np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8))
_TABLE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_ODD = np.random.default_rng(21).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of an array without nulls, and the offsets of each."""
    texts = texts.cast(pa.large_string())
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    return raw, offsets - offsets[0]


def small(batches: Iterator[pa.RecordBatch], *columns: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about `BYTES` of text in the given columns; a longer text comes alone."""
    for batch in batches:
        sizes = sum(pc.binary_length(batch.column(k)).to_numpy(zero_copy_only=False).astype(np.int64) for k in columns)
        part = (np.cumsum(sizes) - 1) // BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in the bytes; words don't cross texts."""
    inside = IN_WORD[raw]
    edge = offsets[(offsets > 0) & (offsets < len(raw))]
    before = np.concatenate([[False], inside[:-1]])
    before[edge] = False
    after = np.concatenate([inside[1:], [False]])
    after[edge - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def hashes(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    out = np.zeros(len(starts), np.uint64)
    for a in range(0, len(raw) if len(starts) else 0, BLOCK):
        b = min(a + BLOCK, len(raw))
        first, last = max(np.searchsorted(starts, a, "right") - 1, 0), np.searchsorted(starts, b, "left")
        if first >= last:
            continue
        own = starts[first:last]
        cut = np.maximum(own - a, 0)
        place = np.arange(a + cut[0], b) - np.repeat(own, np.diff(np.append(cut, b - a)))
        part = raw[a + cut[0] : b]
        value = (part.astype(np.uint64) + np.uint64(1)) * _TABLE[place & 255]
        if place.max(initial=0) > 255:
            value *= (2 * (place >> 8) + 1).astype(np.uint64)
        value[~IN_WORD[part]] = 0
        out[first:last] += np.add.reduceat(value, cut - cut[0])
    return mixed(out)


def lower_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and where each text's words begin (and end)."""
    raw, offsets = buffer_of(pc.utf8_lower(texts))
    starts, _ = bounds(raw, offsets)
    return hashes(raw, starts), np.searchsorted(starts, offsets)


def windows(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words; empty if there are fewer."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out += words[j : j + n] * _ODD[j]
    return mixed(out)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Runs of `size` words; a shorter text is one run of all its words."""
    return windows(words, min(size, max(len(words), 1)))


def labelled(kmers: np.ndarray) -> np.ndarray:
    """Each k-mer hashed with its occurrence number, so that all are different."""
    ordered = np.sort(kmers)
    if not (ordered[1:] == ordered[:-1]).any():
        return kmers
    order = np.argsort(kmers, kind="stable")
    ranked = kmers[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    at = np.arange(len(kmers))
    nth = at - np.maximum.accumulate(np.where(new, at, 0))
    out = np.empty_like(kmers)
    out[order] = ranked + nth.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)
    return np.where(out == kmers, kmers, mixed(out))
