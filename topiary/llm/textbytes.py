"""Vectorised work on the UTF-8 bytes of many texts at once.

Words are runs of allowed bytes; as every separator is ASCII, cutting bytes
equals cutting code points. A word's 64-bit hash is a polynomial in its bytes,
taken for all words of a block from one running sum modulo 2**64, then mixed.
Blocks are cut at document ends, so memory follows the block size; only a
single longer text makes a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _table(separators) -> np.ndarray:
    t = np.ones(256, dtype=bool)
    t[list(separators)] = False
    return t


#: ``[^\x20\x09-\x0D]+``
NON_SPACE = _table([0x20, *range(0x09, 0x0E)])
#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``
ALNUM = _table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    have = 1
    while have < n:
        step = np.uint64(pow(base, have, 1 << 64))
        more = min(have, n - have)
        out[have:have + more] = out[:more] * step
        have += more
    return out


class _Powers:
    """Powers of the base and its inverse, as long as the longest block so far."""

    up = np.zeros(0, dtype=np.uint64)
    down = np.zeros(0, dtype=np.uint64)

    @classmethod
    def of(cls, n: int):
        if len(cls.up) < n:
            if n <= 2 * BLOCK:
                n = 2 * BLOCK
                cls.up, cls.down = _powers(_BASE, n), _powers(_INVERSE, n)
            else:  # one very long text: not kept
                return _powers(_BASE, n), _powers(_INVERSE, n)
        return cls.up[:n], cls.down[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def window_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of data[start:end] for each pair."""
    up, down = _Powers.of(len(data) + 1)
    run = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=run[1:])
    return mixed((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def folded(data: np.ndarray) -> np.ndarray:
    """A-Z to lower case, other bytes unchanged."""
    return _FOLD[data]


def blocks(texts: pa.Array, size: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of about ``size``
    bytes. NULL texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        end = min(end, len(texts))
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


class Words:
    """The words of a block: ``start``/``end`` byte places, ``doc`` (row in the
    block), ``hash``, and ``first``, the index of each row's first word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, table: np.ndarray):
        data = folded(data)
        inside = table[data]
        begins, finishes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        finishes[:-1] &= ~inside[1:]
        edge = offsets[:-1][offsets[:-1] < offsets[1:]]  # a row's first byte begins a word, its last ends one
        begins[edge] = inside[edge]
        edge = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        finishes[edge] = inside[edge]
        self.data = data
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(finishes) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.hash = window_hashes(data, self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    def text(self, i: int, j: int) -> bytes:
        """Words i..j-1, lower-cased, joined by a blank."""
        return b" ".join(self.data[self.start[k]:self.end[k]].tobytes() for k in range(i, j))


_STEP = [np.uint64(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3,
                                0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)]


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` word hashes (runs may cross rows; callers drop those)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.full(m, n, dtype=np.uint64)
    for k in range(n):
        h = (h ^ words[k:k + m]) * _STEP[k % len(_STEP)]
        h ^= h >> np.uint64(32)
    return mixed(h)
