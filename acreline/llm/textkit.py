"""Vectorised words, word hashes and n-gram hashes of whole Arrow text columns.

A word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z became a-z:
in UTF-8, digits, ASCII letters and every byte from 0x80. All work is done on
byte arrays in slices of a bounded size, so memory does not follow the batch;
a single long text is hashed in blocks of that size.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer text is hashed in blocks of this size.
SLICE_BYTES = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_PRIMES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_INVERSES = tuple(np.uint64(pow(int(p), -1, 1 << 64)) for p in _PRIMES)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_LIBC = ctypes.CDLL(None)


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64: a bijection that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _power(seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a seed's prime and of its inverse, up to SLICE_BYTES."""
    if seed not in _powers:
        made = []
        for base in (_PRIMES[seed], _INVERSES[seed]):
            steps = np.full(SLICE_BYTES + 1, base, dtype=np.uint64)
            steps[0] = 1
            with np.errstate(over="ignore"):
                made.append(np.cumprod(steps, dtype=np.uint64))
        _powers[seed] = (made[0], made[1])
    return _powers[seed]


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each range of ``data``; ranges are in order and do not overlap.

    Bytes are summed up in blocks; a range that runs over a block's end is put
    together from its parts.
    """
    up, down = _power(seed)
    value = np.zeros(len(start), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for a in range(0, len(data), SLICE_BYTES):
            b = min(a + SLICE_BYTES, len(data))
            total = np.zeros(b - a + 1, dtype=np.uint64)
            np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * up[: b - a], out=total[1:])
            lo, hi = int(np.searchsorted(end, a, "right")), int(np.searchsorted(start, b, "left"))
            if lo >= hi:
                continue
            s, e = np.maximum(start[lo:hi], a) - a, np.minimum(end[lo:hi], b) - a
            part = (total[e] - total[s]) * down[s]
            if start[lo] < a:  # the range before this block goes on
                part[0] *= np.uint64(pow(int(_PRIMES[seed]), a - int(start[lo]), 1 << 64))
            value[lo:hi] += part
        return mix(value + (end - start).astype(np.uint64))


def runs_of(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true in ``inside``; a run ends with its row."""
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[edge] = inside[edge]
    last[edge[1:] - 1] = inside[edge[1:] - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def release() -> None:
    """Gives memory that a batch needed back to the system; workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def text_slices(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, bytes, offsets) of slices of a string column; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    at, n = 0, len(texts)
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1)
        yield at, to - at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to
    release()


@dataclass
class Words:
    """Words of a slice, in order: owning row, byte range and two independent hashes."""

    rows: int
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    h: np.ndarray
    h2: np.ndarray | None

    def counts(self) -> np.ndarray:
        return np.bincount(self.row, minlength=self.rows)


def words(data: np.ndarray, offsets: np.ndarray, second: bool = False) -> Words:
    rows = len(offsets) - 1
    start, end = runs_of(_WORD[data], offsets)
    row = np.searchsorted(offsets, start, "right") - 1
    low = _LOWER[data]
    made = [range_hashes(low, start, end, seed) for seed in range(1 + second)]
    return Words(rows, row, start, end, made[0], made[1] if second else None)


def grams(h: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(position of the first word, hash) of each run of k words inside one row."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        g = np.full(n, k, dtype=np.uint64)
        for j in range(k):
            g = g * np.uint64(0xD6E8FEB86659FD93) + h[j : j + n]
    at = np.flatnonzero(row[:n] == row[k - 1 : k - 1 + n])
    return at, mix(g[at])


def shingle_sets(w: Words, k: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its k-word runs.

    A row of fewer words, but not none, has one: the run of all its words.
    """
    at, g = grams(w.h, w.row, k)
    owner = w.row[at]
    counts = w.counts()
    if len(short := np.flatnonzero((counts > 0) & (counts < k))):
        begin = np.searchsorted(w.row, short)
        more = np.array([grams(w.h[b : b + c], w.row[b : b + c], c)[1][0] for b, c in zip(begin, counts[short], strict=True)], dtype=np.uint64)
        owner, g = np.concatenate([owner, short]), np.concatenate([g, more])
    order = np.lexsort((g, owner))
    owner, g = owner[order], g[order]
    if len(g):
        keep = np.ones(len(g), dtype=bool)
        keep[1:] = (g[1:] != g[:-1]) | (owner[1:] != owner[:-1])
        owner, g = owner[keep], g[keep]
    return np.split(g, np.searchsorted(owner, np.arange(1, w.rows)))


def words_sql(text: str) -> str:
    """DuckDB SQL of the list of a text's words."""
    return f"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
