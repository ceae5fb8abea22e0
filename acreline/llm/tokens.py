"""Exact ids of the word-level BPE vocabulary, for whole Arrow text columns.

The vocabulary's pre-tokenizer never joins text across white space, so a text
is the concatenation of its chunks between ASCII white space, and each chunk
gives the same ids alone. A chunk is cut once more, before its closing ASCII
punctuation, where the pre-tokenizer cuts too if the character before it is a
letter or digit. These pieces repeat heavily: each is hashed, looked up in a
table of pieces seen by this worker, and only new ones go to the tokenizer.
ASCII capitals are folded before, as the tokenizer's own normaliser does.

Two kinds of chunks go to the tokenizer as they stand: those with ``<``, which
could be a special token, and those with other characters than letters or
digits right before closing punctuation.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from acreline.llm import textkit

#: Bytes of an entry of the table of pieces beside its ids.
ENTRY_BYTES = 25

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_TAIL = np.zeros(256, dtype=bool)
_TAIL[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in "'<"]] = True


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokens:
    """``limit`` bounds the bytes of the table of pieces; those unused for longest go first."""

    def __init__(self, path: str, limit: int = 32 << 20):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.limit, self.clock = limit, 0
        self.key = np.empty(0, dtype=np.uint64)  # sorted
        self.at = np.empty(0, dtype=np.int64)
        self.n = np.empty(0, dtype=np.int32)
        self.safe = np.empty(0, dtype=bool)
        self.used = np.empty(0, dtype=np.int32)
        self.flat, self.size = np.empty(1 << 16, dtype=np.uint32), 0

    def whole(self, text: str) -> np.ndarray:
        """The ids by the library alone."""
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _ids(self, pieces: list[str]) -> list[np.ndarray]:
        """Runs of letters go many at a time: each ends with the one word-end token it has."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        plain = [i for i, p in enumerate(pieces) if p.isalpha()]
        for lo in range(0, len(plain), 512):
            part = plain[lo : lo + 512]
            ids = self.whole(" ".join(pieces[i] for i in part))
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) == len(part) and cuts[-1] == len(ids):
                for i, one in zip(part, np.split(ids, cuts[:-1]), strict=True):
                    out[i] = one
        return [self.whole(p) if ids is None else ids for p, ids in zip(pieces, out, strict=True)]

    def _find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.key):
            return np.zeros(len(key), dtype=np.int64), np.zeros(len(key), dtype=bool)
        p = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return p, self.key[p] == key

    def _add(self, key: np.ndarray, pieces: list[str]) -> None:
        ids = self._ids(pieces)
        n = np.array([len(x) for x in ids], dtype=np.int32)
        if ENTRY_BYTES * (len(self.key) + len(key)) + 4 * (self.size + int(n.sum())) > self.limit:
            self._forget()
        more = int(n.sum())
        if self.size + more > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.size], np.empty(max(more, self.size, 1 << 16), dtype=np.uint32)])
        if more:
            self.flat[self.size : self.size + more] = np.concatenate(ids)
        at = self.size + np.cumsum(n, dtype=np.int64) - n
        self.size += more
        order = np.argsort(key)
        where = np.searchsorted(self.key, key[order])
        safe = np.array([p[-1:].isalpha() or p[-1:].isdecimal() for p in pieces])
        self.key = np.insert(self.key, where, key[order])
        self.at = np.insert(self.at, where, at[order])
        self.n = np.insert(self.n, where, n[order])
        self.safe = np.insert(self.safe, where, safe[order])
        self.used = np.insert(self.used, where, self.clock)

    def _forget(self) -> None:
        if not len(self.key):
            return
        keep = (self.used > np.median(self.used)) | (self.used == self.clock)
        n, at = self.n[keep], self.at[keep]
        take = np.repeat(at - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        self.flat, self.size = self.flat[take], int(n.sum())
        self.at = np.cumsum(n, dtype=np.int64) - n
        self.key, self.n, self.safe, self.used = self.key[keep], n, self.safe[keep], self.used[keep]

    def _slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of the slice and the bounds of each row's."""
        self.clock += 1
        rows = len(offsets) - 1
        inner = ~_SPACE[data]
        c0, c1 = textkit.runs_of(inner, offsets)
        if not len(c0):
            return np.empty(0, dtype=np.uint32), np.zeros(rows + 1, dtype=np.int64)
        core = np.maximum.accumulate(np.where(inner & ~_TAIL[data], np.arange(len(data)), -1))[c1 - 1] + 1
        mid = np.maximum(core, c0)
        raw = np.zeros(len(c0), dtype=bool)
        if len(lt := np.flatnonzero(data == 60)):
            raw[np.unique(np.searchsorted(c0, lt, "right") - 1)] = True
            mid[raw] = c1[raw]
        start = np.stack([c0, mid], axis=1).ravel()
        end = np.stack([mid, c1], axis=1).ravel()
        row = np.repeat(np.searchsorted(offsets, c0, "right") - 1, 2)
        real = start < end
        chunk = np.repeat(np.arange(len(c0)), 2)[real]
        tail = np.tile([False, True], len(c0))[real]
        start, end, row = start[real], end[real], row[real]
        low = textkit._LOWER[data]
        h = textkit.range_hashes(low, start, end)
        text = lambda i, of=low: of[start[i] : end[i]].tobytes().decode("utf-8", "replace")
        if raw.any():
            for i in np.flatnonzero(raw[chunk]):
                h[i] = np.uint64(hash(("raw", text(i, data))) & (2**64 - 1))
        one, example, inverse = np.unique(h, return_index=True, return_inverse=True)
        p, found = self._find(one)
        self.used[p[found]] = self.clock
        if not found.all():
            new = np.flatnonzero(~found)
            self._add(one[new], [text(i, data if raw[chunk[i]] else low) for i in example[new]])
            p, _ = self._find(one)
        entry = p[inverse]
        odd = np.flatnonzero(tail[1:] & ~tail[:-1] & ~self.safe[entry[:-1]] & (chunk[1:] == chunk[:-1]))
        if len(odd):  # the two pieces belong together: the first gets the ids of both
            keys, pieces = [], []
            for i in odd:
                both = low[start[i] : end[i + 1]].tobytes().decode("utf-8", "replace")
                keys.append(np.uint64(hash(("both", both)) & (2**64 - 1)))
                pieces.append(both)
            key, which = np.unique(np.array(keys, dtype=np.uint64), return_index=True)
            found = self._find(key)[1]
            if not found.all():
                self._add(key[~found], [pieces[i] for i in which[~found]])
            entry = self._find(h)[0]
            entry[odd] = self._find(np.array(keys, dtype=np.uint64))[0]
        n = self.n[entry].astype(np.int64)
        n[odd + 1] = 0
        ids = self.flat[np.repeat(self.at[entry] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        bounds = np.zeros(rows + 1, dtype=np.int64)
        np.cumsum(np.bincount(row, weights=n, minlength=rows).astype(np.int64), out=bounds[1:])
        return ids, bounds

    def _long(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A long text in parts that end at white space, where the pre-tokenizer never joins text."""
        made, at = [], 0
        while at < len(data):
            to = min(at + textkit.SLICE_BYTES, len(data))
            if to < len(data):
                back = np.flatnonzero(_SPACE[data[at:to]])
                if len(back):
                    to = at + int(back[-1]) + 1
                else:  # a chunk longer than a part goes whole
                    while to < len(data) and not _SPACE[data[to]]:
                        ahead = np.flatnonzero(_SPACE[data[to : to + textkit.SLICE_BYTES]])
                        to = to + int(ahead[0]) if len(ahead) else min(to + textkit.SLICE_BYTES, len(data))
            made.append(self._slice(data[at:to], np.array([0, to - at]))[0])
            at = to
        ids = np.concatenate(made)
        return ids, np.array([0, len(ids)])

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, bounds) of slices of a column; null is empty."""
        for at, rows, data, offsets in textkit.text_slices(texts):
            yield at, *(self._long(data) if rows == 1 and len(data) > textkit.SLICE_BYTES else self._slice(data, offsets))


_made: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """One tokenizer per worker process and file."""
    if path not in _made:
        _made[path] = WordTokens(path)
    return _made[path]
