"""Numpy core of the nearest-neighbour index: leaves, anisotropic four-bit codes, table scans."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

CODES = 16


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """Spherical k-means: unit centres of unit rows; empty centres restart at the worst rows."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near, best = np.empty(len(x), dtype=np.int64), np.empty(len(x), dtype=np.float32)
        for a in range(0, len(x), 4096):
            s = x[a : a + 4096] @ centres.T
            near[a : a + 4096], best[a : a + 4096] = s.argmax(axis=1), s.max(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        counts = np.bincount(near, minlength=k)
        empty = np.flatnonzero(counts == 0)
        sums[empty] = x[np.argsort(best)[: len(empty)]]
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres.astype(np.float32)


@dataclass
class Index:
    """``eta`` weighs the residual's part along the vector against the part across it."""

    centres: np.ndarray  # leaves x dim
    books: np.ndarray  # subspaces x CODES x width
    eta: float
    noise: float = 0.0  # typical error of a scanned inner product

    @property
    def subspaces(self) -> int:
        return len(self.books)

    def _parts(self, x: np.ndarray) -> np.ndarray:
        m, _, width = self.books.shape
        if x.shape[1] < m * width:
            x = np.pad(x, ((0, 0), (0, m * width - x.shape[1])))
        return x.reshape(len(x), m, width)

    def leaf(self, x: np.ndarray) -> np.ndarray:
        return (x @ self.centres.T).argmax(axis=1)

    def probes(self, q: np.ndarray, n: int) -> np.ndarray:
        s = q @ self.centres.T
        n = min(n, s.shape[1])
        return np.argpartition(-s, n - 1, axis=1)[:, :n]

    def assign(self, residual: np.ndarray, x: np.ndarray, passes: int = 2) -> np.ndarray:
        """Codes (rows x subspaces) by coordinate descent on the anisotropic loss.

        ``|e|^2 + (eta - 1) <e, x>^2`` for the error e = residual - code words.
        """
        r, u = self._parts(residual), self._parts(x)
        loss = ((r[:, :, None, :] - self.books[None]) ** 2).sum(axis=3)  # rows, subspaces, codes
        along = np.einsum("nmw,nmw->nm", r, u)[:, :, None] - np.einsum("nmw,mkw->nmk", u, self.books)
        codes = loss.argmin(axis=2)
        at = np.arange(len(x))
        own = np.take_along_axis(along, codes[:, :, None], axis=2)[:, :, 0]
        total = own.sum(axis=1)
        for _ in range(passes):
            for m in range(self.subspaces):
                rest = total - own[:, m]
                best = (loss[:, m] + (self.eta - 1) * (rest[:, None] + along[:, m]) ** 2).argmin(axis=1)
                codes[:, m] = best
                own[:, m] = along[at, m, best]
                total = rest + own[:, m]
        return codes.astype(np.uint8)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf and codes, two to a byte."""
        leaf = self.leaf(x)
        codes = np.concatenate([self.assign(x[a : a + 2048] - self.centres[leaf[a : a + 2048]], x[a : a + 2048]) for a in range(0, len(x), 2048)])
        return leaf, codes[:, 0::2] * CODES + codes[:, 1::2]

    def tables(self, q: np.ndarray) -> np.ndarray:
        """Per query and byte of a code the sum of its two inner products."""
        one = np.einsum("nmw,mkw->nmk", self._parts(q), self.books)
        return (one[:, 0::2, :, None] + one[:, 1::2, None, :]).reshape(len(q), self.subspaces // 2, CODES * CODES)

    def scan(self, q: np.ndarray, leaf: int, packed: np.ndarray) -> np.ndarray:
        """Approximate inner products of queries with the codes of one leaf."""
        table = self.tables(q)
        out = np.repeat((q @ self.centres[leaf])[:, None], len(packed), axis=1)
        for j in range(packed.shape[1]):
            out += table[:, j, packed[:, j]]
        return out


def fit(x: np.ndarray, leaves: int, width: int = 2, threshold: float = 0.2, rounds: int = 6) -> Index:
    """x: unit rows. ``threshold`` is the cosine from which errors along the vector count (Guo et al., 2020)."""
    dim = x.shape[1]
    m = -(-dim // width)
    m += m % 2
    eta = max(1.0, (dim - 1) * threshold**2 / (1 - threshold**2))
    centres = kmeans(x, leaves)
    index = Index(centres, np.zeros((m, CODES, width), dtype=np.float32), eta)
    residual = x - centres[index.leaf(x)]
    r, u = index._parts(residual), index._parts(x)
    rng = np.random.default_rng(1)
    index.books = np.stack([r[rng.choice(len(x), CODES, replace=len(x) < CODES), j] for j in range(m)]).astype(np.float32)
    for step in range(rounds):
        codes = np.concatenate([index.assign(residual[a : a + 2048], x[a : a + 2048], passes=1 if step else 0) for a in range(0, len(x), 2048)])
        words = index.books[np.arange(m)[None, :], codes]
        along = np.einsum("nmw,nmw->nm", r - words, u)
        total = along.sum(axis=1)
        for j in range(m):
            # least squares per code word, the other subspaces' errors fixed
            rest = total - along[:, j]
            right = r[:, j] + (eta - 1) * u[:, j] * (rest + np.einsum("nw,nw->n", r[:, j], u[:, j]))[:, None]
            left = np.eye(width)[None] + (eta - 1) * u[:, j, :, None] * u[:, j, None, :]
            a, b = np.zeros((CODES, width, width)), np.zeros((CODES, width))
            np.add.at(a, codes[:, j], left)
            np.add.at(b, codes[:, j], right)
            some = np.bincount(codes[:, j], minlength=CODES) > 0
            index.books[j, some] = np.linalg.solve(a[some], b[some][:, :, None])[:, :, 0]
    some = slice(0, 4096)
    error = index._parts(residual[some]) - index.books[np.arange(m)[None, :], index.assign(residual[some], x[some])]
    index.noise = float(np.sqrt((error**2).sum(axis=(1, 2)).mean() / dim))
    return index
