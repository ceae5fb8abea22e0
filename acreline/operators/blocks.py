"""Numpy kernels over blocks of a tile's pixels.

Pixels meet in blocks of BLOCK x BLOCK, after one exchange by (tile, block),
so a task's memory does not follow the tile. Where a kernel looks around, the
pixels near a block's border go to its neighbours too (its halo).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 1024
ABSENT = -1

_KEY = ("tile", "_br", "_bc")


def dealt(px: DataFrame, halo: int = 0) -> DataFrame:
    """px with its block ``_br, _bc``; pixels within ``halo`` of another block go there too."""
    at = lambda c, d: F.floor((F.col(c) + d) / F.lit(BLOCK)).cast("long")
    if not halo:
        return px.withColumns({"_br": at("r", 0), "_bc": at("c", 0)})
    span = lambda c: F.explode(F.sequence(at(c, -halo), at(c, halo)))
    return px.withColumn("_br", span("r")).withColumn("_bc", span("c"))


class Block:
    """One block's rows on a dense grid."""

    def __init__(self, table: pa.Table):
        self.table = table = table.combine_chunks()
        r, c = (table.column(n).to_numpy().astype(np.int64) for n in ("r", "c"))
        self.r0, self.c0 = int(r.min()), int(c.min())
        self.r, self.c = r, c
        self.at = (r - self.r0, c - self.c0)
        self.shape = (int(r.max()) - self.r0 + 1, int(c.max()) - self.c0 + 1)
        self.own = (r // BLOCK == table.column("_br")[0].as_py()) & (c // BLOCK == table.column("_bc")[0].as_py())

    def grid(self, values: np.ndarray, absent: int = 0) -> np.ndarray:
        out = np.full(self.shape, absent, dtype=np.int64)
        out[self.at] = values
        return out

    def codes(self, column: str) -> tuple[np.ndarray, int]:
        """Grid of numbers that are equal where the column is, nulls too, and how many there are; ABSENT elsewhere."""
        coded = pc.dictionary_encode(self.table.column(column).combine_chunks(), null_encoding="encode")
        coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
        return self.grid(coded.indices.to_numpy(), ABSENT), len(coded.dictionary)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component, of nodes 0 .. n-1 and edges (a, b)."""
    p = np.arange(n)
    while True:
        pa_, pb = p[a], p[b]
        apart = pa_ != pb
        if not apart.any():
            return p
        a, b, pa_, pb = a[apart], b[apart], pa_[apart], pb[apart]
        np.minimum.at(p, np.maximum(pa_, pb), np.minimum(pa_, pb))
        while True:
            q = p[p]
            if np.array_equal(p, q):
                break
            p = q


def label_grid(codes: np.ndarray) -> tuple[np.ndarray, int]:
    """4-connected components of equal codes: a grid of numbers 0 .. n-1 (ABSENT where the code is) and n."""
    valid = codes != ABSENT
    fresh = valid.copy()
    fresh[:, 1:] &= codes[:, 1:] != codes[:, :-1]
    run = np.cumsum(fresh.ravel()).reshape(codes.shape) - 1
    same = valid[1:] & (codes[1:] == codes[:-1])
    a, b = run[:-1][same], run[1:][same]
    if len(a):
        once = np.ones(len(a), dtype=bool)
        once[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        a, b = a[once], b[once]
    n = int(fresh.sum())
    root, number = np.unique(roots(n, a, b), return_inverse=True)
    out = np.full(codes.shape, ABSENT, dtype=np.int64)
    if n:
        out[valid] = number[run[valid]]
    return out, len(root)


def block_map(px: DataFrame, column: str, change: Callable[[np.ndarray, np.ndarray], np.ndarray], halo: int) -> DataFrame:
    """px with ``column`` (a whole number, or an array of them: a layer each) after ``change(grid, present)``.

    ``change`` may look ``halo`` pixels around.
    """

    def run(table: pa.Table) -> pa.Table:
        block = Block(table)
        kept = block.table.filter(pa.array(block.own)).drop_columns(["_br", "_bc"])
        at = kept.schema.get_field_index(column)
        kind = kept.schema.field(at).type
        if not block.own.any():
            return kept
        source = block.table.column(column).combine_chunks()
        layered = pa.types.is_list(kind)
        flat = source.flatten() if layered else source
        values = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(source), -1)
        present = np.zeros(block.shape, dtype=bool)
        present[block.at] = True
        made = np.empty((int(block.own.sum()), values.shape[1]), dtype=np.int64)
        spot = tuple(x[block.own] for x in block.at)
        for k in range(values.shape[1]):
            made[:, k] = change(block.grid(values[:, k]), present)[spot]
        new = pa.array(made.ravel(), kind.value_type if layered else kind)
        if layered:
            new = pa.ListArray.from_arrays(pa.array((np.arange(len(made) + 1) * values.shape[1]).astype(np.int32)), new).cast(kind)
        return kept.set_column(at, column, new)

    return dealt(px, halo).groupBy(*_KEY).applyInArrow(run, px.schema)


def pair_counts(labels: DataFrame) -> DataFrame:
    """``tile, lo, hi, sides``: pixel sides between two labels, or inside one (lo = hi)."""

    def run(table: pa.Table) -> pa.Table:
        block = Block(table)
        names, number = np.unique(block.table.column("label").to_numpy(), return_inverse=True)
        grid, own = block.grid(number, ABSENT), block.grid(block.own)
        keys = []
        for a, b, mine in ((grid[:, :-1], grid[:, 1:], own[:, :-1]), (grid[:-1], grid[1:], own[:-1])):
            met = (mine != 0) & (b != ABSENT)
            keys.append(np.minimum(a[met], b[met]) * len(names) + np.maximum(a[met], b[met]))
        key, sides = np.unique(np.concatenate(keys), return_counts=True)
        tile = pa.array([block.table.column("tile")[0].as_py()] * len(key), pa.string())
        return pa.table({"tile": tile, "lo": names[key // len(names)], "hi": names[key % len(names)], "sides": sides})

    b = F.lit(BLOCK)
    here = lambda dr, dc: F.struct((F.floor(F.col("r") / b) - dr).alias("_br"), (F.floor(F.col("c") / b) - dc).alias("_bc"))
    none = F.lit(None).cast("struct<_br:bigint,_bc:bigint>")
    # a block needs the row below it and the column right of it
    cells = F.array_compact(F.array(here(0, 0), F.when(F.col("r") % b == 0, here(1, 0)).otherwise(none), F.when(F.col("c") % b == 0, here(0, 1)).otherwise(none)))
    sent = labels.select("tile", "r", "c", "label", F.inline(cells))
    return sent.groupBy(*_KEY).applyInArrow(run, "tile string, lo long, hi long, sides long").groupBy("tile", "lo", "hi").agg(F.sum("sides").alias("sides"))


def border(column: str) -> Column:
    """Whether the next pixel along ``column`` is in another block."""
    return F.col(column) % BLOCK == BLOCK - 1
