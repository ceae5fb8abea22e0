"""Neighbourhood filters on classes: speckle healing and focal mode.

``px(tile, pix, r, c, v)``, or with an array of years in another ``column``.
Zero is "no class": it is never noise and never counted by the mode, but it
can heal noise. All years and rounds are done in one exchange by blocks, with
a halo as wide as what a pixel's result can depend on.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreline.operators.blocks import ABSENT, block_map, label_grid
from acreline.runtime import stored

#: How far noise looks for its new value at first; farther only in tiles where some finds none.
REACH = 16
#: Pixels whose windows are gathered at once.
CHUNK = 50_000


def sizes(grid: np.ndarray) -> np.ndarray:
    """Pixels of each non-zero pixel's component; 0 at zeros."""
    lab, n = label_grid(np.where(grid == 0, ABSENT, grid + (grid < 0)))
    count = np.append(np.bincount(lab[lab != ABSENT], minlength=n), 0)
    return count[lab]


def _circle(reach: int) -> np.ndarray:
    """Steps (row, column) within ``reach``, by (distance, row, column)."""
    d = np.arange(-reach, reach + 1)
    step = np.stack(np.meshgrid(d, d, indexing="ij"), axis=2).reshape(-1, 2)
    far = (step**2).sum(axis=1)
    order = np.lexsort((step[:, 1], step[:, 0], far))
    return step[order[(far[order] > 0) & (far[order] <= reach * reach)]]


_UNHEALED = -(1 << 31)


def heal_noise(px: DataFrame, max_pixels: int = 2, column: str = "v") -> DataFrame:
    """Components of at most ``max_pixels`` take the value of the nearest other pixel.

    Nearest by (distance, row, column). If all pixels of a tile are noise, or
    none is, it stays. Noise looks REACH far, and where some finds nothing, its
    tile is done again eight times as far. Values are above -(2^31).
    """

    def once(px: DataFrame, reach: int) -> DataFrame:
        steps = _circle(reach)

        def heal(grid: np.ndarray, present: np.ndarray) -> np.ndarray:
            size = sizes(grid)
            noise = (size > 0) & (size <= max_pixels)
            clean = present & ~noise
            out = grid.copy()
            r, c = np.nonzero(noise)
            for dr, dc in steps if clean.any() else ():
                if not len(r):
                    break
                y, x = r + dr, c + dc
                inside = (y >= 0) & (y < grid.shape[0]) & (x >= 0) & (x < grid.shape[1])
                hit = inside.copy()
                hit[inside] = clean[y[inside], x[inside]]
                out[r[hit], c[hit]] = grid[y[hit], x[hit]]
                r, c = r[~hit], c[~hit]
            out[r, c] = _UNHEALED
            return out

        return block_map(px, column, heal, reach + max_pixels)

    layered = px.schema[column].dataType.typeName() == "array"
    left = F.array_contains(column, _UNHEALED) if layered else F.col(column) == _UNHEALED
    done, reach, again = None, REACH, px
    while True:
        made = stored(once(again, reach), "healed")
        tiles = stored(made.where(left).select("tile").distinct(), "unhealed")
        if tiles.isEmpty():
            return made if done is None else done.union(made)
        good = made.join(tiles, "tile", "left_anti")
        done = good if done is None else done.union(good)
        again = again.join(tiles, "tile", "left_semi")
        span = again.groupBy("tile").agg((F.max("r") - F.min("r") + F.max("c") - F.min("c")).alias("n")).agg(F.max("n")).first()[0]
        if reach > span:  # a tile or year of nothing but noise
            old = again.select("tile", "pix", F.col(column).alias("_old"))
            kept = F.transform(F.arrays_zip(F.col(column).alias("new"), F.col("_old").alias("old")), lambda x: F.when(x["new"] == _UNHEALED, x["old"]).otherwise(x["new"])) if layered else F.when(left, F.col("_old")).otherwise(F.col(column))
            return done.union(made.join(tiles, "tile", "left_semi").join(old, ["tile", "pix"]).withColumn(column, kept.cast(px.schema[column].dataType)).select(*px.columns))
        reach *= 8


def mode_at(grid: np.ndarray, where: np.ndarray, radius: int) -> np.ndarray:
    """grid with the most frequent non-zero value of the window around each marked pixel; the smaller one of equals, 0 for none.

    The grid's edge is repeated beyond it.
    """
    padded, out = np.pad(grid, radius, mode="edge"), grid.copy()
    r, c = np.nonzero(where)
    d = np.arange(2 * radius + 1)
    dr, dc = (x.ravel()[:, None] for x in np.meshgrid(d, d, indexing="ij"))
    for a in range(0, len(r), CHUNK):
        y, x = r[a : a + CHUNK], c[a : a + CHUNK]
        seen = np.sort(padded[y + dr, x + dc], axis=0)
        run, most, best = np.zeros(len(y), dtype=np.int64), np.zeros(len(y), dtype=np.int64), np.zeros(len(y), dtype=np.int64)
        for i in range(len(seen)):
            run = np.where(seen[i] == seen[i - 1], run + 1, 1) if i else run + 1
            better = (run > most) & (seen[i] != 0)
            most, best = np.where(better, run, most), np.where(better, seen[i], best)
        out[y, x] = best
    return out


def focal_mode(px: DataFrame, radius: int, column: str = "v") -> DataFrame:
    """Every pixel's most frequent non-zero value around it.

    The window repeats the edge pixels beyond the tile; ties go to the smaller
    value; 0 where there is none. A tile is a full rectangle.
    """
    return block_map(px, column, lambda grid, present: mode_at(grid, present, radius), radius) if radius >= 1 else px


def focal_smooth(px: DataFrame, radius: int = 2, min_patch: int = 5, iterations: int = 4, final_radius: int = 0, column: str = "v") -> DataFrame:
    """Rounds of replacing components of fewer than ``min_patch`` pixels by their mode, then the mode of all."""

    def smooth(grid: np.ndarray, present: np.ndarray) -> np.ndarray:
        for _ in range(iterations if radius >= 1 else 0):
            size = sizes(grid)
            small = (size > 0) & (size < min_patch)
            if not small.any():
                break
            grid = mode_at(grid, small, radius)
        return mode_at(grid, present, final_radius) if final_radius >= 1 else grid

    return block_map(px, column, smooth, iterations * max(radius, min_patch) + final_radius)
