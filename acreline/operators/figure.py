"""A comparison of two coverages as a PNG of four panels.

Ours, truth, what both cover, and what only one covers. Tasks burn their
shapes into bitmaps of the window, one per partition; the driver puts the
bitmaps together, whose size does not grow with the data.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreline.functions import geo
from acreline.functions import geometry as g

Box = tuple[float, float, float, float]
PAPER, GAP = (255, 255, 255), 8
OURS, TRUTH, BOTH = (31, 119, 180), (44, 160, 44), (90, 90, 90)


def burn(polygons: list[g.Rings], window: Box, size: int) -> np.ndarray:
    """The cells of a square grid over the window whose centres are inside (even-odd)."""
    x0, y0, x1, y1 = window
    flips = np.zeros((size, size + 1), dtype=np.uint8)
    for rings in polygons:
        for ring in rings:
            c, r = (ring[:, 0] - x0) / (x1 - x0) * size - 0.5, (y1 - ring[:, 1]) / (y1 - y0) * size - 0.5
            low, high = np.minimum(r[:-1], r[1:]), np.maximum(r[:-1], r[1:])
            first = np.clip(np.ceil(low), 0, size).astype(int)
            many = np.maximum(np.clip(np.ceil(high), 0, size).astype(int) - first, 0)
            edge = np.repeat(np.arange(len(many)), many)
            row = np.arange(len(edge)) - np.repeat(np.cumsum(many) - many, many) + first[edge]
            at = c[edge] + (row - r[edge]) / (r[edge + 1] - r[edge]) * (c[edge + 1] - c[edge])
            np.bitwise_xor.at(flips, (row, np.clip(np.ceil(at), 0, size).astype(int)), 1)
    return np.bitwise_xor.accumulate(flips, axis=1)[:, :size].astype(bool)


def burned_side(shapes: DataFrame, window: Box, size: int) -> np.ndarray:
    """The cells that any of ``shapes(geometry, xmin, ymin, xmax, ymax)`` covers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = np.zeros((size, size), dtype=bool)
        for batch in batches:
            for wkb in batch.column(0).to_pylist():
                made |= burn(g.decode(wkb)[1], window, size)
        if made.any():
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(made).tobytes()])], ["bits"])

    out = np.zeros((size, size), dtype=bool)
    seen = shapes.where(F.col("geometry").isNotNull() & geo.bbox_filter(*window)).select("geometry")
    for r in seen.mapInArrow(run, "bits binary").toLocalIterator():
        out |= np.unpackbits(np.frombuffer(r["bits"], dtype=np.uint8), count=size * size).reshape(size, size).astype(bool)
    return out


def png(image: np.ndarray, notes: dict[str, str] | None = None) -> bytes:
    """An RGB image (height, width, 3) as a PNG with text notes."""
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    height, width, _ = image.shape
    rows = np.concatenate([np.zeros((height, 1), dtype=np.uint8), image.astype(np.uint8).reshape(height, -1)], axis=1)
    texts = b"".join(chunk(b"tEXt", k.encode("latin-1") + b"\0" + v.encode("latin-1")) for k, v in (notes or {}).items())
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + texts + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def render_comparison(ours: DataFrame, truth: DataFrame, window: Box, path: str, size: int = 512) -> dict[str, float]:
    """Writes the figure; the square kilometres that both and that only one covers, by cells, are returned and noted in it."""
    a, b = burned_side(ours, window, size), burned_side(truth, window, size)
    cell = (window[2] - window[0]) * (window[3] - window[1]) / size**2 / 1e6
    found = {"km2_both": float((a & b).sum() * cell), "km2_difference": float((a ^ b).sum() * cell)}
    panels = []
    for layers in (((a, OURS),), ((b, TRUTH),), ((a & b, BOTH),), ((a & ~b, OURS), (b & ~a, TRUTH))):
        panel = np.full((size, size, 3), PAPER, dtype=np.uint8)
        for cells, colour in layers:
            panel[cells] = colour
        panels.append(panel)
    image = np.full((2 * size + GAP, 2 * size + GAP, 3), PAPER, dtype=np.uint8)
    for k, panel in enumerate(panels):
        r, c = k // 2 * (size + GAP), k % 2 * (size + GAP)
        image[r : r + size, c : c + size] = panel
    with open(path, "wb") as f:
        f.write(png(image, {"Title": "ours, truth, both, only one", **{k: f"{v:.6f}" for k, v in found.items()}}))
    return found
