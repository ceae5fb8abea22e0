"""Outlines of labelled pixels, coverage simplification and burning lines.

Pixels are seen in blocks (``blocks``), outlines are traced by region. Borders
are unit edges with the region on the left; at a vertex where a region touches
itself the right turn is taken, so holes stay apart.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreline.functions import geometry as geo
from acreline.functions.codes import PIXEL_M
from acreline.operators.blocks import ABSENT, BLOCK, Block, dealt

#: Side of the squares by which shapes of one key are united first.
PIECE_M = float(BLOCK * PIXEL_M)
# directions west, south, east, north, as steps of (row, column)
_DR, _DC = np.array([0, 1, 0, -1]), np.array([-1, 0, 1, 0])


def border_edges(table: pa.Table) -> pa.Table:
    """``tile, label, e``: a block's border edges, by region, in one number each.

    Start row << 32, column << 3, direction << 1, and 1 where more than two
    borders meet at the start.
    """
    block = Block(table)
    tile, lab = block.table.column("tile")[0].as_py(), block.table.column("label").to_numpy()
    names, number = np.unique(lab, return_inverse=True)
    grid = np.pad(block.grid(number, ABSENT), 1, constant_values=ABSENT)
    nw, ne, sw, se = grid[:-1, :-1], grid[:-1, 1:], grid[1:, :-1], grid[1:, 1:]
    node = ((nw != ne).astype(np.int8) + (sw != se) + (nw != sw) + (ne != se)) > 2  # of the vertex at a pixel's upper left
    i, j, mine = (x[block.own] for x in (*block.at, number))
    out = []
    # side of a pixel: step to the neighbour, start corner, direction
    for sr, sc, dr, dc, d in ((-1, 0, 0, 1, 0), (0, -1, 0, 0, 1), (1, 0, 1, 0, 2), (0, 1, 1, 1, 3)):
        at = grid[i + 1 + sr, j + 1 + sc] != mine
        y, x = i[at] + dr, j[at] + dc
        out.append((mine[at], (y + block.r0) << 32 | (x + block.c0) << 3 | d << 1 | node[y, x]))
    mine, e = (np.concatenate(v) for v in zip(*out, strict=True))
    order = np.argsort(mine, kind="stable")
    some, first = np.unique(mine[order], return_index=True)
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(e)).astype(np.int32)), pa.array(e[order]))
    return pa.table([pa.array([tile] * len(some), pa.string()), pa.array(names[some], pa.int64()), lists], ["tile", "label", "e"])


def chain(row: np.ndarray, r: np.ndarray, c: np.ndarray, d: np.ndarray) -> Iterator[tuple[int, list[int]]]:
    """Closed rings (row, edges in order) from the directed edges of several regions."""
    height, width = int(r.max()) - int(r.min()) + 3, int(c.max()) - int(c.min()) + 3
    r, c = r - r.min() + 1, c - c.min() + 1
    place = lambda r, c, d: ((row * height + r) * width + c) * 4 + d
    start = place(r, c, d)
    order = np.argsort(start)
    keys = start[order]
    er, ec = r + _DR[d], c + _DC[d]
    after = np.full(len(r), -1)
    for turn in (3, 0, 1):
        want = place(er, ec, (d + turn) % 4)
        p = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        hit = (keys[p] == want) & (after < 0)
        after[hit] = order[p[hit]]
    after = after.tolist()
    seen = bytearray(len(after))
    for first in range(len(after)):
        if not seen[first]:
            ring, e = [], first
            while not seen[e]:
                seen[e] = 1
                ring.append(e)
                e = after[e]
            yield int(row[first]), ring


def _world(ring: np.ndarray, x0: float, y0: float, pixel: float) -> np.ndarray:
    return np.stack([x0 + ring[:, 1] * pixel, y0 - ring[:, 0] * pixel], axis=1)


def _assemble(rings: list[np.ndarray]) -> list[geo.Rings]:
    outer = [[r] for r in rings if geo.signed_area(r) > 0]
    for h in (r for r in rings if geo.signed_area(r) < 0):
        (outer[0] if len(outer) == 1 else min((p for p in outer if geo.contains([[p[0]]], *geo.interior_point([[h]]))), key=lambda p: geo.signed_area(p[0]), default=outer[0])).append(h)
    return outer


def visvalingam(points: np.ndarray, least: float, keep: int) -> np.ndarray:
    """Mask of the points that stay: those of the smallest triangles go first, below ``least``; the ends stay."""
    n = len(points)
    stay = np.ones(n, dtype=bool)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    x, y = points[:, 0].tolist(), points[:, 1].tolist()
    size = lambda i: abs((x[after[i]] - x[before[i]]) * (y[i] - y[before[i]]) - (x[i] - x[before[i]]) * (y[after[i]] - y[before[i]])) / 2
    area = [np.inf] + [size(i) for i in range(1, n - 1)] + [np.inf]
    heap = [(a, i) for i, a in enumerate(area) if a < np.inf]
    heapq.heapify(heap)
    left = n
    while heap and left > keep:
        a, i = heapq.heappop(heap)
        if not stay[i] or a != area[i]:
            continue
        if a >= least:
            break
        stay[i] = False
        left -= 1
        p, q = before[i], after[i]
        after[p], before[q] = q, p
        for j in (p, q):
            if 0 < j < n - 1:
                area[j] = max(a, size(j))
                heapq.heappush(heap, (area[j], j))
    return stay


def _stay(points: np.ndarray, least: float, keep: int) -> np.ndarray:
    """``visvalingam`` in the one of both directions that starts smaller, so that both sides of a border agree."""
    if len(points) <= 2:
        return np.ones(len(points), dtype=bool)
    there, back = points[:2].ravel().tolist(), points[:-3:-1].ravel().tolist()
    return visvalingam(points[::-1], least, keep)[::-1] if back < there else visvalingam(points, least, keep)


def simplified(ring: np.ndarray, node: np.ndarray, least: float) -> np.ndarray:
    """The corners of an open ring that stay.

    Where more than two borders meet a corner always stays; between such
    corners each stretch is simplified for itself. A ring without any begins
    at its smallest corner, from either side.
    """
    begin = int(np.flatnonzero(node)[0]) if node.any() else int(np.lexsort((ring[:, 1], ring[:, 0]))[0])
    ring, node = np.roll(ring, -begin, axis=0), np.roll(node, -begin)
    ring = np.vstack([ring, ring[:1]])
    stops = [*np.flatnonzero(node).tolist(), len(ring) - 1] if node.any() else [0, len(ring) - 1]
    stay = np.zeros(len(ring), dtype=bool)
    for a, b in zip(stops[:-1], stops[1:], strict=True):
        part = ring[a : b + 1]
        stay[a : b + 1] |= _stay(part, least, 5 if (part[0] == part[-1]).all() else 2)
    return ring[:-1][stay[:-1]]


def outlines(labels: DataFrame, pixel: float = PIXEL_M, origin: tuple[float, float] = (0.0, 0.0), tolerance: float | None = None) -> DataFrame:
    """``tile, label, geometry BINARY, area_sqm``: one polygon with holes per region.

    Blocks of pixels give border edges, and only these meet again, by region.
    With a tolerance in metres the coverage is simplified: vertices of
    triangles under its square go, on both sides of a border alike, but those
    where three borders meet. Regions that collapse are left out.
    """
    x0, y0 = origin

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            lists = batch.column(2)
            e = lists.flatten().to_numpy()
            row = np.repeat(np.arange(len(batch)), pc.list_value_length(lists).to_numpy())
            r, c, d, node = e >> 32, (e & 0xFFFFFFFF) >> 3, e >> 1 & 3, (e & 1).astype(bool)
            rings: dict[int, list[np.ndarray]] = {}
            for at, edges in chain(row, r, c, d):
                ring, way = np.stack([r[edges], c[edges]], axis=1), d[edges]
                corner = (way != np.roll(way, 1)) | (node[edges] if tolerance is not None else False)
                ring, node_here = ring[corner], node[edges][corner]
                if tolerance is not None:
                    ring = simplified(ring, node_here, (tolerance / pixel) ** 2)
                if len(ring) > 2:
                    ring = _world(np.vstack([ring, ring[:1]]), x0, y0, pixel)
                    if geo.signed_area(ring):
                        rings.setdefault(at, []).append(ring)
            made = {k: v for k in sorted(rings) if (v := _assemble(rings[k]))}
            own = pa.array(list(made), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(own), batch.column(1).take(own), pa.array([geo.encode(v) for v in made.values()], pa.binary()), pa.array([geo.area(v) for v in made.values()], pa.float64())],
                ["tile", "label", "geometry", "area_sqm"],
            )

    edges = dealt(labels.select("tile", "r", "c", "label"), 1).groupBy("tile", "_br", "_bc").applyInArrow(border_edges, "tile string, label long, e array<long>")
    whole = edges.groupBy("tile", "label").agg(F.flatten(F.collect_list("e")).alias("e"))
    return whole.mapInArrow(trace, "tile string, label long, geometry binary, area_sqm double")


def _touched(line: np.ndarray, reach: float) -> np.ndarray:
    """Cells (row, column) of a unit grid within ``reach`` of a line, by exact distance to their squares."""
    out = []
    for (xa, ya), (xb, yb) in zip(line[:-1], line[1:], strict=True):
        n = max(1, int(np.hypot(xb - xa, yb - ya) // 16) + 1)
        t = np.linspace(0, 1, n + 1)
        xs, ys = xa + t * (xb - xa), ya + t * (yb - ya)
        for px, py, qx, qy in zip(xs[:-1], ys[:-1], xs[1:], ys[1:], strict=True):
            c = np.arange(np.floor(min(px, qx) - reach), np.floor(max(px, qx) + reach) + 1)
            r = np.arange(np.floor(min(py, qy) - reach), np.floor(max(py, qy) + reach) + 1)
            cc, rr = (v.ravel() for v in np.meshgrid(c, r))
            ok = _square_distance(cc, rr, px, py, qx, qy) <= reach + 1e-12
            out.append(np.stack([rr[ok], cc[ok]], axis=1))
    return np.unique(np.concatenate(out).astype(np.int64), axis=0) if out else np.empty((0, 2), dtype=np.int64)


def _square_distance(c, r, px, py, qx, qy) -> np.ndarray:  # noqa: ANN001
    dx, dy = qx - px, qy - py
    lo, hi = np.zeros(len(c)), np.ones(len(c))
    for start, step, low in ((px, dx, c), (py, dy, r)):
        if step:
            a, b = (low - start) / step, (low + 1 - start) / step
            lo, hi = np.maximum(lo, np.minimum(a, b)), np.minimum(hi, np.maximum(a, b))
        else:
            hi = np.where((start < low) | (start > low + 1), -1.0, hi)
    cuts = lo <= hi
    outside = lambda x, y: np.hypot(np.maximum(np.maximum(c - x, x - c - 1), 0), np.maximum(np.maximum(r - y, y - r - 1), 0))
    best = np.minimum(outside(px, py), outside(qx, qy))
    n2 = dx * dx + dy * dy
    for i in (0, 1):
        for j in (0, 1):
            t = np.clip(((c + i - px) * dx + (r + j - py) * dy) / n2, 0, 1) if n2 else 0.0
            best = np.minimum(best, np.hypot(c + i - px - t * dx, r + j - py - t * dy))
    return np.where(cuts, 0.0, best)


def burned(lines: DataFrame, pixel: float = PIXEL_M, origin: tuple[float, float] = (0.0, 0.0), buffer: float = 0.0) -> DataFrame:
    """``r, c`` of the pixels that lines (WKB ``geometry``), widened by ``buffer`` metres, touch."""
    x0, y0 = origin

    def burn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in batch.column(0).to_pylist():
                if w is not None:
                    for part in geo.decode(w)[1]:
                        for points in part:
                            cells = _touched((points - (x0, y0)) / (pixel, -pixel), buffer / pixel)
                            yield pa.RecordBatch.from_arrays([pa.array(cells[:, 0]), pa.array(cells[:, 1])], ["r", "c"])

    return lines.select("geometry").mapInArrow(burn, "r long, c long").distinct()


def merge_shapes(shapes: DataFrame, by: list[str]) -> DataFrame:
    """``geometry`` of rows with one key united, their borders cancelled; ``area_sqm`` summed.

    Shapes of one key meet by places of PIECE_M first, and only the unions of these in one task.
    """
    schema = shapes.select(*by).schema.add("geometry", "binary").add("area_sqm", "double")

    def unite(table: pa.Table) -> pa.Table:
        table = table.select([*by, "geometry", "area_sqm"])
        if len(table) == 1:
            return table
        made = geo.encode(geo.union_coverage([geo.decode(w)[1] for w in table.column("geometry").to_pylist()]))
        keys = {b: table.column(b).slice(0, 1) for b in by}
        return pa.table({**keys, "geometry": pa.array([made], pa.binary()), "area_sqm": pa.array([sum(table.column("area_sqm").to_pylist())], pa.float64())})

    at = lambda c: F.floor(F.col(f"_b.{c}") / PIECE_M)
    placed = shapes.select(*by, "geometry", "area_sqm", geo.wkb_bounds("geometry").alias("_b")).select(*by, "geometry", "area_sqm", at("xmin").alias("_px"), at("ymin").alias("_py"))
    return placed.groupBy(*by, "_px", "_py").applyInArrow(unite, schema).groupBy(*by).applyInArrow(unite, schema)


def with_bounds(shapes: DataFrame) -> DataFrame:
    """Plain box columns beside ``geometry``, so that scans can skip row groups."""
    return shapes.withColumn("_b", geo.wkb_bounds("geometry")).select("*", "_b.*").drop("_b")


def derive_shape(shapes: DataFrame) -> DataFrame:
    """``Shape_area, Shape_Length, INSIDE_X, INSIDE_Y`` of ``geometry``."""
    made = shapes.withColumns({"Shape_area": geo.wkb_area("geometry"), "Shape_Length": geo.wkb_length("geometry"), "_p": geo.wkb_interior_point("geometry")})
    return made.withColumns({"INSIDE_X": F.col("_p.x"), "INSIDE_Y": F.col("_p.y")}).drop("_p")
