"""Numpy geometry kernels on WKB, and their Arrow column functions.

Rings are closed arrays of (x, y); outer rings run counter-clockwise. Kernels
are for polygons of modest size, many per Arrow batch.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

Rings = list[np.ndarray]


def encode_polygon(rings: Rings) -> bytes:
    out = [struct.pack("<BII", 1, 3, len(rings))]
    for r in rings:
        out += [struct.pack("<I", len(r)), np.ascontiguousarray(r, dtype="<f8").tobytes()]
    return b"".join(out)


def encode(polygons: list[Rings]) -> bytes:
    """A polygon, or a multipolygon of several."""
    if len(polygons) == 1:
        return encode_polygon(polygons[0])
    return struct.pack("<BII", 1, 6, len(polygons)) + b"".join(map(encode_polygon, polygons))


def encode_line(points: np.ndarray) -> bytes:
    return struct.pack("<BII", 1, 2, len(points)) + np.ascontiguousarray(points, dtype="<f8").tobytes()


def decode(wkb: bytes) -> tuple[int, list[Rings]]:
    """(kind, parts): 1 points, 2 lines, 3 polygons, each part a list of point arrays."""

    def read(at: int) -> tuple[int, list[Rings], int]:
        e = "<" if wkb[at] else ">"
        (kind,) = struct.unpack_from(e + "I", wkb, at + 1)
        at += 5
        points = lambda n, at: np.frombuffer(wkb, dtype=e + "f8", count=2 * n, offset=at).reshape(n, 2).astype(float)
        if kind == 1:
            return 1, [[points(1, at)]], at + 16
        (n,) = struct.unpack_from(e + "I", wkb, at)
        at += 4
        if kind == 2:
            return 2, [[points(n, at)]], at + 16 * n
        if kind == 3:
            rings = []
            for _ in range(n):
                (m,) = struct.unpack_from(e + "I", wkb, at)
                rings.append(points(m, at + 4))
                at += 4 + 16 * m
            return 3, [rings], at
        if kind in (4, 5, 6, 7):
            parts, part = [], kind - 3
            for _ in range(n):
                part, more, at = read(at)
                parts += more
            return part, parts, at
        raise ValueError(f"geometry kind {kind} is not known")

    return read(0)[:2]


def signed_area(ring: np.ndarray) -> float:
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum() / 2)


def area(polygons: list[Rings]) -> float:
    return sum(abs(signed_area(p[0])) - sum(abs(signed_area(h)) for h in p[1:]) for p in polygons if p)


def length(parts: list[Rings]) -> float:
    return sum(float(np.hypot(*np.diff(r, axis=0).T).sum()) for p in parts for r in p)


def bounds(parts: list[Rings]) -> tuple[float, float, float, float]:
    xy = np.concatenate([r for p in parts for r in p])
    return (*xy.min(axis=0).tolist(), *xy.max(axis=0).tolist())


def is_valid(polygons: list[Rings]) -> bool:
    """Closed finite rings of an area that neither cross nor run along each other; a ring may touch itself at a point."""
    rings = [r for p in polygons for r in p]
    good = bool(rings) and all(len(r) >= 4 and np.isfinite(r).all() and (r[0] == r[-1]).all() and signed_area(r) != 0 for r in rings)
    if not good:
        return False
    if len(rings) == 1 and len(rings[0]) == 5:  # four corners that all turn one way
        way = np.diff(rings[0], axis=0)
        turns = way[:, 0] * np.roll(way[:, 1], -1) - way[:, 1] * np.roll(way[:, 0], -1)
        if (turns > 0).all() or (turns < 0).all():
            return True
    edges = _odd_edges(_segments(polygons))
    if edges is None:
        return False
    if len(rings) == 1 and len(np.unique(rings[0][:-1] @ np.array([1, 1j]))) == len(rings[0]) - 1:
        return True  # one ring that neither crosses nor meets a corner of its own twice
    # rings through each other at a vertex, holes outside and parts inside of parts show in the area
    inside, own = _even_odd_area(edges), area(polygons)
    return abs(inside - own) <= 1e-9 * max(inside, own)


def _edges(polygons: list[Rings]) -> np.ndarray:
    """(x0, y0, x1, y1) of all edges that are not level, y0 < y1."""
    e = np.concatenate([np.hstack([r[:-1], r[1:]]) for p in polygons for r in p])
    e = e[e[:, 1] != e[:, 3]]
    down = e[:, 1] > e[:, 3]
    e[down] = e[down][:, [2, 3, 0, 1]]
    return e


def _crossings(edges: np.ndarray, y: float) -> np.ndarray:
    e = edges[(edges[:, 1] <= y) & (edges[:, 3] > y)]
    return np.sort(e[:, 0] + (y - e[:, 1]) / (e[:, 3] - e[:, 1]) * (e[:, 2] - e[:, 0]))


def interior_point(polygons: list[Rings]) -> tuple[float, float]:
    """A point inside: the middle of the widest run on the scanline halfway between two vertex heights."""
    edges = _edges(polygons)
    ys = np.unique(np.concatenate([edges[:, 1], edges[:, 3]]))
    mid = (ys[0] + ys[-1]) / 2
    at = min(len(ys) - 2, max(0, int(np.searchsorted(ys, mid, "right")) - 1))
    y = (ys[at] + ys[at + 1]) / 2
    x = _crossings(edges, y)
    widths = x[1::2] - x[0::2]
    k = int(widths.argmax())
    return float((x[2 * k] + x[2 * k + 1]) / 2), float(y)


def contains(polygons: list[Rings], x: float, y: float) -> bool:
    return bool((_crossings(_edges(polygons), y) < x).sum() % 2)


def intersection_area(a: list[Rings], b: list[Rings]) -> float:
    """Exact by slabs: between vertex and crossing heights the overlap is linear in y."""
    ax0, ay0, ax1, ay1 = bounds(a)
    bx0, by0, bx1, by1 = bounds(b)
    if ax0 >= bx1 or bx0 >= ax1 or ay0 >= by1 or by0 >= ay1:
        return 0.0
    ea, eb = _edges(a), _edges(b)
    lo, hi = max(ay0, by0), min(ay1, by1)
    ea, eb = (e[(e[:, 1] < hi) & (e[:, 3] > lo)] for e in (ea, eb))
    ys = [ea[:, 1], ea[:, 3], eb[:, 1], eb[:, 3]]
    if len(ea) and len(eb):
        p, r = ea[:, None, :2], ea[:, None, 2:] - ea[:, None, :2]
        q, s = eb[None, :, :2], eb[None, :, 2:] - eb[None, :, :2]
        cross = r[..., 0] * s[..., 1] - r[..., 1] * s[..., 0]
        d = q - p
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (d[..., 0] * s[..., 1] - d[..., 1] * s[..., 0]) / cross
            u = (d[..., 0] * r[..., 1] - d[..., 1] * r[..., 0]) / cross
            y = p[..., 1] + t * r[..., 1]
        ys.append(y[(cross != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)])
    ys = np.unique(np.clip(np.concatenate(ys), lo, hi))
    total = 0.0
    for y0, y1 in zip(ys[:-1], ys[1:], strict=True):
        y = (y0 + y1) / 2
        xa, xb = _crossings(ea, y), _crossings(eb, y)
        if len(xa) and len(xb):
            left = np.maximum(xa[0::2][:, None], xb[0::2][None])
            right = np.minimum(xa[1::2][:, None], xb[1::2][None])
            total += float(np.maximum(right - left, 0).sum() * (y1 - y0))
    return total


class _Cells:
    """Segments by the square cells that they pass, about as wide as a segment is long."""

    def __init__(self, s: np.ndarray):
        way = s[:, 2:] - s[:, :2]
        long = np.hypot(way[:, 0], way[:, 1])
        self.width, self.origin = float(long.mean()) or 1.0, s.reshape(-1, 2).min(axis=0) - 1e-6 * long.max()
        self.row = int(((s.reshape(-1, 2).max(axis=0) - self.origin)[0] + 1e-6 * long.max()) // self.width) + 3
        pieces = np.maximum(1, np.ceil(long / (0.9 * self.width))).astype(np.int64)
        i = np.repeat(np.arange(len(s)), pieces)
        j = np.arange(len(i)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        ends = [s[i, :2] + ((j + k) / pieces[i])[:, None] * way[i] for k in (0, 1)]
        slack = (2e-9 * long[i] + 1e-9 * self.width)[:, None]
        low, high = (np.floor((v - self.origin) / self.width).astype(np.int64) for v in (np.minimum(*ends) - slack, np.maximum(*ends) + slack))
        keys, which = [], []
        most = (high - low).max(axis=0, initial=0)
        for dx in range(int(most[0]) + 1):
            for dy in range(int(most[1]) + 1):
                met = (low[:, 0] + dx <= high[:, 0]) & (low[:, 1] + dy <= high[:, 1])
                keys.append((low[met, 1] + dy) * self.row + low[met, 0] + dx)
                which.append(i[met])
        key, which = np.concatenate(keys), np.concatenate(which)
        order = np.lexsort((which, key))
        key, which = key[order], which[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (which[1:] != which[:-1])
        self.key, self.which = key[new], which[new]

    def of(self, points: np.ndarray) -> np.ndarray:
        at = np.floor((points - self.origin) / self.width).astype(np.int64)
        return at[:, 1] * self.row + at[:, 0]

    def met(self, cells: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(number of a cell in ``cells``, segment) in blocks of about ``most``."""
        begin, end = np.searchsorted(self.key, cells), np.searchsorted(self.key, cells, "right")
        total = np.cumsum(end - begin)
        a = 0
        while a < len(cells):
            b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + most, "right")))
            n = end[a:b] - begin[a:b]
            yield np.repeat(np.arange(a, b), n), self.which[np.repeat(begin[a:b] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            a = b


def _points_on(s: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, point, share of the way) of the points inside of segments."""
    cells = _Cells(s)
    found = []
    for j, i in cells.met(cells.of(points)):
        d, v = s[i, 2:] - s[i, :2], points[j] - s[i, :2]
        n2 = (d * d).sum(axis=1)
        t = (v * d).sum(axis=1) / n2
        on = (np.abs(v[:, 0] * d[:, 1] - v[:, 1] * d[:, 0]) <= 1e-9 * n2) & (t > 0) & (t < 1)
        found.append((i[on], j[on], t[on]))
    return tuple(np.concatenate(v) for v in zip(*found, strict=True))


def union_coverage(shapes: list[list[Rings]]) -> list[Rings]:
    """Union of polygons that touch but do not overlap: shared stretches of border cancel."""
    s = _segments([p for shape in shapes for p in shape])
    s = s[(s[:, :2] != s[:, 2:]).any(axis=1)]
    names, number = np.unique(np.concatenate([s[:, 0] + 1j * s[:, 1], s[:, 2] + 1j * s[:, 3]]), return_inverse=True)
    points = np.stack([names.real, names.imag], axis=1)
    which, inner, t = _points_on(s, points)
    every = np.concatenate([np.arange(len(s)), which, np.arange(len(s))])
    stop = np.concatenate([number[: len(s)], inner, number[len(s) :]])
    order = np.lexsort((np.concatenate([np.zeros(len(s)), t, np.ones(len(s))]), every))
    every, stop = every[order], stop[order]
    same = every[1:] == every[:-1]
    p, q = stop[:-1][same], stop[1:][same]
    key, at = np.unique(np.minimum(p, q) * len(points) + np.maximum(p, q), return_inverse=True)
    times = np.bincount(at, weights=np.where(p < q, 1, -1)).astype(np.int64)
    key, times = np.repeat(key, np.abs(times)), np.repeat(times, np.abs(times))
    p, q = key // len(points), key % len(points)
    p, q = np.where(times > 0, p, q), np.where(times > 0, q, p)
    after = _successors(p, q, points)
    if after is None:  # shapes that overlap
        return _polygons(((tuple(a), tuple(b)) for a, b in zip(points[p].tolist(), points[q].tolist(), strict=True)), left=False)
    return _housed([points[p[np.array([*ring, ring[0]])]] for ring in _cycles(after)])


def _successors(p: np.ndarray, q: np.ndarray, points: np.ndarray) -> np.ndarray | None:
    """The edge that follows each edge ``p -> q`` by the sharpest right turn; None if two would have the same."""
    order = np.argsort(p, kind="stable")
    begin, end = np.searchsorted(p[order], q), np.searchsorted(p[order], q, "right")
    n = end - begin
    if not n.all():
        return None
    after = order[begin]
    many = n > 1
    n = n[many]
    i = np.repeat(np.flatnonzero(many), n)
    j = order[np.repeat(begin[many] - np.cumsum(n) + n, n) + np.arange(len(i))]
    way = points[q] - points[p]
    way = np.arctan2(way[:, 1], way[:, 0])
    best = np.lexsort(((way[j] - way[i] + np.pi) % (2 * np.pi), i))
    first = np.ones(len(i), dtype=bool)
    first[1:] = i[best][1:] != i[best][:-1]
    after[i[best][first]] = j[best][first]
    return after if (np.bincount(after, minlength=len(p)) == 1).all() else None


def _cycles(after: np.ndarray) -> Iterator[list[int]]:
    then, seen = after.tolist(), bytearray(len(after))
    for first in range(len(then)):
        if not seen[first]:
            ring, e = [], first
            while not seen[e]:
                seen[e] = 1
                ring.append(e)
                e = then[e]
            yield ring


def _polygons(edges: Iterable[tuple[tuple, tuple]], left: bool) -> list[Rings]:
    """Polygons of directed edges with the inside on their left.

    Where borders touch the sharpest right turn keeps holes apart, the sharpest
    left turn (``left``) keeps polygons apart.
    """
    after: dict[tuple, list[tuple]] = {}
    for p, q in edges:
        after.setdefault(p, []).append(q)
    rings = []
    while after:
        start = next(iter(after))
        ring, before = [start], None
        while True:
            here = ring[-1]
            choices = after[here]
            if before is not None and len(choices) > 1:
                a = np.arctan2(here[1] - before[1], here[0] - before[0])
                choices.sort(key=lambda q: (np.arctan2(q[1] - here[1], q[0] - here[0]) - a + np.pi) % (2 * np.pi), reverse=not left)
            q = choices.pop()
            if not choices:
                del after[here]
            before = here
            ring.append(q)
            if q == start:
                break
        rings += [np.array(r) for r in (_loops(ring) if left else [ring])]
    return _housed(rings)


def _housed(rings: Rings) -> list[Rings]:
    """Polygons of outer rings, and of holes each in the smallest that it is inside of."""
    size = [signed_area(r) for r in rings]
    outer, holes = [r for r, a in zip(rings, size, strict=True) if a > 0], [r for r, a in zip(rings, size, strict=True) if a < 0]
    made = [[r] for r in outer]
    for h, home in zip(holes, _homes(outer, holes), strict=True):
        if home < 0:  # not settled by what is next to it
            mid = (h[0] + h[1]) / 2 + 1e-6 * np.array([h[1, 1] - h[0, 1], h[0, 0] - h[1, 0]])
            inside = [k for k, r in enumerate(outer) if contains([[r]], *mid)] or range(len(outer))
            home = min(inside, key=lambda k: signed_area(outer[k]))
        made[home].append(h)
    return made


def _homes(outer: Rings, holes: Rings) -> list[int]:
    """The outer ring around each hole, or -1.

    What is next on the left of a hole's left end is the border of its own
    polygon: the outer ring, or another hole of that, which has the same home.
    """
    if len(outer) == 1 or not holes:
        return [0] * len(holes)
    rings = [*outer, *holes]
    s, owner = _segments([rings]), np.repeat(np.arange(len(rings)), [len(r) - 1 for r in rings])
    steep = s[:, 1] != s[:, 3]
    s, owner = s[steep], owner[steep]
    down = s[:, 1] > s[:, 3]
    s[down] = s[down][:, [2, 3, 0, 1]]
    cross = lambda i, y: s[i, 0] + (y - s[i, 1]) / (s[i, 3] - s[i, 1]) * (s[i, 2] - s[i, 0])
    order = np.lexsort((s[:, 0] + s[:, 2], owner))
    left = order[np.searchsorted(owner[order], np.arange(len(rings)))]
    y = (s[left, 1] + s[left, 3]) / 2
    own = np.flatnonzero((s[:, 1] <= y[owner]) & (y[owner] < s[:, 3]))
    x = np.full(len(rings), np.inf)
    np.minimum.at(x, owner[own], cross(own, y[owner[own]]))
    beside = np.arange(len(rings))
    cells = _Cells(s)
    some = np.unique(cells.key)
    todo = np.arange(len(outer), len(rings))
    at = cells.of(np.stack([x, y], axis=1))[todo]
    while len(todo):
        best = np.full(len(todo), -np.inf)
        ring = np.full(len(todo), -1)
        for k, i in cells.met(at):
            here, mine = y[todo[k]], todo[k]
            ok = (s[i, 1] <= here) & (here < s[i, 3]) & (owner[i] != mine)
            k, i, mine = k[ok], i[ok], mine[ok]
            where = cross(i, y[mine])
            ok = (where < x[mine]) & (where >= cells.origin[0] + at[k] % cells.row * cells.width)
            k, i, where = k[ok], i[ok], where[ok]
            order = np.lexsort((where, k))
            last = np.ones(len(k), dtype=bool)
            last[:-1] = k[order][1:] != k[order][:-1]
            best[k[order][last]], ring[k[order][last]] = where[order][last], owner[i[order][last]]
        found = ring >= 0
        beside[todo[found]] = ring[found]
        before = np.searchsorted(some, at) - 1  # the next cell on the left that holds anything
        go = ~found & (before >= 0)
        go &= some[before] // cells.row == at // cells.row
        todo, at = todo[go], some[before[go]]
    for _ in range(len(rings).bit_length() + 1):
        beside = beside[beside]
    home = beside[len(outer) :]
    return np.where(home < len(outer), home, -1).tolist()


def _loops(ring: list[tuple]) -> list[list[tuple]]:
    """A closed walk cut where it meets itself."""
    out, path, at = [], [], {}
    for p in ring:
        if p in at:
            loop = path[at[p] :]
            for q in loop[1:]:
                del at[q]
            del path[at[p] + 1 :]
            out.append([*loop, p])
        else:
            at[p] = len(path)
            path.append(p)
    return out


def boundary_samples(parts: list[Rings], pitch: float) -> np.ndarray:
    """At least four evenly spaced points along the whole border."""
    segs = np.concatenate([np.hstack([r[:-1], r[1:]]) for p in parts for r in p])
    lengths = np.hypot(segs[:, 2] - segs[:, 0], segs[:, 3] - segs[:, 1])
    total = lengths.sum()
    n = max(4, int(total / pitch))
    at = np.arange(n) * total / n
    ends = np.cumsum(lengths)
    k = np.minimum(np.searchsorted(ends, at, "right"), len(segs) - 1)
    t = np.divide(at - (ends[k] - lengths[k]), lengths[k], out=np.zeros(n), where=lengths[k] > 0)
    return segs[k, :2] + t[:, None] * (segs[k, 2:] - segs[k, :2])


def distance_to(points: np.ndarray, parts: list[Rings]) -> np.ndarray:
    """Distance of points to the nearest border segment."""
    segs = np.concatenate([np.hstack([r[:-1], r[1:]]) for p in parts for r in p])
    a, d = segs[None, :, :2], (segs[:, 2:] - segs[:, :2])[None]
    n2 = (d**2).sum(axis=2)
    v = points[:, None] - a
    t = np.clip(np.divide((v * d).sum(axis=2), n2, out=np.zeros(v.shape[:2]), where=n2 > 0), 0, 1)
    return np.sqrt(((v - t[..., None] * d) ** 2).sum(axis=2)).min(axis=1)


def chamfer(a: list[Rings], b: list[Rings], pitch: float = 15.0) -> float | None:
    """Half the sum of the two mean distances between borders; None if one has no length."""
    if not length(a) or not length(b):
        return None
    return float((distance_to(boundary_samples(a, pitch), b).mean() + distance_to(boundary_samples(b, pitch), a).mean()) / 2)


def touches(a: list[Rings], b: list[Rings]) -> bool:
    """Whether borders meet, at a point too."""
    near = lambda s, t: distance_to(np.concatenate([r for p in s for r in p]), t).min() <= 1e-6
    return bool(near(a, b) or near(b, a))


def clip(polygons: list[Rings], x0: float, y0: float, x1: float, y1: float) -> list[Rings]:
    """Polygons cut to a box (Sutherland and Hodgman, 1974); what falls apart stays joined along the box's border."""
    out = []
    for rings in polygons:
        kept = [c for r in rings if len(c := _clip_ring(r, (x0, y0, x1, y1))) > 3 and signed_area(c)]
        if kept and len(_clip_ring(rings[0], (x0, y0, x1, y1))) > 3:
            out.append(kept)
    return out


def _clip_ring(ring: np.ndarray, box: tuple[float, float, float, float]) -> np.ndarray:
    p = ring[:-1]
    for k, edge in enumerate(box):
        axis, sign = k % 2, 1 if k < 2 else -1
        if not len(p):
            return p
        d = sign * (p[:, axis] - edge)
        if (d >= 0).all():
            continue
        q, e = np.roll(p, -1, axis=0), np.roll(d, -1)
        inside, crosses = d >= 0, (d >= 0) != (e >= 0)
        t = np.divide(d, d - e, out=np.zeros_like(d), where=crosses)
        cut = p + t[:, None] * (q - p)
        cut[:, axis] = edge
        p = np.stack([p, cut], axis=1).reshape(-1, 2)[np.stack([inside, crosses], axis=1).ravel()]
    return np.concatenate([p, p[:1]]) if len(p) > 2 else p[:0]


def _segments(parts: list[Rings]) -> np.ndarray:
    return np.concatenate([np.hstack([r[:-1], r[1:]]) for p in parts for r in p])


def _cross(a: np.ndarray, b: np.ndarray, p: np.ndarray) -> np.ndarray:
    return (b[..., 0] - a[..., 0]) * (p[..., 1] - a[..., 1]) - (b[..., 1] - a[..., 1]) * (p[..., 0] - a[..., 0])


def intersects(a: list[Rings], b: list[Rings]) -> bool:
    """Whether two polygons have a point in common, one of a border too."""
    ax0, ay0, ax1, ay1 = bounds(a)
    bx0, by0, bx1, by1 = bounds(b)
    if ax0 > bx1 or bx0 > ax1 or ay0 > by1 or by0 > ay1:
        return False
    s, t = _segments(a)[:, None], _segments(b)[None]
    near = (np.minimum(s[..., 0], s[..., 2]) <= np.maximum(t[..., 0], t[..., 2])) & (np.minimum(t[..., 0], t[..., 2]) <= np.maximum(s[..., 0], s[..., 2]))
    near &= (np.minimum(s[..., 1], s[..., 3]) <= np.maximum(t[..., 1], t[..., 3])) & (np.minimum(t[..., 1], t[..., 3]) <= np.maximum(s[..., 1], s[..., 3]))
    i, j = np.nonzero(near)
    p, q, u, v = s[i, 0, :2], s[i, 0, 2:], t[0, j, :2], t[0, j, 2:]
    if ((np.sign(_cross(p, q, u)) * np.sign(_cross(p, q, v)) <= 0) & (np.sign(_cross(u, v, p)) * np.sign(_cross(u, v, q)) <= 0)).any():
        return True
    return contains(a, *b[0][0][0]) or contains(b, *a[0][0][0])


def shared_length(a: list[Rings], b: list[Rings]) -> float:
    """Length of the border that two polygons have in common; points in common count nothing.

    Stretches are found by exact products, so coordinates should be whole
    multiples of a pixel, or vertices shared by both.
    """
    s, t = _segments(a)[:, None], _segments(b)[None]
    p, q, u, v = s[..., :2], s[..., 2:], t[..., :2], t[..., 2:]
    i, j = np.nonzero((_cross(p, q, u) == 0) & (_cross(p, q, v) == 0))
    p, q, u, v = s[i, 0, :2], s[i, 0, 2:], t[0, j, :2], t[0, j, 2:]
    way, long = q - p, np.hypot(*(q - p).T)
    along = lambda x: ((x - p) * way).sum(axis=1) / np.where(long, long, 1)
    from_, to = np.minimum(along(u), along(v)), np.maximum(along(u), along(v))
    return float(np.maximum(np.minimum(to, long) - np.maximum(from_, 0), 0).sum())


def _near_pairs(s: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of segments whose boxes meet, each once, in blocks of about ``most`` candidates."""
    low, high = np.minimum(s[:, :2], s[:, 2:]), np.maximum(s[:, :2], s[:, 2:])
    order = np.argsort(low[:, 0], kind="stable")
    low, high = low[order], high[order]
    n = np.searchsorted(low[:, 0], high[:, 0], "right") - np.arange(len(s)) - 1  # those behind it that begin before it ends
    begin = 0
    total = np.cumsum(n)
    while begin < len(s):
        end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + most, "right")))
        k = n[begin:end]
        i = np.repeat(np.arange(begin, end), k)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(k) - k, k)
        met = (low[j, 1] <= high[i, 1]) & (low[i, 1] <= high[j, 1])
        yield order[i[met]], order[j[met]]
        begin = end


def _cuts(s: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Segments and points inside of them at which others meet them; whether any two cross or run along each other."""
    which, points, crossed = [], [], False
    for i, j in _near_pairs(s):
        p, q, u, v = s[i, :2], s[i, 2:], s[j, :2], s[j, 2:]
        side = [np.sign(x) for x in (_cross(p, q, u), _cross(p, q, v), _cross(u, v, p), _cross(u, v, q))]
        through = (side[0] * side[1] < 0) & (side[2] * side[3] < 0)
        if through.any():
            crossed = True
            a, b, c, d = p[through], q[through], u[through], v[through]
            t = _cross(c, d, a) / (_cross(c, d, a) - _cross(c, d, b))
            at = a + t[:, None] * (b - a)
            which += [i[through], j[through]]
            points += [at, at]
        # ends of one on the other
        on = []
        for flat, x, a, b, k in ((side[0], u, p, q, i), (side[1], v, p, q, i), (side[2], p, u, v, j), (side[3], q, u, v, j)):
            t = ((x - a) * (b - a)).sum(axis=1)
            inner = (flat == 0) & (t > 0) & (t < ((b - a) ** 2).sum(axis=1))
            which.append(k[inner])
            points.append(x[inner])
            on.append(inner)
        level = (side[0] == 0) & (side[1] == 0)
        same = level & (((p == u).all(axis=1) & (q == v).all(axis=1)) | ((p == v).all(axis=1) & (q == u).all(axis=1)))
        crossed |= bool((same | level & (on[0] | on[1] | on[2] | on[3])).any())
    none = np.empty((0, 2))
    return np.concatenate(which) if which else np.empty(0, dtype=int), np.concatenate(points) if points else none, crossed


def _odd_edges(s: np.ndarray, repair: bool = False) -> np.ndarray | None:
    """Segments cut where they meet, less those that lie there an even number of times.

    None if any cross or run along each other, unless ``repair`` is asked for.
    """
    s = s[(s[:, :2] != s[:, 2:]).any(axis=1)]
    if not repair:
        return None if _cuts(s)[2] else s
    grid = 2.0 ** (np.ceil(np.log2(max(np.abs(s).max(initial=0.0), 1e-300))) - 40)  # some micrometres in a country
    s = np.round(s / grid) * grid
    for _ in range(8):  # a cut moves to the grid and may so meet another segment
        s = s[(s[:, :2] != s[:, 2:]).any(axis=1)]
        which, points, _crossed = _cuts(s)
        points = np.round(points / grid) * grid
        moved = (points != s[which, :2]).any(axis=1) & (points != s[which, 2:]).any(axis=1)
        if not moved.any():
            break
        which, points = which[moved], points[moved]
        every = np.concatenate([np.arange(len(s)), which, np.arange(len(s))])
        stops = np.concatenate([s[:, :2], points, s[:, 2:]])
        t = ((stops - s[every, :2]) * (s[every, 2:] - s[every, :2])).sum(axis=1)
        order = np.lexsort((t, every))
        every, stops = every[order], stops[order]
        one = every[1:] == every[:-1]
        s = np.hstack([stops[:-1][one], stops[1:][one]])
    s = s[(s[:, :2] != s[:, 2:]).any(axis=1)]
    back = (s[:, 0] > s[:, 2]) | (s[:, 0] == s[:, 2]) & (s[:, 1] > s[:, 3])
    s[back] = s[back][:, [2, 3, 0, 1]]
    s, times = np.unique(s, axis=0, return_counts=True)
    return s[times % 2 == 1]


def _inside_left(s: np.ndarray) -> np.ndarray:
    """Edges turned so that what an odd number of rings surrounds is on their left."""
    s = s.copy()
    for axis in (0, 1):  # steep edges look along x, level ones along y
        steep = np.abs(s[:, 3] - s[:, 1]) >= np.abs(s[:, 2] - s[:, 0])
        mine = np.flatnonzero(steep if axis == 0 else ~steep)
        if not len(mine):
            continue
        x, y = (s[:, [0, 2]], s[:, [1, 3]]) if axis == 0 else (s[:, [1, 3]], s[:, [0, 2]])
        low, high = y.min(axis=1), y.max(axis=1)
        mid = (s[mine, :2] + s[mine, 2:]) / 2
        my = mid[:, 1 - axis]
        odd = np.zeros(len(mine), dtype=bool)
        heights, at = np.unique(my, return_inverse=True)
        order = np.argsort(at, kind="stable")
        for height, same in zip(heights, np.split(order, np.cumsum(np.bincount(at))[:-1]), strict=True):
            met = np.flatnonzero((low <= height) & (height < high))
            where = x[met, 0] + (height - y[met, 0]) / (y[met, 1] - y[met, 0]) * (x[met, 1] - x[met, 0])
            own = where[np.searchsorted(met, mine[same])]
            odd[same] = (len(met) - np.searchsorted(np.sort(where), own, "right")) % 2
        up = (y[mine, 1] > y[mine, 0]) if axis == 0 else (y[mine, 1] < y[mine, 0])
        # beyond an edge that goes up lies its right side
        turn = mine[up == odd]
        s[turn] = s[turn][:, [2, 3, 0, 1]]
    return s


def _even_odd_area(edges: np.ndarray) -> float:
    s = _inside_left(edges)
    s = s - np.tile(s[0, :2], 2)
    return float((s[:, 0] * s[:, 3] - s[:, 2] * s[:, 1]).sum() / 2)


def repaired(polygons: list[Rings]) -> list[Rings]:
    """Valid polygons of what an odd number of rings surrounds; empty if nothing is.

    Rings are cut where they meet, stretches that lie on each other in pairs
    go, and what touches at a point only becomes polygons of their own. Points
    that are not finite and unclosed ends are mended first. Coordinates of
    shapes that are valid already stay as they are; others come to a grid of
    2**-40 of the largest.
    """
    rings = [r[np.isfinite(r).all(axis=1)] for p in polygons for r in p]
    closed = [np.concatenate([r, r[:1]]) for r in rings if len(r) > 2]
    if not closed:
        return []
    edges = _odd_edges(_segments([closed]), repair=True)
    if not len(edges):
        return []
    pairs = [((a, b), (c, d)) for a, b, c, d in _inside_left(edges).tolist()]
    return _polygons(pairs, left=True)


def box_ring(x0: float, y0: float, x1: float, y1: float) -> list[Rings]:
    return [[np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)], dtype=float)]]


def _doubles(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


def _each(column: pa.Array, f) -> list:  # noqa: ANN001
    return [None if w is None else f(decode(w)[1]) for w in column.to_pylist()]


@F.arrow_udf(T.DoubleType())
def wkb_area(g: pa.Array) -> pa.Array:
    return pa.array(_each(g, area), pa.float64())


@F.arrow_udf(T.DoubleType())
def wkb_length(g: pa.Array) -> pa.Array:
    return pa.array(_each(g, length), pa.float64())


@F.arrow_udf(T.BooleanType())
def wkb_valid(g: pa.Array) -> pa.Array:
    return pa.array(_each(g, is_valid), pa.bool_())


@F.arrow_udf(T.BinaryType())
def wkb_repaired(g: pa.Array) -> pa.Array:
    """Polygons made valid, null if nothing is left; valid ones, lines and points stay as they are."""

    def one(wkb: bytes) -> bytes | None:
        kind, parts = decode(wkb)
        if kind != 3 or is_valid(parts):
            return wkb
        made = repaired(parts)
        return encode(made) if made else None

    return pa.array([None if w is None else one(w) for w in g.to_pylist()], pa.binary())


@F.arrow_udf(_doubles("xmin", "ymin", "xmax", "ymax"))
def wkb_bounds(g: pa.Array) -> pa.Array:
    return pa.array(_each(g, lambda p: dict(zip(("xmin", "ymin", "xmax", "ymax"), bounds(p), strict=True))), pa.struct([(c, pa.float64()) for c in ("xmin", "ymin", "xmax", "ymax")]))


@F.arrow_udf(_doubles("x", "y"))
def wkb_interior_point(g: pa.Array) -> pa.Array:
    return pa.array(_each(g, lambda p: dict(zip(("x", "y"), interior_point(p), strict=True))), pa.struct([("x", pa.float64()), ("y", pa.float64())]))


@F.arrow_udf(T.BooleanType())
def wkb_contains(g: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
    return pa.array([None if w is None else contains(decode(w)[1], a, b) for w, a, b in zip(g.to_pylist(), x.to_pylist(), y.to_pylist(), strict=True)], pa.bool_())


@F.arrow_udf(T.DoubleType())
def wkb_intersection_area(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([None if v is None or w is None else intersection_area(decode(v)[1], decode(w)[1]) for v, w in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.float64())


def _rows(*columns: pa.Array):  # noqa: ANN202
    """Rows without nulls, or None."""
    return (None if any(v is None for v in row) else row for row in zip(*(c.to_pylist() for c in columns), strict=True))


@F.arrow_udf(T.BooleanType())
def wkb_meets_box(g: pa.Array, x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
    return pa.array([None if r is None else intersects(decode(r[0])[1], box_ring(*r[1:])) for r in _rows(g, x0, y0, x1, y1)], pa.bool_())


@F.arrow_udf(T.DoubleType())
def wkb_area_in_box(g: pa.Array, x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
    return pa.array([None if r is None else area(clip(decode(r[0])[1], *r[1:])) for r in _rows(g, x0, y0, x1, y1)], pa.float64())


@F.arrow_udf(T.DoubleType())
def wkb_overlap_in_box(a: pa.Array, b: pa.Array, x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
    def one(r: tuple) -> float:
        u, v = (clip(decode(w)[1], *r[2:]) for w in r[:2])
        return intersection_area(u, v) if u and v else 0.0

    return pa.array([None if r is None else one(r) for r in _rows(a, b, x0, y0, x1, y1)], pa.float64())


@F.arrow_udf(T.BinaryType())
def wkb_clip(g: pa.Array, x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
    """The part inside a box; null if it has no area."""

    def one(r: tuple) -> bytes | None:
        made = clip(decode(r[0])[1], *r[1:])
        return encode(made) if made else None

    return pa.array([None if r is None else one(r) for r in _rows(g, x0, y0, x1, y1)], pa.binary())


@F.arrow_udf(T.DoubleType())
def wkb_chamfer(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([None if v is None or w is None else chamfer(decode(v)[1], decode(w)[1]) for v, w in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.float64())


@F.arrow_udf(T.ArrayType(T.BinaryType()))
def wkb_parts(g: pa.Array) -> pa.Array:
    """A multipolygon's polygons; other kinds give none."""
    return pa.array([None if w is None else [encode_polygon(p) for p in decode(w)[1]] if decode(w)[0] == 3 else [] for w in g.to_pylist()], pa.list_(pa.binary()))


@F.arrow_udf(T.BooleanType())
def wkb_touches(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([None if v is None or w is None else touches(decode(v)[1], decode(w)[1]) for v, w in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.bool_())


@F.arrow_udf(T.DoubleType())
def wkb_shared_length(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([None if v is None or w is None else shared_length(decode(v)[1], decode(w)[1]) for v, w in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.float64())


def lon_lat(points: np.ndarray, rounds: int = 6) -> np.ndarray:
    """Albers metres to degrees."""
    from acreline.functions import geo

    n, c, rho0 = geo.albers_constants()
    x, dy = points[:, 0], rho0 - points[:, 1]
    q = (c - (x * x + dy * dy) * (n * n) / (geo.A * geo.A)) / n
    phi = np.arcsin(q / 2)
    for _ in range(rounds):
        s = np.sin(phi)
        w = 1 - geo._E2 * s * s
        phi = phi + w * w / (2 * np.cos(phi)) * (q / (1 - geo._E2) - s / w + np.log((1 - geo._E * s) / (1 + geo._E * s)) / (2 * geo._E))
    return np.stack([geo.LON0 + np.degrees(np.arctan2(x, dy)) / n, np.degrees(phi)], axis=1)


@F.arrow_udf(T.BinaryType())
def wkb_lon_lat(g: pa.Array) -> pa.Array:
    """Polygons in degrees."""
    return pa.array([None if w is None else encode([[lon_lat(r) for r in p] for p in decode(w)[1]]) for w in g.to_pylist()], pa.binary())


def project(points: np.ndarray) -> np.ndarray:
    """Degrees to Albers metres; the inverse of ``lon_lat``."""
    from acreline.functions import geo

    n, c, rho0 = geo.albers_constants()
    s = np.sin(np.radians(points[:, 1]))
    q = (1 - geo._E2) * (s / (1 - geo._E2 * s * s) - np.log((1 - geo._E * s) / (1 + geo._E * s)) / (2 * geo._E))
    rho, theta = geo.A * np.sqrt(c - n * q) / n, n * np.radians(points[:, 0] - geo.LON0)
    return np.stack([rho * np.sin(theta), rho0 - rho * np.cos(theta)], axis=1)


def encode_lines(parts: list[np.ndarray]) -> bytes:
    """A line, or a multiline of several."""
    if len(parts) == 1:
        return encode_line(parts[0])
    return struct.pack("<BII", 1, 5, len(parts)) + b"".join(map(encode_line, parts))


@F.arrow_udf(T.BinaryType())
def wkb_albers(g: pa.Array) -> pa.Array:
    """Lines or polygons in degrees, in Albers metres."""

    def one(wkb: bytes) -> bytes:
        kind, parts = decode(wkb)
        moved = [[project(r) for r in p] for p in parts]
        return encode_lines([r for p in moved for r in p]) if kind == 2 else encode(moved)

    return pa.array([None if w is None else one(w) for w in g.to_pylist()], pa.binary())
