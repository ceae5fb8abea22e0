import gzip
import json
import struct

import numpy as np
import pytest

from acreline.functions import geometry as g
from acreline.operators import mapfiles as m


def square(x, y, s):
    return np.array([(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)], dtype=float)


SHAPES = [
    (1, "a", 1.5, True, [[square(-100, 40, 0.5), square(-99.9, 40.1, 0.1)[::-1]]]),
    (2, None, None, False, [[square(-98, 41, 0.25)], [square(-97, 41, 0.25)]]),
    (3, "ü", 2.5, None, [[square(-90, 35, 0.00001)]]),
]


@pytest.fixture(scope="module")
def shapes(spark):
    rows = [(i, t, d, b, bytearray(g.encode(p))) for i, t, d, b, p in SHAPES]
    return spark.createDataFrame([*rows, (4, "none", 0.0, True, None)], "id long, name string, acres double, ok boolean, geometry binary")


class Flat:
    """Reads tables of a flatbuffer."""

    def __init__(self, b, at):
        self.b, self.at = b, at
        self.v = at - struct.unpack_from("<i", b, at)[0]

    def place(self, slot):
        if 4 + 2 * slot >= struct.unpack_from("<H", self.b, self.v)[0]:
            return 0
        p = struct.unpack_from("<H", self.b, self.v + 4 + 2 * slot)[0]
        return p and self.at + p

    def get(self, slot, f):
        p = self.place(slot)
        size = struct.calcsize(f)
        assert p % size == 0
        return struct.unpack_from(f, self.b, p)[0] if p else None

    def target(self, slot):
        p = self.place(slot)
        return p and p + struct.unpack_from("<I", self.b, p)[0]

    def table(self, slot):
        return Flat(self.b, self.target(slot))

    def tables(self, slot):
        t = self.target(slot)
        n = struct.unpack_from("<I", self.b, t)[0] if t else 0
        return [Flat(self.b, t + 4 + 4 * i + struct.unpack_from("<I", self.b, t + 4 + 4 * i)[0]) for i in range(n)]

    def vector(self, slot, dtype):
        t = self.target(slot)
        assert (t + 4) % np.dtype(dtype).itemsize == 0
        return np.frombuffer(self.b, dtype, struct.unpack_from("<I", self.b, t)[0], t + 4)

    def text(self, slot):
        return self.vector(slot, "<u1").tobytes().decode()


def buffers(data):
    at = 8
    while at < len(data):
        n = 4 + struct.unpack_from("<I", data, at)[0]
        b = data[at : at + n]
        yield Flat(b, 4 + struct.unpack_from("<I", b, 4)[0])
        at += n
    assert at == len(data)


def test_flatgeobuf_round_trip(shapes, tmp_path):
    assert m.write_flatgeobuf(shapes, str(tmp_path / "x.fgb")) == 3
    data = (tmp_path / "x.fgb").read_bytes()
    assert data[:8] == bytes([0x66, 0x67, 0x62, 3, 0x66, 0x67, 0x62, 0])
    head, *features = buffers(data)
    assert head.text(0) == "fields" and head.get(2, "<B") == 6 and head.get(8, "<Q") == 3 and head.get(9, "<H") == 0
    assert [(c.text(0), c.get(1, "<B")) for c in head.tables(7)] == [("id", 7), ("name", 11), ("acres", 10), ("ok", 2)]
    assert head.table(10).text(0) == "EPSG" and head.table(10).get(1, "<i") == 4326
    got = {}
    for f in features:
        p, at, row = f.vector(1, "<u1").tobytes(), 0, {}
        while at < len(p):
            (k,) = struct.unpack_from("<H", p, at)
            at += 2
            if k == 1:
                (n,) = struct.unpack_from("<I", p, at)
                row[k] = p[at + 4 : at + 4 + n].decode()
                at += 4 + n
            else:
                kind = {0: "<q", 2: "<d", 3: "<?"}[k]
                row[k] = struct.unpack_from(kind, p, at)[0]
                at += struct.calcsize(kind)
        parts = []
        for part in f.table(0).tables(7):
            xy = part.vector(1, "<f8").reshape(-1, 2)
            ends = part.vector(0, "<u4").tolist() if part.target(0) else [len(xy)]
            parts.append([xy[a:b] for a, b in zip([0, *ends], ends, strict=False)])
        got[row.pop(0)] = (row, parts)
    for i, t, d, b, want in SHAPES:
        row, parts = got[i]
        assert row == {k: v for k, v in ((1, t), (2, d), (3, b)) if v is not None}
        assert all(np.array_equal(x, y) for p, q in zip(parts, want, strict=True) for x, y in zip(p, q, strict=True))


def varints(b):
    out, n, shift = [], 0, 0
    for x in b:
        n |= (x & 0x7F) << shift
        shift += 7
        if x < 0x80:
            out.append(n)
            n = shift = 0
    return out


def message(b):
    at, out = 0, []

    def number():
        nonlocal at
        n = shift = 0
        while True:
            x = b[at]
            at += 1
            n |= (x & 0x7F) << shift
            shift += 7
            if x < 0x80:
                return n

    while at < len(b):
        tag = number()
        if tag & 7 == 2:
            n = number()
            out.append((tag >> 3, b[at : at + n]))
            at += n
        elif tag & 7 == 1:
            out.append((tag >> 3, b[at : at + 8]))
            at += 8
        else:
            out.append((tag >> 3, number()))
    return out


def entries(raw):
    n, *v = varints(gzip.decompress(raw))
    ids, runs, sizes, offsets, at = np.cumsum(v[:n]).tolist(), v[n : 2 * n], v[2 * n : 3 * n], v[3 * n :], 0
    out = []
    for t, r, s, o in zip(ids, runs, sizes, offsets, strict=True):
        at = o - 1 if o else at
        out.append((t, at, s, r))
        at += s
    return out


def read_archive(path):
    b = path.read_bytes()
    head = struct.unpack_from("<7sB8Q3Q6B4iB2i", b)
    part = lambda i: b[head[2 + 2 * i] : head[2 + 2 * i] + head[3 + 2 * i]]
    found = {}

    def walk(rows):
        for t, at, n, run in rows:
            if run == 0:
                walk(entries(part(2)[at : at + n]))
            for k in range(run):
                found[t + k] = gzip.decompress(part(3)[at : at + n])

    walk(entries(part(0)))
    return head, json.loads(gzip.decompress(part(1))), found


def decoded(tile):
    """(properties, rings) of a tile's features."""
    ((number, layer),) = message(tile)
    assert number == 3
    layer = message(layer)
    assert dict(layer)[15] == 2 and dict(layer)[5] == 4096
    keys = [v.decode() for k, v in layer if k == 3]
    values = [message(v)[0] for k, v in layer if k == 4]
    value = lambda v: {1: lambda x: x.decode(), 3: lambda x: struct.unpack("<d", x)[0], 6: lambda x: (x >> 1) ^ -(x & 1), 7: bool}[v[0]](v[1])
    for k, f in layer:
        if k != 2:
            continue
        f = dict(message(f))
        assert f[3] == 3
        tags = varints(f[2])
        row = {keys[a]: value(values[b]) for a, b in zip(tags[::2], tags[1::2], strict=True)}
        g_, at, pos, rings = varints(f[4]), 0, np.zeros(2, dtype=int), []
        while at < len(g_):
            op, n = g_[at] & 7, g_[at] >> 3
            at += 1
            if op == 7:
                rings[-1].append(rings[-1][0])
                continue
            for _ in range(n):
                pos = pos + [(v >> 1) ^ -(v & 1) for v in g_[at : at + 2]]
                at += 2
                rings.append([pos]) if op == 1 else rings[-1].append(pos)
        yield row, [np.array(r, dtype=float) for r in rings]


def test_tile_numbers():
    assert [m.tile_id(0, 0, 0), m.tile_id(1, 0, 0), m.tile_id(1, 0, 1), m.tile_id(1, 1, 1), m.tile_id(1, 1, 0), m.tile_id(2, 0, 0)] == [0, 1, 2, 3, 4, 5]
    ids = {m.tile_id(5, x, y): (x, y) for x in range(32) for y in range(32)}
    assert sorted(ids) == list(range(341, 1365))
    assert all(abs(ids[k][0] - ids[k + 1][0]) + abs(ids[k][1] - ids[k + 1][1]) == 1 for k in range(341, 1364))


def test_archive_holds_the_shapes(shapes, tmp_path):
    made = m.tiles(shapes, ["id", "name", "acres", "ok"], (4, 8))
    n = m.write_archive(made, str(tmp_path / "x.pmtiles"), ["id", "name", "acres", "ok"], (4, 8))
    head, about, found = read_archive(tmp_path / "x.pmtiles")
    assert head[:2] == (b"PMTiles", 3) and head[10] == n == len(found) and about["vector_layers"][0]["id"] == "fields"
    x, y = m.mercator(np.array([-99.75]), np.array([40.25]))
    tile = found[m.tile_id(6, int(x[0] * 64), int(y[0] * 64))]
    rows = {r["id"]: (r, rings) for r, rings in decoded(tile)}
    row, rings = rows[1]
    assert row == {"id": 1, "name": "a", "acres": 1.5, "ok": True} and 3 not in rows
    assert len(rings) == 2 and g.signed_area(rings[0]) > 0 > g.signed_area(rings[1])
    assert rings[0].min() >= -m.BUFFER and rings[0].max() <= m.EXTENT + m.BUFFER
    assert np.ptp(rings[0][:, 0]) == pytest.approx(0.5 / 360 * 64 * 4096, abs=1.5)
    # what a shape covers at the last zoom adds up over its tiles
    own = sum(
        abs(g.signed_area(m.clip_ring(r, 0, m.EXTENT))) for t, tile in found.items() if t >= m.tile_id(8, 0, 0) for row, rings in decoded(tile) if row["id"] == 2 for r in rings if len(m.clip_ring(r, 0, m.EXTENT))
    )
    u, v = m.mercator(np.array([-98, -97.75]), np.array([41.25, 41]))
    assert own == pytest.approx(2 * np.ptp(u) * np.ptp(v) * (256 * 4096) ** 2, rel=0.01)


def test_a_crowded_tile_keeps_the_largest(spark):
    rows = [(i, bytearray(g.encode([[square(-100 + i / 100, 40, 0.001 * (i + 1))]]))) for i in range(12)]
    df = spark.createDataFrame(rows, "id long, geometry binary")
    got = m.tiles(df, ["id"], (6, 7), most=4, least_units=0).collect()
    ids = lambda z: {r["id"] for t in got if t["z"] == z for r, _ in decoded(gzip.decompress(t["data"]))}
    assert ids(6) == {8, 9, 10, 11}
    assert ids(7) == set(range(12))  # the last zoom has all
    assert m.tiles(df.where("false"), ["id"], (4, 6)).count() == 0


def test_many_tiles_need_leaves(monkeypatch):
    monkeypatch.setattr(m, "ROOT_BYTES", 300)
    monkeypatch.setattr(m, "LEAF_ENTRIES", 64)
    rng = np.random.default_rng(1)
    want, at = [], 0
    for t in np.unique(rng.integers(0, 10**7, 5000)).tolist():
        n = int(rng.integers(1, 900))
        want.append((t, at, n, 1))
        at += n
    root, leaves = m._directories(want)
    assert len(root) <= 300
    assert [e for _, at, n, run in entries(root) for e in entries(leaves[at : at + n]) if run == 0] == want


def test_clipping():
    ring = square(-10, -10, 20)
    assert g.signed_area(m.clip_ring(ring, -5, 5)) == 100 and len(m.clip_ring(ring, 20, 30)) == 0
    assert g.signed_area(m.clip_ring(square(0, 0, 1), -5, 5)) == 1
