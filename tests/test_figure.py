import json
import struct
import zlib

import numpy as np
import pytest

from acreline import cli
from acreline.functions import geometry as g
from acreline.operators import figure, vector
from test_mapfiles import square
from test_sources import LINE, archive, dbf, packed, server, shp  # noqa: F401  server is a fixture


def pixels(data):
    assert data[:8] == b"\x89PNG\r\n\x1a\n"
    at, notes, raw = 8, {}, b""
    while at < len(data):
        n, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + n]
        assert zlib.crc32(kind + body) == struct.unpack_from(">I", data, at + 8 + n)[0]
        if kind == b"IHDR":
            w, h = struct.unpack_from(">II", body)
        elif kind == b"tEXt":
            k, v = body.split(b"\0")
            notes[k.decode()] = v.decode()
        elif kind == b"IDAT":
            raw += body
        at += 12 + n
    rows = np.frombuffer(zlib.decompress(raw), dtype=np.uint8).reshape(h, 1 + 3 * w)
    assert not rows[:, 0].any()
    return rows[:, 1:].reshape(h, w, 3), notes


def test_burn_is_even_odd():
    window, size = (0.0, 0.0, 10.0, 10.0), 40
    shape = [[square(1, 1, 6), square(2, 2, 2)[::-1]], [np.array([(8, -5), (14, 5), (8, 15), (8, -5)], dtype=float)]]
    xy = (np.arange(size) + 0.5) / 4
    got = figure.burn(shape, window, size)
    want = [[g.contains([shape[0]], x, y) or g.contains([shape[1]], x, y) for x in xy] for y in xy[::-1]]
    assert np.array_equal(got, np.array(want))


def test_comparison(spark, tmp_path):
    frame = lambda *shapes: vector.with_bounds(spark.createDataFrame([(bytearray(g.encode([[s]])),) for s in shapes], "geometry binary"))
    got = figure.render_comparison(frame(square(0, 0, 500), square(5000, 0, 10)), frame(square(250, 0, 500)), (0, 0, 1000, 1000), str(tmp_path / "x.png"), 100)
    assert got == {"km2_both": pytest.approx(0.125), "km2_difference": pytest.approx(0.25)}
    image, notes = pixels((tmp_path / "x.png").read_bytes())
    assert image.shape == (208, 208, 3) and float(notes["km2_both"]) == pytest.approx(0.125)
    assert [int((image == c).all(axis=2).sum()) for c in (figure.OURS, figure.TRUTH, figure.BOTH)] == [2500 + 1250, 2500 + 1250, 1250]
    none = figure.render_comparison(frame(square(0, 0, 1)).where("false"), frame(square(0, 0, 1)).where("false"), (0, 0, 10, 10), str(tmp_path / "y.png"), 10)
    assert none == {"km2_both": 0, "km2_difference": 0}


def test_projection_there_and_back():
    points = np.array([(-120.0, 45.0), (-96.0, 23.0), (-70.5, 31.25)])
    assert g.lon_lat(g.project(points)) == pytest.approx(points, abs=1e-9)
    assert g.project(points)[1] == pytest.approx([0, 0], abs=1e-6)


def test_commands(spark, tmp_path, capsys, server):  # noqa: F811
    base, www = server

    def out(*args):
        capsys.readouterr()
        cli.main([str(a) for a in args])
        return [json.loads(line) for line in capsys.readouterr().out.splitlines()]

    (www / "2020_30m_cdls.zip").write_bytes(packed(**{"2020_30m_cdls_tif": b"x"}))
    assert out("fetch-rasters", base, tmp_path / "r", "2020")[0] == {"year": 2020}
    archive(www / "01001.zip", shp(3, [[LINE / 100 + (-96, 40)]]), dbf([("MTFCC", 5)], [("S1100",)]))
    archive(tmp_path / "rails.zip", shp(3, [[LINE / 100 + (-97, 40)]]), dbf([("MTFCC", 5)], [("R1011",)]))
    out("lines", base + "/{area}.zip", tmp_path / "l", "--areas", "01001,01002", "--rails", tmp_path / "rails.zip")
    lines = {r["kind"]: r for r in spark.read.parquet(str(tmp_path / "l")).collect()}
    assert set(lines) == {"S1100", "rail"} and lines["S1100"]["xmin"] == pytest.approx(0, abs=1e-6) and lines["rail"]["xmin"] < -80_000

    field = [(bytearray(g.encode([[square(0, 1_800_000, 30_000)]])), 7)]
    spark.createDataFrame(field, "geometry binary, CDL2020 int").write.parquet(str(tmp_path / "f"))
    assert out("map-features", tmp_path / "f", tmp_path / "f.fgb")[0] == {"written": 1}
    assert out("map-tiles", tmp_path / "f", tmp_path / "f.tiles", "--zooms", "4,6")[0]["written"] >= 3
    assert out("figure", tmp_path / "f", tmp_path / "f", tmp_path / "f.png", "--window", "0,1800000,60000,1860000", "--size", 64)[0] == {"km2_both": pytest.approx(900), "km2_difference": 0}

    rows = [("A0", r * 12 + c, r, c, [1, 1] if (r, c) != (5, 5) else [5, 5]) for r in range(12) for c in range(12)]
    spark.createDataFrame(rows, "tile string, pix long, r long, c long, cdl array<int>").write.parquet(str(tmp_path / "s"))
    got = out("bench-eliminate", tmp_path / "s", "--sizes", "4,12", "--repeats", 1)
    assert [(r["size"], r["regions"], r["left"], r["area_sqm"]) for r in got[:2]] == [(4, 1, 1, 16 * 900.0), (12, 2, 1, 144 * 900.0)]
    assert [r["size"] for r in got[2:4]] == [4, 12] and got[2]["median"] > 0
