import functools
import http.server
import io
import struct
import threading
import zipfile

import numpy as np
import pytest

from acreline.functions import geometry as g
from acreline.sources import fetch, tables
from acreline.sources.shapefile import ShapefileSource


def shp(kind, records):
    body = b""
    for i, parts in enumerate(records, 1):
        if parts is None:
            content = struct.pack("<i", 0)
        else:
            points = np.concatenate(parts)
            starts = np.cumsum([0, *(len(p) for p in parts[:-1])])
            content = struct.pack("<i4dii", kind, *points.min(axis=0), *points.max(axis=0), len(parts), len(points)) + struct.pack(f"<{len(parts)}i", *starts) + points.astype("<f8").tobytes()
        body += struct.pack(">ii", i, len(content) // 2) + content
    return struct.pack(">i20xi", 9994, 50 + len(body) // 2) + struct.pack("<ii64x", 1000, kind) + body


def dbf(fields, rows, deleted=()):
    head = b"".join(n.encode().ljust(11, b"\0") + b"C" + bytes(4) + bytes([w, 0]) + bytes(14) for n, w in fields)
    size = 1 + sum(w for _, w in fields)
    out = struct.pack("<B3xIHH20x", 3, len(rows), 32 + len(head) + 1, size) + head + b"\r"
    for i, r in enumerate(rows):
        out += (b"*" if i in deleted else b" ") + b"".join(v.encode().ljust(w) for v, (_, w) in zip(r, fields, strict=True))
    return out


LINE = np.array([(0, 0), (3, 4)], dtype=float)


def archive(path, shape, table):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("x.shp", shape)
        z.writestr("x.dbf", table)


def test_lines_of_archives(spark, tmp_path):
    fields = [("MTFCC", 5), ("NAME", 8)]
    archive(tmp_path / "a.zip", shp(3, [[LINE], [LINE, LINE + 9], None, [LINE]]), dbf(fields, [("S1100", "Ä"), ("S1400", ""), ("S1730", "x"), ("S1100", "gone")], deleted=(3,)))
    archive(tmp_path / "b.zip", shp(3, [[LINE]]), dbf([("MTFCC", 5)], [("S1200",)]))
    archive(tmp_path / "c.zip", shp(3, []), dbf(fields, []))
    spark.dataSource.register(ShapefileSource)
    rows = spark.read.format("shapes").option("path", f"{tmp_path}/*.zip").load()
    got = {r["MTFCC"]: r for r in rows.collect()}
    assert sorted(got) == ["S1100", "S1200", "S1400", "S1730"]
    assert got["S1100"]["NAME"] == "Ä" and got["S1400"]["NAME"] is None and got["S1200"]["NAME"] is None
    assert got["S1730"]["geometry"] is None
    assert g.length(g.decode(bytes(got["S1100"]["geometry"]))[1]) == 5 and g.length(g.decode(bytes(got["S1400"]["geometry"]))[1]) == 10
    kept = tables.coded_lines(rows)
    assert {r["kind"] for r in kept.collect()} == {"S1100", "S1200", "S1400"}


def test_polygons_with_holes_and_parts(spark, tmp_path):
    ring = lambda x, y, s: np.array([(x, y), (x, y + s), (x + s, y + s), (x + s, y), (x, y)], dtype=float)  # noqa: E731  clockwise
    (tmp_path / "p.shp").write_bytes(shp(5, [[ring(0, 0, 10), ring(2, 2, 3)[::-1], ring(20, 0, 1)]]))
    (tmp_path / "p.dbf").write_bytes(dbf([("ID", 3)], [("007",)]))
    spark.dataSource.register(ShapefileSource)
    r = spark.read.format("shapes").option("path", str(tmp_path / "p.shp")).load().first()
    kind, parts = g.decode(bytes(r["geometry"]))
    assert r["ID"] == "007" and kind == 3 and g.area(parts) == 100 - 9 + 1 and g.signed_area(parts[0][0]) > 0


@pytest.fixture
def server(tmp_path):
    class Quiet(http.server.SimpleHTTPRequestHandler):
        def log_message(self, *_):
            pass

    (tmp_path / "www").mkdir()
    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), functools.partial(Quiet, directory=str(tmp_path / "www")))
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}", tmp_path / "www"
    s.shutdown()


def packed(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members.items():
            z.writestr(name.replace("_tif", ".tif"), data)
    return out.getvalue()


def test_rasters_are_fetched_once_and_bad_years_left_out(spark, tmp_path, server):
    base, www = server
    (www / "2020_30m_cdls.zip").write_bytes(packed(**{"2020_30m_cdls_tif": b"first"}))
    (www / "2021_30m_cdls.zip").write_bytes(b"not an archive")
    got = fetch.fetch_rasters(spark, base, (2020, 2021, 2022), str(tmp_path / "r"), pause=0)
    assert got == [2020] and (tmp_path / "r/2020/2020_30m_cdls.tif").read_bytes() == b"first"
    (www / "2020_30m_cdls.zip").write_bytes(packed(**{"2020_30m_cdls_tif": b"second"}))
    fetch.fetch_rasters(spark, base, (2020,), str(tmp_path / "r"), pause=0)
    assert (tmp_path / "r/2020/2020_30m_cdls.tif").read_bytes() == b"first"
    fetch.fetch_rasters(spark, base, (2020,), str(tmp_path / "r"), pause=0, overwrite=True)
    assert (tmp_path / "r/2020/2020_30m_cdls.tif").read_bytes() == b"second"
    assert not list((tmp_path / "r").rglob("*.part"))
    with pytest.raises(ValueError):
        fetch.fetch_rasters(spark, base, (2007,), str(tmp_path / "r"))


def test_lines_skip_what_the_server_lacks(spark, tmp_path, server):
    base, www = server
    archive(www / "01001.zip", shp(3, [[LINE]]), dbf([("MTFCC", 5)], [("S1100",)]))
    got = fetch.fetch_lines(spark, base + "/{area}.zip", ["01001", "01002"], str(tmp_path / "l"), pause=0)
    assert [p.rsplit("/", 1)[1] for p in got] == ["01001.zip"]
    (www / "01003.zip").write_bytes(b"broken")
    with pytest.raises(OSError, match="could not be fetched"):
        fetch.fetch_lines(spark, base + "/{area}.zip", ["01003"], str(tmp_path / "l"), pause=0)
