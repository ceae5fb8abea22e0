import json
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from acreline.functions import geo
from acreline.functions import geometry as g
from acreline.operators import evaluate, regions, sinks, vector
from acreline.sources import tables
from test_regions import grid


def box(x0, y0, x1, y1):
    return [[np.array([(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)], dtype=float)]]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=st.lists(st.lists(st.integers(0, 1), min_size=6, max_size=6), min_size=6, max_size=6))
def test_outlines_have_the_pixels_area(spark, a):
    lab = regions.components(grid(spark, a), "v").cache()
    want = {r["label"]: r["n"] * 900 for r in lab.groupBy("label").agg(F.count("*").alias("n")).collect()}
    got = {r["label"]: g.decode(bytes(r["geometry"]))[1] for r in vector.outlines(lab).collect()}
    assert {k: g.area(p) for k, p in got.items()} == want
    for p in got.values():
        assert len(p) == 1 and g.is_valid(p) and g.contains(p, *g.interior_point(p))
        assert g.signed_area(p[0][0]) > 0 and all(g.signed_area(h) < 0 for h in p[0][1:])


def test_simplified_neighbours_share_borders(spark):
    a = [[1] * min(20, 6 + r // 2 + (r % 3 == 0)) + [2] * (20 - min(20, 6 + r // 2 + (r % 3 == 0))) for r in range(20)]
    lab = regions.components(grid(spark, a), "v")
    got = [g.decode(bytes(r["geometry"]))[1] for r in vector.outlines(lab, tolerance=45.0).collect()]
    assert len(got) == 2 and sum(map(g.area, got)) == pytest.approx(400 * 900, rel=0.02)
    assert g.intersection_area(*got) == pytest.approx(0, abs=1e-6)
    assert sum(len(p[0][0]) for p in got) < 40
    assert g.area(g.union_coverage(got)) == pytest.approx(sum(map(g.area, got)))


def test_wkb_round_trip():
    p = [box(0, 0, 4, 4)[0] + [box(1, 1, 2, 2)[0][0][::-1]], box(9, 9, 10, 10)[0]]
    kind, back = g.decode(g.encode(p))
    assert kind == 3 and g.area(back) == 16 and g.length(back) == 24 and g.bounds(back) == (0, 0, 10, 10)
    assert g.decode(g.encode_line(np.array([(0, 0), (3, 4)])))[0] == 2


@settings(max_examples=30, deadline=None)
@given(st.lists(st.floats(0.1, 3), min_size=12, max_size=12), st.floats(-2, 2), st.floats(-2, 2))
def test_intersection_area_of_stars(radii, dx, dy):
    t = np.linspace(0, 2 * np.pi, 7)[:-1]
    star = lambda rr, x, y: [[np.array([*zip(x + rr * np.cos(t), y + rr * np.sin(t), strict=True), (x + rr[0], y)])]]
    a, b = star(np.array(radii[:6]), 0, 0), star(np.array(radii[6:]), dx, dy)
    xy = (np.stack(np.meshgrid(np.arange(150), np.arange(150)), axis=2).reshape(-1, 2) + 0.5) / 150 * 6 - 3

    def inside(p):
        e = g._edges(p)
        hit = (e[None, :, 1] <= xy[:, 1:]) & (e[None, :, 3] > xy[:, 1:])
        x = e[None, :, 0] + (xy[:, 1:] - e[None, :, 1]) / (e[None, :, 3] - e[None, :, 1]) * (e[None, :, 2] - e[None, :, 0])
        return ((x < xy[:, :1]) & hit).sum(axis=1) % 2 == 1

    assert g.intersection_area(a, b) == pytest.approx((inside(a) & inside(b)).mean() * 36, abs=0.3)
    assert g.intersection_area(a, a) == pytest.approx(g.area(a))


def test_chamfer():
    assert 0.3 < g.chamfer(box(0, 0, 20, 20), box(1, 0, 21, 20), 1.0) <= 1
    assert g.chamfer(box(0, 0, 0, 0), box(0, 0, 1, 1)) is None


def test_lines_touch_their_pixels(spark):
    line = g.encode_line(np.array([(15.0, -15.0), (105.0, -15.0)]))
    df = spark.createDataFrame([(bytearray(line),), (None,)], "geometry binary")
    assert {(r["r"], r["c"]) for r in vector.burned(df).collect()} == {(0, c) for c in range(4)}
    assert {(r["r"], r["c"]) for r in vector.burned(df, buffer=15.0).collect()} >= {(r, c) for r in (0, 1) for c in range(4)}


def test_albers_and_back(spark):
    df = spark.createDataFrame([(-96.0, 23.0), (-120.5, 48.25), (-70.0, 30.0)], "lon double, lat double")
    x, y = geo.albers(F.col("lon"), F.col("lat"))
    rows = df.select("lon", "lat", x.alias("x"), y.alias("y"))
    lon, lat = geo.albers_inverse(F.col("x"), F.col("y"))
    for r in rows.select("*", lon.alias("lon2"), lat.alias("lat2")).collect():
        assert (r["lon2"], r["lat2"]) == pytest.approx((r["lon"], r["lat"]), abs=1e-9)
    first = rows.first()
    assert (first["x"], first["y"]) == pytest.approx((0, 0), abs=1e-6)


def test_match_and_instances(spark):
    kind = "id long, xmin double, ymin double, xmax double, ymax double, area double"
    truth = spark.createDataFrame([(1, 0.0, 0.0, 20.0, 20.0, 400.0), (2, 100.0, 100.0, 110.0, 110.0, 100.0)], kind)
    ours = spark.createDataFrame([(1, 0.0, 0.0, 10.0, 20.0, 200.0), (2, 10.0, 0.0, 20.0, 20.0, 200.0)], kind)
    assert {r["id"]: r["iou"] for r in evaluate.best_match(ours, truth).collect()} == {1: 0.5, 2: 0.0}
    s = evaluate.match_summary(evaluate.best_match(ours, truth)).first()
    assert (s["n_matched"], s["frac_none"], s["frac_mid"]) == (1, 0.5, 0.5)
    ladder = evaluate.f1_ladder(evaluate.pairwise_iou(ours, truth), 2, 2).where("threshold = 0.5").first()
    assert (ladder["tp"], ladder["fp"], ladder["fn"]) == (0, 2, 2)
    assert "error" in evaluate.panoptic(evaluate.pairwise_iou(ours, truth), 0, 2).columns


def test_geoparquet_footer_and_rows(spark, tmp_path):
    df = spark.createDataFrame([(bytearray(g.encode(box(i, 0, i + 1, 1))), i) for i in range(20)], "geometry binary, value int").repartition(3)
    assert sinks.write_geoparquet(df, str(tmp_path / "out")) == 20
    files = sorted((tmp_path / "out").iterdir())
    assert all(f.suffix == ".parquet" for f in files)
    meta = json.loads(pq.read_schema(files[0]).metadata[b"geo"])
    assert meta["version"] == "1.1.0" and meta["columns"]["geometry"]["encoding"] == "WKB" and meta["columns"]["geometry"]["crs"]["id"]["code"] == 5070
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.sum("value")).first()[0] == 190


def test_states_and_index(spark, tmp_path):
    df = spark.createDataFrame([("19", 1, 0.0), ("17", 2, 5e5), ("19", 3, 1e6)], "STATEFIPS string, oid long, xmin double").selectExpr("*", "xmin ymin", "xmin + 9 xmax", "xmin + 9 ymax")
    sinks.write_states(df, str(tmp_path / "s"))
    assert {p.name for p in (tmp_path / "s").iterdir() if p.is_dir()} == {"_s=17", "_s=19"}
    sinks.write_indexed(df, str(tmp_path / "i"))
    assert spark.read.parquet(str(tmp_path / "i")).count() == 3


def test_crosswalk(spark):
    text = ["state asd county name flag", "19 10 001 Adair 1", "19 20 001 Adair 1", "19 10 888 All 1", "19 30 003 Old 2", "short 1", "17 40 005 Two Words 1"]
    df = spark.createDataFrame(list(enumerate(text)), "line int, value string")
    assert {tuple(r) for r in tables.crosswalk(df).collect()} == {("19", "001", "20", "1920"), ("17", "005", "40", "1740")}
    counties = spark.createDataFrame([("19", "001", "Adair"), ("19", "999", "None"), ("02", "001", "Out")], "STATEFP string, COUNTYFP string, NAME string")
    assert [r["STATEASD"] for r in tables.boundaries(counties, tables.crosswalk(df)).collect()] == ["1920"]


def test_roads_and_urls(spark):
    rows = [("road", "primary", (0.0, 0.0, 1.0, 1.0)), ("road", "path", (0.0, 0.0, 1.0, 1.0)), ("rail", None, (0.0, 0.0, 1.0, 1.0)), ("rail", None, (50.0, 0.0, 51.0, 1.0))]
    df = spark.createDataFrame(rows, "subtype string, class string, bbox struct<xmin:double,ymin:double,xmax:double,ymax:double>")
    assert sorted(r["kind"] for r in tables.roads(df, ("primary",), (0, 0, 10, 10)).collect()) == ["primary", "rail"]
    assert tables.raster_url("http://x/", 2024, 10) == "http://x/2024_10m_cdls.zip"
    for year, resolution in ((2007, 30), (2020, 10)):
        with pytest.raises(ValueError):
            tables.raster_url("http://x", year, resolution)
    assert len(tables.STATES) == 48


def test_shapes_in_windows(spark):
    """Triangles, for which boxes are wrong: a triangle meets itself fully, and not the window beside its long side."""
    ring = np.array([(0, 0), (100, 0), (0, 100), (0, 0)], dtype=float)
    rows = [(1, bytearray(g.encode([[ring]]))), (2, bytearray(g.encode([[ring + 200]])))]
    side = vector.with_bounds(spark.createDataFrame(rows, "id long, geometry binary")).withColumn("area", g.wkb_area("geometry"))
    boxes = [("whole", -10.0, -10.0, 110.0, 110.0), ("beside", 60.0, 60.0, 99.0, 99.0), ("corner", 50.0, 50.0, 90.0, 90.0), ("part", 0.0, 0.0, 50.0, 50.0)]
    windows = spark.createDataFrame(boxes, "region string, xmin double, ymin double, xmax double, ymax double")
    for clip in (False, True):
        got = {r["region"]: r for r in evaluate.window_parity(side, side, windows, evaluate.SHAPES, clip).collect()}
        assert {k: r["n_ours"] for k, r in got.items()} == {"whole": 1, "beside": 0, "corner": 1, "part": 1}
        assert got["whole"]["iou"] == pytest.approx(1) and got["beside"]["iou"] is None
        assert got["part"]["km2_ours"] == pytest.approx(2500e-6)
        if clip:
            assert got["part"]["iou"] == pytest.approx(1)
    found = evaluate.best_match(side, side, (0.0, 0.0, 50.0, 50.0), evaluate.SHAPES).collect()
    assert [(r["id"], r["match"], r["iou"]) for r in found] == [(1, 1, pytest.approx(1))]
    assert evaluate.tile_parity(side, side, windows, evaluate.SHAPES).where("region = 'whole'").first()["only_ours_acres"] == pytest.approx(0)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 12), min_size=12, max_size=12))
def test_polygons_in_boxes(v):
    a = [[np.array([(v[0], v[1]), (v[2] + 13, v[3]), (v[4], v[5] + 13), (v[0], v[1])], dtype=float)]]
    x0, y0 = float(v[6]), float(v[7])
    box = g.box_ring(x0, y0, x0 + v[8] + 1, y0 + v[9] + 1)
    if not g.signed_area(a[0][0]):
        return
    cut = g.clip(a, *g.bounds(box))
    assert g.area(cut) == pytest.approx(g.intersection_area(a, box), abs=1e-9)
    if g.intersection_area(a, box) > 1e-9:
        assert g.intersects(a, box) and g.intersects(box, a)
    assert g.intersects(a, a) and not g.intersects(a, [[a[0][0] + 100]])


def test_record_steps_reach_the_polygons(spark):
    from acreline.plans import pipeline as p

    a = [[[1, 1]] * 6 + [[5, 5]] * 6 for _ in range(12)]
    a[3][3] = [24, 1]
    rows = [("A0", r * 12 + c, r, c, a[r][c]) for r in range(12) for c in range(12)]
    stack = spark.createDataFrame(rows, "tile string, pix long, r long, c long, cdl array<int>")
    base = {"start": 2020, "end": 2021, "thresholds": (), "min_area": 0.0, "tolerance": 0.0}
    areas = lambda made: sorted(r["area_sqm"] for r in made.collect())
    assert areas(p.polygonize(stack, p.Params(**base))) == [900.0, 71 * 900.0, 72 * 900.0]
    assert areas(p.polygonize(stack, p.Params(**base, noise_px=2))) == [72 * 900.0] * 2
    assert areas(p.polygonize(stack, p.Params(**base, focal_radius=1))) == [72 * 900.0] * 2
    assert areas(p.polygonize(stack, p.Params(**base, noise_px=2, upsample=3))) == [72 * 900.0] * 2
    line = spark.createDataFrame([(bytearray(g.encode_line(np.array([(-100.0, -165.0), (500.0, -165.0)]))),)], "geometry binary")
    cut = areas(p.polygonize(stack, p.Params(**base, noise_px=2, line_buffer=10.0), lines=line))
    assert cut == [30 * 900.0] * 2 + [36 * 900.0] * 2
    lon, lat = g.lon_lat(np.array([[30 * 6 + 15.0, 3000.0 - 15.0]]))[0]
    edges = spark.createDataFrame([(float(lon), float(lat), 1), (float(lon), float(lat), 0)], "lon double, lat double, value int")
    assert areas(p.polygonize(stack, p.Params(**base, noise_px=2, origin=(0.0, 3000.0)), edges=edges)) == [71 * 900.0, 72 * 900.0]


def lzw(data):
    """As TIFF 6.0 tells writers to do it: 10 bits once entry 511 is there, emptied after entry 4094."""
    out, table, known = [], {}, 258
    width = lambda: 9 if known < 512 else 10 if known < 1024 else 11 if known < 2048 else 12
    put = lambda code: out.append(f"{code:0{width()}b}")
    put(256)
    word = b""
    for i in range(len(data)):
        longer = word + data[i : i + 1]
        if len(longer) == 1 or longer in table:
            word = longer
            continue
        put(table.get(word, word[0]))
        table[longer] = known
        known += 1
        word = data[i : i + 1]
        if known == 4095:
            put(256)
            table, known = {}, 258
    if word:
        put(table.get(word, word[0]))
        known += 1
    put(257)
    bits = "".join(out)
    return int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")


def packbits(data):
    out = b""
    for i in range(0, len(data), 100):
        part = data[i : i + 100]
        out += bytes([257 - len(part)]) + part[:1] if len(part) > 1 and len(set(part)) == 1 else bytes([128, len(part) - 1]) + part
    return out


PACKED = {1: bytes, 5: lzw, 8: zlib.compress, 32773: packbits}


def tiff(path, a, compression=1, big=False, rows_per_strip=4, order="<"):
    import struct

    h, w = a.shape
    strips = [PACKED[compression](a[i : i + rows_per_strip].tobytes()) for i in range(0, h, rows_per_strip)]
    head = 16 if big else 8
    offsets = [head + sum(map(len, strips[:i])) for i in range(len(strips))]
    values = {256: (4, [w]), 257: (4, [h]), 258: (3, [8]), 259: (3, [compression]), 273: (16 if big else 4, offsets), 277: (3, [1]), 278: (4, [rows_per_strip]), 279: (4, [len(s) for s in strips]),
              33550: (12, [30.0, 30.0, 0.0]), 33922: (12, [0.0, 0.0, 0.0, 1000.0, 2000.0, 0.0])}
    word, room = ("Q", 8) if big else ("I", 4)
    behind, entries = b"".join(strips), b""
    for tag, (kind, numbers) in values.items():
        packed = struct.pack(f"{order}{len(numbers)}{ {3: 'H', 4: 'I', 12: 'd', 16: 'Q'}[kind] }", *numbers)
        entries += struct.pack(order + "HH" + word, tag, kind, len(numbers))
        if len(packed) > room:
            entries += struct.pack(order + word, head + len(behind))
            behind += packed
        else:
            entries += packed.ljust(room, b"\0")
    mark = b"II" if order == "<" else b"MM"
    start = struct.pack(order + "2sHHHQ", mark, 43, 8, 0, head + len(behind)) if big else struct.pack(order + "2sHI", mark, 42, head + len(behind))
    path.write_bytes(start + behind + struct.pack(order + ("Q" if big else "H"), len(values)) + entries + bytes(room))


@pytest.mark.parametrize(("compression", "big"), [(1, False), (8, False), (5, True)])
def test_raster_source(spark, tmp_path, compression, big):
    from acreline.sources.geotiff import GeoTiffSource, Tiff

    a = {y: np.random.default_rng(y).integers(0, 255, (11, 9)).astype(np.uint8) for y in (2020, 2021)}
    for y, v in a.items():
        tiff(tmp_path / f"{y}.tif", v, compression, big)
    assert Tiff(str(tmp_path / "2020.tif")).origin == (1000, 2000)
    spark.dataSource.register(GeoTiffSource)
    df = spark.read.format("classraster").option("path", str(tmp_path / "{year}.tif")).option("years", "2020,2021").option("tile", "5").load()
    rows = df.collect()
    assert len(rows) == 2 * 99 and {r["tile"] for r in rows} == {f"{x}{j}" for x in "ABC" for j in (0, 1)}
    assert all(a[r["yr"]][r["r"], r["c"]] == r["cdl"] and r["pix"] == r["r"] * 9 + r["c"] for r in rows)


@pytest.mark.parametrize("compression", PACKED)
@pytest.mark.parametrize(("big", "order"), [(False, "<"), (True, ">")])
def test_rasters_of_every_compression(tmp_path, compression, big, order):
    from acreline.sources.geotiff import Tiff

    draw = np.random.default_rng(compression)
    for a in (draw.integers(0, 256, (90, 131)), np.repeat(draw.integers(0, 9, (40, 30)), 23, axis=1), np.zeros((60, 700))):
        a = a.astype(np.uint8)
        tiff(tmp_path / "a.tif", a, compression, big, rows_per_strip=37, order=order)
        t = Tiff(str(tmp_path / "a.tif"))
        assert (t.window(0, 0, *a.shape) == a).all()
        assert (t.window(30, 7, 9, 20) == a[30:39, 7:27]).all() and (t.window(3, 0, 9, 20) == a[3:12, :20]).all()


def test_end_to_end(spark, tmp_path):
    from acreline.plans import pipeline as p

    a = [[("A0" if c < 15 else "A1", r * 30 + c, r, c, [152 if c in (7, 22) else 1 if r < 15 else 5] * 3) for c in range(30)] for r in range(30)]
    stack = spark.createDataFrame([x for row in a for x in row], "tile string, pix long, r long, c long, cdl array<int>")
    params = p.Params(2020, 2022, thresholds=(100.0,), min_area=1.0, tolerance=5.0)
    shapes = p.polygonize(stack, params)
    assert shapes.count() == 8
    county = g.encode(box(-10, -2000, 2000, 10))
    bounds = spark.createDataFrame([(bytearray(county), "19", "1900", "00", "County", "001")], "geometry binary, STATEFIPS string, STATEASD string, ASD string, CNTY string, CNTYFIPS string")
    rows = p.postprocess(shapes, bounds, params).collect()
    assert len(rows) == 6 and sorted(r["oid"] for r in rows) == list(range(1, 7))
    assert {r["FIELDID"] for r in rows} == {f"192022{i:09d}" for i in range(1, 7)}
    assert sum(r["Shape_area"] for r in rows) == pytest.approx(28 * 30 * 900)
    for r in rows:
        assert g.contains(g.decode(bytes(r["geometry"]))[1], r["INSIDE_X"], r["INSIDE_Y"]) and r["CDL2020"] in (1, 5)
        assert r["FIELDACRES"] == pytest.approx(r["Shape_area"] / 4046.86)
    nothing = spark.createDataFrame([("A0", 0, 0, 0, [152, 152])], stack.schema)
    assert p.polygonize(nothing, p.Params(2020, 2021)).collect() == []


def test_stream_is_idempotent(spark, tmp_path):
    from acreline.plans.pipeline import Params
    from acreline.streaming.ingest import ingest

    stack = spark.createDataFrame([("A0", r * 10 + c, r, c, [1, 1]) for r in range(10) for c in range(10)], "tile string, pix long, r long, c long, cdl array<int>")
    stack.coalesce(1).write.parquet(str(tmp_path / "in"))
    for check in ("c1", "c1", "c2"):
        ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / check), Params(2020, 2021)).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == 1
