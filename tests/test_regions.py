import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from acreline.functions import codes
from acreline.operators import combine, denoise, graph, regions, tiles
from acreline.sources import pixels


def grid(spark, a, column="v", kind="int"):
    h, w = len(a), len(a[0])
    rows = [("A0", r * w + c, r, c, a[r][c]) for r in range(h) for c in range(w)]
    return spark.createDataFrame(rows, f"tile string, pix long, r long, c long, {column} {kind}")


def array(df, h, w, column="v"):
    out = np.zeros((h, w), dtype=int)
    for r in df.collect():
        out[r["r"], r["c"]] = r[column]
    return out.tolist()


def label(a):
    h, w = len(a), len(a[0])
    out = [[None] * w for _ in range(h)]
    for r in range(h):
        for c in range(w):
            if out[r][c] is None:
                todo, out[r][c] = [(r, c)], r * w + c
                while todo:
                    i, j = todo.pop()
                    for y, x in ((i - 1, j), (i + 1, j), (i, j - 1), (i, j + 1)):
                        if 0 <= y < h and 0 <= x < w and out[y][x] is None and a[y][x] == a[r][c]:
                            out[y][x] = r * w + c
                            todo.append((y, x))
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=st.lists(st.lists(st.integers(0, 2), min_size=7, max_size=7), min_size=5, max_size=5))
def test_components_are_flood_fill(spark, a):
    assert array(regions.components(grid(spark, a), "v"), 5, 7, "label") == label(a)


@pytest.mark.parametrize("small", [0, 1000])
def test_connected_components(spark, small):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), (None, 1), (7, 6), (6, 5)] + [(100 + i, 101 + i) for i in range(30)]
    got = {r["node"]: r["component"] for r in graph.connected_components(spark.createDataFrame(edges, "u long, v long"), small).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4, 7: 4} | {100 + i: 100 for i in range(31)}
    assert graph.connected_components(spark.createDataFrame([], "u long, v long"), small).collect() == []


def test_kernels_agree_across_blocks(spark):
    """A grid of two by two blocks whose regions cross their borders."""
    rng = np.random.default_rng(4)
    h, w, top = 40, 30, 1024 - 20
    a = np.repeat(np.repeat(rng.integers(1, 4, (h // 4, w // 3)), 4, axis=0), 3, axis=1)
    a[rng.random((h, w)) < 0.05] = 9
    rows = [("A0", int((r + top) * 5000 + c + top), r + top, c + top, int(a[r, c])) for r in range(h) for c in range(w)]
    px = spark.createDataFrame(rows, "tile string, pix long, r long, c long, v int")
    want = label(a.tolist())
    lab = regions.components(px, "v").cache()
    got = {(r["r"] - top, r["c"] - top): r["label"] for r in lab.collect()}
    key = lambda n: (n // w + top) * 5000 + n % w + top
    assert got == {(r, c): key(want[r][c]) for r in range(h) for c in range(w)}
    pairs = {}
    for r in range(h):
        for c in range(w):
            for y, x in ((r + 1, c), (r, c + 1)):
                if y < h and x < w:
                    k = tuple(sorted((key(want[r][c]), key(want[y][x]))))
                    pairs[k] = pairs.get(k, 0) + 1
    assert {(r["lo"], r["hi"]): r["sides"] for r in regions.adjacency(lab).collect()} == {k: n for k, n in pairs.items() if k[0] != k[1]}
    count = {k: sum(row.count(k) for row in want) for row in want for k in row}
    assert {r["label"]: r["perimeter"] for r in regions.perimeters(lab, 1.0).collect()} == {key(k): 4 * n - 2 * pairs.get((key(k), key(k)), 0) for k, n in count.items()}
    from acreline.functions import geometry as g
    from acreline.operators import vector

    shapes = {r["label"]: g.decode(bytes(r["geometry"]))[1] for r in vector.outlines(lab, 1.0).collect()}
    assert {k: g.area(p) for k, p in shapes.items()} == {key(k): n for k, n in count.items()}
    small = spark.createDataFrame([(t, p, r - top, c - top, v) for t, p, r, c, v in rows], px.schema)
    for change in (denoise.heal_noise, denoise.focal_smooth, lambda x: denoise.focal_mode(x, 3)):
        moved = {(r["r"] + top, r["c"] + top): r["v"] for r in change(small).collect()}
        assert {(r["r"], r["c"]): r["v"] for r in change(px).collect()} == moved
    simple = {r["label"]: r["area_sqm"] for r in vector.outlines(lab, 1.0, tolerance=1.5).collect()}
    one = regions.components(small, "v").withColumn("label", F.col("label"))
    assert sorted(simple.values()) == sorted(r["area_sqm"] for r in vector.outlines(one, 1.0, tolerance=1.5).collect())


def test_years_heal_together(spark):
    a = [[[5, 1 + (r + c) % 2, 3] for c in range(9)] for r in range(9)]
    a[4][4] = [9, 1, 8]
    px = spark.createDataFrame([("A0", r * 9 + c, r, c, a[r][c]) for r in range(9) for c in range(9)], "tile string, pix long, r long, c long, cdl array<int>")
    got = {(r["r"], r["c"]): r["cdl"] for r in denoise.heal_noise(px, 2, "cdl").collect()}
    assert got == {(r, c): [5, 1 + (r + c) % 2, 3] for r in range(9) for c in range(9)}  # the second year is noise only


def test_known_answers(spark):
    from acreline.plans import queries as q

    d = "/root/testdata/sf0.001"
    table, edges = q.graph(spark, d)
    assert (table.count(), edges.count(), edges.agg(F.sum("sides")).first()[0] * 30) == (102, 127, 12720)
    counts = []
    for t in (1000.0, 10000.0, 10000.0):
        small, merged = regions.small_labels(table, t).count(), regions.merge_targets(table, edges, t).count()
        table, edges, _ = regions.eliminate(table, edges, (t,))
        counts.append((small, merged, table.count()))
    assert counts == [(74, 68, 34), (19, 13, 21), (6, 1, 20)]
    assert table.agg(F.sum("n_pixels")).first()[0] == 1193


def test_ties_go_to_the_smallest_label(spark):
    a = [[1, 1, 5, 2, 2], [1, 1, 5, 2, 2], [1, 1, 1, 2, 2]]
    lab = regions.components(combine.keyed(grid(spark, [[[v] for v in row] for row in a], "cdl", "array<int>"), 1))
    table, edges = regions.region_table(lab), regions.adjacency(lab)
    to = regions.merge_targets(table, edges, 1800.0).collect()
    assert [(r["label"], r["target"]) for r in to] == [(2, 0)]
    b = [[1, 5, 2]]
    lab = regions.components(combine.keyed(grid(spark, [[[v] for v in b[0]]], "cdl", "array<int>"), 1))
    assert regions.merge_targets(regions.region_table(lab), regions.adjacency(lab), 10000.0).collect() == []


@pytest.mark.parametrize("spots,healed", [([(3, 3)], True), ([(3, 3), (3, 4)], True), ([(3, 3), (3, 4), (3, 5)], False), ([(2, 2), (3, 3)], True)])
def test_noise_of_two_pixels_heals(spark, spots, healed):
    a = [[5] * 7 for _ in range(7)]
    for r, c in spots:
        a[r][c] = 9
    got = array(denoise.heal_noise(grid(spark, a)), 7, 7)
    assert got == ([[5] * 7 for _ in range(7)] if healed else a)


def test_noise_limits(spark):
    a = [[0] * 7 for _ in range(7)]
    a[3][3] = 9
    assert array(denoise.heal_noise(grid(spark, a)), 7, 7) == [[0] * 7 for _ in range(7)]
    b = [[1, 2], [3, 4]]
    assert array(denoise.heal_noise(grid(spark, b)), 2, 2) == b
    c = [[3] * 5 for _ in range(5)]
    assert array(denoise.heal_noise(grid(spark, c)), 5, 5) == c


def test_focal_filter(spark):
    a = [[1] * 5 for _ in range(5)]
    a[2][2] = 2
    assert array(denoise.focal_smooth(grid(spark, a)), 5, 5) == [[1] * 5 for _ in range(5)]
    b = [[1] * 5 for _ in range(5)]
    for r in (1, 2, 3):
        for c in (1, 2, 3):
            b[r][c] = 2
    assert array(denoise.focal_smooth(grid(spark, b)), 5, 5) == b
    assert array(denoise.focal_mode(grid(spark, a), 0), 5, 5) == a


def test_keys_round_trip(spark):
    df = spark.createDataFrame([([1, 254, 0, 254, 5, 6, 7, 254],), ([0] * 8,)], "k array<int>").withColumn("s", codes.pack(F.col("k"), 8))
    assert all(r["k"] == r["b"] for r in df.withColumn("b", codes.unpack(F.col("s"), 8)).collect())
    assert df.select(codes.effective(F.col("k"), 8).alias("e")).first()["e"] == 4
    with pytest.raises(ValueError, match="9"):
        codes.pack(F.col("k"), 9)


def test_general_classes(spark):
    df = spark.createDataFrame([(v,) for v in (1, 61, 131, 176, 37, 66, 74, 254, 0, 255)], "v int")
    assert [r[0] for r in df.select(codes.general_class(F.col("v"))).collect()] == [1, 45, 45, 0, 26, 46, 46, 5, 0, 0]
    assert max(codes.GENERAL_CLASS.values()) <= 63


def test_combine_counts_years(spark):
    px = combine.keyed(spark.createDataFrame([("A0", 0, 0, 0, [1, 254, 0])], "tile string, pix long, r long, c long, cdl array<int>"), 3)
    r = px.first()
    assert (r["effective"], r["attr"], r["keys"]) == (1, [1, 0, 0], [1, 254, 0])


def test_stack_of_years(spark):
    rows = [("A0", 0, 0, 0, y, v) for y, v in ((2020, 3), (2021, 4))] + [("A0", 1, 0, 1, 2021, 9)]
    df = spark.createDataFrame(rows, "tile string, pix long, r long, c long, yr int, cdl int")
    assert {r["pix"]: r["cdl"] for r in pixels.stack_of(df, (2020, 2021)).collect()} == {0: [3, 4], 1: [0, 9]}


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 24])
def test_shards_cover_the_tiles(spark, n):
    t = tiles.tile_windows(spark, 30_000, 20_000)
    counts = [r["n"] for r in tiles.shard(t, n).groupBy("shard").agg(F.count("*").alias("n")).collect()]
    assert sum(counts) == 24 and max(counts) - min(counts) <= 1
    with pytest.raises(ValueError, match="no shard"):
        tiles.shard(t, n, n)


def test_tile_windows(spark):
    got = {r["tile"]: tuple(r)[1:] for r in tiles.tile_windows(spark, 110, 60, 50).collect()}
    assert len(got) == 6 and got["B2"] == (100, 50, 10, 10)
    assert "AB0" in {r["tile"] for r in tiles.tile_windows(spark, 10, 300, 10).collect()}
