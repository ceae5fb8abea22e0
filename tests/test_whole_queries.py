"""Registered queries cover all of their input."""

import random

from pyspark.sql import functions as F

from acreline.plans import queries as q

D = "/root/testdata/sf0.01"


def test_upsample_covers_the_grid(spark):
    rows = {(r["r"], r["c"]): r["seq"] for r in q.px(spark, D).withColumn("keys", q.codes.unpack(F.col("seq"), q.N)).select("r", "c", q.text("keys").alias("seq")).collect()}
    got = q.QUERIES["upsample"](spark, D).collect()
    assert {(r["r"], r["c"]) for r in got} == {(3 * r + i, 3 * c + j) for r, c in rows for i in range(3) for j in range(3)}
    assert len(got) == 9 * len(rows) and all(x["seq"] == rows[x["r"] // 3, x["c"] // 3] and x["pix"] == x["r"] * 300 + x["c"] for x in got)


def test_burn_lines_keeps_all_pixels(spark):
    from acreline.plans import shape_queries  # noqa: F401  registers them

    got = {(r["r"], r["c"]) for r in q.QUERIES["burn_lines"](spark, D).collect()}
    ends = {(int((29 * k + 7) // 30), int((3000 - 20 * k) // 30)) for k in range(25)}
    assert ends <= got and {(-1, 0), (23, 84)} <= got
    assert (min(r for r, _ in got), max(r for r, _ in got), max(c for _, c in got)) == (-1, 23, 100)


def test_a_dense_tile_keeps_all_shapes(spark):
    from acreline.operators import mapfiles
    from acreline.plans import shape_queries

    corner = spark.range(20_500).select((F.col("id") / 2000 - 100).alias("xmin"), F.lit(40.0).alias("ymin"))
    boxes = shape_queries._box_wkb(corner.withColumns({"xmax": F.col("xmin") + 0.1, "ymax": F.lit(40.1)})).select("geometry")
    assert mapfiles.in_tiles(boxes, (4, 4)).agg(F.countDistinct("geometry")).first()[0] == 20_500


def brute_focal(a, rounds):
    n = len(a)
    for _ in range(rounds):
        seen, small = {}, []
        for at in [(r, c) for r in range(n) for c in range(n) if a[r][c]]:
            if at not in seen:
                todo, part = [at], {at}
                while todo:
                    r, c = todo.pop()
                    for y, x in ((r - 1, c), (r + 1, c), (r, c - 1), (r, c + 1)):
                        if 0 <= y < n and 0 <= x < n and (y, x) not in part and a[y][x] == a[r][c]:
                            part.add((y, x))
                            todo.append((y, x))
                seen |= dict.fromkeys(part)
                small += part if len(part) < 5 else ()
        new = [list(row) for row in a]
        for r, c in small:
            near = [a[min(max(r + i, 0), n - 1)][min(max(c + j, 0), n - 1)] for i in range(-2, 3) for j in range(-2, 3)]
            new[r][c] = min((-near.count(v), v) for v in set(near) if v)[1]
        a = new
    return a


def test_focal_smooth_runs_the_rounds_of_the_reference(spark, monkeypatch):
    rng = random.Random(0)
    a = [[rng.randrange(5) for _ in range(14)] for _ in range(14)]
    px = spark.createDataFrame([("A0", r * 14 + c, r, c, a[r][c]) for r in range(14) for c in range(14)], "tile string, pix long, r long, c long, v int")
    monkeypatch.setattr(q, "one_year", lambda spark, d: px)
    got = {r["pix"]: r["v"] for r in q.QUERIES["focal_smooth"](spark, D).collect()}
    want = [{r * 14 + c: m[r][c] for r in range(14) for c in range(14)} for m in (brute_focal(a, n) for n in (1, 3, 4))]
    assert got == want[2] and want[2] not in want[:2]
