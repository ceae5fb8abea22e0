"""Registered queries over traced outlines."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreline.functions import geometry as geo
from acreline.operators import vector
from acreline.plans import oracle as o
from acreline.operators import combine, evaluate, polygons
from acreline.plans.coverage_queries import BOXES, _MEASURES, _rounded, ours, truth, windows
from acreline.plans.queries import labelled, query
from acreline.runtime import stored

_INNER = ", inner_sides as (select a.label, count(*) x from lab a join lab b on a.label = b.label and ((b.pix = a.pix + 1 and b.r = a.r) or b.pix = a.pix + 100) group by 1)"


def shapes(spark: SparkSession, d: str) -> DataFrame:
    return stored(vector.outlines(labelled(spark, d)), "shapes")


@query(
    o.sql(
        o.LABELS + _INNER,
        """select label, n * 900.0::double area, (4 * n - 2 * coalesce(x, 0)) * 30.0::double perimeter, x0 * 30.0::double xmin, -y1 * 30.0::double ymin, x1 * 30.0::double xmax, -y0 * 30.0::double ymax, true as valid, true as inside
 from (select label, count(*) n, min(c) x0, max(c) + 1 x1, min(r) y0, max(r) + 1 y1 from lab group by 1) left join inner_sides using (label)""",
    )
)
def outlines(spark: SparkSession, d: str) -> DataFrame:
    got = vector.with_bounds(vector.derive_shape(shapes(spark, d)))
    return got.select("label", F.col("Shape_area").alias("area"), F.col("Shape_Length").alias("perimeter"), "xmin", "ymin", "xmax", "ymax", geo.wkb_valid("geometry").alias("valid"), geo.wkb_contains("geometry", "INSIDE_X", "INSIDE_Y").alias("inside"))


@query(o.sql(o.LABELS, "select label, c // 20 zone, count(*) * 900.0::double area from lab group by 1, 2"))
def polygon_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Intersection areas of outlines with strips, by the geometry kernel."""
    from acreline.operators.spatialjoin import box_join

    found = stored(vector.with_bounds(vector.outlines(labelled(spark, d))), "bounds")
    low = found.agg(F.coalesce(F.min("ymin"), F.lit(-30.0))).first()[0]  # strips go down to the lowest outline
    strips = spark.range(5).select(F.col("id").alias("zone"), (F.col("id") * 600.0).alias("xmin"), F.lit(low).alias("ymin"), (F.col("id") * 600.0 + 600).alias("xmax"), F.lit(0.0).alias("ymax"))
    pairs = box_join(found, _box_wkb(strips), 100_000.0)
    return pairs.select(F.col("a.label").alias("label"), F.col("b.zone").alias("zone"), F.round(geo.wkb_intersection_area("a.geometry", "b.geometry"), 6).alias("area")).where("area > 0")


@query(o.sql(o.MASKED, "select (select count(*) from m) * 900.0::double area, (4 * (select count(*) from m) - 2 * (select count(*) from m a join m b on (b.pix = a.pix + 1 and b.r = a.r) or b.pix = a.pix + 100)) * 30.0::double perimeter"))
def union_shapes(spark: SparkSession, d: str) -> DataFrame:
    merged = vector.merge_shapes(shapes(spark, d), ["tile"])
    return merged.select("area_sqm", geo.wkb_area("geometry").alias("area"), geo.wkb_length("geometry").alias("perimeter")).select("area", "perimeter")


@query()
def simplify_coverage(spark: SparkSession, d: str) -> DataFrame:
    got = vector.outlines(labelled(spark, d), tolerance=30.0)
    return got.select("label", F.round("area_sqm", 3).alias("area"), geo.wkb_valid("geometry").alias("valid"))


def _box_wkb(side: DataFrame) -> DataFrame:
    @F.arrow_udf("binary")
    def make(x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
        return pa.array([geo.encode_polygon([np.array([(a, b), (c, b), (c, e), (a, e), (a, b)])]) for a, b, c, e in zip(*(v.to_pylist() for v in (x0, y0, x1, y1)), strict=True)], pa.binary())

    return side.withColumn("geometry", make("xmin", "ymin", "xmax", "ymax"))


@query()
def chamfer_distance(spark: SparkSession, d: str) -> DataFrame:
    """Mean border distance of matched pairs."""
    from acreline.functions.geo import box_overlap
    from acreline.operators.evaluate import CELL
    from acreline.operators.spatialjoin import box_join

    pairs = box_join(_box_wkb(ours(spark, d)), _box_wkb(truth(spark, d)), CELL)
    iou = F.col("_i") / (F.col("a.area") + F.col("b.area") - F.col("_i"))
    matched = pairs.withColumn("_i", box_overlap("a", "b")).where(iou > 0.5)
    return matched.select(F.col("a.id").alias("oid"), F.col("b.id").alias("tid"), F.round(geo.wkb_chamfer("a.geometry", "b.geometry"), 6).alias("chamfer_m"))


@query()
def burn_lines(spark: SparkSession, d: str) -> DataFrame:
    """Pixels touched by 25 buffered lines."""
    rows = spark.read.parquet(f"{d}/nation.parquet").select(F.col("n_nationkey").cast("double").alias("k"))

    @F.arrow_udf("binary")
    def line(k: pa.Array) -> pa.Array:
        return pa.array([geo.encode_line(np.array([(40 * v, -13 * v), (3000 - 20 * v, -29 * v - 7)])) for v in k.to_pylist()], pa.binary())

    return vector.burned(rows.select(line("k").alias("geometry")), buffer=15.0)


@query(
    """with b as (select -125 + (o_orderkey * 37 % 5800) / 100.0::double x0, 24 + (o_custkey * 17 % 2500) / 100.0::double y0, (o_orderkey % 10 + 1) / 100.0::double s from orders),
m as (select (x0 + 180) / 360 x0, (x0 + s + 180) / 360 x1, (1 - asinh(tan(radians(y0 + s))) / pi()) / 2 y0, (1 - asinh(tan(radians(y0))) / pi()) / 2 y1 from b),
p as (select m.*, z, power(2.0::double, z) n from m, range(4, 9) t(z)),
q as (select * from p where (x1 - x0) * (y1 - y0) * n * n * 4096 * 4096 >= 16 or z = 8)
select z::int z, x, y, count(*) n from q, unnest(range(floor(x0 * n - 1 / 64.0::double)::bigint, floor(x1 * n + 1 / 64.0::double)::bigint + 1)) a(x),
 unnest(range(floor(y0 * n - 1 / 64.0::double)::bigint, floor(y1 * n + 1 / 64.0::double)::bigint + 1)) c(y) group by all"""
)
def map_tile_assignment(spark: SparkSession, d: str) -> DataFrame:
    """Which tiles of a map hold how many shapes."""
    from acreline.operators.mapfiles import in_tiles

    o = spark.read.parquet(f"{d}/orders.parquet")
    corner = o.select((-125 + (F.col("o_orderkey") * 37 % 5800) / 100.0).alias("xmin"), (24 + (F.col("o_custkey") * 17 % 2500) / 100.0).alias("ymin"), ((F.col("o_orderkey") % 10 + 1) / 100.0).alias("s"))
    boxes = _box_wkb(corner.withColumns({"xmax": F.col("xmin") + F.col("s"), "ymax": F.col("ymin") + F.col("s")}))
    return in_tiles(boxes.select("geometry"), (4, 8)).groupBy("z", "x", "y").agg(F.count("*").alias("n"))


@query(
    """with b as (select -125 + (o_orderkey * 37 % 5800) / 100.0::double x0, 24 + (o_custkey * 17 % 2500) / 100.0::double y0, (o_orderkey % 10 + 1) / 100.0::double s from orders),
m as (select (x0 + 180) / 360 x0, (x0 + s + 180) / 360 x1, (1 - asinh(tan(radians(y0 + s))) / pi()) / 2 y0, (1 - asinh(tan(radians(y0))) / pi()) / 2 y1 from b),
p as (select m.*, z, power(2.0::double, z) n from m, range(4, 13) t(z)),
q as (select * from p where (x1 - x0) * (y1 - y0) * n * n * 4096 * 4096 >= 16 or z = 12)
select z::int z, x, y, count(*) n from q, unnest(range(floor(x0 * n - 1 / 64.0::double)::bigint, floor(x1 * n + 1 / 64.0::double)::bigint + 1)) a(x),
 unnest(range(floor(y0 * n - 1 / 64.0::double)::bigint, floor(y1 * n + 1 / 64.0::double)::bigint + 1)) c(y) group by all"""
)
def map_tile_assignment_all(spark: SparkSession, d: str) -> DataFrame:
    """The same at the default zooms."""
    from acreline.operators.mapfiles import in_tiles

    o = spark.read.parquet(f"{d}/orders.parquet")
    corner = o.select((-125 + (F.col("o_orderkey") * 37 % 5800) / 100.0).alias("xmin"), (24 + (F.col("o_custkey") * 17 % 2500) / 100.0).alias("ymin"), ((F.col("o_orderkey") % 10 + 1) / 100.0).alias("s"))
    boxes = _box_wkb(corner.withColumns({"xmax": F.col("xmin") + F.col("s"), "ymax": F.col("ymin") + F.col("s")}))
    return in_tiles(boxes.select("geometry")).groupBy("z", "x", "y").agg(F.count("*").alias("n"))


@query()
def map_tiles(spark: SparkSession, d: str) -> DataFrame:
    """Encoded tiles of the outlines, and how large they are."""
    from acreline.operators.mapfiles import tiles

    moved = shapes(spark, d).select("label", geo.wkb_lon_lat("geometry").alias("geometry"))
    return tiles(moved, ["label"], (4, 12)).select("tile_id", "z", "x", "y", (F.octet_length("data") > 0).alias("some"))


# --- shapes that are not boxes: each box without its upper right quarter


def _notched(side: DataFrame) -> DataFrame:
    @F.arrow_udf("binary")
    def make(x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
        rows = zip(*(v.to_pylist() for v in (x0, y0, x1, y1)), strict=True)
        return pa.array([geo.encode_polygon([np.array([(a, b), (c, b), (c, (b + e) / 2), ((a + c) / 2, (b + e) / 2), ((a + c) / 2, e), (a, e), (a, b)])]) for a, b, c, e in rows], pa.binary())

    return stored(side.withColumns({"geometry": make("xmin", "ymin", "xmax", "ymax"), "area": F.col("area") * 0.75}), "notched")


def _area_sql(*rects: tuple[str, str, str, str]) -> str:
    side = lambda i: f"greatest(least({', '.join(r[i + 2] for r in rects)}) - greatest({', '.join(r[i] for r in rects)}), 0)"
    return f"({side(0)} * {side(1)})"


def _rect(t: str) -> tuple[str, str, str, str]:
    return f"{t}.xmin", f"{t}.ymin", f"{t}.xmax", f"{t}.ymax"


def _notch(t: str) -> tuple[str, str, str, str]:
    return f"({t}.xmin + {t}.xmax) / 2", f"({t}.ymin + {t}.ymax) / 2", f"{t}.xmax", f"{t}.ymax"


def _in_sql(t: str, w: str) -> str:
    return f"({_area_sql(_rect(t), _rect(w))} - {_area_sql(_notch(t), _rect(w))})"


def _both_sql(*w: str) -> str:
    more = [_rect(x) for x in w]
    return f"({_area_sql(_rect('a'), _rect('b'), *more)} - {_area_sql(_notch('a'), _rect('b'), *more)} - {_area_sql(_rect('a'), _notch('b'), *more)} + {_area_sql(_notch('a'), _notch('b'), *more)})"


def _meets_sql(t: str, w: str) -> str:
    """The lower and the left half of a notched box, one of them."""
    touch = lambda x1, y1: f"({t}.xmin <= {w}.xmax and {w}.xmin <= {x1} and {t}.ymin <= {w}.ymax and {w}.ymin <= {y1})"
    return f"({touch(f'{t}.xmax', f'({t}.ymin + {t}.ymax) / 2')} or {touch(f'({t}.xmin + {t}.xmax) / 2', f'{t}.ymax')})"


def _shape_parity_sql(clip: bool) -> str:
    side = lambda s, n: f"(select w.region, count(b.id) n_{n}, coalesce(sum(b.area * 0.75), 0) / 4046.86 acres_{n}, coalesce(sum({_in_sql('b', 'w')}), 0) / 1e6 km2_{n} from win w left join {s} b on {_meets_sql('b', 'w')} group by 1) {n}"
    return f"""select region, n_ours, n_truth, {_MEASURES} from {side("ours", "ours")} join {side("truth", "truth")} using (region)
 left join (select w.region, sum({_both_sql("w") if clip else _both_sql()}) / 1e6 i from win w join ours a on {_meets_sql("a", "w")} join truth b on {_meets_sql("b", "w")} and {_both_sql()} > 0 group by 1) using (region)"""


@query(o.sql(BOXES, _shape_parity_sql(False)))
def window_parity_of_shapes(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(evaluate.window_parity(_notched(ours(spark, d)), _notched(truth(spark, d)), windows(spark, d), evaluate.SHAPES))


@query(o.sql(BOXES, _shape_parity_sql(True)))
def window_parity_of_clipped_shapes(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(evaluate.window_parity(_notched(ours(spark, d)), _notched(truth(spark, d)), windows(spark, d), evaluate.SHAPES, clip_intersection=True))


@query(
    o.sql(
        BOXES + ", z as (select 400 xmin, 50 ymin, 2000 xmax, 1700 ymax)",
        f"""select t.id, oid as match, round(coalesce(i / (oa + ta - i), 0), 9) iou from (select b.id from truth b, z where {_in_sql("b", "z")} > 0) t left join
 (select * from (select *, row_number() over (partition by tid order by i desc, oid) k from
   (select a.id oid, b.id tid, {_in_sql("a", "z")} oa, {_in_sql("b", "z")} ta, {_both_sql("z")} i from ours a, truth b, z) where i > 0) where k = 1) on tid = t.id""",
    )
)
def best_match_of_shapes(spark: SparkSession, d: str) -> DataFrame:
    got = evaluate.best_match(_notched(ours(spark, d)), _notched(truth(spark, d)), (400.0, 50.0, 2000.0, 1700.0), evaluate.SHAPES)
    return got.withColumn("iou", F.round("iou", 9))


@query(
    """with l as (select n_nationkey k, 40.0::double * n_nationkey x0, case when n_nationkey % 2 = 0 then 40.0::double * n_nationkey + 700 else 40.0::double * n_nationkey end x1,
  -13.0::double * n_nationkey - (case when n_nationkey % 2 = 0 then 0 else 500 end) y0, -13.0::double * n_nationkey y1 from nation),
s as (select *, unnest(range(floor((x0 - 15) / 30)::bigint - 1, floor((x1 + 15) / 30)::bigint + 2)) c from l),
q as (select *, unnest(range(floor((-y1 - 15) / 30)::bigint - 1, floor((-y0 + 15) / 30)::bigint + 2)) r from s)
select distinct r, c from q where power(greatest(c * 30 - x1, x0 - (c + 1) * 30, 0), 2) + power(greatest(-(r + 1) * 30 - y1, y0 + r * 30, 0), 2) <= 225"""
)
def burn_straight_lines(spark: SparkSession, d: str) -> DataFrame:
    """Level and upright lines, for which the pixels within a buffer have a closed form."""
    rows = spark.read.parquet(f"{d}/nation.parquet").select(F.col("n_nationkey").cast("double").alias("k"))

    @F.arrow_udf("binary")
    def line(k: pa.Array) -> pa.Array:
        ends = lambda v: [(40 * v, -13 * v), (40 * v + 700, -13 * v)] if v % 2 == 0 else [(40 * v, -13 * v - 500), (40 * v, -13 * v)]
        return pa.array([geo.encode_line(np.array(ends(v))) for v in k.to_pylist()], pa.binary())

    return vector.burned(rows.select(line("k").alias("geometry")), buffer=15.0)


def _edge_sql() -> str:
    from acreline.plans.queries import _albers_sql

    prelude = _albers_sql().rsplit("select id, round(", 1)[0]
    from acreline.functions import geo as plane

    return prelude + f"select floor((3172605 - ({plane.albers_constants()[2]!r} - rho * cos(theta))) / 30000)::bigint r, floor((rho * sin(theta) + 2356095) / 30000)::bigint c from k group by 1, 2 having max(id % 3) > 1"


@query(_edge_sql())
def edge_raster(spark: SparkSession, d: str) -> DataFrame:
    """Cells of a raster in degrees on a coarser grid in metres, the largest value of each."""
    rows = spark.read.parquet(f"{d}/orders.parquet").select(
        (-125 + (F.col("o_orderkey") * 37 % 5800) / F.lit(100.0)).alias("lon"), (24 + (F.col("o_custkey") * 17 % 2500) / F.lit(100.0)).alias("lat"), (F.col("o_orderkey") % 3 - 1).alias("value")
    )
    return combine.edge_cells(rows, 30_000.0, (-2356095.0, 3172605.0))


@query(o.sql(o.GRAPH + ",\nm0 as (select label, label target from r0)" + o.eliminate_pass(1, 1000), "select label, target from t1"))
def eliminate_shapes_once(spark: SparkSession, d: str) -> DataFrame:
    """Merges of one pass from the borders of polygons."""
    return polygons.merge_targets(shapes(spark, d), 1000.0).select("label", "target")


@query(o.sql(o.ELIMINATED, "select label, n * 900.0::double area from merged"))
def eliminate_shapes(spark: SparkSession, d: str) -> DataFrame:
    """All passes on polygons; areas are those of the merged shapes, not sums."""
    return polygons.eliminate(shapes(spark, d)).select("label", F.round(geo.wkb_area("geometry"), 3).alias("area"))
