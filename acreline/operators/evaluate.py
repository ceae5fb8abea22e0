"""Scoring one coverage against another.

Both sides are tables ``id, xmin, ymin, xmax, ymax, area`` and, for classes,
``cls``. What a row covers is a ``Cover``: its box by default, its ``geometry``
with SHAPES, for which areas and what touches a window are exact. Unions are never
built: their area is A + B - I, which holds if neither side overlaps itself.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreline.functions import geometry as g
from acreline.functions.codes import ACRE_M2
from acreline.functions.geo import GRID_LEFT, GRID_PIXEL, GRID_TOP, bbox_filter
from acreline.operators.spatialjoin import box_join

CELL = 500.0
LADDER = tuple(round(0.5 + 0.05 * i, 2) for i in range(10))

# Validation regions, name and target point in metres.
REGIONS = [
    ("iowa_corn_belt", -100000, 1950000), ("illinois_corn", 250000, 2000000), ("nebraska_irrigated", -300000, 1700000), ("kansas_wheat", -300000, 1400000),
    ("texas_panhandle", -625000, 1100000), ("texas_cotton_belt", -350000, 900000), ("mississippi_delta", 250000, 1100000), ("georgia_peanut", 950000, 1100000),
    ("central_valley_ca", -2000000, 1650000), ("imperial_valley_ca", -1750000, 1300000), ("palouse_wheat", -1850000, 2850000), ("snake_river_id", -1500000, 2400000),
    ("northern_plains_nd", -150000, 2700000), ("wisconsin_mixed", 200000, 2400000), ("ohio_corn_soy", 950000, 2100000), ("delmarva", 1700000, 1900000),
]



@dataclass(frozen=True)
class Cover:
    """Columns over rows (structs with a box and, for shapes, ``geometry``) and windows (structs with a box)."""

    overlap: Callable[[str, str], Column]
    meets: Callable[[str, str], Column]
    area_in: Callable[[str, str], Column]
    overlap_in: Callable[[str, str, str], Column]
    clipped: Callable[[DataFrame, tuple[float, float, float, float]], DataFrame]


def _sides(*names: str) -> Column:
    """Area of the intersection of boxes."""
    far = lambda lo, hi: F.greatest(F.least(*(F.col(f"{n}.{hi}") for n in names)) - F.greatest(*(F.col(f"{n}.{lo}") for n in names)), F.lit(0))
    return far("xmin", "xmax") * far("ymin", "ymax")


def _touching(a: str, b: str) -> Column:
    return (F.col(f"{a}.xmin") <= F.col(f"{b}.xmax")) & (F.col(f"{a}.xmax") >= F.col(f"{b}.xmin")) & (F.col(f"{a}.ymin") <= F.col(f"{b}.ymax")) & (F.col(f"{a}.ymax") >= F.col(f"{b}.ymin"))


def _cut_boxes(side: DataFrame, window: tuple[float, float, float, float]) -> DataFrame:
    x0, y0, x1, y1 = window
    cut = side.where(bbox_filter(*window)).withColumns({"xmin": F.greatest("xmin", F.lit(x0)), "ymin": F.greatest("ymin", F.lit(y0)), "xmax": F.least("xmax", F.lit(x1)), "ymax": F.least("ymax", F.lit(y1))})
    return cut.withColumn("area", (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))).where("area > 0")


def _cut_shapes(side: DataFrame, window: tuple[float, float, float, float]) -> DataFrame:
    cut = side.where(bbox_filter(*window)).withColumn("geometry", g.wkb_clip("geometry", *map(F.lit, window))).where("geometry is not null")
    return cut.drop("xmin", "ymin", "xmax", "ymax").withColumns({"area": g.wkb_area("geometry"), "_b": g.wkb_bounds("geometry")}).select("*", "_b.*").drop("_b")


def _corners(w: str) -> list[Column]:
    return [F.col(f"{w}.{c}") for c in ("xmin", "ymin", "xmax", "ymax")]


BOXES = Cover(_sides, _touching, _sides, _sides, _cut_boxes)
SHAPES = Cover(
    lambda a, b: g.wkb_intersection_area(f"{a}.geometry", f"{b}.geometry"),
    lambda a, w: g.wkb_meets_box(f"{a}.geometry", *_corners(w)),
    lambda a, w: g.wkb_area_in_box(f"{a}.geometry", *_corners(w)),
    lambda a, b, w: g.wkb_overlap_in_box(f"{a}.geometry", f"{b}.geometry", *_corners(w)),
    _cut_shapes,
)


def region_window(x: Column, y: Column, tile_size: int = 5000) -> dict[str, Column]:
    """The tile's box that holds a point; offsets are truncated towards zero."""
    side = F.lit(tile_size * GRID_PIXEL)
    col = ((x - F.lit(GRID_LEFT)) / side).cast("int")
    row = ((F.lit(GRID_TOP) - y) / side).cast("int")
    xmin, ymax = F.lit(GRID_LEFT) + col * side, F.lit(GRID_TOP) - row * side
    return {"xmin": xmin, "ymin": ymax - side, "xmax": xmin + side, "ymax": ymax}


def _of_window(side: DataFrame, windows: DataFrame, cover: Cover, cell: float, count: str, acres: str, km2: str) -> DataFrame:
    """Rows, whole acres and clipped area of what touches each window."""
    met = box_join(windows, side, cell).where(cover.meets("b", "a"))
    return met.groupBy(F.col("a.region").alias("region")).agg(
        F.count("*").alias(count), (F.sum("b.area") / ACRE_M2).alias(acres), (F.sum(cover.area_in("b", "a")) / 1e6).alias(km2)
    )


def window_parity(ours: DataFrame, truth: DataFrame, windows: DataFrame, cover: Cover = BOXES, clip_intersection: bool = False, cell: float = CELL) -> DataFrame:
    """One row per window of ``windows(region, xmin, ymin, xmax, ymax)``, all in one pass.

    Areas are clipped to the window; the intersection is with
    ``clip_intersection`` only. A window that one side does not touch has null
    measures.
    """
    a = _of_window(ours, windows, cover, cell, "n_ours", "acres_ours", "km2_ours")
    b = _of_window(truth, windows, cover, cell, "n_truth", "acres_truth", "km2_truth")
    pairs = box_join(ours, truth, cell).withColumn("inter", cover.overlap("a", "b")).where("inter > 0")
    # a pair counts for the windows that both of its rows touch; it is looked for where their boxes meet or lie beside each other
    outer = [F.least(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in ("xmin", "ymin")] + [F.greatest(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in ("xmax", "ymax")]
    whole = pairs.select(F.col("a").alias("first"), F.col("b").alias("second"), "inter", *outer)
    met = box_join(windows, whole, cell).select("a", "b.first", "b.second", "b.inter")
    met = met.where(_touching("first", "a") & _touching("second", "a")).where(cover.meets("first", "a") & cover.meets("second", "a"))
    area = cover.overlap_in("first", "second", "a") if clip_intersection else F.col("inter")
    i = met.groupBy(F.col("a.region").alias("region")).agg((F.sum(area) / 1e6).alias("_i"))
    out = windows.select("region").join(a, "region", "left").join(b, "region", "left").join(i, "region", "left")
    return _measures(out)


def _measures(out: DataFrame) -> DataFrame:
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    out = out.select("region", zero("n_ours"), zero("n_truth"), *(zero(c) for c in ("acres_ours", "acres_truth", "km2_ours", "km2_truth")), F.coalesce("_i", F.lit(0.0)).alias("_i"))
    some = (F.col("n_ours") > 0) & (F.col("n_truth") > 0)
    union = F.col("km2_ours") + F.col("km2_truth") - F.col("_i")
    return out.select(
        *(c for c in out.columns if c != "_i"),
        F.when(some, F.col("_i")).alias("km2_both"),
        F.when(some, union).alias("km2_union"),
        F.when(some, F.try_divide(F.col("_i"), union)).alias("iou"),
        F.when(some, F.try_divide("n_ours", "n_truth")).alias("count_ratio"),
        F.when(some, F.try_divide("acres_ours", "acres_truth")).alias("acre_ratio"),
    )


def whole_parity(ours: DataFrame, truth: DataFrame, cover: Cover = BOXES, cell: float = CELL) -> DataFrame:
    """window_parity over everything, nothing clipped."""
    one = lambda s, n, acres, km2: s.agg(F.count("*").alias(n), (F.sum("area") / ACRE_M2).alias(acres), (F.sum("area") / 1e6).alias(km2)).withColumn("region", F.lit("all"))
    i = box_join(ours, truth, cell).agg((F.sum(cover.overlap("a", "b")) / 1e6).alias("_i")).withColumn("region", F.lit("all"))
    return _measures(one(ours, "n_ours", "acres_ours", "km2_ours").join(one(truth, "n_truth", "acres_truth", "km2_truth"), "region").join(i, "region"))


def confusion(ours: DataFrame, truth: DataFrame, cover: Cover = BOXES, cell: float = CELL) -> DataFrame:
    """``ours, truth, km2`` of every pair of classes that overlap."""
    pairs = box_join(ours, truth, cell).withColumn("_i", cover.overlap("a", "b")).where("_i > 0")
    return pairs.groupBy(F.col("a.cls").alias("ours"), F.col("b.cls").alias("truth")).agg((F.sum("_i") / 1e6).alias("km2"))


def best_match(ours: DataFrame, truth: DataFrame, window: tuple[float, float, float, float] | None = None, cover: Cover = BOXES, cell: float = CELL) -> DataFrame:
    """Each truth row's IoU with the row of ours that overlaps it most; 0 where none does.

    With a window all rows are clipped to it first.
    """
    if window:
        ours, truth = (cover.clipped(s, window) for s in (ours, truth))
    pairs = box_join(ours, truth, cell).withColumn("_i", cover.overlap("a", "b")).where("_i > 0")
    best = pairs.groupBy(F.col("b.id").alias("id")).agg(F.min_by(F.struct("a.id", "a.area", "_i"), F.struct(-F.col("_i"), F.col("a.id"))).alias("m"))
    out = truth.join(best, "id", "left")
    return out.select("id", F.col("m.id").alias("match"), F.coalesce(F.col("m._i") / (F.col("area") + F.col("m.area") - F.col("m._i")), F.lit(0.0)).alias("iou"))


def match_summary(matches: DataFrame) -> DataFrame:
    """Median and mean over matched rows; shares over all."""
    some = F.when(F.col("iou") > 0, F.col("iou"))
    share = lambda cond: (F.count_if(cond) / F.count("*"))
    return matches.agg(
        F.count("*").alias("n"), F.count(some).alias("n_matched"), F.median(some).alias("median_iou"), F.avg(some).alias("mean_iou"),
        share(F.col("iou") >= 0.9).alias("frac_high"), share((F.col("iou") >= 0.5) & (F.col("iou") < 0.9)).alias("frac_mid"),
        share((F.col("iou") > 0) & (F.col("iou") < 0.5)).alias("frac_low"), share(F.col("iou") == 0).alias("frac_none"),
    )


def pairwise_iou(ours: DataFrame, truth: DataFrame, cover: Cover = BOXES, cell: float = CELL) -> DataFrame:
    """``ours, truth, iou`` of all pairs that overlap."""
    pairs = box_join(ours, truth, cell).withColumn("_i", cover.overlap("a", "b")).where("_i > 0")
    return pairs.select(F.col("a.id").alias("ours"), F.col("b.id").alias("truth"), (F.col("_i") / (F.col("a.area") + F.col("b.area") - F.col("_i"))).alias("iou"))


def f1_ladder(ious: DataFrame, n_ours: int, n_truth: int, thresholds: tuple[float, ...] = LADDER) -> DataFrame:
    """``threshold, tp, fp, fn, precision, recall, f1``; a pair matches if its IoU exceeds the threshold."""
    counts = ious.agg(*(F.count_if(F.col("iou") > t).alias(f"_{i}") for i, t in enumerate(thresholds)))
    rungs = F.array(*(F.struct(F.lit(t).alias("threshold"), F.col(f"_{i}").alias("tp")) for i, t in enumerate(thresholds)))
    out = counts.select(F.inline(rungs)).select("threshold", "tp", (F.lit(n_ours) - F.col("tp")).alias("fp"), (F.lit(n_truth) - F.col("tp")).alias("fn"))
    guarded = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    out = out.withColumns({"precision": guarded(F.col("tp"), F.col("tp") + F.col("fp")), "recall": guarded(F.col("tp"), F.col("tp") + F.col("fn"))})
    return out.withColumn("f1", guarded(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def panoptic(ious: DataFrame, n_ours: int, n_truth: int) -> DataFrame:
    """One row: recognition, segmentation and panoptic quality at 0.5, mean F1, difference of counts."""
    if not n_ours or not n_truth:
        return ious.sparkSession.createDataFrame([("one side is empty",)], "error string")
    ladder = f1_ladder(ious, n_ours, n_truth)
    at = ladder.agg(F.max(F.when(F.col("threshold") == 0.5, F.col("f1"))).alias("rq"), F.avg("f1").alias("mean_f1"), F.lit("x").alias("_k"))
    sq = ious.where("iou > 0.5").agg(F.coalesce(F.avg("iou"), F.lit(0.0)).alias("sq"), F.lit("x").alias("_k"))
    return at.join(sq, "_k").select("rq", "sq", (F.col("rq") * F.col("sq")).alias("pq"), "mean_f1", F.lit(n_ours - n_truth).cast("long").alias("count_delta"))


def region_summary(records: DataFrame) -> DataFrame:
    """Over regions with a measure: IoU and the ratios (zero and null ratios are skipped)."""
    ratio = lambda c: F.when(F.col(c) != 0, F.col(c))
    return records.agg(
        F.count("iou").alias("n"), F.avg("iou").alias("mean_iou"), F.median("iou").alias("median_iou"), F.min("iou").alias("min_iou"), F.max("iou").alias("max_iou"),
        F.avg(ratio("count_ratio")).alias("mean_count_ratio"), F.median(ratio("count_ratio")).alias("median_count_ratio"),
        F.avg(ratio("acre_ratio")).alias("mean_acre_ratio"), F.median(ratio("acre_ratio")).alias("median_acre_ratio"),
    )


def quartiles(df: DataFrame, column: str) -> DataFrame:
    q = F.percentile(column, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return df.agg(q.alias("_q"), F.min(column).alias("min"), F.max(column).alias("max")).select(F.col("_q")[1].alias("median"), F.col("_q")[0].alias("q1"), F.col("_q")[2].alias("q3"), "min", "max")


def overlay_areas(ours: DataFrame, truth: DataFrame, cover: Cover = BOXES, cell: float = CELL) -> DataFrame:
    """``km2_both, km2_union, km2_difference`` of two coverages, without building either geometry."""
    one = lambda s, n: s.agg(F.coalesce(F.sum("area"), F.lit(0.0)).alias(n)).withColumn("_k", F.lit(1))
    i = box_join(ours, truth, cell).agg(F.coalesce(F.sum(cover.overlap("a", "b")), F.lit(0.0)).alias("_i")).withColumn("_k", F.lit(1))
    met = one(ours, "_a").join(one(truth, "_b"), "_k").join(i, "_k")
    both = F.col("_a") + F.col("_b")
    return met.select((F.col("_i") / 1e6).alias("km2_both"), ((both - F.col("_i")) / 1e6).alias("km2_union"), ((both - 2 * F.col("_i")) / 1e6).alias("km2_difference"))


def tile_parity(ours: DataFrame, truth: DataFrame, windows: DataFrame, cover: Cover = BOXES, cell: float = CELL) -> DataFrame:
    """window_parity with both sides clipped, and the acres that only one side covers."""
    out = window_parity(ours, truth, windows, cover, clip_intersection=True, cell=cell)
    only = lambda c: (F.col(c) - F.col("km2_both")) * 1e6 / ACRE_M2
    return out.withColumns({"only_ours_acres": only("km2_ours"), "only_truth_acres": only("km2_truth")})


def chamfer_summary(pairs: DataFrame, distance: Column, max_pairs: int | None = None) -> DataFrame:
    """Mean and 95th percentile of ``distance`` over ``pairs(ours, truth, ...)``.

    All of them, or a sample of ``max_pairs``: the first by a hash of the ids,
    the same for every run.
    """
    if max_pairs is not None:
        pairs = pairs.orderBy(F.xxhash64("ours", "truth"), "ours", "truth").limit(max_pairs)
    return pairs.select(distance.alias("_d")).agg(F.count("_d").alias("n"), F.avg("_d").alias("mean_m"), F.percentile("_d", F.lit(0.95)).alias("p95_m"))


def matched_pairs(ours: DataFrame, truth: DataFrame, ious: DataFrame, least: float = 0.5) -> DataFrame:
    """``ours, truth, iou, ours_geometry, truth_geometry`` of the pairs above an IoU."""
    of = lambda s, n: s.select(F.col("id").alias(n), F.col("geometry").alias(f"{n}_geometry"))
    return ious.where(F.col("iou") > least).join(of(ours, "ours"), "ours").join(of(truth, "truth"), "truth")
