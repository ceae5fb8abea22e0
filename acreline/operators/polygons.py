"""Merging of small polygons on their shapes alone, without pixels.

The same merges as ``regions.eliminate``, from shared borders of polygons
where that counts pixel sides; each checks the other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreline.functions import geometry as geo
from acreline.operators import vector
from acreline.operators.regions import THRESHOLDS
from acreline.operators.spatialjoin import box_join
from acreline.runtime import stored


def small_beside_large(shapes: DataFrame, threshold: float, cell: float = 2_000.0) -> DataFrame:
    """``tile, label, target, length``: small shapes, and the large ones of their tile with a border in common.

    ``shapes(tile, label, geometry, area_sqm)``; small is an area of at most
    ``threshold``. Shapes that meet in points only are no pair.
    """
    boxed = vector.with_bounds(shapes.select("tile", "label", "geometry", "area_sqm"))
    small = F.col("area_sqm") <= threshold
    pairs = box_join(boxed.where(small), boxed.where(~small), cell, ("tile",))
    met = pairs.select(F.col("a.tile").alias("tile"), F.col("a.label").alias("label"), F.col("b.label").alias("target"), geo.wkb_shared_length("a.geometry", "b.geometry").alias("length"))
    return met.where("length > 0")


def merge_targets(shapes: DataFrame, threshold: float, cell: float = 2_000.0) -> DataFrame:
    """``tile, label, target``: the large neighbour along the longest border, the smallest label of equals."""
    best = F.min_by("target", F.struct(-F.col("length"), F.col("target")))
    return small_beside_large(shapes, threshold, cell).groupBy("tile", "label").agg(best.alias("target"))


def eliminate(shapes: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS, cell: float = 2_000.0) -> DataFrame:
    """Shapes after passes of merging the small ones; what has no large neighbour stays."""
    shapes = shapes.select("tile", "label", "geometry", "area_sqm")
    for threshold in thresholds:
        to = stored(merge_targets(shapes, threshold, cell), "merges")
        moved = shapes.join(to, ["tile", "label"], "left").withColumn("_at", F.coalesce("target", "label"))
        changed = to.select("tile", F.col("target").alias("_at")).distinct()
        united = vector.merge_shapes(moved.join(changed, ["tile", "_at"], "left_semi").select("tile", F.col("_at").alias("label"), "geometry", "area_sqm"), ["tile", "label"])
        kept = moved.where("target is null").join(changed, ["tile", "_at"], "left_anti").select("tile", "label", "geometry", "area_sqm")
        shapes = stored(kept.unionByName(united.select("tile", "label", "geometry", "area_sqm")), "eliminated")
    return shapes
