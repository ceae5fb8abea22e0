"""Parameter sweeps: polygonize under a grid of parameters and score against truth by region."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace
from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreline.functions import geometry as g
from acreline.operators import evaluate, vector
from acreline.operators.spatialjoin import box_join
from acreline.plans.pipeline import Params, polygonize
from acreline.runtime import stored

CELL = 5000.0


def grid(**values: list) -> Iterator[dict]:
    """Every combination of values of some parameters."""
    for chosen in product(*values.values()):
        yield dict(zip(values, chosen, strict=True))


def in_windows(stack: DataFrame, windows: DataFrame, p: Params) -> DataFrame:
    """The whole tiles of a stack that touch a window."""
    x, y = F.lit(p.origin[0]) + F.col("c") * p.pixel_m, F.lit(p.origin[1]) - F.col("r") * p.pixel_m
    extent = stack.groupBy("tile").agg(F.min(x).alias("xmin"), F.min(y - p.pixel_m).alias("ymin"), F.max(x + p.pixel_m).alias("xmax"), F.max(y).alias("ymax"))
    tiles = box_join(extent, windows, 150_000.0).select(F.col("a.tile").alias("tile")).distinct()
    return stack.join(F.broadcast(tiles), "tile", "left_semi")  # a row per tile


def sweep(stack: DataFrame, truth: DataFrame, windows: DataFrame, base: Params, combinations: Iterator[dict], **cut: DataFrame) -> Iterator[tuple[dict, DataFrame]]:
    """Each combination with its ``tile_parity`` by region.

    ``truth`` has ``geometry``; a combination's ``road_mask`` says whether
    ``cut`` (mask, lines, edges of ``polygonize``) is applied.
    """
    near = stored(in_windows(stack, windows, base), "near")
    truth = stored(sided(truth), "truth")
    for one in combinations:
        fields = {k: v for k, v in one.items() if k != "road_mask"}
        made = polygonize(near, replace(base, **fields), **(cut if one.get("road_mask", True) else {}))
        yield one, evaluate.tile_parity(stored(sided(made), "ours"), truth, windows, evaluate.SHAPES, CELL)


def sided(shapes: DataFrame) -> DataFrame:
    """Shapes as a side of a comparison, made valid: ``id, area`` and box columns."""
    shapes = shapes.withColumn("geometry", g.wkb_repaired("geometry"))
    boxed = shapes if "xmin" in shapes.columns else vector.with_bounds(shapes)
    return boxed.withColumns({"id": F.monotonically_increasing_id(), "area": g.wkb_area("geometry")})
