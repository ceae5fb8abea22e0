"""Joins of boxes and of what has boxes.

A join on overlapping intervals alone would be a nested loop. Here each box is
dealt to the grid cells it touches, cells are joined by equality, and a pair
is kept only in the cell of its lower left common corner, so once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _dealt(df: DataFrame, name: str, cell: float, keys: tuple[str, ...]) -> DataFrame:
    span = lambda lo, hi: F.sequence(F.floor(F.col(lo) / cell).cast("bigint"), F.floor(F.col(hi) / cell).cast("bigint"))
    whole = F.struct(*df.columns).alias(name)
    return df.select(*keys, whole, F.explode(span("xmin", "xmax")).alias("_cx"), "ymin", "ymax").select(*keys, name, "_cx", F.explode(span("ymin", "ymax")).alias("_cy"))


def box_join(a: DataFrame, b: DataFrame, cell: float, keys: tuple[str, ...] = ()) -> DataFrame:
    """Pairs ``a, b`` (structs) of rows whose boxes touch and whose ``keys`` are equal.

    ``cell`` should be near the size of the larger usual box: a box is sent to
    every cell it touches.
    """
    met = _dealt(a, "a", cell, keys).join(_dealt(b, "b", cell, keys), [*keys, "_cx", "_cy"])
    touch = (F.col("a.xmin") <= F.col("b.xmax")) & (F.col("b.xmin") <= F.col("a.xmax")) & (F.col("a.ymin") <= F.col("b.ymax")) & (F.col("b.ymin") <= F.col("a.ymax"))
    corner = lambda lo: F.floor(F.greatest(F.col(f"a.{lo}"), F.col(f"b.{lo}")) / cell).cast("bigint")
    return met.where(touch & (F.col("_cx") == corner("xmin")) & (F.col("_cy") == corner("ymin"))).select("a", "b")


def largest_overlap(pairs: DataFrame, left: list[str], area: str, tie: str) -> DataFrame:
    """Of each ``left`` the pair with the largest ``area``; the smallest ``tie`` of equals."""
    best = Window.partitionBy(*left).orderBy(F.desc(area), F.col(tie))
    return pairs.withColumn("_k", F.row_number().over(best)).where("_k = 1").drop("_k")


def pixel_overlap(labels: DataFrame, zones: DataFrame) -> DataFrame:
    """``tile, label, zone, n_pixels`` of labelled pixels and ``zones(tile, pix, zone)``."""
    return labels.join(zones.select("tile", "pix", "zone"), ["tile", "pix"]).groupBy("tile", "label", "zone").agg(F.count("*").alias("n_pixels"))


def clipped(box: str, window: str) -> Column:
    """Area of a box within a window, both structs with xmin, ymin, xmax, ymax."""
    from acreline.functions.geo import box_overlap

    return box_overlap(box, window)
