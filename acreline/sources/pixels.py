"""Pixel stacks: one row per pixel, all years' classes in one array.

``tile STRING, pix BIGINT, r BIGINT, c BIGINT, cdl ARRAY<INT>``; pix numbers a
tile's pixels row by row. A stack needs no shuffle to combine its years.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH = 100
YEARS = tuple(range(2018, 2026))

# The classes that the demonstration grid is painted with.
PAINT = (1, 5, 24, 36, 61, 176, 152, 0, 37)


def demo_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grid of rotating 7 x 11 fields with speckle, from the dense keys of ``orders``."""
    g = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("pix"), F.col("o_custkey").alias("k"))
    g = g.withColumns({"r": F.expr(f"pix div {WIDTH}"), "c": F.col("pix") % WIDTH})
    g = g.withColumn("b", F.expr("(r div 7) * 31 + (c div 11) * 17"))
    paint = F.array(*map(F.lit, PAINT))

    def year(y: F.Column) -> F.Column:
        n = F.when(F.col("k") % 23 == 0, (F.floor(F.col("k") / 23) + y) % 9)
        n = n.when(F.col("b") % 5 == 0, F.when(y == YEARS[0], 0).otherwise(6)).otherwise((F.col("b") + (y - YEARS[0]) * (F.col("b") % 3)) % 6)
        return F.element_at(paint, n.cast("int") + 1)

    return g.select(F.lit("A0").alias("tile"), "pix", "r", "c", F.transform(F.array(*map(F.lit, YEARS)), year).alias("cdl"))


def stack_of(pixel_years: DataFrame, years: tuple[int, ...]) -> DataFrame:
    """A stack from ``tile, pix, r, c, yr, cdl`` rows; a missing year is class 0."""
    out = pixel_years.groupBy("tile", "pix", "r", "c").agg(*(F.max(F.when(F.col("yr") == y, F.col("cdl"))).alias(f"_{y}") for y in years))
    return out.select("tile", "pix", "r", "c", F.array(*(F.coalesce(F.col(f"_{y}"), F.lit(0)) for y in years)).alias("cdl"))


def pixel_years(stack: DataFrame, years: tuple[int, ...] = YEARS) -> DataFrame:
    """One row per pixel and year."""
    return stack.select("tile", "pix", "r", "c", F.posexplode("cdl").alias("_i", "cdl")).select("tile", "pix", "r", "c", (F.col("_i") + years[0]).alias("yr"), "cdl")
