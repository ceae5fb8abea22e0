"""From a stack of years to sequence keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreline.functions import codes, geo
from acreline.operators import denoise

MIN_CROP_YEARS = 2


def keyed(stack: DataFrame, n_years: int, general: bool = False, exclude_low: bool = False, noise_px: int = 0) -> DataFrame:
    """Adds ``keys``, ``seq``, ``effective`` and ``attr``, the classes given out.

    By default other classes than crops count as barren, and a pixel shows its
    keys; with ``general`` it shows its raw classes where the general class is
    not 0. Row-wise, without a shuffle, unless components of at most
    ``noise_px`` pixels of a year's keys are healed.
    """
    key = codes.general_class if general else lambda v: codes.crop_or_barren(v, exclude_low)
    out = stack.withColumn("keys", F.transform(F.slice("cdl", 1, n_years), key))
    out = denoise.heal_noise(out, noise_px, "keys") if noise_px else out
    raw = F.zip_with(F.slice("cdl", 1, n_years), "keys", lambda v, k: F.when(k == 0, 0).otherwise(v)) if general else F.col("keys")
    barren = codes.GENERAL_BARREN if general else codes.BARREN
    made = lambda k: F.struct(k.alias("keys"), codes.pack(k, n_years).alias("seq"), codes.effective(k, n_years, barren).alias("effective"))
    # by a generator of one row: a filter on what it makes is not moved below it, where all would be worked out once more
    columns = [F.col(f"`{c}`") for c in out.columns if c not in ("keys", "seq", "effective")]
    return out.select(*columns, F.inline(F.transform(F.array("keys"), made))).withColumn("attr", F.transform(raw, codes.shown))


def sequences(px: DataFrame) -> DataFrame:
    """Distinct sequences of each tile: pixels, first pixel and that pixel's classes.

    ``combo`` numbers them from 1 in the unsigned order of keys.
    """
    groups = px.groupBy("tile", "seq").agg(
        F.count("*").alias("n_pixels"), F.min("pix").alias("first_pix"), F.min_by("attr", "pix").alias("attr"), F.first("effective").alias("effective")
    )
    from pyspark.sql import Window

    return groups.withColumn("combo", F.row_number().over(Window.partitionBy("tile").orderBy(codes.ordered(F.col("seq")))))


def retained(px: DataFrame, min_years: int = MIN_CROP_YEARS) -> DataFrame:
    return px.where(F.col("effective") >= min_years)


def without(px: DataFrame, mask: DataFrame) -> DataFrame:
    """Pixels that are not in ``mask(tile, pix)``, such as roads."""
    return px.join(mask.select("tile", "pix").distinct(), ["tile", "pix"], "left_anti")


def without_cells(px: DataFrame, cells: DataFrame) -> DataFrame:
    """Pixels that are not among ``cells(r, c)`` of the whole grid."""
    return px.join(cells.select("r", "c").distinct(), ["r", "c"], "left_anti")


def upsampled(px: DataFrame, k: int, width: int = 1 << 31) -> DataFrame:
    """Every pixel as k x k smaller ones, nearest neighbour; ``width`` is at least the tile's in pixels."""
    cells = F.expr(f"transform(sequence(0, {k * k - 1}), x -> struct(x div {k} as dr, x % {k} as dc))")
    out = px.withColumn("_d", F.explode(cells))
    r, c = F.col("r") * k + F.col("_d.dr"), F.col("c") * k + F.col("_d.dc")
    return out.withColumns({"r": r, "c": c}).withColumn("pix", F.col("r") * F.lit(width * k).cast("long") + F.col("c")).drop("_d")


def edge_cells(edges: DataFrame, pixel: float, origin: tuple[float, float]) -> DataFrame:
    """``r, c`` of the cells that hold the centre of a set cell of ``edges(lon, lat, value)``, a raster in degrees.

    A cell takes the largest value of the finer cells in it.
    """
    x, y = geo.albers(F.col("lon"), F.col("lat"))
    at = edges.select(F.floor((F.lit(origin[1]) - y) / pixel).alias("r"), F.floor((x - F.lit(origin[0])) / pixel).alias("c"), "value")
    return at.groupBy("r", "c").agg(F.max("value").alias("_most")).where("_most > 0").select("r", "c")
