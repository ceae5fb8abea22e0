"""Processing windows: enumeration, naming, shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TILE_SIZE = 5000


def row_letters(i: Column) -> Column:
    """0 -> A, 25 -> Z, 26 -> AA, as spreadsheet columns are named (two letters at most)."""
    one = lambda n: F.char(n + 65)
    return F.when(i < 26, one(i)).otherwise(F.concat(one(F.floor(i / 26) - 1), one(i % 26)))


def tile_windows(spark: SparkSession, width: int, height: int, size: int = TILE_SIZE) -> DataFrame:
    """``tile, col_off, row_off, width, height``; the last row and column may be smaller."""
    rows = spark.range(-(-height // size)).withColumnRenamed("id", "i")
    both = rows.select("i", F.explode(F.sequence(F.lit(0), F.lit(-(-width // size) - 1))).alias("j"))
    row_off, col_off = F.col("i") * size, F.col("j") * size
    return both.select(
        F.concat(row_letters(F.col("i")), F.col("j").cast("string")).alias("tile"),
        col_off.cast("long").alias("col_off"),
        row_off.cast("long").alias("row_off"),
        F.least(F.lit(size), F.lit(width) - col_off).cast("long").alias("width"),
        F.least(F.lit(size), F.lit(height) - row_off).cast("long").alias("height"),
    )


def shard(tiles: DataFrame, n_shards: int, index: int | None = None) -> DataFrame:
    """Tiles dealt round robin by name; one shard's, or all with ``shard``. A catalogue, never pixels."""
    if n_shards < 1 or index is not None and not 0 <= index < n_shards:
        raise ValueError(f"no shard {index} of {n_shards}")
    dealt = tiles.withColumn("shard", (F.row_number().over(Window.orderBy("tile")) - 1) % n_shards)
    return dealt if index is None else dealt.where(F.col("shard") == index)


def pending(tiles: DataFrame, done: DataFrame) -> DataFrame:
    """Tiles without a finished row in ``done(tile)``: what a resumed run still has to do."""
    return tiles.join(done.select("tile").distinct(), "tile", "left_anti")


def tile_of_point(tiles: DataFrame, x: float, y: float, left: float, top: float, pixel: float) -> str:
    """The tile that holds a point (left and lower sides belong to it); none is an error."""
    x0, y1 = F.lit(left) + F.col("col_off") * pixel, F.lit(top) - F.col("row_off") * pixel
    held = tiles.where((x0 <= x) & (F.lit(x) < x0 + F.col("width") * pixel) & (y1 - F.col("height") * pixel <= y) & (F.lit(y) < y1))
    found = held.select("tile").first()
    if found is None:
        raise ValueError(f"no tile holds ({x}, {y})")
    return found["tile"]
