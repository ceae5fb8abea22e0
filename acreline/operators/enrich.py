"""Boundaries, national numbering and the dissolve across tile seams.

Regions are sets of labelled pixels, ``tile, label``; a tile's pixels keep
their place ``r, c`` in the national grid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acreline.functions import codes
from acreline.operators.graph import connected_components
from acreline.operators.spatialjoin import largest_overlap, pixel_overlap
from acreline.runtime import stored

ROWS_PER_PART = 100_000


def with_boundary(table: DataFrame, labels: DataFrame, zones: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Regions with the attributes of the boundary that covers most of each.

    ``zones(tile, pix, zone)`` burns ``boundaries(zone, CNTYFIPS, ...)`` into
    pixels; a region outside all of them is dropped, ties go to the smaller
    CNTYFIPS.
    """
    pairs = pixel_overlap(labels, zones).join(boundaries, "zone")
    best = largest_overlap(pairs, ["tile", "label"], "n_pixels", "CNTYFIPS").drop("n_pixels", "zone")
    return table.join(best, ["tile", "label"])


def numbered(df: DataFrame, order: list[str], name: str = "oid") -> DataFrame:
    """Gapless numbers from 1 in a total order, without a single-task window.

    Rows are range-partitioned and stored once, so that counts and numbers see
    the same partitions.
    """
    parts = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()), "numbered")
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # one row per partition
    base = parts.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(before, F.lit(0)).alias("_base"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return parts.join(F.broadcast(base), "_part").withColumn(name, (own + F.col("_base")).cast("long")).drop("_part", "_base")


def extents(labels: DataFrame) -> DataFrame:
    """``tile, label, xmin, ymin, xmax, ymax`` in pixels, the far sides exclusive."""
    return labels.groupBy("tile", "label").agg(F.min("c").alias("xmin"), F.min("r").alias("ymin"), (F.max("c") + 1).alias("xmax"), (F.max("r") + 1).alias("ymax"))


def seam_candidates(boxes: DataFrame, slack: float = 0.0) -> DataFrame:
    """Regions that reach within ``slack`` of their tile's data envelope."""
    tile = Window.partitionBy("tile")
    near = lambda lo, hi: (F.col(lo) <= F.min(lo).over(tile) + slack) | (F.col(hi) >= F.max(hi).over(tile) - slack)
    return boxes.withColumn("_near", near("xmin", "xmax") | near("ymin", "ymax")).where("_near").drop("_near")


def touch_pairs(px: DataFrame) -> DataFrame:
    """``lo, hi`` of numbered regions with equal ``key`` whose pixels touch, at a corner too.

    ``px(oid, key, r, c)`` of the candidates' pixels.
    """
    cells = px.select(F.col("oid").alias("_o"), "key", "r", "c")
    steps = F.explode(F.array(*(F.struct(F.lit(a).alias("dr"), F.lit(b).alias("dc")) for a, b in ((0, 1), (1, -1), (1, 0), (1, 1)))))
    ahead = px.withColumn("_s", steps).select("oid", "key", (F.col("r") + F.col("_s.dr")).alias("r"), (F.col("c") + F.col("_s.dc")).alias("c"))
    return ahead.join(cells, ["key", "r", "c"]).where("oid <> _o").select(F.least("oid", "_o").alias("lo"), F.greatest("oid", "_o").alias("hi")).distinct()


def dissolve(national: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Linked regions become the row of the smallest oid, renumbered: the table and ``oid, root`` of all.

    The root keeps its attributes; ``n_pixels`` is the sum.
    """
    linked = connected_components(pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v"))).withColumnsRenamed({"node": "oid", "component": "root"})
    roots = stored(national.select("oid").join(linked, "oid", "left").select("oid", F.coalesce("root", "oid").alias("root")), "roots")
    sums = national.select("oid", "n_pixels").join(roots, "oid").groupBy("root").agg(F.sum("n_pixels").alias("_sum"))
    absorbed = roots.where("oid <> root").select("oid")
    kept = national.join(absorbed, "oid", "left_anti").join(sums, F.col("oid") == F.col("root")).withColumn("n_pixels", F.col("_sum")).drop("_sum", "root")
    return numbered(kept.withColumnRenamed("oid", "_old"), ["_old"]).drop("_old"), roots


def derived(national: DataFrame, start: int, end: int, pixel_area: float = codes.PIXEL_AREA, prefix: str = "FIELD") -> DataFrame:
    """Adds ``{prefix}ID, {prefix}YEARS, {prefix}ACRES, Shape_area``."""
    tag = codes.years_tag(start, end)
    area = F.col("n_pixels") * F.lit(float(pixel_area))
    return national.withColumns({f"{prefix}YEARS": tag, "Shape_area": area, f"{prefix}ACRES": codes.acres(area), f"{prefix}ID": codes.field_id(F.col("STATEFIPS"), tag, F.col("oid"))})


def replace_from(table: DataFrame, changed: DataFrame, key: str, column: str) -> DataFrame:
    """An update: the column from ``changed`` where the key is there."""
    new = changed.select(key, F.col(column).alias("_new"))
    return table.join(new, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def delete_in(table: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    return table.join(gone.select(key).distinct(), key, "left_anti")
