"""Regions: components of equal pixels, their graph, and merging on the graph.

Pixels are touched twice: to label them and to count what the graph needs.
All merging works on regions and edges, which are far fewer. A region's label
is the smallest pixel of the component it grew from; a merged region keeps the
label of the region that absorbed the others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreline.functions.codes import PIXEL_AREA, PIXEL_M
from acreline.operators import blocks
from acreline.operators.graph import connected_components
from acreline.runtime import stored

THRESHOLDS = (100.0, 1000.0, 10000.0, 10000.0)
MIN_AREA = 10000.0
#: Rows of three numbers up to which a table, counted first, is broadcast.
BROADCAST_ROWS = 500_000


def components(px: DataFrame, value: str = "seq") -> DataFrame:
    """px with ``label``: 4-connected pixels of a tile with one value.

    A block's pixels are labelled at once; the graph has those components
    only that touch across the borders of blocks. Columns that are not needed
    should be left out of px, as all go through the kernel.
    """

    def label(table: pa.Table) -> pa.Table:
        block = blocks.Block(table)
        grid, n = blocks.label_grid(block.codes(value)[0])
        own, pix = grid[block.at], block.table.column("pix").to_numpy()
        least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(least, own, pix)
        return block.table.drop_columns(["_br", "_bc"]).append_column("_local", pa.array(least[own]))

    schema = T.StructType([*px.schema.fields, T.StructField("_local", T.LongType())])
    local = stored(blocks.dealt(px).groupBy("tile", "_br", "_bc").applyInArrow(label, schema), "blocks")
    side = local.select("tile", "r", "c", F.col(value).alias("_v"), "_local")
    first = lambda c: F.col(c) % blocks.BLOCK == 0
    ahead = side.where(blocks.border("r")).withColumn("r", F.col("r") + 1).union(side.where(blocks.border("c")).withColumn("c", F.col("c") + 1))
    ahead = ahead.select("tile", "r", "c", F.col("_v").alias("_w"), F.col("_local").alias("_other"))
    node = lambda c: F.struct("tile", F.col(c).alias("label"))
    edges = side.where(first("r") | first("c")).join(ahead, ["tile", "r", "c"]).where(F.col("_v").eqNullSafe(F.col("_w"))).select(node("_local").alias("u"), node("_other").alias("v"))
    linked = connected_components(edges).select("node.tile", F.col("node.label").alias("_local"), F.col("component.label").alias("_root"))
    linked = stored(linked, "linked")
    linked = F.broadcast(linked) if linked.count() <= BROADCAST_ROWS else linked
    return local.join(linked, ["tile", "_local"], "left").withColumn("label", F.coalesce("_root", "_local")).select(*px.columns, "label")


def adjacency(labels: DataFrame) -> DataFrame:
    """``tile, lo, hi, sides``: pixel sides between regions, lo < hi."""
    return blocks.pair_counts(labels).where("lo <> hi")


def region_table(labels: DataFrame) -> DataFrame:
    """``tile, label, n_pixels, first_pix, seq, effective`` of labelled pixels."""
    return labels.groupBy("tile", "label").agg(F.count("*").alias("n_pixels"), F.min("pix").alias("first_pix"), F.min_by("seq", "pix").alias("seq"), F.min_by("effective", "pix").alias("effective"))


def small_labels(regions: DataFrame, threshold: float, pixel_area: float = PIXEL_AREA) -> DataFrame:
    return regions.where(F.col("n_pixels") * pixel_area <= threshold).select("tile", "label")


def merge_targets(regions: DataFrame, edges: DataFrame, threshold: float, pixel_area: float = PIXEL_AREA) -> DataFrame:
    """``tile, label, target``: the large neighbour along the longest border, the smallest label of equals.

    A target is never small itself, so merges do not chain.
    """
    flags = regions.select("tile", "label", (F.col("n_pixels") * pixel_area <= threshold).alias("small"))
    of = lambda end: flags.select("tile", F.col("label").alias(end), F.col("small").alias(f"_{end}"))
    mixed = edges.join(of("lo"), ["tile", "lo"]).join(of("hi"), ["tile", "hi"]).where(F.col("_lo") != F.col("_hi"))
    sided = mixed.select("tile", F.when(F.col("_lo"), F.col("lo")).otherwise(F.col("hi")).alias("label"), F.when(F.col("_lo"), F.col("hi")).otherwise(F.col("lo")).alias("target"), "sides")
    return sided.groupBy("tile", "label").agg(F.min_by("target", F.struct(-F.col("sides"), F.col("target"))).alias("target"))


def _relabel(regions: DataFrame, edges: DataFrame, to: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Regions and edges after ``to(tile, label, target)``; others keep their label."""
    moved = regions.join(to, ["tile", "label"], "left").withColumn("_at", F.coalesce("target", "label"))
    regions = moved.groupBy("tile", "_at").agg(
        F.sum("n_pixels").alias("n_pixels"), F.min("first_pix").alias("first_pix"), F.min_by("seq", "first_pix").alias("seq"), F.min_by("effective", "first_pix").alias("effective")
    ).withColumnRenamed("_at", "label")
    end = lambda e, name: e.join(to.withColumnsRenamed({"label": name, "target": "_t"}), ["tile", name], "left").withColumn(name, F.coalesce("_t", name)).drop("_t")
    moved = end(end(edges, "lo"), "hi").where("lo <> hi").select("tile", F.least("lo", "hi").alias("lo"), F.greatest("lo", "hi").alias("hi"), "sides")
    return regions, moved.groupBy("tile", "lo", "hi").agg(F.sum("sides").alias("sides"))


def eliminate(regions: DataFrame, edges: DataFrame, thresholds: tuple[float, ...] = THRESHOLDS, pixel_area: float = PIXEL_AREA) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Passes of merging small regions: regions, edges and ``tile, label, target`` of all old labels."""
    mapping = regions.select("tile", "label", F.col("label").alias("target"))
    for threshold in thresholds:
        if threshold < pixel_area:
            continue  # no region is that small
        to = stored(merge_targets(regions, edges, threshold, pixel_area), "merges")
        regions, edges = (stored(x, "graph") for x in _relabel(regions, edges, to))
        step = to.withColumnsRenamed({"label": "_l", "target": "_t"})
        mapping = mapping.join(step, (mapping["tile"] == step["tile"]) & (mapping["target"] == step["_l"]), "left").select(mapping["tile"], "label", F.coalesce("_t", "target").alias("target"))
    return regions, edges, stored(mapping, "mapping")


def dissolve_equal(regions: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Adjacent regions whose first pixels share a sequence become one: regions and the mapping.

    The smallest label stays.
    """
    seq = lambda end: regions.select("tile", F.col("label").alias(end), F.col("seq").alias(f"_{end}"))
    same = edges.join(seq("lo"), ["tile", "lo"]).join(seq("hi"), ["tile", "hi"]).where(F.col("_lo") == F.col("_hi"))
    node = lambda c: F.struct("tile", F.col(c).alias("label"))
    linked = connected_components(same.select(node("lo").alias("u"), node("hi").alias("v"))).select("node.tile", "node.label", F.col("component.label").alias("target"))
    mapping = regions.select("tile", "label").join(linked, ["tile", "label"], "left").select("tile", "label", F.coalesce("target", "label").alias("target"))
    merged, _ = _relabel(regions, edges, mapping)
    return merged, mapping


def keep_large(regions: DataFrame, min_area: float = MIN_AREA, pixel_area: float = PIXEL_AREA) -> DataFrame:
    return regions.where(F.col("n_pixels") * pixel_area >= min_area)


def keep_cropped(regions: DataFrame, min_years: int = 2, min_area: float = MIN_AREA, pixel_area: float = PIXEL_AREA) -> DataFrame:
    """Retention by region: enough crop years, or large with one at least."""
    large = (F.col("n_pixels") * pixel_area >= min_area) & (F.col("effective") >= 1)
    return regions.where((F.col("effective") >= min_years) | large)


def relabelled(labels: DataFrame, *mappings: DataFrame) -> DataFrame:
    """Labelled pixels after one or more mappings, one after the other."""
    for m in mappings:
        labels = labels.join(m, ["tile", "label"]).withColumn("label", F.col("target")).drop("target")
    return labels


def perimeters(labels: DataFrame, pixel_m: float = PIXEL_M) -> DataFrame:
    """``tile, label, perimeter``: sides without a pixel of the same region beyond them."""
    own = labels.groupBy("tile", "label").agg(F.count("*").alias("n"))
    inner = blocks.pair_counts(labels).where("lo = hi").select("tile", F.col("lo").alias("label"), F.col("sides").alias("inner"))
    return own.join(inner, ["tile", "label"], "left").select("tile", "label", ((4 * F.col("n") - 2 * F.coalesce("inner", F.lit(0))) * pixel_m).alias("perimeter"))
