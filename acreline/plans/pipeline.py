"""The two halves of a run: stacks to polygons, polygons to a national table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acreline.functions import codes
from acreline.operators import combine, denoise, enrich, regions, sinks, vector
from acreline.runtime import stored


@dataclass(frozen=True)
class Params:
    start: int = 2018
    end: int = 2025
    min_years: int = 2
    thresholds: tuple[float, ...] = regions.THRESHOLDS
    min_area: float = regions.MIN_AREA
    tolerance: float = 30.0
    general: bool = False
    exclude_low: bool = False
    by_region: bool = False  # retention of whole regions instead of pixels
    dissolve: bool = True
    pixel_m: float = codes.PIXEL_M
    origin: tuple[float, float] = field(default=(0.0, 0.0))
    focal_radius: int = 0  # rounds of the focal filter on each year's classes
    noise_px: int = 0  # components of a year's keys that are healed
    upsample: int = 1  # smaller pixels a side, after the filters
    line_buffer: float = 15.0  # metres around the lines that are burned out

    @property
    def years(self) -> tuple[int, ...]:
        return tuple(range(self.start, self.end + 1))


def keyed_pixels(stack: DataFrame, p: Params) -> DataFrame:
    """Years combined: focal filter, classes to keys, noise filter, smaller pixels, in this order."""
    if p.focal_radius:
        stack = denoise.focal_smooth(stack, p.focal_radius, column="cdl")
    px = combine.keyed(stack, len(p.years), p.general, p.exclude_low, p.noise_px)
    return combine.upsampled(px, p.upsample) if p.upsample > 1 else px


def polygonize(stack: DataFrame, p: Params, mask: DataFrame | None = None, lines: DataFrame | None = None, edges: DataFrame | None = None) -> DataFrame:
    """``tile, label, geometry, area_sqm, effective_count, CDL{year}...`` of a stack of pixels.

    Before labelling are taken out: ``mask(tile, pix)``, the pixels that
    ``lines(geometry)`` touch, and those of ``edges(lon, lat, value)``, a
    raster in degrees. Tiles where nothing is left have no rows.
    """
    pixel = p.pixel_m / p.upsample
    area = pixel * pixel
    px = keyed_pixels(stack, p)
    if p.focal_radius or p.noise_px:
        px = stored(px, "keyed")
    kept = combine.retained(px, 1 if p.by_region else p.min_years)
    kept = kept if mask is None else combine.without(kept, mask)
    kept = kept if lines is None else combine.without_cells(kept, vector.burned(lines, pixel, p.origin, p.line_buffer))
    kept = kept if edges is None else combine.without_cells(kept, combine.edge_cells(edges, pixel, p.origin))
    labels = stored(regions.components(kept.drop("cdl", "keys", "attr")), "labels")
    table = regions.region_table(labels)
    if p.by_region:
        table = regions.keep_cropped(table, p.min_years, p.min_area, area)
        labels = stored(labels.join(table.select("tile", "label"), ["tile", "label"], "left_semi"), "labels")
    edges = stored(regions.adjacency(labels), "edges")
    table, edges, moved = regions.eliminate(stored(table, "regions"), edges, p.thresholds, area)
    steps = [moved]
    if p.dissolve:
        table, same = regions.dissolve_equal(table, edges)
        steps.append(same)
    large = stored(regions.keep_large(table, p.min_area, area), "large")
    final = regions.relabelled(labels, *steps).join(large.select("tile", "label"), ["tile", "label"], "left_semi")
    shapes = vector.outlines(final, pixel, p.origin, p.tolerance).where(F.col("area_sqm") >= p.min_area)
    attr = px.select("tile", F.col("pix").alias("first_pix"), "attr")
    shown = large.join(attr, ["tile", "first_pix"]).select("tile", "label", F.col("effective").alias("effective_count"), *(F.col("attr")[i].alias(f"CDL{y}") for i, y in enumerate(p.years)))
    return shapes.join(shown, ["tile", "label"])


def postprocess(shapes: DataFrame, boundaries: DataFrame, p: Params, cell: float = 50_000.0, prefix: str = "FIELD") -> DataFrame:
    """The national table: boundary of most overlap, seams dissolved, ids and measures.

    ``boundaries`` has ``geometry, STATEFIPS, STATEASD, ASD, CNTY, CNTYFIPS``.
    """
    from acreline.functions import geometry as g
    from acreline.operators.graph import connected_components
    from acreline.operators.spatialjoin import box_join, largest_overlap

    boxed = stored(vector.with_bounds(shapes), "boxed")
    mended = boundaries.withColumn("geometry", g.wkb_repaired("geometry")).where("geometry is not null")
    pairs = box_join(boxed, stored(vector.with_bounds(mended), "boundaries"), cell).withColumn("_o", g.wkb_intersection_area("a.geometry", "b.geometry")).where("_o > 0")
    names = [c for c in boundaries.columns if c != "geometry"]
    flat = pairs.select("a.*", *(F.col(f"b.{c}").alias(c) for c in names), "_o")
    best = largest_overlap(flat, ["tile", "label"], "_o", "CNTYFIPS").drop("_o")
    national = stored(enrich.numbered(best, ["tile", "label"]), "national")
    near = enrich.seam_candidates(national.select("oid", "tile", "STATEFIPS", "geometry", *(f"CDL{y}" for y in p.years), "xmin", "ymin", "xmax", "ymax"), slack=1.0)
    same = ["STATEFIPS", *(f"CDL{y}" for y in p.years)]
    met = box_join(near, near, cell, tuple(same)).where(F.col("a.oid") < F.col("b.oid"))
    met = met.where(g.wkb_touches("a.geometry", "b.geometry")).select(F.col("a.oid").alias("u"), F.col("b.oid").alias("v"))
    linked = stored(connected_components(met), "linked")
    groups = national.join(linked.withColumnsRenamed({"node": "oid", "component": "root"}), "oid")
    united = vector.merge_shapes(groups.select("root", "geometry", "area_sqm"), ["root"]).select(F.col("root").alias("oid"), "geometry")
    absorbed = linked.where("node <> component").select(F.col("node").alias("oid"))
    whole = enrich.replace_from(enrich.delete_in(national, absorbed, "oid"), united, "oid", "geometry")
    whole = enrich.numbered(whole.withColumnRenamed("oid", "_old"), ["_old"]).drop("_old", "xmin", "ymin", "xmax", "ymax")
    made = vector.derive_shape(whole)
    tag = codes.years_tag(p.start, p.end)
    return made.withColumns({f"{prefix}YEARS": tag, f"{prefix}ACRES": codes.acres(F.col("Shape_area")), f"{prefix}ID": codes.field_id(F.col("STATEFIPS"), tag, F.col("oid"))}).drop("tile", "label")


def write_national(table: DataFrame, path: str) -> None:
    sinks.write_geoparquet(table, f"{path}/national")
    sinks.write_states(table, f"{path}/states")
