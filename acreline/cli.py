"""Command line: ``python -m acreline.cli COMMAND ...``."""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def thresholds(text: str) -> tuple[float, ...]:
    """A comma list of square metres; empty for the default."""
    from acreline.operators.regions import THRESHOLDS

    try:
        return tuple(float(x) for x in text.split(",") if x.strip()) or THRESHOLDS
    except ValueError as e:
        raise argparse.ArgumentTypeError(f"not a list of numbers: {text}") from e


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="acreline")
    sub = top.add_subparsers(dest="command", required=True)

    def add(name: str, about: str, *paths: str) -> argparse.ArgumentParser:
        p = sub.add_parser(name, help=about)
        for path in paths:
            p.add_argument(path)
        return p

    def shared(p: argparse.ArgumentParser) -> None:
        p.add_argument("--start", type=int, default=2018)
        p.add_argument("--end", type=int, default=2025)
        p.add_argument("--min-years", type=int, default=2)
        p.add_argument("--thresholds", type=thresholds, default=thresholds(""))
        p.add_argument("--min-area", type=float, default=10000.0)
        p.add_argument("--tolerance", type=float, default=30.0)
        for flag in ("--general", "--exclude-low", "--by-region", "--no-dissolve"):
            p.add_argument(flag, action="store_true")
        p.add_argument("--focal-radius", type=int, default=0, help="focal filter on every year")
        p.add_argument("--noise", type=int, default=0, help="heal components of that many pixels of every year")
        p.add_argument("--upsample", type=int, default=1)
        p.add_argument("--origin", default="0,0", help="left and top of pixel (0, 0)")

    def masks(p: argparse.ArgumentParser) -> None:
        p.add_argument("--mask", help="Parquet (tile, pix) to leave out")
        p.add_argument("--lines", help="Parquet with geometry of lines to burn out")
        p.add_argument("--line-buffer", type=float, default=15.0)
        p.add_argument("--edges", help="Parquet (lon, lat, value) of an edge raster to leave out")

    p = add("polygonize", "stacks or rasters to tile polygons", "source", "target")
    shared(p)
    masks(p)
    p.add_argument("--tile", default="5000")
    p.add_argument("--area", help="one tile only")
    p.add_argument("--shards", type=int, default=1)
    p.add_argument("--shard", type=int, default=0)
    p.add_argument("--resume", action="store_true", help="skip the tiles that target has")
    p = add("postprocess", "tile polygons to the national and state tables", "source", "boundaries", "target")
    shared(p)
    p = add("run-all", "polygonize and postprocess", "source", "boundaries", "target")
    shared(p)
    masks(p)
    p.add_argument("--tile", default="5000")
    p = add("boundaries", "counties and crosswalk to boundaries", "counties", "crosswalk", "target")
    p.add_argument("--projected", action="store_true", help="geometries are in metres already")
    p = add("roads", "segments to road and rail lines", "segments", "target")
    p.add_argument("--classes", default="motorway,trunk,primary,secondary,tertiary")
    p.add_argument("--window", default="-125,24,-66.5,50")
    p.add_argument("--projected", action="store_true", help="geometries are in metres already")
    p = add("raster-urls", "where yearly rasters are", "base")
    p.add_argument("years")
    p.add_argument("--resolution", type=int, default=30)
    p = add("fetch-rasters", "download yearly rasters", "base", "target")
    p.add_argument("years")
    p.add_argument("--resolution", type=int, default=30)
    p.add_argument("--overwrite", action="store_true")
    p.add_argument("--workers", type=int, default=8)
    p = add("lines", "road and rail shapefiles, downloaded or given, to lines", "source", "target")
    p.add_argument("--areas", help="comma list; source is then a URL with {area}")
    p.add_argument("--rails", help="glob of rail shapefiles")
    p.add_argument("--folder", help="where downloads go")
    p.add_argument("--workers", type=int, default=8)
    p = add("figure", "PNG of two coverages in a window", "ours", "truth", "target")
    p.add_argument("--window", required=True, help="xmin,ymin,xmax,ymax")
    p.add_argument("--size", type=int, default=512)
    for name, about in (("map-tiles", "vector tiles in one archive"), ("map-features", "one FlatGeobuf file")):
        p = add(name, about, "source", "target")
        p.add_argument("--zooms", default="4,12")
        p.add_argument("--attributes", default="", help="comma list; all for none")
    p = add("bench-eliminate", "time elimination on growing windows", "source")
    p.add_argument("--sizes", default="1000,2500,5000")
    p.add_argument("--repeats", type=int, default=5)
    p.add_argument("--fresh", action="store_true", help="a process for each run")
    add("index", "Hilbert-sorted copy with boxes", "source", "target")
    p = add("parity", "coverage of ours and truth", "ours", "truth")
    p.add_argument("--whole", action="store_true")
    p.add_argument("--per-class", type=int, metavar="YEAR")
    p.add_argument("--tile", type=int, default=5000)
    p.add_argument("--report", help="folder that JSON rows are added to")
    for name, about in (("match", "best match of every truth polygon"), ("instances", "F1 ladder, panoptic quality and border distance")):
        p = add(name, about, "ours", "truth")
        p.add_argument("--regions", action="store_true", help="for each validation region")
        p.add_argument("--tile", type=int, default=5000)
        p.add_argument("--report", help="folder that JSON rows are added to")
    p = add("sweep", "scores against truth, by region, under a grid of parameters", "source", "truth")
    shared(p)
    masks(p)
    for name in ("--grid-min-years", "--grid-tolerances", "--grid-min-areas"):
        p.add_argument(name, default="", help="comma list")
    p.add_argument("--grid-dissolve", action="store_true", help="with and without")
    p.add_argument("--grid-road-mask", action="store_true", help="with and without")
    p.add_argument("--window", help="xmin,ymin,xmax,ymax instead of the validation regions")
    p.add_argument("--tile", type=int, default=5000)
    p.add_argument("--report", help="folder that JSON rows are added to")
    return top


def params(a: argparse.Namespace):  # noqa: ANN201
    from acreline.plans.pipeline import Params

    x0, y0 = (float(v) for v in a.origin.split(","))
    filters = {"focal_radius": a.focal_radius, "noise_px": a.noise, "upsample": a.upsample, "line_buffer": getattr(a, "line_buffer", 15.0), "origin": (x0, y0)}
    return Params(a.start, a.end, a.min_years, a.thresholds, a.min_area, a.tolerance, a.general, a.exclude_low, a.by_region, not a.no_dissolve, **filters)


def cuts(spark: SparkSession, a: argparse.Namespace) -> dict[str, DataFrame]:
    """What is taken out before labelling."""
    return {n: spark.read.parquet(path) for n, path in (("mask", a.mask), ("lines", a.lines), ("edges", a.edges)) if path}


def region_windows(spark: SparkSession, tile: int) -> DataFrame:
    from acreline.operators import evaluate

    points = spark.createDataFrame([(n, float(x), float(y)) for n, x, y in evaluate.REGIONS], "region string, x double, y double")
    return points.select("region", *(c.alias(n) for n, c in evaluate.region_window(F.col("x"), F.col("y"), tile).items()))


def scores(spark: SparkSession, a: argparse.Namespace, ours: DataFrame, truth: DataFrame, cell: float) -> DataFrame:
    """Match or instance figures of the whole, or a row per region that truth touches."""
    from acreline.functions import geometry as g
    from acreline.operators import evaluate

    def one(ours: DataFrame, truth: DataFrame) -> DataFrame:
        if a.command == "match":
            return evaluate.match_summary(evaluate.best_match(ours, truth, cover=evaluate.SHAPES, cell=cell))
        from acreline.runtime import stored

        ious = stored(evaluate.pairwise_iou(ours, truth, evaluate.SHAPES, cell), "iou")
        made = evaluate.panoptic(ious, ours.count(), truth.count())
        if "error" in made.columns:
            return made
        pairs = evaluate.matched_pairs(ours, truth, ious)
        far = evaluate.chamfer_summary(pairs, g.wkb_chamfer("ours_geometry", "truth_geometry"))
        return made.crossJoin(F.broadcast(far.withColumnRenamed("n", "n_chamfer")))  # a row each

    if not a.regions:
        return one(ours, truth)
    out = None
    for r in region_windows(spark, a.tile).collect():
        window = (r["xmin"], r["ymin"], r["xmax"], r["ymax"])
        got = one(*(evaluate.SHAPES.clipped(s, window) for s in (ours, truth))).select(F.lit(r["region"]).alias("region"), "*")
        out = got if out is None else out.unionByName(got, allowMissingColumns=True)
    return out


def stacks(spark: SparkSession, source: str, years: tuple[int, ...], tile: str) -> DataFrame:
    """A Parquet stack, or rasters by a path with ``{year}``."""
    if "{year}" not in source:
        return spark.read.parquet(source)
    from acreline.sources.geotiff import GeoTiffSource
    from acreline.sources.pixels import stack_of

    spark.dataSource.register(GeoTiffSource)
    rows = spark.read.format("classraster").option("path", source).option("years", ",".join(map(str, years))).option("tile", tile).load()
    return stack_of(rows, years)


def sides(spark: SparkSession, *paths: str) -> list[DataFrame]:
    """Indexed polygon tables as sides of a comparison."""
    from acreline.plans.experiment import sided
    from acreline.runtime import stored

    return [stored(sided(spark.read.parquet(p)), "side") for p in paths]


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("acreline").getOrCreate()
    started = time.time()
    from acreline.functions import geometry as g
    from acreline.operators import evaluate, sinks, tiles, vector
    from acreline.plans import pipeline
    from acreline.sources import tables

    out: DataFrame | None = None
    if a.command in ("polygonize", "run-all"):
        p = params(a)
        rows = stacks(spark, a.source, p.years, a.tile)
        if a.command == "polygonize":
            names = rows.select("tile").distinct()
            names = names.where(F.col("tile") == a.area) if a.area else tiles.shard(names, a.shards, a.shard)
            if a.resume:
                names = tiles.pending(names, spark.read.parquet(a.target))
            rows = rows.join(names, "tile", "left_semi")
        shapes = pipeline.polygonize(rows, p, **cuts(spark, a))
        target = a.target if a.command == "polygonize" else f"{a.target}/tiles"
        shapes.write.mode("append" if a.command == "polygonize" and a.resume else "overwrite").partitionBy("tile").parquet(target)
    if a.command in ("postprocess", "run-all"):
        source = a.source if a.command == "postprocess" else f"{a.target}/tiles"
        pipeline.write_national(pipeline.postprocess(spark.read.parquet(source), spark.read.parquet(a.boundaries), params(a)), a.target)
    elif a.command == "boundaries":
        made = tables.boundaries(spark.read.parquet(a.counties), tables.read_crosswalk(spark, a.crosswalk))
        sinks.write_geoparquet(made if a.projected else made.withColumn("geometry", g.wkb_albers("geometry")), a.target)
    elif a.command == "roads":
        window = tuple(float(x) for x in a.window.split(","))
        lines = tables.roads(spark.read.parquet(a.segments), tuple(a.classes.split(",")), window).where("geometry is not null").select("geometry", "kind")
        lines = lines if a.projected else lines.withColumn("geometry", g.wkb_albers("geometry"))
        vector.with_bounds(lines).write.mode("overwrite").option("compression", "zstd").parquet(a.target)
    elif a.command == "raster-urls":
        out = spark.createDataFrame([(tables.raster_url(a.base, int(y), a.resolution),) for y in a.years.split(",")], "url string")
    elif a.command == "fetch-rasters":
        from acreline.sources.fetch import fetch_rasters

        got = fetch_rasters(spark, a.base, tuple(int(y) for y in a.years.split(",")), a.target, a.resolution, a.overwrite, a.workers)
        out = spark.createDataFrame([(y,) for y in got], "year int")
    elif a.command == "lines":
        from acreline.sources.fetch import fetch_lines
        from acreline.sources.shapefile import ShapefileSource

        spark.dataSource.register(ShapefileSource)
        source = ",".join(fetch_lines(spark, a.source, a.areas.split(","), a.folder or f"{a.target}-archives", a.workers)) if a.areas else a.source
        load = lambda path: spark.read.format("shapes").option("path", path).load()
        lines = tables.coded_lines(load(source), rails=load(a.rails) if a.rails else None)
        projected = lines.where("geometry is not null").withColumn("geometry", g.wkb_albers("geometry"))
        vector.with_bounds(projected.select("geometry", "kind")).write.mode("overwrite").option("compression", "zstd").parquet(a.target)
    elif a.command == "figure":
        from acreline.operators.figure import render_comparison

        ours, truth = (vector.with_bounds(spark.read.parquet(p).select("geometry")) for p in (a.ours, a.truth))
        print(json.dumps(render_comparison(ours, truth, tuple(float(x) for x in a.window.split(",")), a.target, a.size)))
    elif a.command in ("map-tiles", "map-features"):
        from acreline.operators import mapfiles

        shapes = sinks.for_map(spark.read.parquet(a.source))
        names = [c for c in a.attributes.split(",") if c] or [c for c in shapes.columns if c != "geometry"]
        if a.command == "map-features":
            n = mapfiles.write_flatgeobuf(shapes.select(*names, "geometry"), a.target)
        else:
            low, high = map(int, a.zooms.split(","))
            n = mapfiles.write_archive(mapfiles.tiles(shapes, names, (low, high)), a.target, names, (low, high))
        print(json.dumps({"written": n}))
    elif a.command == "bench-eliminate":
        from acreline.plans import elimination

        rows, sizes = spark.read.parquet(a.source), tuple(int(x) for x in a.sizes.split(","))
        made = []
        for record in elimination.fresh_runs(a.source, sizes, a.repeats) if a.fresh else elimination.runs(rows, len(rows.first()["cdl"]), sizes, a.repeats):
            print(json.dumps(record), flush=True)
            made.append(record)
        for record in elimination.summary(spark, made):
            print(json.dumps(record))
    elif a.command == "index":
        sinks.write_indexed(vector.with_bounds(spark.read.parquet(a.source)), a.target)
    elif a.command in ("parity", "match", "instances"):
        ours, truth = sides(spark, a.ours, a.truth)
        cell = 5000.0
        if a.command != "parity":
            out = scores(spark, a, ours, truth, cell)
        elif a.per_class:
            cls = lambda s: s.withColumn("cls", F.col(f"CDL{a.per_class}"))
            out = evaluate.confusion(cls(ours), cls(truth), evaluate.SHAPES, cell).orderBy(F.desc("km2"), "ours", "truth").limit(25)
        elif a.whole:
            out = evaluate.whole_parity(ours, truth, evaluate.SHAPES, cell)
        else:
            out = evaluate.window_parity(ours, truth, region_windows(spark, a.tile), evaluate.SHAPES, cell=cell)
    elif a.command == "sweep":
        from acreline.plans import experiment

        base, both = params(a), lambda flag, one: [True, False] if flag else [one]
        numbers = lambda text, one, kind: [kind(v) for v in text.split(",") if v] or [one]
        chosen = experiment.grid(
            min_years=numbers(a.grid_min_years, base.min_years, int), tolerance=numbers(a.grid_tolerances, base.tolerance, float), min_area=numbers(a.grid_min_areas, base.min_area, float),
            dissolve=both(a.grid_dissolve, base.dissolve), road_mask=both(a.grid_road_mask, True),
        )
        windows = region_windows(spark, a.tile)
        if a.window:
            windows = spark.createDataFrame([("window", *(float(v) for v in a.window.split(",")))], "region string, xmin double, ymin double, xmax double, ymax double")
        for one, scored in experiment.sweep(spark.read.parquet(a.source), spark.read.parquet(a.truth), windows, base, chosen, **cuts(spark, a)):
            made = scored.select(*(F.lit(v).alias(k) for k, v in one.items()), "*")
            out = made if out is None else out.unionByName(made)
    if out is not None and getattr(a, "report", None):
        sinks.write_report(out, a.report)
    for r in out.toJSON().collect() if out is not None else []:
        print(r)
    print(json.dumps({"command": a.command, "seconds": round(time.time() - started, 1)}))


if __name__ == "__main__":
    main()
