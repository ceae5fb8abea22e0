"""Registered queries of sources and of whole runs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreline.functions import codes
from acreline.functions import geometry as g
from acreline.operators import evaluate
from acreline.plans import oracle as o
from acreline.plans import pipeline
from acreline.plans.coverage_queries import BOXES, _inter, _touch, ours, truth, windows
from acreline.plans.queries import query
from acreline.plans.shape_queries import _box_wkb
from acreline.runtime import stored
from acreline.sources import pixels, tables


@query(
    """with l as (select n_nationkey as line, string_split(v, ' ') w from (select n_nationkey,
   lpad((n_regionkey * 3)::varchar, 2, '0') || ' ' || (n_nationkey % 4 * 10)::varchar || ' ' || (case when n_nationkey % 7 = 3 then '888' else lpad((n_nationkey // 2)::varchar, 3, '0') end)
   || ' ' || n_name || ' ' || (case when n_nationkey % 5 = 4 then '2' else '1' end) v from nation)),
 k as (select line, w[1] s, w[2] a, w[3] c from l where len(w) >= 5 and w[3] not in ('000', '888', '999') and w[-1] = '1')
select s as STATEFP, c as COUNTYFP, arg_max(a, line) as ASD, s || arg_max(a, line) as STATEASD from k group by s, c"""
)
def county_districts(spark: SparkSession, d: str) -> DataFrame:
    n = spark.read.parquet(f"{d}/nation.parquet")
    pad = lambda c, w: F.lpad(c.cast("string"), w, "0")
    county = F.when(F.col("n_nationkey") % 7 == 3, "888").otherwise(pad(F.floor(F.col("n_nationkey") / 2), 3))
    text = F.concat_ws(" ", pad(F.col("n_regionkey") * 3, 2), (F.col("n_nationkey") % 4 * 10).cast("string"), county, "n_name", F.when(F.col("n_nationkey") % 5 == 4, "2").otherwise("1"))
    return tables.crosswalk(n.select(F.col("n_nationkey").alias("line"), text.alias("value")))


_SEGMENT = "case when o_custkey % 6 = 0 then 'rail' else 'road' end subtype, ['motorway', 'primary', 'path', 'track', 'trunk'][o_orderkey % 5 + 1] class, o_custkey * 1.0::double x, o_orderkey * 0.5::double y"


@query(
    f"""select o_orderkey id, case when subtype = 'rail' then 'rail' else class end kind from (select o_orderkey, {_SEGMENT} from orders)
 where x >= 10 and x + 5 <= 900 and y >= 20 and y + 5 <= 4000 and ((subtype = 'road' and class in ('motorway', 'primary', 'trunk')) or subtype = 'rail')"""
)
def road_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.parquet(f"{d}/orders.parquet").withColumns({"x": F.col("o_custkey") * 1.0, "y": F.col("o_orderkey") * 0.5})
    kinds = F.array(*map(F.lit, ("motorway", "primary", "path", "track", "trunk")))
    box = F.struct(F.col("x").alias("xmin"), F.col("y").alias("ymin"), (F.col("x") + 5).alias("xmax"), (F.col("y") + 5).alias("ymax"))
    segments = rows.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_custkey") % 6 == 0, "rail").otherwise("road").alias("subtype"), kinds[(F.col("o_orderkey") % 5).cast("int")].alias("class"), box.alias("bbox"))
    return tables.roads(segments, ("motorway", "primary", "trunk"), (10, 20, 900, 4000)).select("id", "kind")


@query(f"select state, fips from (values {', '.join(f'({k!r}, {v!r})' for k, v in tables.STATES.items())}) t(state, fips)")
def state_catalogue(spark: SparkSession, d: str) -> DataFrame:
    return tables.states(spark)


@query(
    o.sql(
        BOXES,
        """select round(i / 1e6, 9) km2_both, round((a + b - i) / 1e6, 9) km2_union, round((a + b - 2 * i) / 1e6, 9) km2_difference
 from (select sum(area) a from ours), (select sum(area) b from truth), (select sum(i) i from pairs)""",
    )
)
def overlay_areas(spark: SparkSession, d: str) -> DataFrame:
    got = evaluate.overlay_areas(ours(spark, d), truth(spark, d))
    return got.select(*(F.round(c, 9).alias(c) for c in got.columns))


_CLIP = "greatest(least(a.xmax, b.xmax, w.xmax) - greatest(a.xmin, b.xmin, w.xmin), 0) * greatest(least(a.ymax, b.ymax, w.ymax) - greatest(a.ymin, b.ymin, w.ymin), 0)"


@query(
    o.sql(
        BOXES,
        f"""select region, round((a - coalesce(i, 0)) / 4046.86, 6) only_ours_acres, round((b - coalesce(i, 0)) / 4046.86, 6) only_truth_acres
 from (select w.region, sum({_inter('w', 'b')}) a from win w join ours b on {_touch('w', 'b')} group by 1) join (select w.region, sum({_inter('w', 'b')}) b from win w join truth b on {_touch('w', 'b')} group by 1) using (region)
 left join (select w.region, sum({_CLIP}) i from win w join ours a on {_touch('w', 'a')} join truth b on {_touch('w', 'b')} and {_touch('a', 'b')} group by 1) using (region)""",
    )
)
def tile_parity(spark: SparkSession, d: str) -> DataFrame:
    got = evaluate.tile_parity(ours(spark, d), truth(spark, d), windows(spark, d)).where("n_ours > 0 and n_truth > 0")
    return got.select("region", F.round("only_ours_acres", 6).alias("only_ours_acres"), F.round("only_truth_acres", 6).alias("only_truth_acres"))


@query()
def chamfer_summary(spark: SparkSession, d: str) -> DataFrame:
    a, b = (stored(_box_wkb(s), "boxes") for s in (ours(spark, d), truth(spark, d)))
    pairs = evaluate.matched_pairs(a, b, evaluate.pairwise_iou(a, b))
    got = evaluate.chamfer_summary(pairs, g.wkb_chamfer("ours_geometry", "truth_geometry"))
    return got.select("n", F.round("mean_m", 6).alias("mean_m"), F.round("p95_m", 6).alias("p95_m"))


def _stack(spark: SparkSession, d: str) -> DataFrame:
    tile = F.concat(codes.character(F.floor(F.col("r") / 50) + 65), F.floor(F.col("c") / 50).cast("string"))
    return pixels.demo_stack(spark, d).withColumn("tile", tile)


@query()
def polygonize(spark: SparkSession, d: str) -> DataFrame:
    """A whole first half, tiles to simplified polygons."""
    got = pipeline.polygonize(_stack(spark, d), pipeline.Params())
    return got.select("tile", "label", F.round("area_sqm", 3).alias("area_sqm"), "effective_count", *(c for c in got.columns if c.startswith("CDL")))


@query()
def polygonize_record(spark: SparkSession, d: str) -> DataFrame:
    """The same with general classes, noise healed, smaller pixels and lines burned out."""
    p = pipeline.Params(general=True, noise_px=2, focal_radius=1, upsample=2, by_region=True)
    rows = spark.read.parquet(f"{d}/nation.parquet").select((F.col("n_nationkey") * 120.0).alias("x"))
    thin = rows.select("x", F.lit(-1e5).alias("ymin"), F.lit(0.0).alias("ymax"))
    lines = _box_wkb(thin.select(F.col("x").alias("xmin"), "ymin", F.col("x").alias("xmax"), "ymax")).select("geometry")
    got = pipeline.polygonize(_stack(spark, d), p, lines=lines)
    return got.select("tile", "label", F.round("area_sqm", 3).alias("area_sqm"), "effective_count", *(c for c in got.columns if c.startswith("CDL")))


@query()
def postprocess(spark: SparkSession, d: str) -> DataFrame:
    """A whole second half: boundaries, seams, ids and measures."""
    high = pixels.demo_stack(spark, d).agg((F.max("r") + 1) * 30.0).first()[0]
    n = spark.read.parquet(f"{d}/nation.parquet").withColumns({"gx": F.col("n_nationkey") % 5 * 600.0, "gy": -F.floor(F.col("n_nationkey") / 5) * (high / 5)})
    boxes = _box_wkb(n.withColumns({"xmin": F.col("gx"), "xmax": F.col("gx") + 600, "ymax": F.col("gy").cast("double"), "ymin": F.col("gy") - high / 5}))
    state, county = F.lpad((F.col("n_regionkey") + 1).cast("string"), 2, "0"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0")
    bounds = boxes.select("geometry", state.alias("STATEFIPS"), F.concat(state, F.lit("10")).alias("STATEASD"), F.lit("10").alias("ASD"), F.col("n_name").alias("CNTY"), county.alias("CNTYFIPS"))
    shapes = stored(pipeline.polygonize(_stack(spark, d), pipeline.Params()), "shapes")
    got = pipeline.postprocess(shapes, bounds, pipeline.Params(), cell=3000.0)
    return got.select("FIELDID", "FIELDYEARS", F.round("FIELDACRES", 6).alias("FIELDACRES"), "CNTYFIPS", F.round("Shape_area", 3).alias("Shape_area"), F.round("Shape_Length", 3).alias("Shape_Length"))
