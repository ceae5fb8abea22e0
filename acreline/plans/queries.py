"""Registered queries of the raster half, with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreline.functions import codes, geo
from acreline.operators import combine, denoise, regions, tiles
from acreline.plans import oracle as o
from acreline.sources import pixels

N = len(pixels.YEARS)
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def text(c: str) -> F.Column:
    return F.array_join(F.col(c).cast("array<string>"), ",")


def px(spark: SparkSession, d: str) -> DataFrame:
    return combine.keyed(pixels.demo_stack(spark, d), N)


def masked(spark: SparkSession, d: str) -> DataFrame:
    return combine.retained(px(spark, d))


def labelled(spark: SparkSession, d: str) -> DataFrame:
    return regions.components(masked(spark, d).drop("cdl", "keys", "attr"))


def graph(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    from acreline.runtime import stored

    lab = stored(labelled(spark, d), "labels")
    return stored(regions.region_table(lab), "regions"), stored(regions.adjacency(lab), "edges")


@query(o.sql(o.STACK, "select seq, count(*) n_pixels, min(pix) first_pix, arg_min(attr, pix) attr, any_value(eff) effective from px group by seq"))
def combine_sequences(spark: SparkSession, d: str) -> DataFrame:
    got = combine.sequences(px(spark, d)).withColumn("keys", codes.unpack(F.col("seq"), N))
    return got.select(text("keys").alias("seq"), "n_pixels", "first_pix", text("attr").alias("attr"), F.col("effective").cast("long").alias("effective"))


def _tile_sql(w: int, h: int, s: int) -> str:
    return f"""select chr((65 + i)::int) || j::varchar as tile, j * {s} as col_off, i * {s} as row_off, least({s}, {w} - j * {s}) as width, least({s}, {h} - i * {s}) as height
from range({-(-h // s)}) a(i), range({-(-w // s)}) b(j)"""


@query(_tile_sql(110_000, 60_000, 5000))
def tile_windows(spark: SparkSession, d: str) -> DataFrame:
    return tiles.tile_windows(spark, 110_000, 60_000)


@query(f"select tile, (row_number() over (order by tile) - 1) % 7 as shard from ({_tile_sql(50_000, 50_000, 5000)})")
def tile_shards(spark: SparkSession, d: str) -> DataFrame:
    return tiles.shard(tiles.tile_windows(spark, 50_000, 50_000), 7).select("tile", F.col("shard").cast("long").alias("shard"))


@query(f"select tile from ({_tile_sql(30_000, 20_000, 5000)}) where tile not in ('A0', 'B3', 'D5')")
def pending_tiles(spark: SparkSession, d: str) -> DataFrame:
    done = spark.createDataFrame([("A0",), ("B3",), ("D5",), ("D5",)], "tile string")
    return tiles.pending(tiles.tile_windows(spark, 30_000, 20_000), done).select("tile")


_values = ", ".join(f"({k}, {v})" for k, v in codes.GENERAL_CLASS.items())


@query(o.sql(o.PIXELS, f"select cdl, coalesce(general, 0) general, count(*) n from py left join (values {_values}) t(code, general) on code = cdl group by all"))
def reclass(spark: SparkSession, d: str) -> DataFrame:
    rows = pixels.pixel_years(pixels.demo_stack(spark, d))
    return rows.groupBy("cdl", codes.general_class(F.col("cdl")).alias("general")).agg(F.count("*").alias("n"))


@query(o.sql(o.PIXELS, "select cdl, case when cdl > 81 then 254 else cdl end as coarse, case when cdl > 81 or cdl between 61 and 65 then 254 else cdl end as low, count(*) n from py group by all"))
def remap(spark: SparkSession, d: str) -> DataFrame:
    rows = pixels.pixel_years(pixels.demo_stack(spark, d))
    return rows.groupBy("cdl", codes.crop_or_barren(F.col("cdl")).alias("coarse"), codes.crop_or_barren(F.col("cdl"), True).alias("low")).agg(F.count("*").alias("n"))


@query(
    o.sql(
        o.PIXELS + f", gc as (select py.*, coalesce(general, 0) key from py left join (values {_values}) t(code, general) on code = cdl)",
        """select pix, string_agg(key::varchar, ',' order by yr) seq, count(*) filter (key > 0) - count(*) filter (key = 45) effective,
        string_agg((case when key = 0 or cdl = 254 then 0 else cdl end)::varchar, ',' order by yr) attr from gc group by pix""",
    )
)
def general_sequences(spark: SparkSession, d: str) -> DataFrame:
    got = combine.keyed(pixels.demo_stack(spark, d), N, general=True).withColumn("back", codes.unpack(F.col("seq"), N))
    return got.select("pix", text("back").alias("seq"), F.col("effective").cast("long").alias("effective"), text("attr").alias("attr"))


@query(o.sql(o.STACK, "select eff as effective, count(*) n, count(*) filter (eff >= 2) kept from px group by eff"))
def pixel_retention(spark: SparkSession, d: str) -> DataFrame:
    rows = px(spark, d)
    kept = combine.retained(rows).groupBy("effective").agg(F.count("*").alias("kept"))
    return rows.groupBy("effective").agg(F.count("*").alias("n")).join(kept, "effective", "left").select(F.col("effective").cast("long").alias("effective"), "n", F.coalesce("kept", F.lit(0)).alias("kept"))


@query(o.sql(o.LABELS, "select pix, label from lab"))
def label_components(spark: SparkSession, d: str) -> DataFrame:
    return labelled(spark, d).select("pix", "label")


@query(o.sql(o.LABELS, "select pix as node, label as component from lab"))
def components_in_rounds(spark: SparkSession, d: str) -> DataFrame:
    """Components of the pixel graph by star rounds, which larger graphs take."""
    from acreline.operators.graph import connected_components

    cells = masked(spark, d).select("r", "c", "pix", "seq")
    ahead = cells.select((F.col("r") + 1).alias("r"), "c", F.col("pix").alias("u"), "seq").union(cells.select("r", (F.col("c") + 1).alias("c"), F.col("pix").alias("u"), "seq"))
    edges = cells.join(ahead, ["r", "c", "seq"]).select("u", F.col("pix").alias("v"))
    found = connected_components(edges, small=0)
    alone = cells.select(F.col("pix").alias("node")).join(found.select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
    return found.union(alone)


@query(o.sql(o.LABELS, "select label, count(*) * 900.0::double area from lab group by label"))
def label_areas(spark: SparkSession, d: str) -> DataFrame:
    return labelled(spark, d).groupBy("label").agg((F.count("*") * 900.0).alias("area"))


@query(o.sql(o.GRAPH, "select lo, hi, s * 30.0::double as length from e0"))
def region_adjacency(spark: SparkSession, d: str) -> DataFrame:
    return regions.adjacency(labelled(spark, d)).select("lo", "hi", (F.col("sides") * 30.0).alias("length"))


@query(o.sql(o.GRAPH + ",\nm0 as (select label, label target from r0)" + o.eliminate_pass(1, 1000), "select label, target from t1"))
def eliminate_once(spark: SparkSession, d: str) -> DataFrame:
    return regions.merge_targets(*graph(spark, d), 1000.0).select("label", "target")


@query(o.sql(o.ELIMINATED, "select label, target from m4"))
def eliminate_passes(spark: SparkSession, d: str) -> DataFrame:
    return regions.eliminate(*graph(spark, d))[2].select("label", "target")


@query(o.sql(o.ELIMINATED, "select label, n n_pixels, fp first_pix, seq, eff effective from merged"))
def region_attributes(spark: SparkSession, d: str) -> DataFrame:
    merged = regions.eliminate(*graph(spark, d))[0].withColumn("keys", codes.unpack(F.col("seq"), N))
    return merged.select("label", "n_pixels", "first_pix", text("keys").alias("seq"), F.col("effective").cast("long").alias("effective"))


@query(o.sql(o.ELIMINATED, "select lo, hi, s sides from e4"))
def merged_adjacency(spark: SparkSession, d: str) -> DataFrame:
    return regions.eliminate(*graph(spark, d))[1].select("lo", "hi", "sides")


@query(o.sql(o.DISSOLVED, "select label, n n_pixels, fp first_pix from fin"))
def dissolve_same_sequence(spark: SparkSession, d: str) -> DataFrame:
    merged, edges, _ = regions.eliminate(*graph(spark, d))
    return regions.dissolve_equal(merged, edges)[0].select("label", "n_pixels", "first_pix")


@query(o.sql(o.DISSOLVED, "select label, n * 900.0::double area from fin where n * 900 >= 10000"))
def min_area_filter(spark: SparkSession, d: str) -> DataFrame:
    merged, edges, _ = regions.eliminate(*graph(spark, d))
    return regions.keep_large(regions.dissolve_equal(merged, edges)[0]).select("label", (F.col("n_pixels") * 900.0).alias("area"))


@query(
    o.sql(
        o.STACK + ", m as (select * from px where eff >= 1)" + o.components("m", "seq", "lab") + ", q as (select label, count(*) n, arg_min(eff, pix) e from lab group by label)",
        "select label, n n_pixels, e effective from q where e >= 2 or (n * 900 >= 10000 and e >= 1)",
    )
)
def label_retention(spark: SparkSession, d: str) -> DataFrame:
    table = regions.region_table(regions.components(combine.retained(px(spark, d), 1)))
    return regions.keep_cropped(table).select("label", "n_pixels", F.col("effective").cast("long").alias("effective"))


_ROAD = "(c % 37 = 18 or r % 41 = 20)"


@query(o.sql(o.MASKED, f"select pix from m where not {_ROAD}"))
def road_mask(spark: SparkSession, d: str) -> DataFrame:
    rows = masked(spark, d)
    return combine.without(rows, px(spark, d).where(_ROAD)).select("pix")


@query(o.sql(o.STACK, "select (r * 3 + x // 3) * 300 + c * 3 + x % 3 as pix, r * 3 + x // 3 as r, c * 3 + x % 3 as c, seq from px, range(9) t(x)"))
def upsample(spark: SparkSession, d: str) -> DataFrame:
    rows = combine.upsampled(px(spark, d), 3, pixels.WIDTH).withColumn("keys", codes.unpack(F.col("seq"), N))
    return rows.select("pix", "r", "c", text("keys").alias("seq"))


def one_year(spark: SparkSession, d: str) -> DataFrame:
    return pixels.demo_stack(spark, d).select("tile", "pix", "r", "c", F.col("cdl")[1].alias("v"))


_V = o.PIXELS + ", v as (select pix, r, c, cdl v from py where yr = 2019), nz as (select * from v where v <> 0)" + o.components("nz", "v", "cc") + ", sz as (select *, count(*) over (partition by label) size from cc)"


@query(
    o.sql(
        _V + """, noise as (select * from sz where size <= 2), clean as (select * from v where pix not in (select pix from noise)),
        near as (select n.pix, arg_min(k.v, ((k.r - n.r) * (k.r - n.r) + (k.c - n.c) * (k.c - n.c)) * 1e9 + k.r * 1000 + k.c) nv from noise n join (select * from range(-9, 10) t(dr)) o on true
          join clean k on k.r = n.r + o.dr and abs(k.c - n.c) <= 9 group by n.pix)""",
        "select v.pix, coalesce(nv, v.v) v from v left join near using (pix)",
    )
)
def noise_filter(spark: SparkSession, d: str) -> DataFrame:
    return denoise.heal_noise(one_year(spark, d), 2).select("pix", "v")


_MODE = """, edge as (select max(r) r1, max(c) c1 from v),
 win as (select a.pix, b.v, count(*) n from v a, edge, range(-1, 2) x(dr), range(-1, 2) z(dc), v b
   where b.pix = least(greatest(a.r + dr, 0), r1) * 100 + least(greatest(a.c + dc, 0), c1) and b.v <> 0 group by all),
 md as (select pix, v as mode from (select *, row_number() over (partition by pix order by n desc, v) k from win) where k = 1)"""


@query(o.sql(_V + _MODE, "select v.pix, coalesce(mode, 0) v from v left join md using (pix)"))
def focal_mode(spark: SparkSession, d: str) -> DataFrame:
    return denoise.focal_mode(one_year(spark, d), 1).select("pix", "v")


_KEYS = o.PIXELS + f""", v as (select pix + (yr - 2018) * 10000000 pix, r, c, coalesce(general, 0) v from py left join (values {_values}) t(code, general) on code = cdl), nz as (select * from v where v <> 0)""" + o.components("nz", "v", "cc") + ", sz as (select *, count(*) over (partition by label) size from cc)"


@query(
    o.sql(
        _KEYS + """, noise as (select * from sz where size <= 2), clean as (select * from v where pix not in (select pix from noise)),
        near as (select n.pix, arg_min(k.v, ((k.r - n.r) * (k.r - n.r) + (k.c - n.c) * (k.c - n.c)) * 1e9 + k.r * 1000 + k.c) nv from noise n join (select * from range(-9, 10) t(dr)) o on true
          join clean k on k.r = n.r + o.dr and abs(k.c - n.c) <= 9 and k.pix // 10000000 = n.pix // 10000000 group by n.pix)""",
        "select v.pix % 10000000 as pix, string_agg(coalesce(nv, v.v)::varchar, ',' order by v.pix) seq, count(*) filter (coalesce(nv, v.v) > 0) - count(*) filter (coalesce(nv, v.v) = 45) effective from v left join near using (pix) group by 1",
    )
)
def record_keys(spark: SparkSession, d: str) -> DataFrame:
    """General classes with the noise of every year healed before the years are combined."""
    got = combine.keyed(pixels.demo_stack(spark, d), N, general=True, noise_px=2).withColumn("back", codes.unpack(F.col("seq"), N))
    return got.select("pix", text("back").alias("seq"), F.col("effective").cast("long").alias("effective"))


def _focal_round(i: int) -> str:
    """v{i + 1} from v{i}: radius 2, components of fewer than 5 pixels."""
    return f""",
nz{i} as (select * from v{i} where v <> 0)""" + o.components(f"nz{i}", "v", f"cc{i}") + f""",
sm{i} as (select pix, r, c from (select *, count(*) over (partition by label) size from cc{i}) where size < 5),
win{i} as (select a.pix, b.v, count(*) n from sm{i} a, edge, range(-2, 3) x(dr), range(-2, 3) z(dc), v{i} b
  where b.pix = least(greatest(a.r + dr, 0), r1) * 100 + least(greatest(a.c + dc, 0), c1) and b.v <> 0 group by all),
md{i} as (select pix, v as mode from (select *, row_number() over (partition by pix order by n desc, v) k from win{i}) where k = 1),
v{i + 1} as (select a.pix, a.r, a.c, case when s.pix is null then a.v else coalesce(mode, 0) end v from v{i} a left join sm{i} s using (pix) left join md{i} using (pix))"""


@query(
    o.sql(
        o.PIXELS + ", v0 as (select pix, r, c, cdl v from py where yr = 2019), edge as (select max(r) r1, max(c) c1 from v0)" + "".join(map(_focal_round, range(4))),
        "select pix, v from v4",
    )
)
def focal_smooth(spark: SparkSession, d: str) -> DataFrame:
    return denoise.focal_smooth(one_year(spark, d)).select("pix", "v")


@query(o.sql(o.LABELS, """select label, (4 * count(*) - 2 * sum(x))::double * 30 perimeter from (select a.label, a.pix,
  (select count(*) from lab b where b.label = a.label and ((b.pix = a.pix + 1 and b.r = a.r) or b.pix = a.pix + 100)) x from lab a) group by label"""))
def region_perimeter(spark: SparkSession, d: str) -> DataFrame:
    return regions.perimeters(labelled(spark, d)).select("label", F.col("perimeter").cast("double").alias("perimeter"))


@query(
    """with recursive h(id, x, y, d, s) as (
  select o_orderkey, (o_orderkey * 7919) % 65536, (o_custkey * 104729) % 65536, 0::bigint, 32768::bigint from orders
  union all
  select id, case when y & s = 0 then (case when x & s > 0 then s - 1 - (y & (s - 1)) else y & (s - 1) end) else x & (s - 1) end,
         case when y & s = 0 then (case when x & s > 0 then s - 1 - (x & (s - 1)) else x & (s - 1) end) else y & (s - 1) end,
         d + s * s * xor(case when x & s > 0 then 3 else 0 end, case when y & s > 0 then 1 else 0 end), s // 2
  from h where s > 0)
select id, d::bigint as hilbert from h where s = 0"""
)
def hilbert_key(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.parquet(f"{d}/orders.parquet")
    return rows.select(F.col("o_orderkey").alias("id"), geo.hilbert(F.col("o_orderkey") * 7919 % 65536, F.col("o_custkey") * 104729 % 65536).alias("hilbert"))


def _albers_sql() -> str:
    n, c, rho0 = geo.albers_constants()
    e2, e, a = geo._E2, geo._E, geo.A
    return f"""with p as (select o_orderkey id, -125 + (o_orderkey * 37 % 5800) / 100.0::double lon, 24 + (o_custkey * 17 % 2500) / 100.0::double lat from orders),
s as (select *, sin(radians(lat)) z from p),
q as (select *, {1 - e2!r} * (z / (1 - {e2!r} * z * z) - ln((1 - {e!r} * z) / (1 + {e!r} * z)) / {2 * e!r}) qq from s),
k as (select *, {a!r} * sqrt({c!r} - {n!r} * qq) / {n!r} rho, {n!r} * radians(lon - ({geo.LON0!r})) theta from q)
select id, round(rho * sin(theta), 3) x, round({rho0!r} - rho * cos(theta), 3) y, round(lon, 6) lon, round(lat, 6) lat from k"""


@query(_albers_sql())
def albers_projection(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.read.parquet(f"{d}/orders.parquet")
    rows = rows.select(F.col("o_orderkey").alias("id"), (-125 + (F.col("o_orderkey") * 37 % 5800) / F.lit(100.0)).alias("lon"), (24 + (F.col("o_custkey") * 17 % 2500) / F.lit(100.0)).alias("lat"))
    x, y = geo.albers(F.col("lon"), F.col("lat"))
    rows = rows.select("id", x.alias("x"), y.alias("y"))
    lon, lat = geo.albers_inverse(F.col("x"), F.col("y"))
    return rows.select("id", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@query("select a as exclude_low, b as min_years, c as threshold from (values (false), (true)) x(a), (values (1), (2), (3)) y(b), (values (100.0::double), (1000.0), (10000.0)) z(c)")
def parameter_grid(spark: SparkSession, d: str) -> DataFrame:
    one = spark.range(1).select(F.explode(F.array(F.lit(False), F.lit(True))).alias("exclude_low"))
    return one.select("*", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("min_years")).select("*", F.explode(F.array(*map(F.lit, (100.0, 1000.0, 10000.0)))).alias("threshold"))
