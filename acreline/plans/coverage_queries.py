"""Registered queries of the vector half: enrichment and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreline.functions import codes, geo
from acreline.operators import combine, enrich, evaluate, regions
from acreline.operators.spatialjoin import box_join, largest_overlap, pixel_overlap
from acreline.plans import oracle as o
from acreline.plans.queries import px, query
from acreline.runtime import stored

# --- boxes of field blocks as ours, of shifted blocks as truth


def _side(spark: SparkSession, d: str, dr: int, dc: int, crops: bool = True) -> DataFrame:
    rows = px(spark, d).select((F.floor((F.col("r") + dr) / 7)).alias("br"), (F.floor((F.col("c") + dc) / 11)).alias("bc"), "r", "c")
    box = rows.groupBy("br", "bc").agg(*((f * 30).cast("double").alias(n) for f, n in ((F.min("c"), "xmin"), (F.min("r"), "ymin"), (F.max("c") + 1, "xmax"), (F.max("r") + 1, "ymax"))))
    b = F.col("br") * 31 + F.col("bc") * 17
    box = box.where(b % 5 != 0) if crops else box
    return box.select((F.col("br") * 1000 + F.col("bc")).alias("id"), (b % 7).alias("cls"), "xmin", "ymin", "xmax", "ymax", ((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin"))).alias("area"))


def ours(spark: SparkSession, d: str) -> DataFrame:
    return stored(_side(spark, d, 0, 0), "ours")


def truth(spark: SparkSession, d: str) -> DataFrame:
    return stored(_side(spark, d, 1, 2), "truth")


def windows(spark: SparkSession, d: str) -> DataFrame:
    """The extent cut 4 x 4."""
    top = px(spark, d).agg((F.max("r") + 1) * 30.0).first()[0]
    rows = [(4 * i + j, j * 750.0, i * top / 4, (j + 1) * 750.0, (i + 1) * top / 4) for i in range(4) for j in range(4)]
    return spark.createDataFrame(rows, "region long, xmin double, ymin double, xmax double, ymax double")


def _box_sql(name: str, dr: int, dc: int) -> str:
    return f"""{name} as (select br * 1000 + bc id, (br * 31 + bc * 17) % 7 cls, xmin, ymin, xmax, ymax, (xmax - xmin) * (ymax - ymin) area from
 (select (r + {dr}) // 7 br, (c + {dc}) // 11 bc, min(c) * 30.0::double xmin, min(r) * 30.0::double ymin, (max(c) + 1) * 30.0::double xmax, (max(r) + 1) * 30.0::double ymax from g group by 1, 2)
 where (br * 31 + bc * 17) % 5 <> 0)"""


def _inter(a: str = "a", b: str = "b") -> str:
    return f"greatest(least({a}.xmax, {b}.xmax) - greatest({a}.xmin, {b}.xmin), 0) * greatest(least({a}.ymax, {b}.ymax) - greatest({a}.ymin, {b}.ymin), 0)"


def _touch(a: str, b: str) -> str:
    return f"{a}.xmin <= {b}.xmax and {b}.xmin <= {a}.xmax and {a}.ymin <= {b}.ymax and {b}.ymin <= {a}.ymax"


BOXES = o.PIXELS + ",\n" + _box_sql("ours", 0, 0) + ",\n" + _box_sql("truth", 1, 2) + f""",
win as (select 4 * i + j as region, j * 750.0::double xmin, i * h / 4 ymin, (j + 1) * 750.0::double xmax, (i + 1) * h / 4 ymax
  from range(4) x(i), range(4) z(j), (select (max(r) + 1) * 30.0::double h from g)),
pairs as (select a.id oid, b.id tid, a.cls ocls, b.cls tcls, a.area oa, b.area ta, {_inter()} i from ours a join truth b on {_touch('a', 'b')}),
iou as (select oid, tid, i / (oa + ta - i) iou from pairs where i > 0)"""


@query(o.sql(BOXES, "select id, area from ours where xmax >= 700 and xmin <= 1900 and ymax >= 100 and ymin <= 1500"))
def bbox_filter(spark: SparkSession, d: str) -> DataFrame:
    return ours(spark, d).where(geo.bbox_filter(700, 100, 1900, 1500)).select("id", "area")


@query(o.sql(BOXES, "select oid, tid, i area from pairs"))
def box_intersections(spark: SparkSession, d: str) -> DataFrame:
    pairs = box_join(ours(spark, d), truth(spark, d), evaluate.CELL)
    return pairs.select(F.col("a.id").alias("oid"), F.col("b.id").alias("tid"), geo.box_overlap("a", "b").alias("area"))


_MEASURES = """round(km2_ours, 9) km2_ours, round(km2_truth, 9) km2_truth, round(case when n_ours > 0 and n_truth > 0 then coalesce(i, 0) end, 9) km2_both,
 round(case when n_ours > 0 and n_truth > 0 then coalesce(i, 0) / nullif(km2_ours + km2_truth - coalesce(i, 0), 0) end, 9) iou,
 round(case when n_ours > 0 and n_truth > 0 then n_ours::double / n_truth end, 9) count_ratio, round(case when n_ours > 0 and n_truth > 0 then acres_ours / acres_truth end, 9) acre_ratio"""


def _parity_sql(clip: bool) -> str:
    side = lambda s, n: f"""(select w.region, count(b.id) n_{n}, coalesce(sum(b.area), 0) / 4046.86 acres_{n}, coalesce(sum({_inter('w', 'b')}), 0) / 1e6 km2_{n} from win w left join {s} b on {_touch('w', 'b')} group by 1) {n}"""
    area = _inter()
    if clip:
        area = "greatest(least(a.xmax, b.xmax, w.xmax) - greatest(a.xmin, b.xmin, w.xmin), 0) * greatest(least(a.ymax, b.ymax, w.ymax) - greatest(a.ymin, b.ymin, w.ymin), 0)"
    return f"""select region, n_ours, n_truth, {_MEASURES} from {side('ours', 'ours')} join {side('truth', 'truth')} using (region)
 left join (select w.region, sum({area}) / 1e6 i from win w join ours a on {_touch('w', 'a')} join truth b on {_touch('w', 'b')} and {_touch('a', 'b')} group by 1) using (region)"""


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("region", "n_ours", "n_truth", *(F.round(c, 9).alias(c) for c in ("km2_ours", "km2_truth", "km2_both", "iou", "count_ratio", "acre_ratio")))


@query(o.sql(BOXES, _parity_sql(False)))
def window_parity(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(evaluate.window_parity(ours(spark, d), truth(spark, d), windows(spark, d)))


@query(o.sql(BOXES, _parity_sql(True)))
def window_parity_clipped(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(evaluate.window_parity(ours(spark, d), truth(spark, d), windows(spark, d), clip_intersection=True))


@query(
    o.sql(
        BOXES,
        f"""select 'all' region, n_ours, n_truth, {_MEASURES} from (select count(*) n_ours, sum(area) / 4046.86 acres_ours, sum(area) / 1e6 km2_ours from ours),
 (select count(*) n_truth, sum(area) / 4046.86 acres_truth, sum(area) / 1e6 km2_truth from truth), (select sum(i) / 1e6 i from pairs)""",
    )
)
def whole_parity(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(evaluate.whole_parity(ours(spark, d), truth(spark, d)))


@query(o.sql(BOXES, "select ocls ours, tcls truth, round(sum(i) / 1e6, 9) km2 from pairs where i > 0 group by 1, 2"))
def confusion(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.confusion(ours(spark, d), truth(spark, d)).withColumn("km2", F.round("km2", 9))


@query(o.sql(BOXES, "select ocls ours, tcls truth, round(sum(i) / 1e6, 9) km2 from pairs where i > 0 group by 1, 2 order by 3 desc, 1, 2 limit 25"))
def confusion_top25(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.confusion(ours(spark, d), truth(spark, d)).withColumn("km2", F.round("km2", 9)).orderBy(F.desc("km2"), "ours", "truth").limit(25)


_BEST = ", best as (select * from (select *, row_number() over (partition by tid order by i desc, oid) k from pairs where i > 0) where k = 1), mt as (select t.id, oid, coalesce(i / (oa + ta - i), 0) iou from truth t left join best on tid = t.id)"


@query(o.sql(BOXES + _BEST, "select id, oid as match, round(iou, 9) iou from mt"))
def best_match(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.best_match(ours(spark, d), truth(spark, d)).withColumn("iou", F.round("iou", 9))


_CUT = """, co as (select id, greatest(xmin, 400) xmin, greatest(ymin, 50) ymin, least(xmax, 2000) xmax, least(ymax, 1700) ymax from ours where xmax >= 400 and xmin <= 2000 and ymax >= 50 and ymin <= 1700),
ct as (select id, greatest(xmin, 400) xmin, greatest(ymin, 50) ymin, least(xmax, 2000) xmax, least(ymax, 1700) ymax from truth where xmax >= 400 and xmin <= 2000 and ymax >= 50 and ymin <= 1700),
ca as (select *, (xmax - xmin) * (ymax - ymin) area from co where xmax > xmin and ymax > ymin), cb as (select *, (xmax - xmin) * (ymax - ymin) area from ct where xmax > xmin and ymax > ymin),
cp as (select * from (select a.id oid, b.id tid, a.area oa, b.area ta, """ + _inter() + """ i from ca a, cb b) where i > 0)"""


@query(o.sql(BOXES + _CUT, "select t.id, oid as match, round(coalesce(i / (oa + ta - i), 0), 9) iou from cb t left join (select * from (select *, row_number() over (partition by tid order by i desc, oid) k from cp) where k = 1) on tid = t.id"))
def best_match_in_window(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.best_match(ours(spark, d), truth(spark, d), (400.0, 50.0, 2000.0, 1700.0)).withColumn("iou", F.round("iou", 9))


@query(
    o.sql(
        BOXES + _BEST,
        """select count(*) n, count(*) filter (iou > 0) n_matched, round(median(iou) filter (iou > 0), 9) median_iou, round(avg(iou) filter (iou > 0), 9) mean_iou,
 round(avg((iou >= 0.9)::int), 9) frac_high, round(avg((iou >= 0.5 and iou < 0.9)::int), 9) frac_mid, round(avg((iou > 0 and iou < 0.5)::int), 9) frac_low, round(avg((iou = 0)::int), 9) frac_none from mt""",
    )
)
def match_summary(spark: SparkSession, d: str) -> DataFrame:
    got = evaluate.match_summary(evaluate.best_match(ours(spark, d), truth(spark, d)))
    return got.select("n", "n_matched", *(F.round(c, 9).alias(c) for c in got.columns[2:]))


@query(o.sql(BOXES, "select oid ours, tid truth, round(iou, 9) iou from iou"))
def pairwise_iou(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.pairwise_iou(ours(spark, d), truth(spark, d)).withColumn("iou", F.round("iou", 9))


_LADDER = """, th as (select * from (values (0.5::double), (0.55), (0.6), (0.65), (0.7), (0.75), (0.8), (0.85), (0.9), (0.95)) t(threshold)),
tp as (select threshold, (select count(*) from iou where iou > threshold) tp from th),
ld as (select *, coalesce(tp / nullif(tp + fp, 0), 0) as "precision", coalesce(tp / nullif(tp + fn, 0), 0) recall from
  (select threshold, tp, (select count(*) from ours) - tp fp, (select count(*) from truth) - tp fn from tp)),
lf as (select *, coalesce(2 * "precision" * recall / nullif("precision" + recall, 0), 0) f1 from ld)"""


@query(o.sql(BOXES + _LADDER, 'select threshold, tp, fp, fn, round("precision", 9) as "precision", round(recall, 9) recall, round(f1, 9) f1 from lf'))
def f1_ladder(spark: SparkSession, d: str) -> DataFrame:
    a, b = ours(spark, d), truth(spark, d)
    got = evaluate.f1_ladder(evaluate.pairwise_iou(a, b), a.count(), b.count())
    return got.select("threshold", "tp", "fp", "fn", *(F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")))


@query(
    o.sql(
        BOXES + _LADDER,
        """select round(rq, 9) rq, round(sq, 9) sq, round(rq * sq, 9) pq, round(mean_f1, 9) mean_f1, (select count(*) from ours) - (select count(*) from truth) count_delta
 from (select max(f1) filter (threshold = 0.5) rq, avg(f1) mean_f1 from lf), (select coalesce(avg(iou), 0) sq from iou where iou > 0.5)""",
    )
)
def panoptic(spark: SparkSession, d: str) -> DataFrame:
    a, b = ours(spark, d), truth(spark, d)
    got = evaluate.panoptic(stored(evaluate.pairwise_iou(a, b), "iou"), a.count(), b.count())
    return got.select(*(F.round(c, 9).alias(c) for c in ("rq", "sq", "pq", "mean_f1")), "count_delta")


@query(
    o.sql(
        BOXES + f", rec as ({_parity_sql(False)})",
        """select count(iou) n, round(avg(iou), 6) mean_iou, round(median(iou), 6) median_iou, round(min(iou), 6) min_iou, round(max(iou), 6) max_iou,
 round(avg(count_ratio) filter (count_ratio <> 0), 6) mean_count_ratio, round(median(count_ratio) filter (count_ratio <> 0), 6) median_count_ratio,
 round(avg(acre_ratio) filter (acre_ratio <> 0), 6) mean_acre_ratio, round(median(acre_ratio) filter (acre_ratio <> 0), 6) median_acre_ratio from rec""",
    )
)
def region_summary(spark: SparkSession, d: str) -> DataFrame:
    got = evaluate.region_summary(evaluate.window_parity(ours(spark, d), truth(spark, d), windows(spark, d)))
    return got.select("n", *(F.round(c, 6).alias(c) for c in got.columns[1:]))


@query(o.sql(BOXES, "select round(median(iou), 9) median, round(quantile_cont(iou, 0.25), 9) q1, round(quantile_cont(iou, 0.75), 9) q3, round(min(iou), 9) min, round(max(iou), 9) max from iou"))
def iou_quartiles(spark: SparkSession, d: str) -> DataFrame:
    got = evaluate.quartiles(evaluate.pairwise_iou(ours(spark, d), truth(spark, d)), "iou")
    return got.select(*(F.round(c, 9).alias(c) for c in got.columns))


_REGION_VALUES = ", ".join(f"('{n}', {x}, {y})" for n, x, y in evaluate.REGIONS)


@query(
    f"""select name, -2356095 + 150000.0::double * i xmin, 3172605 - 150000.0::double * j - 150000 ymin, -2356095 + 150000.0::double * i + 150000 xmax, 3172605 - 150000.0::double * j ymax
 from (select name, trunc((x + 2356095) / 150000.0::double)::int i, trunc((3172605 - y) / 150000.0::double)::int j from (values {_REGION_VALUES}) t(name, x, y))"""
)
def region_windows(spark: SparkSession, d: str) -> DataFrame:
    rows = spark.createDataFrame(evaluate.REGIONS, "name string, x long, y long")
    return rows.select("name", *(c.alias(n) for n, c in evaluate.region_window(F.col("x"), F.col("y")).items()))


# --- tiles of 50 x 50 pixels, counties as boxes


def _tiled(spark: SparkSession, d: str) -> DataFrame:
    tile = F.concat(codes.character(F.floor(F.col("r") / 50) + 65), F.floor(F.col("c") / 50).cast("string"))
    return stored(regions.components(combine.retained(px(spark, d)).drop("cdl", "keys", "attr").withColumn("tile", tile)), "tiled")


def _zones(spark: SparkSession, d: str) -> DataFrame:
    rows = px(spark, d)
    high = rows.agg(F.max("r") + 1).first()[0]
    tile = F.concat(codes.character(F.floor(F.col("r") / 50) + 65), F.floor(F.col("c") / 50).cast("string"))
    return rows.select(tile.alias("tile"), "pix", (F.least(F.floor(F.col("r") / max(1, high // 5)), F.lit(4)) * 5 + F.floor(F.col("c") / 20)).cast("int").alias("zone"))


def _counties(spark: SparkSession, d: str) -> DataFrame:
    n = spark.read.parquet(f"{d}/nation.parquet")
    return n.select(F.col("n_nationkey").cast("int").alias("zone"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("CNTYFIPS"), F.lpad((F.col("n_regionkey") + 1).cast("string"), 2, "0").alias("STATEFIPS"), F.col("n_name").alias("CNTY"))


def _national(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    lab = _tiled(spark, d)
    table = enrich.with_boundary(regions.region_table(lab), lab, _zones(spark, d), _counties(spark, d))
    return stored(enrich.numbered(table, ["tile", "label"]), "national"), lab


TILED = (
    o.MASKED
    + ", mt as (select *, chr((65 + r // 50)::int) || (c // 50)::varchar tile, seq || '|' || (r // 50)::varchar || '|' || (c // 50)::varchar st from m)"
    + o.components("mt", "st", "tl")
    + """,
zone as (select pix, least(r // greatest(1, h // 5), 4) * 5 + c // 20 zone from g, (select max(r) + 1 h from g)),
county as (select n_nationkey zone, lpad(n_nationkey::varchar, 3, '0') CNTYFIPS, lpad((n_regionkey + 1)::varchar, 2, '0') STATEFIPS, n_name CNTY from nation),
ov as (select tile, label, CNTYFIPS, STATEFIPS, CNTY, count(*) n from tl join zone using (pix) join county using (zone) group by all),
bo as (select * from (select *, row_number() over (partition by tile, label order by n desc, CNTYFIPS) k from ov) where k = 1),
nat as (select tile, label, n_pixels, seq, CNTYFIPS, STATEFIPS, CNTY, row_number() over (order by tile, label) oid
  from (select tile, label, count(*) n_pixels, arg_min(seq, pix) seq from tl group by tile, label) join bo using (tile, label)),
bx as (select tile, label, min(c) x0, min(r) y0, max(c) + 1 x1, max(r) + 1 y1 from tl group by tile, label),
cand as (select tile, label from (select *, x0 <= min(x0) over (partition by tile) or x1 >= max(x1) over (partition by tile) or y0 <= min(y0) over (partition by tile) or y1 >= max(y1) over (partition by tile) near from bx) where near),
cpx as (select oid, STATEFIPS, tl.seq, r, c from tl join cand using (tile, label) join nat using (tile, label)),
tp as (select distinct least(a.oid, b.oid) lo, greatest(a.oid, b.oid) hi from cpx a, (values (0, 1), (1, -1), (1, 0), (1, 1)) s(dr, dc), cpx b
  where b.r = a.r + dr and b.c = a.c + dc and a.seq = b.seq and a.STATEFIPS = b.STATEFIPS and a.oid <> b.oid)"""
)
ROOTS = TILED + """,
te as (select lo u, hi v from tp union all select hi, lo from tp),
tr(oid, root) as (select oid, oid from nat union select e.v, x.root from tr x join te e on e.u = x.oid where x.root < e.v),
roots as (select oid, min(root) root from tr group by oid),
done as (select n.*, row_number() over (order by n.oid) as new_oid, total from nat n join (select root, sum(n_pixels)::bigint total from roots join nat using (oid) group by root) s on s.root = n.oid)"""


@query(o.sql(TILED, "select tile, label, CNTYFIPS, n n_pixels from bo"))
def best_overlap_join(spark: SparkSession, d: str) -> DataFrame:
    pairs = pixel_overlap(_tiled(spark, d), _zones(spark, d)).join(_counties(spark, d), "zone")
    return largest_overlap(pairs, ["tile", "label"], "n_pixels", "CNTYFIPS").select("tile", "label", "CNTYFIPS", "n_pixels")


@query(o.sql(TILED, "select oid, tile, label, n_pixels, STATEFIPS, CNTY from nat"))
def union_numbering(spark: SparkSession, d: str) -> DataFrame:
    return _national(spark, d)[0].select("oid", "tile", "label", "n_pixels", "STATEFIPS", "CNTY")


@query(o.sql(TILED, "select tile, label from cand"))
def seam_candidates(spark: SparkSession, d: str) -> DataFrame:
    return enrich.seam_candidates(enrich.extents(_tiled(spark, d))).select("tile", "label")


def _pairs(national: DataFrame, lab: DataFrame) -> DataFrame:
    near = enrich.seam_candidates(enrich.extents(lab)).select("tile", "label")
    cells = lab.select("tile", "label", "r", "c").join(near, ["tile", "label"]).join(national.select("tile", "label", "oid", F.struct("STATEFIPS", "seq").alias("key")), ["tile", "label"])
    return stored(enrich.touch_pairs(cells.select("oid", "key", "r", "c")), "pairs")


@query(o.sql(TILED, "select lo, hi from tp"))
def touch_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(*_national(spark, d))


@query(o.sql(ROOTS, "select new_oid oid, tile, label, total n_pixels, CNTYFIPS from done"))
def seam_dissolve(spark: SparkSession, d: str) -> DataFrame:
    national, lab = _national(spark, d)
    return enrich.dissolve(national, _pairs(national, lab))[0].select("oid", "tile", "label", "n_pixels", "CNTYFIPS")


@query(
    o.sql(
        ROOTS,
        """select STATEFIPS || '1825' || lpad(new_oid::varchar, 9, '0') FIELDID, '1825' FIELDYEARS, total * 900.0::double Shape_area, round(total * 900.0::double / 4046.86, 6) FIELDACRES from done""",
    )
)
def derived_fields(spark: SparkSession, d: str) -> DataFrame:
    national, lab = _national(spark, d)
    got = enrich.derived(enrich.dissolve(national, _pairs(national, lab))[0], 2018, 2025)
    return got.select("FIELDID", "FIELDYEARS", "Shape_area", F.round("FIELDACRES", 6).alias("FIELDACRES"))


@query(o.sql(ROOTS, "select STATEFIPS, count(*) n, sum(total)::bigint n_pixels from done group by 1"))
def state_split(spark: SparkSession, d: str) -> DataFrame:
    national, lab = _national(spark, d)
    return enrich.dissolve(national, _pairs(national, lab))[0].groupBy("STATEFIPS").agg(F.count("*").alias("n"), F.sum("n_pixels").alias("n_pixels"))


@query("select c_custkey, case when c_custkey % 3 = 0 then -1.5::double else c_acctbal end c_acctbal from customer where c_custkey % 10 <> 4")
def update_and_delete(spark: SparkSession, d: str) -> DataFrame:
    table = spark.read.parquet(f"{d}/customer.parquet").select("c_custkey", "c_acctbal")
    changed = table.where("c_custkey % 3 = 0").select("c_custkey", F.lit(-1.5).alias("c_acctbal"))
    return enrich.delete_in(enrich.replace_from(table, changed, "c_custkey", "c_acctbal"), table.where("c_custkey % 10 = 4"), "c_custkey")


@query(
    o.sql(
        o.PIXELS,
        "select tile, count(*) n_pixels, sum(k)::bigint total from (select 'A' || (c // 50)::varchar tile, o_custkey k from (select *, o_orderkey % 100 c from orders)) group by tile",
    )
)
def union_tiles(spark: SparkSession, d: str) -> DataFrame:
    orders = spark.read.parquet(f"{d}/orders.parquet").select((F.col("o_orderkey") % 100).alias("c"), F.col("o_custkey").alias("k"))
    both = orders.where("c < 50").select(F.lit("A0").alias("tile"), "k").unionByName(orders.where("c >= 50").select("k", F.lit("A1").alias("tile")))
    return both.groupBy("tile").agg(F.count("*").alias("n_pixels"), F.sum("k").alias("total"))


@query(o.sql(o.STACK, "select (c // 11) * 1000 + r // 7 as cell, max(eff) effective, count(*) n from px group by 1"))
def coarse_grid(spark: SparkSession, d: str) -> DataFrame:
    """Downsampling by the maximum, as road pixels are brought to a coarser grid."""
    rows = px(spark, d)
    return rows.groupBy((F.floor(F.col("c") / 11) * 1000 + F.floor(F.col("r") / 7)).alias("cell")).agg(F.max("effective").cast("long").alias("effective"), F.count("*").alias("n"))


