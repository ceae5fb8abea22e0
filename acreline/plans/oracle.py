"""DuckDB SQL for the registered queries, in shared pieces."""

PIXELS = """
g as (select o_orderkey pix, o_orderkey // 100 r, o_orderkey % 100 c, o_custkey k from orders),
f as (select *, (r // 7) * 31 + (c // 11) * 17 as b from g),
y as (select * from (values (2018),(2019),(2020),(2021),(2022),(2023),(2024),(2025)) t(yr)),
py as (select pix, r, c, yr, case (case when k % 23 = 0 then (k // 23 + yr) % 9
         when b % 5 = 0 then (case when yr = 2018 then 0 else 6 end) else (b + (yr - 2018) * (b % 3)) % 6 end)
       when 0 then 1 when 1 then 5 when 2 then 24 when 3 then 36 when 4 then 61 when 5 then 176 when 6 then 152 when 7 then 0 else 37 end as cdl
       from f cross join y)"""

STACK = PIXELS + """,
px as (select pix, r, c, string_agg(key::varchar, ',' order by yr) seq,
         count(*) filter (key > 0) - count(*) filter (key = 254) eff,
         string_agg((case when key = 254 then 0 else key end)::varchar, ',' order by yr) attr
       from (select *, case when cdl > 81 then 254 else cdl end as key from py) group by pix, r, c)"""

MASKED = STACK + """,
m as (select * from px where eff >= 2)"""


def components(src: str, value: str, name: str) -> str:
    """Recursive reachability: the smallest pixel that reaches a pixel is its label."""
    return f""",
{name}_e as (select a.pix u, b.pix v from {src} a join {src} b on b.pix = a.pix + 1 and b.r = a.r and a.{value} = b.{value}
  union all select a.pix, b.pix from {src} a join {src} b on b.pix = a.pix + 100 and a.{value} = b.{value}),
{name}_ee as (select u, v from {name}_e union all select v, u from {name}_e),
{name}_reach(pix, label) as (select pix, pix from {src} union select e.v, x.label from {name}_reach x join {name}_ee e on e.u = x.pix where x.label < e.v),
{name} as (select s.*, x.label from {src} s join (select pix, min(label) label from {name}_reach group by pix) x using (pix))"""


LABELS = MASKED + components("m", "seq", "lab")

GRAPH = LABELS + """,
r0 as (select label, count(*) n, min(pix) fp from lab group by label),
e0 as (select least(a.label, b.label) lo, greatest(a.label, b.label) hi, count(*) s from lab a
  join lab b on (b.pix = a.pix + 1 and b.r = a.r) or b.pix = a.pix + 100 where a.label <> b.label group by all)"""


def eliminate_pass(i: int, threshold: float) -> str:
    """Regions r{i}, edges e{i} and mapping m{i} from those before."""
    j = i - 1
    return f""",
t{i} as (select label, target from (select case when a.n * 900 <= {threshold} then lo else hi end label, case when a.n * 900 <= {threshold} then hi else lo end target,
    row_number() over (partition by case when a.n * 900 <= {threshold} then lo else hi end order by s desc, case when a.n * 900 <= {threshold} then hi else lo end) k
  from e{j} join r{j} a on a.label = lo join r{j} b on b.label = hi where (a.n * 900 <= {threshold}) <> (b.n * 900 <= {threshold})) where k = 1),
r{i} as (select coalesce(target, r.label) label, sum(n)::bigint n, min(fp) fp from r{j} r left join t{i} t on t.label = r.label group by 1),
e{i} as (select least(a, b) lo, greatest(a, b) hi, sum(s)::bigint s from (select coalesce(x.target, lo) a, coalesce(z.target, hi) b, s from e{j} left join t{i} x on x.label = lo left join t{i} z on z.label = hi) where a <> b group by 1, 2),
m{i} as (select m.label, coalesce(t.target, m.target) target from m{j} m left join t{i} t on t.label = m.target)"""


ELIMINATED = GRAPH + ",\nm0 as (select label, label target from r0)" + "".join(eliminate_pass(i, t) for i, t in enumerate((100, 1000, 10000, 10000), 1)) + """,
merged as (select q.label, n, fp, seq, eff, attr from r4 q join px on px.pix = fp)"""

DISSOLVED = ELIMINATED + """,
d_e as (select lo u, hi v from e4 join merged a on a.label = lo join merged b on b.label = hi where a.seq = b.seq),
d_ee as (select u, v from d_e union all select v, u from d_e),
d_reach(label, target) as (select label, label from merged union select e.v, x.target from d_reach x join d_ee e on e.u = x.label where x.target < e.v),
d_map as (select label, min(target) target from d_reach group by label),
fin as (select q.*, seq, eff, attr from (select target label, sum(n)::bigint n, min(fp) fp from merged join d_map using (label) group by 1) q join px on px.pix = fp)"""


def sql(prelude: str, body: str) -> str:
    return f"with recursive {prelude.strip()}\n{body.strip()}"
