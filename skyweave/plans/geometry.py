"""Queries on pixels, projection, boxes and checks, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.functions import labels, pixels
from skyweave.operators import boxes, checks, projection, reports, scenes
from skyweave.plans.catalogue import _BEST, _PARTS, HEIGHT, WIDTH, _r6, query
from skyweave.sources.relations import relation

_KEY = ("unique_scene", "row_idx", "col_idx")


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, without negative zeros."""
    return df.select(*((F.round(c, digits) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


@query("select unique_scene, row_idx, col_idx, round(case when range_m > 0 then 0.05 + least(greatest(least((range_m - 6) / 4, (34 - range_m) / 4), 0.0), 1.0) * (0.7 - 0.05) else 0.0 end, 6) as gray from px", "px")
def bright_band(spark, sf_dir):
    gray = pixels.bright_band(F.col("range_m"), 10.0, 30.0, 4.0, 0.05, 0.7)
    return relation(spark, sf_dir, "px").select(*_KEY, F.round(gray, 6).alias("gray"))


@query("""with s as (select unique_scene, quantile_cont(ln(range_m), 0.01) as a, quantile_cont(ln(range_m), 0.99) as b from px where range_m > 0 group by 1)
select q.unique_scene, row_idx, col_idx, round(case when range_m > 0 then pow(1 - least(greatest(case when b > a then (ln(range_m) - a) / (b - a) else ln(range_m) end, 0.0), 1.0), 0.8) else 0.0 end, 6) as gray from px q left join s on q.unique_scene = s.unique_scene""", "px")
def range_encode(spark, sf_dir):
    return scenes.range_encode(relation(spark, sf_dir, "px"), "near_bright", 0.8).select(*_KEY, *_r6("gray"))


_JET = ", ".join(f"cast(round_even(least(greatest(1.5 - abs(4.0 * v - {k}), 0.0), 1.0) * 255, 0) as integer) as jet_{n}" for n, k in (("r", 3), ("g", 2), ("b", 1)))
_VIRIDIS = "cast(round_even(case when v <= 0.25 then 68 + v / 0.25 * (59 - 68) when v <= 0.5 then 59 + (v - 0.25) / 0.25 * (33 - 59) when v <= 0.75 then 33 + (v - 0.5) / 0.25 * (94 - 33) else 94 + (v - 0.75) / 0.25 * (253 - 94) end, 0) as integer) as viridis_r"


@query(f"with g as (select unique_scene, row_idx, col_idx, is_aircraft, cast(intensity / 65536 as double) as v from px) select unique_scene, row_idx, col_idx, {_JET}, {_VIRIDIS}, cast(floor(case when is_aircraft then round_even(v * 255, 0) * 0.5 + 127.5 else round_even(v * 255, 0) end) as integer) as tinted_r from g", "px")
def colormap(spark, sf_dir):
    px = relation(spark, sf_dir, "px").withColumn("v", F.col("intensity") / 65536)
    tinted = pixels.mask_tint(pixels.colormap(F.col("v"), "gray"), F.col("is_aircraft"))
    jet = pixels.colormap(F.col("v"), "jet")
    return px.select(*_KEY, *(jet[n].alias(f"jet_{n}") for n in "rgb"), pixels.colormap(F.col("v"), "viridis")["r"].alias("viridis_r"), tinted["r"].alias("tinted_r"))


@query("""with g as (select *, intensity / 65536 as v from px), r as (select unique_scene, row_idx, median(v) as m from g group by 1, 2), f as (select unique_scene, median(m) as fill from r group by 1),
d as (select f.unique_scene, i.i, coalesce(m, fill) as m from f cross join (select unnest(range(16)) as i) i left join r on r.unique_scene = f.unique_scene and r.row_idx = i.i),
o as (select unnest(range(-8, 9)) as o),
t as (select d.unique_scene, d.i, any_value(d.m) as m, sum(e.m * exp(-o.o * o.o / 8.0)) / sum(exp(-o.o * o.o / 8.0)) as trend from d cross join o join d e on e.unique_scene = d.unique_scene and e.i = least(greatest(d.i + o.o, 0), 15) group by 1, 2),
b as (select unique_scene, i, 0.8 * least(greatest(m - trend, -0.12), 0.12) as band from t),
p as (select g.unique_scene, row_idx, col_idx, v, band, avg(band) over (partition by g.unique_scene) as mean_band from g join b on b.unique_scene = g.unique_scene and b.i = g.row_idx)
select unique_scene, row_idx, col_idx, round(least(greatest(v - band + mean_band, 0.0), 1.0), 6) as gray from p""", "px")
def row_band_correction(spark, sf_dir):
    px = relation(spark, sf_dir, "px").withColumn("gray", F.col("intensity") / 65536)
    return scenes.row_band_correction(px, HEIGHT, sigma=2.0).select(*_KEY, *_r6("gray"))


@query("""with m as (select unique_scene, avg(intensity / 65536) as a, avg(reflectivity / 65536) as b, avg(range_m / 50) as c from px group by 1), t as (select *, list_sort([a, b, c])[2] as mid from m)
select p.unique_scene, row_idx, col_idx, round(least(intensity / 65536 * least(greatest(mid / a, 0.25), 2.0), 1.0), 6) as r, round(least(reflectivity / 65536 * least(greatest(mid / b, 0.25), 2.0), 1.0), 6) as g, round(least(range_m / 50 * least(greatest(mid / c, 0.25), 2.0), 1.0), 6) as b from px p join t on p.unique_scene = t.unique_scene""", "px")
def channel_balance(spark, sf_dir):
    px = relation(spark, sf_dir, "px").select(*_KEY, (F.col("intensity") / 65536).alias("r"), (F.col("reflectivity") / 65536).alias("g"), (F.col("range_m") / 50).alias("b"))
    return scenes.channel_balance(px, ["r", "g", "b"]).select(*_KEY, *_r6("r", "g", "b"))


@query("select unique_scene, kp_name, round(cos(0.1 * kp_idx) * x - sin(0.1 * kp_idx) * y + 1, 6) + 0.0 as x, round(sin(0.1 * kp_idx) * x + cos(0.1 * kp_idx) * y + 2, 6) + 0.0 as y, round(z + 3, 6) + 0.0 as z from kp3d", "kp3d")
def apply_transform(spark, sf_dir):
    r = pixels.euler_xyz(F.lit(0.0), F.lit(0.0), F.col("kp_idx") * 0.1)
    move = [F.lit(v) for v in (1.0, 2.0, 3.0)]
    matrix = F.array(*(F.get(r, 3 * i + j) if j < 3 else move[i] for i in range(3) for j in range(4)), *(F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)))
    moved = pixels.apply_transform(F.col("x"), F.col("y"), F.col("z"), matrix)
    return _rounded(relation(spark, sf_dir, "kp3d").select("unique_scene", "kp_name", *(v.alias(k) for v, k in zip(moved, "xyz", strict=True))))


@query("""with c as (select unique_scene, col_idx, round(atan2(avg(sin(atan2(y, x))), avg(cos(atan2(y, x)))), 9) as v from px where is_aircraft group by 1, 2),
e as (select unique_scene, i.i from (select distinct unique_scene from c) s cross join (select unnest(range(64)) as i) i)
select unique_scene, cast(i as integer) as col_idx, v as azimuth from (select e.unique_scene, e.i, v, row_number() over (partition by e.unique_scene, e.i order by abs(c.col_idx - e.i), c.col_idx) as rn from e join c on c.unique_scene = e.unique_scene) q where rn = 1""", "px")
def fill_nearest(spark, sf_dir):
    found = scenes.col_calibration(relation(spark, sf_dir, "px").where("is_aircraft")).select("unique_scene", "col_idx", F.round("azimuth", 9).alias("azimuth"))
    return projection.fill_nearest(found, ["unique_scene"], "col_idx", "azimuth", WIDTH)


_PROJECTED = """with rc as (select unique_scene, row_idx, round(median(atan2(z, sqrt(x * x + y * y))), 9) as v from px group by 1, 2), cc as (select unique_scene, col_idx, round(atan2(avg(sin(atan2(y, x))), avg(cos(atan2(y, x)))), 9) as v from px group by 1, 2),
kk as (select *, atan2(y, x) as az, atan2(z, sqrt(x * x + y * y)) as el from kp3d),
kr as (select kk.unique_scene, kp_name, row_idx as r, row_number() over (partition by kk.unique_scene, kp_name order by abs(v - el), row_idx) as rn from kk join rc on rc.unique_scene = kk.unique_scene),
kc as (select kk.unique_scene, kp_name, col_idx as c, row_number() over (partition by kk.unique_scene, kp_name order by abs(atan2(sin(az - v), cos(az - v))), col_idx) as rn from kk join cc on cc.unique_scene = kk.unique_scene),
pk as (select kk.unique_scene, kk.kp_name, x, y, z, cast(r as integer) as r, cast(c as integer) as c from kk join kr on kr.unique_scene = kk.unique_scene and kr.kp_name = kk.kp_name and kr.rn = 1 join kc on kc.unique_scene = kk.unique_scene and kc.kp_name = kk.kp_name and kc.rn = 1)
"""


def _projected(spark, sf_dir) -> DataFrame:
    px = relation(spark, sf_dir, "px")
    rows = scenes.row_calibration(px).withColumn("elevation", F.round("elevation", 9))
    columns = scenes.col_calibration(px).withColumn("azimuth", F.round("azimuth", 9))
    return projection.project_keypoints(relation(spark, sf_dir, "kp3d").select("unique_scene", "kp_name", "x", "y", "z"), rows, columns)


@query(_PROJECTED + "select unique_scene, kp_name, r, c from pk", "px", "kp3d")
def project_keypoints(spark, sf_dir):
    return _projected(spark, sf_dir).select("unique_scene", "kp_name", "r", "c")


@query(_PROJECTED.rstrip() + """, hit as (select pk.unique_scene, kp_name, min(range_m) as depth from pk join px on px.unique_scene = pk.unique_scene and abs(row_idx - r) <= 1 and abs(col_idx - c) <= 1 where range_m > 0 group by 1, 2)
select pk.unique_scene, pk.kp_name, depth, case when pk.kp_name = 'center' then 1 when depth is null then case when pk.kp_name = 'engine_left' then 0 else 1 end when sqrt(x * x + y * y + z * z) > depth + 1.5 then 0 else 1 end as visible
from pk left join hit on hit.unique_scene = pk.unique_scene and hit.kp_name = pk.kp_name""", "px", "kp3d")
def ray_visibility(spark, sf_dir):
    met = projection.patch_min_depth(_projected(spark, sf_dir), relation(spark, sf_dir, "px"), 1)
    return projection.ray_visibility(met, 1.5, exempt=("center",), need_hit=("engine_left",)).select("unique_scene", "kp_name", "depth", "visible")


_NEAR = "from pk join px on px.unique_scene = pk.unique_scene and abs(row_idx - r) <= {0} and abs(col_idx - c) <= {0}"


@query(_PROJECTED.rstrip() + f""", a as (select pk.unique_scene, kp_name, row_idx, col_idx, row_number() over (partition by pk.unique_scene, kp_name order by (row_idx - r) * (row_idx - r) + (col_idx - c) * (col_idx - c) + cast(0.02 as double) * range_m, row_idx, col_idx) as rn {_NEAR.format(1)} where range_m > 0),
b as (select pk.unique_scene, kp_name, row_idx, col_idx, row_number() over (partition by pk.unique_scene, kp_name order by (row_idx - r) * (row_idx - r) + (col_idx - c) * (col_idx - c), row_idx, col_idx) as rn {_NEAR.format(4)} where range_m > 0 and (row_idx - r) * (row_idx - r) + (col_idx - c) * (col_idx - c) <= 16)
select pk.unique_scene, pk.kp_name, cast(coalesce(a.row_idx, b.row_idx, r) as integer) as snap_r, cast(coalesce(a.col_idx, b.col_idx, c) as integer) as snap_c from pk left join a on a.unique_scene = pk.unique_scene and a.kp_name = pk.kp_name and a.rn = 1 left join b on b.unique_scene = pk.unique_scene and b.kp_name = pk.kp_name and b.rn = 1""", "px", "kp3d")
def snap_pixel(spark, sf_dir):
    return projection.snap_pixel(_projected(spark, sf_dir), relation(spark, sf_dir, "px"), 1, reach=4.0).select("unique_scene", "kp_name", "snap_r", "snap_c")


@query(_PROJECTED.rstrip() + f""", a as (select pk.unique_scene, kp_name, px.x, px.y, px.z, row_number() over (partition by pk.unique_scene, kp_name order by (row_idx - r) * (row_idx - r) + (col_idx - c) * (col_idx - c), row_idx, col_idx) as rn {_NEAR.format(2)})
select pk.unique_scene, pk.kp_name, a.x, a.y, a.z from pk left join a on a.unique_scene = pk.unique_scene and a.kp_name = pk.kp_name and a.rn = 1""", "px", "kp3d")
def sample_xyz_nearest(spark, sf_dir):
    return projection.sample_xyz_nearest(_projected(spark, sf_dir), relation(spark, sf_dir, "px"), 2).select("unique_scene", "kp_name", "p.x", "p.y", "p.z")


_ROBUST = f""", a as (select pk.unique_scene, kp_name, row_idx, col_idx, px.x, px.y, px.z, range_m, is_aircraft, bool_or(is_aircraft) over (partition by pk.unique_scene, kp_name) as any_craft {_NEAR.format(2)}),
f as (select * from a where is_aircraft or not any_craft),
q as (select unique_scene, kp_name, quantile_cont(range_m, 0.25) as q1, quantile_cont(range_m, 0.5) as q2, quantile_cont(range_m, 0.75) as q3 from f group by 1, 2),
o as (select f.*, q1, q2, q3, abs(range_m - q2) as away from f join q using (unique_scene, kp_name)), d as (select unique_scene, kp_name, median(away) as mad from o group by 1, 2),
k as (select o.* from o join d using (unique_scene, kp_name) where case when mad > 0 then away <= cast(3 * 1.4826 as double) * mad else range_m between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) end),
m as (select unique_scene, kp_name, median(x) as mx, median(y) as my, median(z) as mz, count(*) as n from k group by 1, 2),
w as (select k.*, mx, my, mz, n, row_number() over (partition by unique_scene, kp_name order by (x - mx) * (x - mx) + (y - my) * (y - my) + (z - mz) * (z - mz), row_idx, col_idx) as rn from k join m using (unique_scene, kp_name)),
s as (select unique_scene, kp_name, case when any_value(n) < 5 then any_value(mx) else avg(x) end as x, case when any_value(n) < 5 then any_value(my) else avg(y) end as y, case when any_value(n) < 5 then any_value(mz) else avg(z) end as z from w where n < 5 or rn <= ceil(n * cast(0.8 as double)) group by 1, 2)"""


@query(_PROJECTED.rstrip() + _ROBUST + """
select pk.unique_scene, pk.kp_name, round(s.x, 6) + 0.0 as x, round(s.y, 6) + 0.0 as y, round(s.z, 6) + 0.0 as z from pk left join s on s.unique_scene = pk.unique_scene and s.kp_name = pk.kp_name""", "px", "kp3d")
def sample_xyz_robust(spark, sf_dir):
    return _rounded(projection.sample_xyz_robust(_projected(spark, sf_dir), relation(spark, sf_dir, "px"), 2).select("unique_scene", "kp_name", "p.x", "p.y", "p.z"))


@query("""with a as (select *, atan2(z, sqrt(x * x + y * y)) as el from px), s as (select unique_scene, quantile_cont(el, 0.01) as lo, quantile_cont(el, 0.99) as hi from a group by 1),
c as (select a.unique_scene, row_idx, col_idx, x, y, z, cast(least(greatest(floor(coalesce((hi - el) / nullif(hi - lo, 0), 0.0) * 8), 0), 7) as integer) as r, cast(least(greatest(floor((atan2(y, x) + pi()) / (2 * pi()) * 32), 0), 31) as integer) as c from a join s on a.unique_scene = s.unique_scene)
select unique_scene, r, c, x, y, z from (select *, row_number() over (partition by unique_scene, r, c order by sqrt(x * x + y * y + z * z), row_idx, col_idx) as rn from c) q where rn = 1""", "px")
def zbuffer_project(spark, sf_dir):
    return projection.zbuffer_project(relation(spark, sf_dir, "px"), 8, 32, F.struct("row_idx", "col_idx"))


@query("""with a as (select unique_scene, x as px, y as py, z as pz, min(z) over (partition by unique_scene) as low from px where is_aircraft), w as (select * from kp3d where kp_name like '%wheel%'),
m as (select w.unique_scene, kp_name, px, py, pz, sqrt((px - x) * (px - x) + (py - y) * (py - y) + (pz - z) * (pz - z)) as d from w join a on a.unique_scene = w.unique_scene where pz < low + 4),
s as (select unique_scene, kp_name, count(*) filter (d < 4) as n1, count(*) as n2, avg(px) filter (d < 4) as ax, avg(py) filter (d < 4) as ay, avg(pz) filter (d < 4) as az, avg(px) as bx, avg(py) as by_, avg(pz) as bz from m where d < 7 group by 1, 2)
select w.unique_scene, w.kp_name, round(case when n1 >= 3 then ax when n2 >= 3 then bx else x end, 6) + 0.0 as x, round(case when n1 >= 3 then ay when n2 >= 3 then by_ else y end, 6) + 0.0 as y, round(case when n1 >= 3 then az when n2 >= 3 then bz else z end, 6) + 0.0 as z, coalesce(n2 >= 3, false) as used
from w left join s on s.unique_scene = w.unique_scene and s.kp_name = w.kp_name""", "px", "kp3d")
def cluster_adjust(spark, sf_dir):
    wheels = relation(spark, sf_dir, "kp3d").where("kp_name like '%wheel%'")
    return _rounded(projection.cluster_adjust(wheels, relation(spark, sf_dir, "px"), 4.0, 7.0, 4.0, 3))


@query("""with p as (select unique_scene, max(x) filter (kp_name = 'left_wing_tip') - max(x) filter (kp_name = 'right_wing_tip') as yx, max(y) filter (kp_name = 'left_wing_tip') - max(y) filter (kp_name = 'right_wing_tip') as yy from kp3d group by 1),
u as (select unique_scene, yx / sqrt(yx * yx + yy * yy) as a, yy / sqrt(yx * yx + yy * yy) as b from p)
select unique_scene, round(b, 6) + 0.0 as xx, round(-a, 6) + 0.0 as xy, round(a, 6) + 0.0 as yx, round(b, 6) + 0.0 as yy, cast(1 as double) as zz from u""", "kp3d")
def frame_basis(spark, sf_dir):
    """In these relations scenes are turned about z only, so that x is y turned back by a right angle."""
    found = projection.frame_basis(relation(spark, sf_dir, "kp3d"))
    return _rounded(found.select("unique_scene", *(F.get("basis", i).alias(n) for i, n in ((0, "xx"), (1, "xy"), (3, "yx"), (4, "yy"), (8, "zz")))))


_LABELED = _PARTS + ", b as (select unique_scene, line_no, 0 as cls, cx, cy, w, h from n union all select unique_scene, line_no, 1, x, y, cast(0.125 as double), cast(0.25 as double) from n where v > 0), e as (select *, greatest(cx - w / 2, 0.0) as a, greatest(cy - h / 2, 0.0) as bb, least(cx + w / 2, 1.0) as c, least(cy + h / 2, 1.0) as d from b), k as (select unique_scene, line_no, cls, (a + c) / 2 as cx, (bb + d) / 2 as cy, c - a as w, d - bb as h from e where c > a and d > bb)"
_SIDES = ", ".join(f"round({c}, 6) as {c}" for c in ("cx", "cy", "w", "h"))


def _part_boxes(spark, sf_dir) -> DataFrame:
    parsed = relation(spark, sf_dir, "pose_label_lines").withColumn("l", labels.parse_pose_line(F.col("text"))).where("l.error is null").select("unique_scene", "line_no", "l")
    return boxes.boxes_from_keypoints(parsed, [(1, 0, 4.0, 2.0)], WIDTH, HEIGHT)


@query(_LABELED + f" select unique_scene, line_no, cls, {_SIDES} from k", "pose_label_lines")
def boxes_from_keypoints(spark, sf_dir):
    return _rounded(_part_boxes(spark, sf_dir))


@query(_LABELED + f", s as (select *, case cls when 0 then 0.5 else 1.5 end as f, case cls when 0 then 0.25 else -0.125 end as dx from k), g as (select *, greatest(cx + dx - w * f / 2, 0.0) as a, greatest(cy - h * f / 2, 0.0) as bb, least(cx + dx + w * f / 2, 1.0) as c, least(cy + h * f / 2, 1.0) as d from s), fin as (select unique_scene, line_no, cls, (a + c) / 2 as cx, (bb + d) / 2 as cy, c - a as w, d - bb as h from g where c > a and d > bb) select unique_scene, line_no, cls, {_SIDES} from fin", "pose_label_lines")
def edit_boxes(spark, sf_dir):
    return _rounded(boxes.edit_boxes(_part_boxes(spark, sf_dir), {0: (0.5, 0.25, 0.0), 1: (1.5, -0.125, 0.0)}))


_BIG = "big as (select * from (select *, row_number() over (partition by unique_scene, cls order by greatest(x2 - x1, 0) * greatest(y2 - y1, 0) desc, det_idx) as rn from detections where conf >= 0.3) q where rn = 1)"
_FIT = """o as (select unique_scene, cls, least(greatest(least(p1, p2), 0.0), 63.0) as x1, least(greatest(greatest(p1, p2), 0.0), 63.0) as x2, least(greatest(least(q1, q2), 0.0), 15.0) as y1, least(greatest(greatest(q1, q2), 0.0), 15.0) as y2 from raw),
f as (select unique_scene, cls, case when x2 - x1 < 2 then greatest((x1 + x2) * 0.5 - 1, 0.0) else x1 end as x1, case when y2 - y1 < 2 then greatest((y1 + y2) * 0.5 - 1, 0.0) else y1 end as y1, case when x2 - x1 < 2 then least((x1 + x2) * 0.5 + 1, 63.0) else x2 end as x2, case when y2 - y1 < 2 then least((y1 + y2) * 0.5 + 1, 15.0) else y2 end as y2 from o)
select unique_scene, cls, round(x1, 6) + 0.0 as x1, round(y1, 6) + 0.0 as y1, round(x2, 6) + 0.0 as x2, round(y2, 6) + 0.0 as y2 from f where x2 > x1 and y2 > y1"""


@query(f"with {_BIG}, raw as (select a.unique_scene, case when l.cls is null then 1 else 2 end as cls, a.x1 + a.x2 - coalesce(l.x2, r.x2) as p1, coalesce(l.y1, r.y1) as q1, a.x1 + a.x2 - coalesce(l.x1, r.x1) as p2, coalesce(l.y2, r.y2) as q2 from (select * from big where cls = 0) a left join (select * from big where cls = 1) l on l.unique_scene = a.unique_scene left join (select * from big where cls = 2) r on r.unique_scene = a.unique_scene where (l.cls is null) <> (r.cls is null)), {_FIT}", "detections")
def suggest_missing_engine(spark, sf_dir):
    return _rounded(boxes.suggest_missing_engine(relation(spark, sf_dir, "detections").where("conf >= 0.3"), WIDTH, HEIGHT))


@query(f"""with {_BIG}, pair as (select l.unique_scene, (l.x1 + l.x2) * 0.5 as lx, (r.x1 + r.x2) * 0.5 as rx, (l.y1 + l.y2 + r.y1 + r.y2) * 0.25 as my, (greatest(l.x2 - l.x1, 2.0) + greatest(r.x2 - r.x1, 2.0)) * 0.5 as ew, (greatest(l.y2 - l.y1, 2.0) + greatest(r.y2 - r.y1, 2.0)) * 0.5 as eh
from (select * from big where cls = 1) l join (select * from big where cls = 2) r on r.unique_scene = l.unique_scene where not exists (select 1 from detections d where d.conf >= 0.3 and d.cls = 4 and d.unique_scene = l.unique_scene)),
m as (select unique_scene, (lx + rx) * 0.5 + 0.25 * greatest(abs(rx - lx), 2.0) as x, my + 0.5 * eh as y, greatest(0.5 * ew, 2.0) as w, greatest(0.75 * eh, 2.0) as h from pair),
raw as (select unique_scene, 4 as cls, x - 0.5 * w as p1, y - 0.5 * h as q1, x + 0.5 * w as p2, y + 0.5 * h as q2 from m), {_FIT}""", "detections")
def suggest_front_gear(spark, sf_dir):
    return _rounded(boxes.suggest_front_gear(relation(spark, sf_dir, "detections").where("conf >= 0.3"), WIDTH, HEIGHT, 0.25, 0.5, 0.5, 0.75, front=4))


_MID = "cast(round_even(({0}x1 + {0}x2) / 2, 0) as integer)"


@query(f"""with {_BEST}, b as (select unique_scene, cls, conf, round_even(x1, 0) as x1, round_even(x2, 0) as x2 from best),
j as (select a.unique_scene, {_MID.format('a.')} as am, {_MID.format('l.')} as lm, {_MID.format('r.')} as rm, l.conf as lc, r.conf as rc from (select * from b where cls = 0) a left join (select * from b where cls = 1) l on l.unique_scene = a.unique_scene left join (select * from b where cls = 2) r on r.unique_scene = a.unique_scene),
k as (select *, case when lm > rm then 'swap_both_by_x_order' when rm is null and lm > am then 'move_single_left_to_right_by_aircraft_center' when lm is null and rm < am then 'move_single_right_to_left_by_aircraft_center' else 'none' end as reason from j)
select unique_scene, reason, case when reason = 'none' then lc else rc end as left_conf, case when reason = 'none' then rc else lc end as right_conf from k""", "detections")
def normalize_engine_sides(spark, sf_dir):
    best = reports.best_per_class(relation(spark, sf_dir, "detections"))
    one = lambda c, k: F.max(F.when(F.col("cls") == k, c))
    box = F.struct(*boxes.CORNERS)
    wide = best.groupBy("unique_scene").agg(one(box, 0).alias("aircraft"), one(box, 1).alias("left"), one(box, 2).alias("right"), one(F.col("conf"), 1).alias("left_conf"), one(F.col("conf"), 2).alias("right_conf")).where("aircraft is not null")
    return boxes.normalize_engine_sides(wide).select("unique_scene", "reason", "left_conf", "right_conf")


@query("""with c as (select unique_scene, det_source, max(conf) as conf, count(*) filter (cls in (1, 2)) as n_engines, count(*) filter (cls = 3) / count(*) as recall from detections group by 1, 2),
a as (select * from c where det_source = 'image'), b as (select * from c where det_source <> 'image')
select coalesce(a.unique_scene, b.unique_scene) as unique_scene, case when o then b.det_source else a.det_source end as det_source, case when o then b.n_engines else a.n_engines end as n_engines, case when o then b.conf else a.conf end as conf from (select a, b, b.conf is not null and (a.conf is null or ((a.n_engines <= 0 or a.recall < 0.3) and (b.recall, b.n_engines, b.conf) > (a.recall, a.n_engines, a.conf))) as o from a full join b on a.unique_scene = b.unique_scene) q""", "detections")
def choose_source(spark, sf_dir):
    found = relation(spark, sf_dir, "detections").groupBy("unique_scene", "det_source").agg(F.max("conf").alias("conf"), F.count_if(F.col("cls").isin(1, 2)).alias("n_engines"), (F.count_if(F.col("cls") == 3) / F.count("*")).alias("recall"))
    return boxes.choose_source(found, 0.3).select("unique_scene", "det_source", "n_engines", "conf")


@query("with a as (select *, bool_or(warning_level = 4) over (partition by profile) as lv from crop_boxes), b as (select *, name like '%right%' as nm from a where warning_level = 4 or not lv), c as (select *, bool_or(nm) over (partition by profile) as an from b) select profile, name from c where nm or not an", "crop_boxes")
def select_boxes(spark, sf_dir):
    return boxes.select_boxes(relation(spark, sf_dir, "crop_boxes"), 4, ["right"]).select("profile", "name")


@query("select profile, max(name) filter (name = 'engine_left') as left_box, max(name) filter (name = 'engine_right') as right_box from crop_boxes where name like 'engine%' group by 1", "crop_boxes")
def pick_engine_pair(spark, sf_dir):
    return boxes.pick_engine_pair(relation(spark, sf_dir, "crop_boxes"))


@query("select profile, name, cast(i as integer) as corner, round(x + cos(0.5) * case when i & 1 = 0 then -sx / 2 else sx / 2 end - sin(0.5) * case when i & 2 = 0 then -sy / 2 else sy / 2 end, 6) + 0.0 as x, round(y + sin(0.5) * case when i & 1 = 0 then -sx / 2 else sx / 2 end + cos(0.5) * case when i & 2 = 0 then -sy / 2 else sy / 2 end, 6) + 0.0 as y, round(case when i & 4 = 0 then z - sz / 2 else z + sz / 2 end, 6) + 0.0 as z from crop_boxes cross join (select unnest(range(8)) as i) i", "crop_boxes")
def box_corners(spark, sf_dir):
    turned = relation(spark, sf_dir, "crop_boxes").withColumn("rotation", pixels.euler_xyz(F.lit(0.0), F.lit(0.0), F.lit(0.5)))
    return _rounded(boxes.box_corners(turned.select("profile", "name", "x", "y", "z", "sx", "sy", "sz", "rotation")))


_CLS = "case name when 'engine_left' then 1 when 'engine_right' then 2 when 'left_wing' then 3 end"


@query(f"""with b as (select unique_scene, {_CLS} as cls, x, y, z, sx / 2 as hx, sy / 2 as hy, sz / 2 as hz from scene_meta m join crop_boxes c on c.profile = m.profile where {_CLS} is not null),
s as (select p.unique_scene, row_idx, col_idx, cls, row_number() over (partition by p.unique_scene, row_idx, col_idx order by greatest(abs(p.x - b.x) / hx, abs(p.y - b.y) / hy, abs(p.z - b.z) / hz), cls) as rn from px p join b on b.unique_scene = p.unique_scene where abs(p.x - b.x) <= hx + 1e-6 and abs(p.y - b.y) <= hy + 1e-6 and abs(p.z - b.z) <= hz + 1e-6)
select p.unique_scene, p.row_idx, p.col_idx, case when is_aircraft and coalesce(cls, 0) = 0 then 4 else coalesce(cls, 0) end as cls from px p left join s on s.unique_scene = p.unique_scene and s.row_idx = p.row_idx and s.col_idx = p.col_idx and rn = 1""", "px", "scene_meta", "crop_boxes")
def assign_box_class(spark, sf_dir):
    cls = F.when(F.col("name") == "engine_left", 1).when(F.col("name") == "engine_right", 2).when(F.col("name") == "left_wing", 3)
    specs = relation(spark, sf_dir, "scene_meta").select("unique_scene", "profile").join(relation(spark, sf_dir, "crop_boxes"), "profile").withColumn("cls", cls).where("cls is not null")
    specs = specs.select("unique_scene", "cls", *(F.col(k).alias(f"c{k}") for k in "xyz"), *((F.col(f"s{k}") / 2).alias(f"h{k}") for k in "xyz"))
    return boxes.assign_box_class(relation(spark, sf_dir, "px"), specs, aircraft=4).select(*_KEY, "cls")


@query("with s as (select unique_scene, min(x) as a, max(x) as b, min(y) as c, max(y) as d, min(z) as e, max(z) as f from px where is_aircraft and col_idx < 8 group by 1) select p.unique_scene, row_idx, col_idx from px p join s on s.unique_scene = p.unique_scene where x between a and b and y between c and d and z between e - 0.5 and f + 0.5", "px")
def expand_vertical(spark, sf_dir):
    px = relation(spark, sf_dir, "px")
    return boxes.expand_vertical(px, px.where("is_aircraft and col_idx < 8"), 0.5).select(*_KEY)


@query(f"with {_BEST} select p.unique_scene, row_idx, col_idx from px p join (select * from best where cls = 0) a on a.unique_scene = p.unique_scene where col_idx between round_even(a.x1, 0) and round_even(a.x2, 0) and row_idx between round_even(a.y1, 0) and round_even(a.y2, 0) and not exists (select 1 from best e where e.cls = 1 and e.unique_scene = p.unique_scene and col_idx between round_even(e.x1, 0) and round_even(e.x2, 0) and row_idx between round_even(e.y1, 0) and round_even(e.y2, 0))", "px", "detections")
def crop_bbox(spark, sf_dir):
    best = reports.best_per_class(relation(spark, sf_dir, "detections"))
    return boxes.crop_bbox(relation(spark, sf_dir, "px"), best.where("cls = 0"), best.where("cls = 1")).select(*_KEY)


_KEYED = "case when {0} like '%engine%' and {0} like '%left%' then '{1}' when {0} like '%engine%' and {0} like '%right%' then '{2}' when {0} like '%front%' or {0} like '%nose%' then 'front_landing_gear' end"
_CHECKS = f"""with sp as (select * from (select *, row_number() over (partition by profile, box_key order by name) as rn from (select *, {_KEYED.format('name', 'engine_left', 'engine_right')} as box_key from crop_boxes) c where box_key is not null) d where rn = 1),
ms as (select unique_scene, p.box_key, p.x as cx, p.y as cy, p.z as cz, greatest(sx / 2, 0.25) as hx, greatest(sy / 2, 0.25) as hy, greatest(sz / 2, 0.25) as hz from scene_meta m join sp p on p.profile = m.profile),
kb as (select *, false as swapped, {_KEYED.format('kp_name', 'engine_left', 'engine_right')} as box_key from kp3d union all select *, true, {_KEYED.format('kp_name', 'engine_right', 'engine_left')} from kp3d),
ck as (select k.unique_scene, kp_name, k.box_key, swapped, abs(x - cx) <= hx + 1e-6 and abs(y - cy) <= hy + 1e-6 and abs(z - cz) <= hz + 1e-6 as inside, abs(x - cx) as ax, abs(y - cy) as ay, abs(z - cz) as az, hx, hy, hz from kb k join ms s on s.unique_scene = k.unique_scene and s.box_key = k.box_key),
pr as (select unique_scene from ms where box_key in ('engine_left', 'engine_right') group by 1 having count(distinct box_key) = 2),
sw as (select c.unique_scene, count(*) filter (inside and swapped) > count(*) filter (inside and not swapped) and max(p.unique_scene) is not null as swap from ck c left join pr p on p.unique_scene = c.unique_scene group by 1),
au as (select c.* from ck c join sw on sw.unique_scene = c.unique_scene and sw.swap = c.swapped),
di as (select *, sqrt(greatest(ax - hx, 0) * greatest(ax - hx, 0) + greatest(ay - hy, 0) * greatest(ay - hy, 0) + greatest(az - hz, 0) * greatest(az - hz, 0)) as outside, least(hx - ax, hy - ay, hz - az) as margin from au),
nm as (select *, inside or outside <= 2 as near from di),
ve as (select m.unique_scene, case when n is null then 'no warning-box checks produced' when o > 0 then concat(cast(o as varchar), ' outside warning box') else '' end as reason, coalesce(i, 0) as n_inside, coalesce(o, 0) as n_outside from scene_meta m left join (select unique_scene, count(*) as n, count(*) filter (near) as i, count(*) filter (not near) as o from nm group by 1) t on t.unique_scene = m.unique_scene),
vd as (select *, case when reason = '' then 'PASS' else 'FAIL' end as verdict from ve),
cf as (select unique_scene, case event_key when 0 then 'engine_left' when 1 then 'engine_right' when 2 then 'plane_front_left_wheel_link' end as kp_name, max(conf) as conf from (select *, cls % 3 as event_key from detections) d group by 1, 2),
pf as (select n.unique_scene, n.kp_name, box_key, case when near then 'PASS' else 'FAIL' end as check_status, verdict as scene_result, conf as confidence, coalesce(conf >= 0.5, false) as counted from nm n join vd v on v.unique_scene = n.unique_scene left join cf on cf.unique_scene = n.unique_scene and cf.kp_name = n.kp_name
  union all select unique_scene, '__scene__', 'scene_summary', verdict, verdict, null, false from vd where n_inside + n_outside = 0)
"""
_ON = ("scene_meta", "kp3d", "crop_boxes", "detections")


def _specs(spark, sf_dir) -> DataFrame:
    return checks.box_specs(relation(spark, sf_dir, "scene_meta"), relation(spark, sf_dir, "crop_boxes"))


def _near(spark, sf_dir) -> DataFrame:
    return checks.near_margin_pass(checks.auto_swap_lr(relation(spark, sf_dir, "kp3d"), _specs(spark, sf_dir)), 2.0)


def _confidences(spark, sf_dir) -> DataFrame:
    name = F.element_at(F.array(*map(F.lit, ("engine_left", "engine_right", "plane_front_left_wheel_link"))), F.col("cls") % 3 + 1)
    return relation(spark, sf_dir, "detections").groupBy("unique_scene", name.alias("kp_name")).agg(F.max("conf").alias("conf"))


@query(_CHECKS + "select unique_scene, kp_name, box_key, inside, ax, ay, az, hx, hy, hz from ck where not swapped", *_ON)
def build_checks(spark, sf_dir):
    return checks.build_checks(relation(spark, sf_dir, "kp3d"), _specs(spark, sf_dir)).drop("swapped")


@query(_CHECKS + "select unique_scene, kp_name, box_key, inside, swapped from au", *_ON)
def auto_swap_lr(spark, sf_dir):
    return checks.auto_swap_lr(relation(spark, sf_dir, "kp3d"), _specs(spark, sf_dir)).select("unique_scene", "kp_name", "box_key", "inside", "swapped")


@query(_CHECKS + "select unique_scene, kp_name, inside as inside_raw, near as inside, near and not inside as near_pass from nm", *_ON)
def near_margin_pass(spark, sf_dir):
    return _near(spark, sf_dir).select("unique_scene", "kp_name", "inside_raw", "inside", "near_pass")


@query(_CHECKS + "select a.unique_scene, kp_name from au a join scene_meta m on m.unique_scene = a.unique_scene where not (m.profile = '777_300er' and box_key = 'front_landing_gear')", *_ON)
def skip_front_checks(spark, sf_dir):
    found = checks.auto_swap_lr(relation(spark, sf_dir, "kp3d"), _specs(spark, sf_dir))
    return checks.skip_front_checks(found, relation(spark, sf_dir, "scene_meta"), "777_300er").select("unique_scene", "kp_name")


@query(_CHECKS + "select unique_scene, kp_name, box_key, round(outside, 6) as outside_m, round(case when margin >= 0 then -margin else outside end, 6) + 0.0 as signed_m, round(margin, 6) + 0.0 as margin_m, case when margin >= 0 then 1 else 0 end as inside_box, 'ok' as status from di", *_ON)
def box_distance(spark, sf_dir):
    found = checks.box_distance(checks.auto_swap_lr(relation(spark, sf_dir, "kp3d"), _specs(spark, sf_dir)))
    return _rounded(found.drop("dx_m", "dy_m", "dz_m"))


def _verdicts(spark, sf_dir) -> DataFrame:
    return checks.scene_verdict(relation(spark, sf_dir, "scene_meta"), _near(spark, sf_dir))


@query(_CHECKS + "select unique_scene, verdict, reason, n_inside, n_outside from vd", *_ON)
def scene_verdict(spark, sf_dir):
    return _verdicts(spark, sf_dir)


@query(_CHECKS + "select 'sample' as kind, unique_scene as name, verdict, count(*) as n from vd group by 2, 3 union all select 'all', 'ALL', verdict, count(*) from vd group by 3 union all select 'fail_reason', reason, verdict, count(*) from vd where reason <> '' group by 2, 3", *_ON)
def verdict_summary(spark, sf_dir):
    return checks.verdict_summary(_verdicts(spark, sf_dir))


@query(_CHECKS + "select n_inside, count(*) as n from vd where verdict = 'PASS' group by 1", *_ON)
def pass_by_inside_count(spark, sf_dir):
    return checks.pass_by_inside_count(_verdicts(spark, sf_dir))


def _rows(spark, sf_dir) -> DataFrame:
    return checks.pass_fail_rows(_verdicts(spark, sf_dir), _near(spark, sf_dir), _confidences(spark, sf_dir), 0.5)


@query(_CHECKS + "select * from pf", *_ON)
def pass_fail_rows(spark, sf_dir):
    return _rows(spark, sf_dir)


@query(_CHECKS + "select check_status, round(avg(confidence) filter (counted), 6) as mean_conf, count(*) filter (counted) as n, count(*) filter (confidence < 0.5) as n_below, count(*) filter (confidence is null) as n_missing from pf where kp_name <> '__scene__' group by 1", *_ON)
def confidence_by_check(spark, sf_dir):
    return _rounded(checks.confidence_by_check(_rows(spark, sf_dir), 0.5))


_NAMES = ["engine_left", "engine_right", "plane_front_left_wheel_link"]


@query(_CHECKS + "select unique_scene, " + ", ".join(f"max(conf) filter (kp_name = '{n}') as conf_{n}" for n in _NAMES) + ", cast(count(*) as integer) as num_conf, 1 as has_conf from cf group by 1", *_ON)
def confidence_wide(spark, sf_dir):
    return checks.confidence_wide(_confidences(spark, sf_dir), _NAMES)


@query(_CHECKS + "select kp_name, count(*) as n, round(avg(conf), 6) as mean, round(min(conf), 6) as min, round(max(conf), 6) as max from cf group by 1", *_ON)
def confidence_stats(spark, sf_dir):
    return _rounded(checks.confidence_stats(checks.confidence_long(checks.confidence_wide(_confidences(spark, sf_dir), _NAMES))))
