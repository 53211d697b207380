"""Queries on turned boxes, front boxes and checks, rolls, truth points, label variants and markers, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.functions import labels
from skyweave.operators import checks, poses
from skyweave.plans.catalogue import _PARTS, _TOKENS, HEIGHT, WIDTH, query
from skyweave.plans.geometry import _CHECKS, _ROBUST, _rounded, _specs
from skyweave.sources.relations import relation

_POSES = "select unique_scene, profile, (scene_key % 4) * 0.5D as turn, cast(scene_key % 11 - 5 as double) as tx, cast(scene_key % 7 - 3 as double) as ty, cast(scene_key % 3 as double) as tz from scene_meta"


def _turned_boxes(spark, sf_dir) -> DataFrame:
    boxes = relation(spark, sf_dir, "crop_boxes").withColumn("rz", F.when(F.col("name").contains("wing"), 0.2).otherwise(0.0))
    placed = spark.sql(_POSES).withColumn("rotation", F.expr("array(cos(turn), -sin(turn), 0D, sin(turn), cos(turn), 0D, 0D, 0D, 1D)"))
    return poses.turn_boxes(placed, boxes, 1.2)


_TURNED = f"""with p as ({_POSES.replace('0.5D', 'cast(0.5 as double)')}), tb as (select unique_scene, name as box_key, x * cos(turn) - y * sin(turn) + tx as cx, x * sin(turn) + y * cos(turn) + ty as cy, z + tz as cz, greatest(0.25, sx * 0.5) * 1.2 as hx, greatest(0.25, sy * 0.5) * 1.2 as hy, greatest(0.25, sz * 0.5) * 1.2 as hz,
  cos(turn + case when name like '%wing%' then 0.2 else 0 end) as r0, sin(turn + case when name like '%wing%' then 0.2 else 0 end) as r3 from p join crop_boxes c on c.profile = p.profile)
"""


@query(_TURNED + "select unique_scene, box_key, round(cx, 6) + 0.0 as cx, round(cy, 6) + 0.0 as cy, round(cz, 6) + 0.0 as cz, round(hx, 6) as hx, round(hy, 6) as hy, round(hz, 6) as hz, round(r0, 6) + 0.0 as r0, round(r3, 6) + 0.0 as r3 from tb", "scene_meta", "crop_boxes")
def turn_boxes(spark, sf_dir):
    turned = _turned_boxes(spark, sf_dir)
    return _rounded(turned.withColumn("r0", F.get("rotation", 0)).withColumn("r3", F.get("rotation", 3)).drop("rotation"))


@query(_TURNED + "select unique_scene, box_key as kp_name, round(cx, 6) + 0.0 as x, round(cy, 6) + 0.0 as y, round(cz, 6) + 0.0 as z from tb where box_key in ('engine_left', 'engine_right')", "scene_meta", "crop_boxes")
def box_keypoints(spark, sf_dir):
    return _rounded(poses.box_keypoints(_turned_boxes(spark, sf_dir)))


@query("""with b as (select unique_scene, name, x, y, z from scene_meta m join crop_boxes c on c.profile = m.profile where c.name = 'front_landing_gear_left' and scene_key % 3 = 0),
n as (select unique_scene, x, y, z from kp3d where kp_name = 'center' and substr(unique_scene, length(unique_scene), 1) in ('1', '4', '7')),
w as (select unique_scene, avg(x) as x, avg(y) as y, avg(z) as z from kp3d where kp_name like 'plane_front%' group by 1)
select w.unique_scene, coalesce(b.x, n.x, w.x) as x, coalesce(b.y, n.y, w.y) as y, coalesce(b.z, n.z, w.z) as z, case when b.x is not null then 'box' when n.x is not null then 'nose' else 'wheels' end as source from w left join b on b.unique_scene = w.unique_scene left join n on n.unique_scene = w.unique_scene""", "scene_meta", "crop_boxes", "kp3d")
def front_midpoint(spark, sf_dir):
    kps = relation(spark, sf_dir, "kp3d")
    renamed = F.when((F.col("kp_name") == "center") & F.col("unique_scene").rlike("[147]$"), "nose_gear").otherwise(F.col("kp_name"))
    boxes = relation(spark, sf_dir, "scene_meta").where("scene_key % 3 = 0").join(relation(spark, sf_dir, "crop_boxes").where("name = 'front_landing_gear_left'"), "profile")
    front = boxes.select("unique_scene", *(F.col(a).alias(f"c{a}") for a in "xyz"))
    return poses.front_midpoint(kps.withColumn("kp_name", renamed), front, ("nose", "nose_gear"))


_NOSE = _CHECKS.rstrip() + """,
dv as (select unique_scene, avg(x) + 0.5 as cx, avg(y) as cy, avg(z) as cz from kp3d where kp_name like 'plane_front%' and substr(unique_scene, 10, 4) in ('a380', 'b787') group by 1),
kd as (select k.unique_scene, kp_name, abs(x - cx) as ax, abs(y - cy) as ay, abs(z - cz) as az, cast(1 as double) as hx, cast(1 as double) as hy, cast(1 as double) as hz from kp3d k join dv on dv.unique_scene = k.unique_scene),
od as (select *, ax <= hx + 1e-6 and ay <= hy + 1e-6 and az <= hz + 1e-6 as inside, sqrt(greatest(ax - 1, 0) * greatest(ax - 1, 0) + greatest(ay - 1, 0) * greatest(ay - 1, 0) + greatest(az - 1, 0) * greatest(az - 1, 0)) as outside from kd),
"""
_FIELDS = ("inside", "ax", "ay", "az", "hx", "hy", "hz")


def _noses(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    kps = relation(spark, sf_dir, "kp3d")
    derived = poses.derived_nose_specs(kps.where("substr(unique_scene, 10, 4) in ('a380', 'b787')")).withColumn("cx", F.col("cx") + 0.5)
    return kps, derived


@query(_NOSE + "mv as (select d.*, d.box_key = 'front_landing_gear' and coalesce(o.outside < d.outside, false) as mv, " + ", ".join(f"o.{c} as o_{c}" for c in _FIELDS) + " from di d left join od o on o.unique_scene = d.unique_scene and o.kp_name = d.kp_name) select unique_scene, kp_name, case when mv then 'derived_nose_gear' else box_key end as box_key, " + ", ".join(f"case when mv then o_{c} else {c} end as {c}" for c in _FIELDS) + " from mv", "scene_meta", "kp3d", "crop_boxes", "detections")
def derived_nose_remap(spark, sf_dir):
    kps, derived = _noses(spark, sf_dir)
    return poses.derived_nose_remap(checks.auto_swap_lr(kps, _specs(spark, sf_dir)), kps, derived)


@query(_NOSE + "base as (select * from di where not (box_key = 'front_landing_gear' and kp_name like '%left%')), ms_ as (select unique_scene, kp_name from kp3d where kp_name like '%front%' and kp_name not in (select kp_name from base where box_key = 'front_landing_gear')), fr as (select * from di where box_key = 'front_landing_gear' and substr(unique_scene, length(unique_scene), 1) < '6'), ad as (select m.unique_scene, m.kp_name, case when f.unique_scene is not null and (o.unique_scene is null or f.outside <= o.outside) then 'front_landing_gear' when o.unique_scene is not null then 'derived_nose_gear' end as box_key, " + ", ".join(f"f.{c} as f_{c}, o.{c} as o_{c}" for c in _FIELDS) + " from ms_ m left join fr f on f.unique_scene = m.unique_scene and f.kp_name = m.kp_name left join od o on o.unique_scene = m.unique_scene and o.kp_name = m.kp_name) select unique_scene, kp_name, box_key, " + ", ".join(_FIELDS) + " from base union all select unique_scene, kp_name, box_key, " + ", ".join(f"case when box_key = 'front_landing_gear' then f_{c} else o_{c} end" for c in _FIELDS) + " from ad where box_key is not null", "scene_meta", "kp3d", "crop_boxes", "detections")
def ensure_front_check(spark, sf_dir):
    kps, derived = _noses(spark, sf_dir)
    specs = _specs(spark, sf_dir)
    made = checks.auto_swap_lr(kps, specs).where("not (box_key = 'front_landing_gear' and kp_name like '%left%')")
    front = specs.where("box_key = 'front_landing_gear' and substr(unique_scene, length(unique_scene), 1) < '6'").drop("box_key")
    return poses.ensure_front_check(made, kps, front, derived)


_FRONTS = "select profile, name, warning_level, x, y, z, sx, sy, sz from crop_boxes where profile <> 'a320' union all select profile, 'Nose_Gear', 3, x + 1, y, z, sx, sy, sz from crop_boxes where name = 'front_landing_gear_left' and profile in ('a320', '737_max8') union all select 'b787_9', 'front_gear_left', 4, 9, 5, 0, 1, 1, 1 union all select 'b787_9', 'front_gear_right', 4, 9, -3, 0, 1, 1, 1"


@query(f"""with f as (select profile, lower(name) as name, warning_level, x, y, z, sx, sy, sz from ({_FRONTS}) q where regexp_matches(lower(name), 'front_landing_gear|landing_gear_front|nose_gear|front_gear') and warning_level <= 4),
s as (select *, regexp_replace(name, '_(left|right)$', '') as base from f where regexp_matches(name, 'left|right')),
p as (select a.profile, concat(a.base, '_center') as name, a.warning_level, 0.5 * (a.x + b.x) as x, 0.5 * (a.y + b.y) as y, 0.5 * (a.z + b.z) as z, 0.5 * (a.sx + b.sx) as sx, 0.5 * (a.sy + b.sy) as sy, 0.5 * (a.sz + b.sz) as sz, 1 as tier from s a join s b on b.profile = a.profile and b.warning_level = a.warning_level and b.base = a.base and contains(a.name, 'left') and contains(b.name, 'right')),
u as (select *, case when regexp_matches(name, 'left|right') then 2 else 0 end as tier from f union all select * from p)
select profile, name, warning_level, x, y, z, sx, sy, sz from (select *, row_number() over (partition by profile order by warning_level desc, tier, case when tier = 1 then abs(y) else 0 end, name) as rn from u) q where rn = 1""", "crop_boxes")
def pick_front_box(spark, sf_dir):
    relation(spark, sf_dir, "crop_boxes").createOrReplaceTempView("crop_boxes")
    return poses.pick_front_box(spark.sql(_FRONTS).withColumns({c: F.col(c).cast("double") for c in ("x", "y", "z", "sx", "sy", "sz")}), 4)


def _gaps(source: str, n: str) -> str:
    """Tables o, g and f with that number: occupied columns of `source`, gaps between them, and each scene's roll."""
    return f"""o{n} as (select distinct unique_scene, col_idx from {source}),
g{n} as (select unique_scene, (col_idx + 1) % 64 as s, coalesce(lead(col_idx) over (partition by unique_scene order by col_idx), min(col_idx) over (partition by unique_scene) + 64) - col_idx - 1 as n from o{n}),
f{n} as (select unique_scene, (64 - (s + n // 2) % 64) % 64 as roll from (select *, row_number() over (partition by unique_scene order by n desc, s) as rn from g{n} where n > 0) q where rn = 1)"""


@query(f"""with m as (select unique_scene, col_idx, row_idx from px where is_aircraft), {_gaps('m', '1')},
r as (select m.unique_scene, m.col_idx, coalesce(roll, 0) as roll, (m.col_idx + coalesce(roll, 0)) % 64 as c2 from m left join f1 on f1.unique_scene = m.unique_scene),
b as (select unique_scene, case when max(c2) - min(c2) < max(col_idx) - min(col_idx) then any_value(roll) else 0 end as r1, (least(max(c2) - min(c2), max(col_idx) - min(col_idx)) + 1) / 64 as share from r group by 1),
w as (select m.unique_scene, (m.col_idx + r1) % 64 as col_idx from m join b on b.unique_scene = m.unique_scene where share > 0.75), {_gaps('w', '2')},
t as (select b.unique_scene, cast((r1 + case when share > 0.75 then case when coalesce(f2.roll, 0) = 0 then 20 else f2.roll end else 0 end) % 64 as integer) as roll from b left join f2 on f2.unique_scene = b.unique_scene)
select unique_scene, roll, case when roll > 32 then roll - 64 else roll end as signed from t""", "px")
def export_roll(spark, sf_dir):
    return poses.export_roll(relation(spark, sf_dir, "px"), WIDTH, 0.75, 20)


@query(f"""with {_TOKENS}, lb as (select unique_scene, k from (select unique_scene, k, row_number() over (partition by unique_scene order by line_no) as rn from good) q where rn = 1),
wn as (select s.unique_scene, s.scene_key, v.i, v.kp_name, lb.k from scene_meta s cross join (values (0, 'nose'), (1, 'left'), (2, 'right'), (3, 'tail')) v(i, kp_name) left join lb on lb.unique_scene = s.unique_scene and s.scene_key % 5 <> 0),
aw as (select *, cast(k[6 + 3 * i] as double) as kx, cast(k[7 + 3 * i] as double) as ky, cast(k[8 + 3 * i] as integer) as kv from wn),
al as (select *, cast(round_even(kx * 63, 0) as integer) as c, cast(round_even(ky * 15, 0) as integer) as r from aw), pxs as (select * from px where unique_scene in (select unique_scene from scene_meta where scene_key % 7 <> 0)),
pk as (select unique_scene, kp_name, r, c from al where kv > 0 and scene_key % 7 <> 0){_ROBUST}
select al.unique_scene, al.kp_name, al.i as kp_idx, al.r, al.c, round(s.x, 6) + 0.0 as x, round(s.y, 6) + 0.0 as y, round(s.z, 6) + 0.0 as z,
case when ps.unique_scene is null then 'scene_xyz_unavailable' when k is null then 'label_not_found' when kv is null then 'kp_missing_in_label' when kv <= 0 then 'kp_not_visible' when s.x is null then 'xyz_not_found' else 'ok' end as status
from al left join s on s.unique_scene = al.unique_scene and s.kp_name = al.kp_name left join (select distinct unique_scene from pxs) ps on ps.unique_scene = al.unique_scene""", "pose_label_lines", "px", "scene_meta")
def gt_3d_from_2d(spark, sf_dir):
    scenes = relation(spark, sf_dir, "scene_meta")
    parsed = relation(spark, sf_dir, "pose_label_lines").withColumn("l", labels.parse_pose_line(F.col("text"))).where("l.error is null")
    first = parsed.groupBy("unique_scene").agg(F.min_by("l", "line_no").alias("l")).join(scenes.where("scene_key % 5 <> 0"), "unique_scene", "left_semi")
    px = relation(spark, sf_dir, "px").join(scenes.where("scene_key % 7 <> 0"), "unique_scene", "left_semi")
    return _rounded(poses.gt_3d_from_2d(scenes, first, px, ["nose", "left", "right", "tail"], WIDTH, HEIGHT))


_ROLLS, _SCALES, _SHIFTS = (2, 4, 8, 16, 32, 64, 128, 256, 384, 512, 640, 768), (0.9, 1.1), (2, -2)
_WIDE = 1024
_ROLLED = " union all ".join(f"select unique_scene, line_no, concat(unique_scene, '_roll{r}') as stem, round((cx + {r / _WIDE}) - floor(cx + {r / _WIDE}), 9) as cx, round(cy, 9) as cy from n" for r in _ROLLS)
_SCALED = " union all ".join(f"select unique_scene, line_no, concat(unique_scene, '_scale{s:.2f}'), ".replace(".", "p") + ", ".join(f"round((least(greatest(({c} - {d} / 2 - 0.5) * {s} + 0.5, 0.0), 1.0) + least(greatest(({c} + {d} / 2 - 0.5) * {s} + 0.5, 0.0), 1.0)) / 2, 9)" for c, d in (("cx", "w"), ("cy", "h"))) + " from n" for s in _SCALES)
_SHIFTED = " union all ".join(f"select unique_scene, line_no, concat(unique_scene, '_vshift{'p' if d > 0 else 'm'}{abs(d)}'), round(cx, 9), round(least(greatest(cy + {d / HEIGHT}, 0.0), 1.0), 9) from n" for d in _SHIFTS)


@query(f"{_PARTS} {_ROLLED} union all {_SCALED} union all {_SHIFTED}", "pose_label_lines")
def label_variants(spark, sf_dir):
    parsed = relation(spark, sf_dir, "pose_label_lines").withColumn("l", labels.parse_pose_line(F.col("text"))).where("l.error is null")
    rows = parsed.select("unique_scene", "line_no", F.col("unique_scene").alias("stem"), "l")
    made = poses.label_variants(rows, [0, *_ROLLS], [1.0, *_SCALES], [0, *_SHIFTS], _WIDE, HEIGHT)
    return made.select("unique_scene", "line_no", "stem", F.round("l.cx", 9).alias("cx"), F.round("l.cy", 9).alias("cy"))


@query("with d as (select * from (values (-1), (0), (1)) t(d)) select unique_scene, kp_name, round(x + 0.22 * a.d, 6) + 0.0 as x, round(y + 0.22 * b.d, 6) + 0.0 as y, round(z + 0.22 * c.d, 6) + 0.0 as z from kp3d, d a, d b, d c where abs(a.d) + abs(b.d) + abs(c.d) <= 2", "kp3d")
def marker_points(spark, sf_dir):
    return _rounded(poses.marker_points(relation(spark, sf_dir, "kp3d").select("unique_scene", "kp_name", "x", "y", "z")))


@query("select unique_scene, kp_idx, case when kp_idx % 4 = 1 then concat('k', kp_idx) else kp_name end as kp_name, x, y, z from kp3d where not (kp_idx = 3 and z = 0) and not (kp_idx = 5 and z = 0)", "kp3d")
def valid_keypoints(spark, sf_dir):
    """Of keypoints some of which have no name, or a coordinate that is missing or no number."""
    broken = F.when((F.col("kp_idx") == 3) & (F.col("z") == 0), F.lit(float("nan"))).when((F.col("kp_idx") == 5) & (F.col("z") == 0), None).otherwise(F.col("z"))
    name = F.when(F.col("kp_idx") % 4 == 1, " ").otherwise(F.col("kp_name"))
    return poses.valid_keypoints(relation(spark, sf_dir, "kp3d").withColumn("z", broken).withColumn("kp_name", name))
