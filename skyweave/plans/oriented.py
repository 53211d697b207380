"""Queries on boxes with a rotation about all axes, in scenes that are turned themselves, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.operators import boxes, checks, poses, scenes
from skyweave.plans.catalogue import query
from skyweave.plans.geometry import _CLS, _KEY, _KEYED, _rounded
from skyweave.sources.relations import relation

#: Each scene's pose, and the angles of the profile's boxes; the SQL runs in both engines.
_POSE = "select unique_scene, profile, (scene_key % 4) * cast(1.5 as double) as turn, cast(scene_key % 11 - 5 as double) as tx, cast(scene_key % 7 - 3 as double) as ty, cast(scene_key % 3 as double) as tz from scene_meta"
_ANGLES = ("case when name like 'engine%' then 0.3 else 0.1 end", "case when name like 'front%' then -0.4 else 0.2 end", "case when name like '%wing%' then 0.5 else -0.2 end")

_TURNED = f"""with ps as ({_POSE}), cb as (select *, cos(a) as ca, sin(a) as sa, cos(b) as cb, sin(b) as sb, cos(c) as cc, sin(c) as sc from (select *, {', '.join(f'cast({v} as double) as {n}' for n, v in zip('abc', _ANGLES, strict=True))} from crop_boxes) q),
ow as (select *, cc * cb as o00, cc * sb * sa - sc * ca as o01, cc * sb * ca + sc * sa as o02, sc * cb as o10, sc * sb * sa + cc * ca as o11, sc * sb * ca - cc * sa as o12, -sb as o20, cb * sa as o21, cb * ca as o22 from cb),
tb as (select unique_scene, name, x * cos(turn) - y * sin(turn) + tx as cx, x * sin(turn) + y * cos(turn) + ty as cy, z + tz as cz, greatest(0.25, sx / 2) as hx, greatest(0.25, sy / 2) as hy, greatest(0.25, sz / 2) as hz,
  {', '.join(f'cos(turn) * o0{j} - sin(turn) * o1{j} as r0{j}, sin(turn) * o0{j} + cos(turn) * o1{j} as r1{j}, o2{j} as r2{j}' for j in range(3))} from ps join ow on ow.profile = ps.profile),
"""
_AWAY = ", ".join(f"abs((p.x - cx) * r0{j} + (p.y - cy) * r1{j} + (p.z - cz) * r2{j}) as a{k}" for j, k in enumerate("xyz"))
_INSIDE = "ax <= hx + 1e-6 and ay <= hy + 1e-6 and az <= hz + 1e-6"


def _posed(spark, sf_dir) -> DataFrame:
    relation(spark, sf_dir, "scene_meta").createOrReplaceTempView("scene_meta")
    return spark.sql(_POSE).withColumn("rotation", F.expr("array(cos(turn), -sin(turn), 0D, sin(turn), cos(turn), 0D, 0D, 0D, 1D)"))


def _tilted(spark, sf_dir) -> DataFrame:
    return relation(spark, sf_dir, "crop_boxes").withColumns({n: F.expr(f"cast({v} as double)") for n, v in zip(("rx", "ry", "rz"), _ANGLES, strict=True)})


def _boxes(spark, sf_dir) -> DataFrame:
    return poses.turn_boxes(_posed(spark, sf_dir), _tilted(spark, sf_dir))


@query(_TURNED + f"mt as (select p.unique_scene, name, hx, hy, hz, {_AWAY} from px p join tb on tb.unique_scene = p.unique_scene) select unique_scene, name as box_name, count(*) as n from mt where {_INSIDE} group by 1, 2", "px", "scene_meta", "crop_boxes")
def points_in_turned_boxes(spark, sf_dir):
    turned = _boxes(spark, sf_dir)
    sized = turned.select("unique_scene", F.col("box_key").alias("box_name"), *(F.col(f"c{a}").alias(a) for a in "xyz"), *((2 * F.col(f"h{a}")).alias(f"s{a}") for a in "xyz"), "rotation")
    return scenes.points_in_boxes(relation(spark, sf_dir, "px"), sized).groupBy("unique_scene", "box_name").agg(F.count("*").alias("n"))


@query(_TURNED + f"""mt as (select p.unique_scene, row_idx, col_idx, {_CLS} as cls, hx, hy, hz, {_AWAY} from px p join tb on tb.unique_scene = p.unique_scene where {_CLS} is not null),
s as (select *, row_number() over (partition by unique_scene, row_idx, col_idx order by greatest(ax / hx, ay / hy, az / hz), cls) as rn from mt where {_INSIDE})
select p.unique_scene, p.row_idx, p.col_idx, case when is_aircraft and coalesce(cls, 0) = 0 then 4 else coalesce(cls, 0) end as cls from px p left join s on s.unique_scene = p.unique_scene and s.row_idx = p.row_idx and s.col_idx = p.col_idx and rn = 1""", "px", "scene_meta", "crop_boxes")
def assign_turned_box_class(spark, sf_dir):
    cls = F.when(F.col("box_key") == "engine_left", 1).when(F.col("box_key") == "engine_right", 2).when(F.col("box_key") == "left_wing", 3)
    return boxes.assign_box_class(relation(spark, sf_dir, "px"), _boxes(spark, sf_dir).withColumn("cls", cls).where("cls is not null"), aircraft=4).select(*_KEY, "cls")


_CHECKS = _TURNED + f"""sp as (select * from (select *, row_number() over (partition by unique_scene, box_key order by name) as rn from (select *, {_KEYED.format('name', 'engine_left', 'engine_right')} as box_key from tb) c where box_key is not null) d where rn = 1),
kb as (select *, false as swapped, {_KEYED.format('kp_name', 'engine_left', 'engine_right')} as box_key from kp3d union all select *, true, {_KEYED.format('kp_name', 'engine_right', 'engine_left')} from kp3d),
mt as (select p.unique_scene, kp_name, p.box_key, swapped, hx, hy, hz, {_AWAY} from kb p join sp on sp.unique_scene = p.unique_scene and sp.box_key = p.box_key),
ck as (select *, {_INSIDE} as inside from mt),
pr as (select unique_scene from sp where box_key in ('engine_left', 'engine_right') group by 1 having count(distinct box_key) = 2),
sw as (select c.unique_scene, count(*) filter (inside and swapped) > count(*) filter (inside and not swapped) and max(p.unique_scene) is not null as swap from ck c left join pr p on p.unique_scene = c.unique_scene group by 1),
di as (select c.*, sqrt(greatest(ax - hx, 0) * greatest(ax - hx, 0) + greatest(ay - hy, 0) * greatest(ay - hy, 0) + greatest(az - hz, 0) * greatest(az - hz, 0)) as outside, least(hx - ax, hy - ay, hz - az) as margin from ck c join sw on sw.unique_scene = c.unique_scene and sw.swap = c.swapped)
"""
_ON = ("scene_meta", "kp3d", "crop_boxes")


def _specs(spark, sf_dir) -> DataFrame:
    return checks.box_specs(_posed(spark, sf_dir), _tilted(spark, sf_dir))


def _chosen(spark, sf_dir) -> DataFrame:
    return checks.auto_swap_lr(relation(spark, sf_dir, "kp3d"), _specs(spark, sf_dir))


@query(_CHECKS + "select unique_scene, box_key, " + ", ".join(f"round({c}, 6) + 0.0 as {c}" for c in ("cx", "cy", "cz", "hx", "hy", "hz", *(f"r{i}{j}" for i in range(3) for j in range(3)))) + " from sp", *_ON)
def turned_box_specs(spark, sf_dir):
    entries = {f"r{i // 3}{i % 3}": F.get("rotation", i) for i in range(9)}
    return _rounded(_specs(spark, sf_dir).withColumns(entries).drop("rotation"))


@query(_CHECKS + "select unique_scene, kp_name, box_key, inside, round(ax, 6) as ax, round(ay, 6) as ay, round(az, 6) as az, hx, hy, hz from ck where not swapped", *_ON)
def turned_checks(spark, sf_dir):
    return _rounded(checks.build_checks(relation(spark, sf_dir, "kp3d"), _specs(spark, sf_dir)).drop("swapped"))


@query(_CHECKS + "select unique_scene, kp_name, box_key, inside, swapped, round(outside, 6) as outside_m, round(case when margin >= 0 then -margin else outside end, 6) + 0.0 as signed_m, round(margin, 6) + 0.0 as margin_m from di", *_ON)
def turned_box_distance(spark, sf_dir):
    made = _chosen(spark, sf_dir)
    away = checks.box_distance(made).select("unique_scene", "kp_name", "box_key", "outside_m", "signed_m", "margin_m")
    return _rounded(made.select("unique_scene", "kp_name", "box_key", "inside", "swapped").join(away, ["unique_scene", "kp_name", "box_key"]))


@query(_CHECKS + """select m.unique_scene, case when n > 0 and o = 0 then 'PASS' else 'FAIL' end as verdict, case when n is null then 'no warning-box checks produced' when o > 0 then concat(cast(o as varchar), ' outside warning box') else '' end as reason, coalesce(i, 0) as n_inside, coalesce(o, 0) as n_outside
from scene_meta m left join (select unique_scene, count(*) as n, count(*) filter (inside or outside <= 1) as i, count(*) filter (not (inside or outside <= 1)) as o from di group by 1) t on t.unique_scene = m.unique_scene""", *_ON)
def turned_verdicts(spark, sf_dir):
    return checks.scene_verdict(relation(spark, sf_dir, "scene_meta"), checks.near_margin_pass(_chosen(spark, sf_dir), 1.0))
