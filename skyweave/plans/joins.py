"""Queries on joins by name, picks, masks and label lines, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyweave.functions import labels, names
from skyweave.operators import matching
from skyweave.plans.catalogue import _TOKENS, HEIGHT, WIDTH, query
from skyweave.plans.geometry import _rounded
from skyweave.sources.relations import relation


@query("select case when a.s is null then 'label_only' when b.s is null then 'image_only' else 'pair' end as kind, count(*) as n from (select distinct unique_scene as s from detections where conf >= 0.3) a full join (select distinct unique_scene as s from pose_label_lines) b on a.s = b.s group by 1", "detections", "pose_label_lines")
def pair_images_labels(spark, sf_dir):
    return matching.pair_counts(relation(spark, sf_dir, "detections").where("conf >= 0.3"), relation(spark, sf_dir, "pose_label_lines"), ["unique_scene"])


@query("with k as (select unique_scene, bag_stem, string_split(substr(bag_stem, 10), '__')[1] as token from scene_meta), c as (select distinct profile from crop_boxes union select 'movement_a320__run004') select unique_scene, coalesce(a.profile, b.profile) as entry, case when a.profile is not null then 'first' when b.profile is not null then 'second' end as found_by from k left join c a on a.profile = bag_stem left join c b on b.profile = token", "scene_meta", "crop_boxes")
def profile_lookup(spark, sf_dir):
    profiles = relation(spark, sf_dir, "crop_boxes").select("profile").union(spark.sql("select 'movement_a320__run004'")).distinct()
    rows = relation(spark, sf_dir, "scene_meta").select("unique_scene", "bag_stem")
    found = matching.profile_lookup(rows, profiles.select(F.col("profile").alias("key"), F.col("profile").alias("entry")), F.col("bag_stem"), names.aircraft_token(F.col("bag_stem")))
    return found.drop("bag_stem")


@query("select unique_scene, det_idx, cls from (select *, row_number() over (partition by unique_scene order by case when cls = 3 then 0 else 1 end, det_idx) as rn from detections where conf >= 0.2) q where rn = 1", "detections")
def pick_label_row(spark, sf_dir):
    rows = relation(spark, sf_dir, "detections").where("conf >= 0.2")
    return matching.pick_row(rows, ["unique_scene"], F.col("cls") == 3, "det_idx").select("unique_scene", "det_idx", "cls")


@query("with a as (select * from (values ('nose', 0), ('wing_tip', 1), ('engine_right', 2), ('center', 3)) t(alias, pos)), m as (select unique_scene, kp_name, kp_idx, pos, case when kp_name = alias then 0 else 1 end as tier from kp3d join a on contains(kp_name, alias)) select unique_scene, kp_name, cast(tier as integer) as tier from (select *, row_number() over (partition by unique_scene order by tier, pos, kp_idx) as rn from m) q where rn = 1", "kp3d")
def match_alias(spark, sf_dir):
    return matching.match_alias(relation(spark, sf_dir, "kp3d"), ["nose", "wing_tip", "engine_right", "center"], "kp_idx")


_GT = """with pr as (select row_id, unique_scene, case kp_name when 'click' then 'engine_left' when 'view' then 'left_tip' when 'purchase' then 'front_wheel' else kp_name end as kp_name, error_l2_m as x, cast(0 as double) as y, cast(row_id % 3 as double) as z from kp_error),
fm as (select unique_scene, avg(x) as x, avg(y) as y, avg(z) as z from kp3d where kp_name like 'plane_front%' group by 1),
re as (select pr.*, coalesce(e.x, a.x, case when pr.kp_name = 'front_wheel' then fm.x end) as gx, coalesce(e.y, a.y, case when pr.kp_name = 'front_wheel' then fm.y end) as gy, coalesce(e.z, a.z, case when pr.kp_name = 'front_wheel' then fm.z end) as gz, case when e.x is not null then 'exact' when a.x is not null then 'alias' when pr.kp_name = 'front_wheel' then 'midpoint' end as gt_source
from pr left join kp3d e on e.unique_scene = pr.unique_scene and e.kp_name = pr.kp_name left join kp3d a on a.unique_scene = pr.unique_scene and pr.kp_name = 'left_tip' and a.kp_name = 'left_wing_tip' left join fm on fm.unique_scene = pr.unique_scene)
"""


@query(_GT + "select row_id, kp_name, gt_source, case when gx is null then 'gt_match_not_found' else 'ok' end as status, round(sqrt((x - gx) * (x - gx) + (y - gy) * (y - gy) + (z - gz) * (z - gz)), 6) as error_l2_m from re", "kp_error", "kp3d")
def keypoint_error(spark, sf_dir):
    name = F.when(F.col("kp_name") == "click", "engine_left").when(F.col("kp_name") == "view", "left_tip").when(F.col("kp_name") == "purchase", "front_wheel").otherwise(F.col("kp_name"))
    predicted = relation(spark, sf_dir, "kp_error").select("row_id", "unique_scene", name.alias("kp_name"), F.col("error_l2_m").alias("x"), F.lit(0.0).alias("y"), (F.col("row_id") % 3).cast("double").alias("z"))
    front = ("plane_front_left_wheel_link", "plane_front_right_wheel_link")
    resolved = matching.resolve_gt_point(predicted, relation(spark, sf_dir, "kp3d"), {"left_tip": ["tip_l", "left_wing_tip"]}, {"front_wheel": front})
    return _rounded(matching.keypoint_error(resolved).select("row_id", "kp_name", "gt_source", "status", "error_l2_m"))


@query("with e as (select profile, name, x + 1 as x, cast(null as double) as sx from crop_boxes where name like 'engine%' union all select distinct profile, 'tail', cast(-9 as double), cast(2 as double) from crop_boxes) select coalesce(c.profile, e.profile) as profile, coalesce(c.name, e.name) as name, coalesce(e.x, c.x) as x, coalesce(e.sx, c.sx) as sx from crop_boxes c full join e on e.profile = c.profile and e.name = c.name", "crop_boxes")
def override_specs(spark, sf_dir):
    boxes = relation(spark, sf_dir, "crop_boxes").select("profile", "name", "x", "sx")
    moved = boxes.where("name like 'engine%'").select("profile", "name", (F.col("x") + 1).alias("x"), F.lit(None).cast("double").alias("sx"))
    tails = boxes.select("profile").distinct().select("profile", F.lit("tail").alias("name"), F.lit(-9.0).alias("x"), F.lit(2.0).alias("sx"))
    return matching.override_specs(boxes, moved.unionByName(tails), ["profile", "name"])


@query("select unique_scene, cls, n from (select unique_scene, cls, count(*) as n, row_number() over (partition by unique_scene order by count(*) desc, min(det_idx)) as rn from detections group by 1, 2) q where rn = 1", "detections")
def dominant_class(spark, sf_dir):
    return matching.dominant(relation(spark, sf_dir, "detections"), ["unique_scene"], "cls", "det_idx")


@query("with c as (select unique_scene, case when is_aircraft then 1 when is_ground then 2 else 0 end as cls from px) select unique_scene, cls, count(*) as n, count(*) >= 100 as enough from c group by 1, 2 union all select unique_scene, null, count(*), count(*) >= 100 from c group by 1", "px")
def seg_class_summary(spark, sf_dir):
    cls = F.when(F.col("is_aircraft"), 1).when(F.col("is_ground"), 2).otherwise(0)
    return matching.class_summary(relation(spark, sf_dir, "px").select("unique_scene", cls.alias("cls")), 100)


@query("select cast(row_number() over (order by part, a, b) - 1 as integer) as idx, kp_name from (select kp_name, 0 as part, min(unique_scene) as a, min(kp_idx) as b from kp3d where kp_name <> 'center' group by 1 union all select 'front_mid', 1, '', 0) q", "kp3d")
def keypoint_order(spark, sf_dir):
    return matching.keypoint_order(relation(spark, sf_dir, "kp3d"), ["unique_scene", "kp_idx"], ["center"], ["front_mid"])


_STEPS = "n as (select * from (values (0, 0), (0, 1), (0, -1), (1, 0), (-1, 0)) t(dr, dc))"
_DILATED = f"with m as (select unique_scene, row_idx, col_idx from px where is_aircraft), {_STEPS} select distinct unique_scene, row_idx + dr as row_idx, col_idx + dc as col_idx from m, n where row_idx + dr between 0 and 15 and col_idx + dc between 0 and 63"


@query(_DILATED, "px")
def morph_dilate(spark, sf_dir):
    return matching.dilate(relation(spark, sf_dir, "px").where("is_aircraft"), 3, HEIGHT, WIDTH)


@query(f"with m as (select unique_scene, row_idx, col_idx from px where range_m > 15), {_STEPS}, met as (select m.unique_scene, m.row_idx, m.col_idx, count(*) filter (m.row_idx + dr between 0 and 15 and m.col_idx + dc between 0 and 63) as want, count(o.row_idx) as have from m cross join n left join m o on o.unique_scene = m.unique_scene and o.row_idx = m.row_idx + dr and o.col_idx = m.col_idx + dc group by 1, 2, 3), er as (select * from met where want = have) select distinct unique_scene, row_idx + dr as row_idx, col_idx + dc as col_idx from er, n where row_idx + dr between 0 and 15 and col_idx + dc between 0 and 63", "px")
def morph_open(spark, sf_dir):
    eroded = matching.erode(relation(spark, sf_dir, "px").where("range_m > 15").select("unique_scene", "row_idx", "col_idx"), 3, HEIGHT, WIDTH)
    return matching.dilate(eroded, 3, HEIGHT, WIDTH)


@query("""with b as (select unique_scene, name as box_name, x as cx, y as cy, z as cz, sx / 2 as hx, sy / 2 as hy, sz / 2 as hz from scene_meta m join crop_boxes c on c.profile = m.profile),
j as (select b.*, p.x, p.y, p.z, abs(p.x - cx) <= hx + 1e-6 and abs(p.y - cy) <= hy + 1e-6 and abs(p.z - cz) <= hz + 1e-6 as ins from b join px p on p.unique_scene = b.unique_scene where abs(p.x - cx) <= hx * 1.2 + 1e-6 and abs(p.y - cy) <= hy * 1.2 + 1e-6 and abs(p.z - cz) <= hz * 1.2 + 1e-6),
g as (select unique_scene, box_name, case when count(*) filter (ins) >= 3 then median(x) filter (ins) else median(x) end as mx, case when count(*) filter (ins) >= 3 then median(y) filter (ins) else median(y) end as my, case when count(*) filter (ins) >= 3 then median(z) filter (ins) else median(z) end as mz from j group by 1, 2),
a as (select b.*, mx, my, mz, sqrt((mx - cx) * (mx - cx) + (my - cy) * (my - cy) + (mz - cz) * (mz - cz)) as away from b left join g using (unique_scene, box_name))
select unique_scene, box_name, round(case when away > 1.25 then cx else mx end, 6) + 0.0 as px, round(case when away > 1.25 then cy else my end, 6) + 0.0 as py, round(case when away > 1.25 then cz else mz end, 6) + 0.0 as pz from a""", "px", "scene_meta", "crop_boxes")
def snap_in_box(spark, sf_dir):
    scenes = relation(spark, sf_dir, "scene_meta").select("unique_scene", "profile").join(relation(spark, sf_dir, "crop_boxes"), "profile")
    boxes = scenes.select("unique_scene", F.col("name").alias("box_name"), *(F.col(k).alias(f"c{k}") for k in "xyz"), *((F.col(f"s{k}") / 2).alias(f"h{k}") for k in "xyz"))
    return _rounded(matching.snap_in_box(relation(spark, sf_dir, "px"), boxes, least=3).select("unique_scene", "box_name", "px", "py", "pz"))


@query(f"with {_TOKENS} select unique_scene, line_no, concat(k[1], ' ', k[2], '000 ', k[3], '000 ', k[4], '000 ', k[5], '000') as line, cast(k[6] as double) as x0, cast(3 as integer) as n_points from good", "pose_label_lines")
def det_and_seg_lines(spark, sf_dir):
    """Box lines and polygon lines made of each pose line's numbers."""
    k = F.split("text", " ")
    rows = relation(spark, sf_dir, "pose_label_lines").where((F.size(k) - 5) % 3 == 0)
    det = labels.parse_det_line(F.array_join(F.slice(k, 1, 5), " "))
    seg = labels.parse_seg_line(F.concat_ws(" ", F.get(k, 0), F.get(k, 5), F.get(k, 6), F.get(k, 8), F.get(k, 9), F.get(k, 11), F.get(k, 12)), F.lit(WIDTH), F.lit(HEIGHT))
    return rows.select("unique_scene", "line_no", labels.format_det_line(det).alias("line"), F.round(F.get(seg["points"], 0)["x"] / (WIDTH - 1), 6).alias("x0"), F.size(seg["points"]).alias("n_points"))
