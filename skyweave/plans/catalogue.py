"""Queries on derived relations, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyweave.functions import boxes2d, labels, names, pixels
from skyweave.operators import reports, scenes, splits
from skyweave.sources.relations import relation, with_relations

WIDTH, HEIGHT = 64, 16
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str = "", *reads: str):
    """Registers a query under its function's name, with the SQL over the relations it reads."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = with_relations(sql.strip(), *reads) if reads else sql.strip()
        return f

    return register


def _r6(*columns: str) -> list:
    return [F.round(c, 6).alias(c) for c in columns]


_BEST = "best as (select * from (select *, row_number() over (partition by unique_scene, cls order by conf desc, det_idx) as rn from detections) q where rn = 1)"


@query(f"with {_BEST} select unique_scene, cls, det_source, det_idx, conf, cast(round_even(x1, 0) as integer) as x1, cast(round_even(y1, 0) as integer) as y1, cast(round_even(x2, 0) as integer) as x2, cast(round_even(y2, 0) as integer) as y2 from best", "detections")
def best_per_class(spark, sf_dir):
    return reports.best_per_class(relation(spark, sf_dir, "detections"))


_COVERAGE = f"""with {_BEST},
box as (select unique_scene, greatest(least(cast(round_even(x1, 0) as integer), 63), 0) as x1, greatest(least(cast(round_even(y1, 0) as integer), 15), 0) as y1,
  greatest(least(cast(round_even(x2, 0) as integer), 63), 0) as x2, greatest(least(cast(round_even(y2, 0) as integer), 15), 0) as y2 from best where cls = 0),
good as (select * from box where x2 > x1 and y2 > y1),
counts as (select p.unique_scene, count(*) as total, count(*) filter (col_idx between x1 and x2 and row_idx between y1 and y2) as inside
  from px p left join good g on p.unique_scene = g.unique_scene where is_aircraft group by 1),
joined as (select m.unique_scene, x1, y1, x2, y2, coalesce(total, 0) as total, coalesce(inside, 0) as inside,
  case when coalesce(total, 0) > 0 then inside / total else 0.0 end as recall
  from scene_meta m left join good g on m.unique_scene = g.unique_scene left join counts c on m.unique_scene = c.unique_scene),
judged as (select *, case when x1 is null then 'no_detection' when total = 0 then 'no_aircraft_px' when recall >= 0.995 then 'ok' else 'partial' end as reason from joined)
"""


@query(_COVERAGE + "select unique_scene, case when reason = 'ok' then 'PASS' else 'FAIL' end as status, reason, total as px_total, inside as px_inside, round(recall, 6) as recall, cast(coalesce((x2 - x1 + 1) * (y2 - y1 + 1), 0) as bigint) as area_px from judged", "px", "scene_meta", "detections")
def bbox_coverage(spark, sf_dir):
    best = reports.best_per_class(relation(spark, sf_dir, "detections").where("cls = 0"))
    box = boxes2d.clip_xyxy(*map(F.col, ("x1", "y1", "x2", "y2")), F.lit(WIDTH), F.lit(HEIGHT))
    boxes = best.select("unique_scene", box.alias("b")).where("b is not null").select("unique_scene", "b.*")
    return reports.bbox_coverage(relation(spark, sf_dir, "px"), boxes, relation(spark, sf_dir, "scene_meta"))


@query(_COVERAGE + "select case when reason = 'ok' then 'PASS' else 'FAIL' end as status, reason, count(*) as n from judged group by 1, 2", "px", "scene_meta", "detections")
def coverage_summary(spark, sf_dir):
    return reports.coverage_summary(bbox_coverage(spark, sf_dir))


@query("select unique_scene, min(col_idx) as x1, min(row_idx) as y1, max(col_idx) as x2, max(row_idx) as y2, count(*) as n_px from px where is_aircraft group by 1", "px")
def mask_bbox(spark, sf_dir):
    return scenes.mask_bbox(relation(spark, sf_dir, "px"))


_GAP = """with occupied as (select unique_scene, col_idx from px where is_aircraft group by 1, 2),
gaps as (select unique_scene, (col_idx + 1) % 64 as s, coalesce(lead(col_idx) over w, min(col_idx) over (partition by unique_scene) + 64) - col_idx - 1 as n from occupied window w as (partition by unique_scene order by col_idx)),
best as (select unique_scene, s as gap_start, n as gap_len from (select *, row_number() over (partition by unique_scene order by n desc, s) as rn from gaps where n > 0) q where rn = 1),
seams as (select unique_scene, cast(gap_start as integer) as gap_start, cast(gap_len as integer) as gap_len, cast((gap_start + gap_len // 2) % 64 as integer) as seam from best),
found as (select a.unique_scene, gap_start, gap_len, seam, cast(coalesce((64 - seam) % 64, 0) as integer) as roll from (select distinct unique_scene from px) a left join seams b on a.unique_scene = b.unique_scene)
"""


@query(_GAP + "select * from found", "px")
def largest_empty_gap(spark, sf_dir):
    return scenes.largest_empty_gap(relation(spark, sf_dir, "px"), WIDTH)


_WRAP = _GAP.rstrip() + """,
both_ways as (select p.unique_scene, min(roll) as roll, min(col_idx) as a, max(col_idx) as b, min((col_idx + roll) % 64) as c, max((col_idx + roll) % 64) as d, min(row_idx) as y1, max(row_idx) as y2
  from px p join found f on p.unique_scene = f.unique_scene where is_aircraft group by 1),
wrapped as (select unique_scene, case when d - c < b - a then c else a end as x1, y1, case when d - c < b - a then d else b end as x2, y2, case when d - c < b - a then roll else 0 end as roll from both_ways)
"""


@query(_WRAP + "select * from wrapped", "px")
def wrap_aware_bbox(spark, sf_dir):
    return scenes.wrap_aware_bbox(relation(spark, sf_dir, "px"), WIDTH)


@query(_WRAP + "select * from wrapped where (x2 - x1 + 1) / 64.0 <= 0.6", "px")
def width_gate(spark, sf_dir):
    return scenes.width_gate(wrap_aware_bbox(spark, sf_dir), WIDTH)


@query("select unique_scene, row_idx, round(median(atan2(z, sqrt(x * x + y * y))), 6) as elevation from px group by 1, 2", "px")
def row_calibration(spark, sf_dir):
    return scenes.row_calibration(relation(spark, sf_dir, "px")).select("unique_scene", "row_idx", *_r6("elevation"))


@query("select unique_scene, col_idx, round(atan2(avg(sin(atan2(y, x))), avg(cos(atan2(y, x)))), 6) as azimuth from px group by 1, 2", "px")
def col_calibration(spark, sf_dir):
    return scenes.col_calibration(relation(spark, sf_dir, "px")).select("unique_scene", "col_idx", *_r6("azimuth"))


@query("""with s as (select unique_scene, avg(intensity / 65535) as m, stddev_pop(intensity / 65535) as d from px group by 1)
select p.unique_scene, row_idx, col_idx, round(v / (1 + v), 6) as gray from (select q.unique_scene, row_idx, col_idx, greatest(coalesce((intensity / 65535 - (m - 2 * d)) / nullif((m + 2 * d) - (m - 2 * d), 0), 0), 0) as v from px q join s on q.unique_scene = s.unique_scene) p""", "px")
def tone_map(spark, sf_dir):
    return scenes.tone_map(relation(spark, sf_dir, "px"), "intensity").select("unique_scene", "row_idx", "col_idx", *_r6("gray"))


@query("""with s as (select unique_scene, quantile_cont(range_m, 0.01) as a, quantile_cont(range_m, 0.99) as b from px group by 1)
select q.unique_scene, row_idx, col_idx, round(least(greatest(case when b > a then (range_m - a) / (b - a) else range_m end, 0.0), 1.0), 6) as gray from px q join s on q.unique_scene = s.unique_scene""", "px")
def percentile_norm(spark, sf_dir):
    return scenes.percentile_norm(relation(spark, sf_dir, "px"), "range_m").select("unique_scene", "row_idx", "col_idx", *_r6("gray"))


@query("select unique_scene, cast(floor(x / 4.0) as bigint) as vx, cast(floor(y / 4.0) as bigint) as vy, cast(floor(z / 4.0) as bigint) as vz, arg_min(x, row_idx * 64 + col_idx) as x, arg_min(y, row_idx * 64 + col_idx) as y, arg_min(z, row_idx * 64 + col_idx) as z from px group by 1, 2, 3, 4", "px")
def voxel_first(spark, sf_dir):
    return scenes.voxel_first(relation(spark, sf_dir, "px"), 4.0, ["row_idx", "col_idx"])


@query("select unique_scene, bag_stem, row_idx, col_idx, x, y, z, range_m, intensity, reflectivity, is_ground, is_aircraft from (select *, row_number() over (partition by unique_scene order by md5(concat('1234|', unique_scene, '|', row_idx, '|', col_idx)), row_idx, col_idx) as rn from px) q where rn <= 50", "px")
def subsample(spark, sf_dir):
    return scenes.subsample(relation(spark, sf_dir, "px"), 50, ["row_idx", "col_idx"])


@query("select unique_scene, count(*) as n_points, min(x) as min_x, max(x) as max_x, min(y) as min_y, max(y) as max_y, min(z) as min_z, max(z) as max_z, round(avg(x), 6) as mean_x, round(avg(y), 6) as mean_y, round(avg(z), 6) as mean_z from px group by 1", "px")
def cloud_summary(spark, sf_dir):
    found = scenes.cloud_summary(relation(spark, sf_dir, "px"))
    return found.select("unique_scene", "n_points", *(f"{n}_{c}" for c in "xyz" for n in ("min", "max")), *_r6("mean_x", "mean_y", "mean_z"))


@query("""select m.unique_scene, c.name as box_name, count(*) as n from px p join scene_meta m on p.unique_scene = m.unique_scene join crop_boxes c on c.profile = m.profile
where abs(p.x - c.x) <= c.sx / 2 + 1e-6 and abs(p.y - c.y) <= c.sy / 2 + 1e-6 and abs(p.z - c.z) <= c.sz / 2 + 1e-6 group by 1, 2""", "px", "scene_meta", "crop_boxes")
def points_in_boxes(spark, sf_dir):
    boxes = relation(spark, sf_dir, "scene_meta").select("unique_scene", "profile").join(relation(spark, sf_dir, "crop_boxes").withColumnRenamed("name", "box_name"), "profile")
    return scenes.points_in_boxes(relation(spark, sf_dir, "px"), boxes).groupBy("unique_scene", "box_name").agg(F.count("*").alias("n"))


_STATS = ", ".join(f"round({e}, 9) as {n}" for n, e in (("mean", "avg(e)"), ("median", "median(e)"), ("p90", "quantile_cont(e, 0.9)"), ("p95", "quantile_cont(e, 0.95)"), ("min", "min(e)"), ("max", "max(e)"), ("std", "stddev_pop(e)")))


@query(f"with ok as (select kp_name, unique_scene, error_l2_m as e from kp_error where status = 'ok') select 'keypoint' as kind, kp_name as name, count(*) as n, {_STATS} from ok group by 2 union all select 'scene', unique_scene, count(*), {_STATS} from ok group by 2", "kp_error")
def error_summary(spark, sf_dir):
    return reports.error_summary(relation(spark, sf_dir, "kp_error"))


@query("select 'status' as kind, status as name, count(*) as n from kp_error group by 2 union all select 'gt_source', case when trim(gt_source) = '' then 'unknown' else gt_source end, count(*) from kp_error group by 2", "kp_error")
def status_counts(spark, sf_dir):
    return reports.status_counts(relation(spark, sf_dir, "kp_error"))


@query("""with ok as (select error_l2_m as e, min(error_l2_m) over () as a, max(error_l2_m) over () as b from kp_error where status = 'ok')
select cast(least(floor(coalesce((e - a) / nullif(b - a, 0), 0.0) * 40), 39) as integer) as bin, count(*) as n from ok group by 1""", "kp_error")
def error_histogram(spark, sf_dir):
    return reports.error_histogram(relation(spark, sf_dir, "kp_error"))


@query("select row_id, unique_scene, kp_name, error_l2_m from kp_error where status = 'ok' order by error_l2_m desc, row_id limit 20", "kp_error")
def top_errors(spark, sf_dir):
    return reports.top_errors(relation(spark, sf_dir, "kp_error"), 20)


@query("select distinct unique_scene from kp_error where status <> 'ok'", "kp_error")
def ever_failed(spark, sf_dir):
    return reports.ever_failed(relation(spark, sf_dir, "kp_error"))


@query("select bag_stem, count(distinct unique_scene) as n_scenes from scene_meta group by 1", "scene_meta")
def scenes_per_bag(spark, sf_dir):
    return reports.scenes_per_bag(relation(spark, sf_dir, "scene_meta"))


_BAGS = "bags as (select *, row_number() over (order by n_scenes desc, bag_stem) as rn from (select bag_stem, count(distinct unique_scene) as n_scenes from scene_meta group by 1) q)"
_FOLDS = f"""with recursive {_BAGS},
f as (select cast(0 as bigint) as rn, [cast(0 as bigint), 0, 0, 0, 0] as load, cast(null as varchar) as bag_stem, cast(0 as bigint) as n_scenes, cast(0 as bigint) as fold
  union all select b.rn, list_transform(range(1, 6), lambda i: load[i] + case when i = list_position(load, list_min(load)) then b.n_scenes else 0 end), b.bag_stem, b.n_scenes, list_position(load, list_min(load)) from f join bags b on b.rn = f.rn + 1)
"""


@query(_FOLDS + "select bag_stem, n_scenes, cast(fold - 1 as integer) as fold from f where rn > 0", "scene_meta")
def kfold(spark, sf_dir):
    return splits.kfold(scenes_per_bag(spark, sf_dir), 5)


@query(f"""with recursive {_BAGS}, total as (select cast(sum(n_scenes) as double) as t from bags),
f as (select cast(0 as bigint) as rn, [t * 0.7::double, t * 0.2::double, t * 0.1::double] as lack, cast(null as varchar) as bag_stem, cast(0 as bigint) as n_scenes, cast(0 as bigint) as i from total
  union all select b.rn, list_transform(range(1, 4), lambda i: lack[i] - case when i = list_position(lack, list_max(lack)) then b.n_scenes else 0 end), b.bag_stem, b.n_scenes, list_position(lack, list_max(lack)) from f join bags b on b.rn = f.rn + 1)
select bag_stem, n_scenes, ['train', 'val', 'test'][i] as split from f where rn > 0""", "scene_meta")
def balanced_split(spark, sf_dir):
    return splits.balanced_split(scenes_per_bag(spark, sf_dir))


@query(_FOLDS + "select cast(k as integer) as fold, case when fold - 1 = k then 'val' else 'train' end as role, unique_scene from f join scene_meta using (bag_stem) cross join range(5) r(k)", "scene_meta")
def fold_members(spark, sf_dir):
    return splits.fold_members(relation(spark, sf_dir, "scene_meta"), kfold(spark, sf_dir), 5)


_TOKENS = "t as (select unique_scene, line_no, split, string_split(text, ' ') as k from pose_label_lines), good as (select * from t where (len(k) - 5) % 3 = 0)"


@query("with t as (select unique_scene, line_no, string_split(text, ' ') as k from pose_label_lines) select unique_scene, line_no, case when (len(k) - 5) % 3 <> 0 then 'broken keypoint triplets' end as error, case when (len(k) - 5) % 3 = 0 then cast(k[2] as double) end as cx, case when (len(k) - 5) % 3 = 0 then cast((len(k) - 5) // 3 as bigint) end as n_kps, case when (len(k) - 5) % 3 = 0 then cast(k[6] as double) end as x0, case when (len(k) - 5) % 3 = 0 then cast(k[8] as integer) end as v0 from t", "pose_label_lines")
def parse_pose_line(spark, sf_dir):
    parsed = relation(spark, sf_dir, "pose_label_lines").withColumn("l", labels.parse_pose_line(F.col("text")))
    first = F.get(F.col("l.kps"), 0)
    return parsed.select("unique_scene", "line_no", "l.error", "l.cx", F.when(F.col("l.kps").isNotNull(), F.size("l.kps")).cast("bigint").alias("n_kps"), first["x"].alias("x0"), first["v"].alias("v0"))


@query(f"with {_TOKENS} select unique_scene, line_no, concat(k[1], ' ', k[2], '000 ', k[3], '000 ', k[4], '000 ', k[5], '000 ', case when k[8] = '0' then '0.000000 0.000000 0' else concat(k[6], '000 ', k[7], '000 1') end, ' ', k[9], '000 ', k[10], '000 1 ', case when k[14] = '0' then '0.000000 0.000000 0' else concat(k[12], '000 ', k[13], '000 1') end) as line from good", "pose_label_lines")
def format_pose_line(spark, sf_dir):
    parsed = relation(spark, sf_dir, "pose_label_lines").withColumn("l", labels.parse_pose_line(F.col("text")))
    return parsed.where("l.error is null").select("unique_scene", "line_no", labels.format_pose_line(F.col("l")).alias("line"))


def _augmented(spark, sf_dir, change, digits: int = 6) -> DataFrame:
    parsed = relation(spark, sf_dir, "pose_label_lines").withColumn("l", labels.parse_pose_line(F.col("text"))).where("l.error is null").withColumn("l", change(F.col("l")))
    first = F.get(F.col("l.kps"), 0)
    return parsed.select("unique_scene", "line_no", *(F.round(F.col(f"l.{c}"), digits).alias(c) for c in ("cx", "cy", "w", "h")), F.round(first["x"], digits).alias("x0"), F.round(first["y"], digits).alias("y0"), first["v"].alias("v0"))


_PARTS = f"with {_TOKENS}, n as (select unique_scene, line_no, cast(k[2] as double) as cx, cast(k[3] as double) as cy, cast(k[4] as double) as w, cast(k[5] as double) as h, cast(k[6] as double) as x, cast(k[7] as double) as y, cast(k[8] as integer) as v from good)"


@query(_PARTS + " select unique_scene, line_no, round((cx + 0.125) - floor(cx + 0.125), 6) as cx, round(cy, 6) as cy, round(w, 6) as w, round(h, 6) as h, round(case when v > 0 then (x + 0.125) - floor(x + 0.125) else x end, 6) as x0, round(y, 6) as y0, v as v0 from n", "pose_label_lines")
def augment_roll(spark, sf_dir):
    return _augmented(spark, sf_dir, lambda label: labels.augment_roll(label, 8, WIDTH))


@query(_PARTS + """, s as (select *, least(greatest((cx - w / 2 - 0.5) * 1.25 + 0.5, 0.0), 1.0) as a, least(greatest((cy - h / 2 - 0.5) * 1.25 + 0.5, 0.0), 1.0) as b, least(greatest((cx + w / 2 - 0.5) * 1.25 + 0.5, 0.0), 1.0) as c, least(greatest((cy + h / 2 - 0.5) * 1.25 + 0.5, 0.0), 1.0) as d, (x - 0.5) * 1.25 + 0.5 as sx, (y - 0.5) * 1.25 + 0.5 as sy from n),
g as (select *, v > 0 and sx between 0 and 1 and sy between 0 and 1 as stays from s)
select unique_scene, line_no, round((a + c) / 2, 9) as cx, round((b + d) / 2, 9) as cy, round(c - a, 9) as w, round(d - b, 9) as h, round(case when stays then sx else 0 end, 9) as x0, round(case when stays then sy else 0 end, 9) as y0, case when stays then 1 else 0 end as v0 from g""", "pose_label_lines")
def augment_scale(spark, sf_dir):
    return _augmented(spark, sf_dir, lambda label: labels.augment_scale(label, 1.25), digits=9)


@query(_PARTS + ", g as (select *, v > 0 and y - 0.125 between 0 and 1 as stays from n) select unique_scene, line_no, round(cx, 6) as cx, round(least(greatest(cy - 0.125, 0.0), 1.0), 6) as cy, round(w, 6) as w, round(h, 6) as h, round(case when stays then x else 0 end, 6) as x0, round(case when stays then y - 0.125 else 0 end, 6) as y0, case when stays then v else 0 end as v0 from g", "pose_label_lines")
def augment_vshift(spark, sf_dir):
    return _augmented(spark, sf_dir, lambda label: labels.augment_vshift(label, -2, HEIGHT))


@query(_PARTS + ", g as (select *, greatest(cx - w / 2, 0.0) as a, greatest(cy - h / 2, 0.0) as b, least(cx + w / 2, 1.0) as c, least(cy + h / 2, 1.0) as d from n) select unique_scene, line_no, round((a + c) / 2, 6) as cx, round((b + d) / 2, 6) as cy, round(c - a, 6) as w, round(d - b, 6) as h from g where c > a and d > b", "pose_label_lines")
def clip_box(spark, sf_dir):
    parsed = relation(spark, sf_dir, "pose_label_lines").withColumn("l", labels.parse_pose_line(F.col("text"))).where("l.error is null")
    box = boxes2d.clip_xywhn(*(F.col(f"l.{c}") for c in ("cx", "cy", "w", "h")))
    return parsed.select("unique_scene", "line_no", box.alias("b")).where("b is not null").select("unique_scene", "line_no", *(F.round(F.col(f"b.{c}"), 6).alias(c) for c in ("cx", "cy", "w", "h")))


@query("select unique_scene, det_source, det_idx, round((x1 + x2 + 1) / 2 / 64, 6) as cx, round((y1 + y2 + 1) / 2 / 16, 6) as cy, round((x2 - x1 + 1) / 64, 6) as w, round((y2 - y1 + 1) / 16, 6) as h, cast(round_even((x1 + x2) / 2, 0) as integer) as u, cast(round_even((y1 + y2) / 2, 0) as integer) as v from detections", "detections")
def xyxy_to_xywhn(spark, sf_dir):
    corners = list(map(F.col, ("x1", "y1", "x2", "y2")))
    shares = boxes2d.xyxy_to_xywhn(*corners, F.lit(WIDTH), F.lit(HEIGHT))
    u, v = boxes2d.center_px(*corners)
    return relation(spark, sf_dir, "detections").select("unique_scene", "det_source", "det_idx", *(F.round(s, 6).alias(n) for s, n in zip(shares, ("cx", "cy", "w", "h"), strict=True)), u.alias("u"), v.alias("v"))


_SHARES = ", ".join(f"cast(k[{i}] as double) as {n}" for i, n in ((2, "cx"), (3, "cy"), (4, "w"), (5, "h")))
_ENDS = (("cx", "w", "-", 64), ("cy", "h", "-", 16), ("cx", "w", "+", 64), ("cy", "h", "+", 16))
_CORNERS = ", ".join(x for i, (c, s, o, n) in enumerate(_ENDS) for x in (f"round(({c} {o} {s} / 2) * {n}, 6) + 0.0 as f{i}", f"least(greatest(round_even(({c} {o} {s} / 2) * {n}, 0), 0), {n - 1}) + 0.0 as r{i}", f"cast(least(greatest({'floor' if o == '-' else 'ceil'}(({c} {o} {s} / 2) * {n}){'' if o == '-' else ' - 1'}, 0), {n - 1}) as bigint) as o{i}"))


@query(f"with {_TOKENS}, n as (select unique_scene, line_no, {_SHARES} from good) select unique_scene, line_no, {_CORNERS} from n", "pose_label_lines")
def xywhn_to_xyxy(spark, sf_dir):
    """The corners of each label's box by all three conventions."""
    parsed = relation(spark, sf_dir, "pose_label_lines").withColumn("l", labels.parse_pose_line(F.col("text"))).where("l.error is null")
    box = [F.col(f"l.{c}") for c in ("cx", "cy", "w", "h")]
    made = {m: boxes2d.xywhn_to_xyxy(*box, F.lit(WIDTH), F.lit(HEIGHT), m) for m in ("float", "round", "outer")}
    plain = {"float": lambda c: F.round(c, 6) + F.lit(0.0), "round": lambda c: c + F.lit(0.0), "outer": lambda c: c.cast("bigint")}
    return parsed.select("unique_scene", "line_no", *(plain[m](c).alias(f"{m[0]}{i}") for m in made for i, c in enumerate(made[m])))


@query(f"with {_TOKENS} select unique_scene, line_no, concat(k[1], ' ', k[6], '000 ', k[7], '000 ', k[9], '000 ', k[10], '000 ', k[12], '000 ', k[13], '000') as line from good", "pose_label_lines")
def format_seg_line(spark, sf_dir):
    """Polygon lines of the keypoints' places, read into pixels and written again."""
    k = F.split("text", " ")
    rows = relation(spark, sf_dir, "pose_label_lines").where((F.size(k) - 5) % 3 == 0)
    size = F.lit(WIDTH), F.lit(HEIGHT)
    seg = labels.parse_seg_line(F.concat_ws(" ", *(F.get(k, i) for i in (0, 5, 6, 8, 9, 11, 12))), *size)
    return rows.select("unique_scene", "line_no", seg.alias("seg")).select("unique_scene", "line_no", labels.format_seg_line(F.col("seg"), *size).alias("line"))


@query("select unique_scene, row_idx, col_idx, round(least(greatest(g + 0.35 * b * (1 - g), 0.0), 1.0), 6) as gray from (select *, least(greatest(intensity / 65535 * 1.35, 0.0), 1.0) as g, least(range_m / 50, 1.0) as b from px) q", "px")
def far_boost(spark, sf_dir):
    gray = pixels.far_boost(F.col("intensity") / 65535, F.least(F.col("range_m") / 50, F.lit(1.0)), 0.35, 1.35)
    return relation(spark, sf_dir, "px").select("unique_scene", "row_idx", "col_idx", F.round(gray, 6).alias("gray"))


@query("select unique_scene, profile from scene_meta where contains(lower(unique_scene), 'a380')", "scene_meta")
def stem_filter(spark, sf_dir):
    return relation(spark, sf_dir, "scene_meta").where(names.stem_filter(F.col("unique_scene"), " A380 ")).select("unique_scene", "profile")


_ODD = "concat(' A--', unique_scene, '+', upper(profile), ' ', scene_key, '!/x ')"


@query(f"""with s as (select unique_scene, {_ODD} as n from scene_meta), t as (select unique_scene, n, lower(trim(n)) as low, replace(replace(lower(trim(n)), '-', '_'), ' ', '_') as under from s)
select unique_scene, under as key, regexp_replace(under, '_+', '_', 'g') as collapse, regexp_replace(under, '[^a-z0-9_]', '', 'g') as strict, trim(regexp_replace(low, '[^a-z0-9+]+', '_', 'g'), '_') as slug, regexp_replace(trim(n), '[^A-Za-z0-9._-]+', '_', 'g') as file from t""", "scene_meta")
def normal_names(spark, sf_dir):
    named = relation(spark, sf_dir, "scene_meta").withColumn("n", F.expr(_ODD.replace("upper(profile), ' ', scene_key", "upper(profile), ' ', cast(scene_key as string)")))
    return named.select("unique_scene", *(names.norm_name(F.col("n"), m).alias(m) for m in ("key", "collapse", "strict", "slug", "file")))


@query("""select unique_scene, regexp_extract(unique_scene, '^(.*)__', 1) as bag, string_split(unique_scene, '__')[-1] as scene, case when starts_with(bag_stem, 'movement_') then string_split(substr(bag_stem, 10), '__')[1] else bag_stem end as token,
replace(replace(lower(trim(bag_stem)), '-', '_'), ' ', '_') as key from scene_meta""", "scene_meta")
def scene_names(spark, sf_dir):
    s = F.col("unique_scene")
    return relation(spark, sf_dir, "scene_meta").select(s, names.scene_bag(s).alias("bag"), names.scene_name(s).alias("scene"), names.aircraft_token(F.col("bag_stem")).alias("token"), names.norm_name(F.col("bag_stem")).alias("key"))


@query("select profile, name, case when name like '%engine%' then 1 when name like '%gear%' then 2 when name like '%rear_wing%' then 3 when name like '%wing%' then 4 else cast(0 as double) end as dz, case when name like '%engine%left%' or name like '%left%engine%' then 'engine_left' when name like '%engine%' and name like '%right%' then 'engine_right' when name like '%front%' or name like '%nose%' then 'front_landing_gear' end as box_key from crop_boxes", "crop_boxes")
def box_names(spark, sf_dir):
    n = F.col("name")
    return relation(spark, sf_dir, "crop_boxes").select("profile", n, names.box_z_offset(n, 1.0, 2.0, 3.0, 4.0).alias("dz"), names.target_box_key(n).alias("box_key"))


@query("select unique_scene, cls, det_idx, area from (select *, row_number() over (partition by unique_scene, cls order by area desc, det_idx) as rn from (select *, (x2 - x1) * (y2 - y1) as area from detections) a) q where rn = 1", "detections")
def largest_box(spark, sf_dir):
    return reports.largest_box(relation(spark, sf_dir, "detections"))


_CLASSES = {"aircraft": 0, "engine_left": 1, "engine_right": 2, "front": 3}
_WIDE = ", ".join(f"max(x1) filter (cls = {k}) as {n}_x1, max(y2) filter (cls = {k}) as {n}_y2, max(conf) filter (cls = {k}) as {n}_conf" for n, k in _CLASSES.items())


@query(_COVERAGE.split("box as (select unique_scene,")[0] + "box as (select unique_scene, cls, conf," + _COVERAGE.split("box as (select unique_scene,")[1].split("from best where")[0] + f"from best), good as (select * from box where x2 > x1 and y2 > y1), wide as (select unique_scene, {_WIDE} from good group by 1) select * from wide where aircraft_x1 is not null", "detections")
def scene_detections(spark, sf_dir):
    found = reports.scene_detections(reports.best_per_class(relation(spark, sf_dir, "detections")), WIDTH, HEIGHT, _CLASSES)
    return found.select("unique_scene", *(c for n in _CLASSES for c in (F.col(f"{n}_box.x1").alias(f"{n}_x1"), F.col(f"{n}_box.y2").alias(f"{n}_y2"), F.col(f"{n}_conf"))))


@query("select unique_scene, bag_stem from (select *, row_number() over (order by unique_scene) - 1 as rn from scene_meta) q where rn % 3 = 0", "scene_meta")
def every_nth(spark, sf_dir):
    return reports.every_nth(relation(spark, sf_dir, "scene_meta"), "unique_scene", "bag_stem", 3).select("unique_scene", "bag_stem")


@query("""with k as (select unique_scene, cast(round_even(x * 1000, 0) as bigint) as x, cast(round_even(y * 1000, 0) as bigint) as y, cast(round_even(z * 1000, 0) as bigint) as z, bool_or(is_aircraft) as a, bool_or(is_ground) as b from px where is_aircraft or is_ground group by 1, 2, 3, 4)
select unique_scene, count(*) filter (a) as n_left, count(*) filter (b) as n_right, count(*) filter (a and b) as n_both from k group by 1""", "px")
def overlap_count(spark, sf_dir):
    px = relation(spark, sf_dir, "px")
    return scenes.overlap_count(px.where("is_aircraft"), px.where("is_ground"))


@query("select unique_scene, row_idx, col_idx from px p where exists (select 1 from px s where s.is_aircraft and s.unique_scene = p.unique_scene and (p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y) + (p.z - s.z) * (p.z - s.z) <= 2.25)", "px")
def expand_radius(spark, sf_dir):
    px = relation(spark, sf_dir, "px")
    return scenes.expand_radius(px, px.where("is_aircraft"), 1.5).select("unique_scene", "row_idx", "col_idx")


@query("select unique_scene, row_idx, col_idx, case when is_ground and not is_aircraft then intensity * 0.25 else intensity end as intensity from px", "px")
def ground_attenuate(spark, sf_dir):
    return scenes.ground_attenuate(relation(spark, sf_dir, "px"), "intensity", 0.25).select("unique_scene", "row_idx", "col_idx", "intensity")


@query(f"with {_TOKENS} select unique_scene, line_no, cast(k[9] as double) as x0, cast(len(k) - 8 as bigint) // 3 as n_kps from good", "pose_label_lines")
def drop_keypoints(spark, sf_dir):
    parsed = relation(spark, sf_dir, "pose_label_lines").withColumn("l", labels.parse_pose_line(F.col("text"))).where("l.error is null")
    left = labels.drop_keypoints(F.col("l.kps"), [0])
    return parsed.select("unique_scene", "line_no", F.get(left, 0)["x"].alias("x0"), F.size(left).cast("bigint").alias("n_kps"))


@query(f"with {_TOKENS} select unique_scene, line_no, cast(k[12] as double) as x0, cast(0 as double) as x1, cast(k[6] as double) as x2, 0 as v1 from good", "pose_label_lines")
def remap_keypoints(spark, sf_dir):
    parsed = relation(spark, sf_dir, "pose_label_lines").withColumn("l", labels.parse_pose_line(F.col("text"))).where("l.error is null")
    kps = labels.remap_keypoints(F.col("l.kps"), ["front", "left", "right"], ["right", "tail", "front"])
    return parsed.select("unique_scene", "line_no", *(F.get(kps, i)["x"].alias(f"x{i}") for i in range(3)), F.get(kps, 1)["v"].alias("v1"))


@query(f"""with {_TOKENS}, v as (select unnest(range(-5, 7)) * 8 as roll) select unique_scene, line_no, concat(unique_scene, '_roll', case when roll < 0 then 'm' else '' end, cast(abs(roll) as varchar)) as stem,
round(cast(k[2] as double) + roll / 64 - floor(cast(k[2] as double) + roll / 64), 6) as cx from good, v where split = 'train' and roll <> 0""", "pose_label_lines")
def augment_fanout(spark, sf_dir):
    parsed = relation(spark, sf_dir, "pose_label_lines").where("split = 'train'").withColumn("l", labels.parse_pose_line(F.col("text"))).where("l.error is null")
    rolled = parsed.withColumn("roll", F.explode(F.array(*(F.lit(8 * i) for i in range(-5, 7) if i))))
    sign = F.when(F.col("roll") < 0, "m").otherwise("")
    return rolled.select("unique_scene", "line_no", F.concat("unique_scene", F.lit("_roll"), sign, F.abs("roll").cast("string")).alias("stem"), F.round(labels.augment_roll(F.col("l"), F.col("roll"), WIDTH)["cx"], 6).alias("cx"))
