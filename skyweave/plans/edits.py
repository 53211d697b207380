"""Queries on edits of label files, seeded splits and folds, run manifests and label variants, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyweave.functions import boxes2d, labels
from skyweave.operators import edits, runs, splits
from skyweave.plans.catalogue import HEIGHT, WIDTH, query, scenes_per_bag
from skyweave.sources.relations import relation
from skyweave.sources.shared import new_folder

_NAMES = ["nose", "tail", "wing"]
_LINES = "l as (select unique_scene, line_no, text, string_split(text, ' ') as k from pose_label_lines), e as (select *, case when len(k) < 5 then 'too few fields' when (len(k) - 5) % 3 <> 0 then 'broken keypoint triplets' when len(k) <> 14 then concat('keypoints: ', (len(k) - 5) // 3) end as error from l), f as (select *, bool_or(error is not null) over (partition by unique_scene) as file_error from e)"


def _edited(spark, sf_dir):
    return edits.drop_from_files(relation(spark, sf_dir, "pose_label_lines").select("unique_scene", "line_no", "text"), _NAMES, ["tail"], "unique_scene")


@query(f"with {_LINES} select unique_scene, line_no, case when file_error then text else concat_ws(' ', array_to_string(k[1:8], ' '), array_to_string(k[12:14], ' ')) end as text, error, file_error, not file_error as changed from f", "pose_label_lines")
def drop_from_files(spark, sf_dir):
    """One broken line keeps its file unchanged."""
    return _edited(spark, sf_dir)


@query(f"with {_LINES} select count(distinct unique_scene) as n_files, count(distinct unique_scene) filter (not file_error) as files_changed, count(*) filter (not file_error) as lines_changed, count(distinct unique_scene) filter (file_error) as file_errors from f", "pose_label_lines")
def drop_preview(spark, sf_dir):
    return edits.edit_counts(_edited(spark, sf_dir), "unique_scene")


_SEEDED = "bags as (select *, row_number() over (order by n_scenes desc, md5(concat('7|', bag_stem)), bag_stem) as rn from (select bag_stem, count(distinct unique_scene) as n_scenes from scene_meta group by 1) q)"
_SEEDED_FOLDS = f"""with recursive {_SEEDED},
f as (select cast(0 as bigint) as rn, [cast(0 as bigint), 0, 0] as load, cast(null as varchar) as bag_stem, cast(0 as bigint) as n_scenes, cast(0 as bigint) as fold
  union all select b.rn, list_transform(range(1, 4), lambda i: load[i] + case when i = list_position(load, list_min(load)) then b.n_scenes else 0 end), b.bag_stem, b.n_scenes, list_position(load, list_min(load)) from f join bags b on b.rn = f.rn + 1)
"""


@query(_SEEDED_FOLDS + "select bag_stem, n_scenes, cast(fold - 1 as integer) as fold from f where rn > 0", "scene_meta")
def seeded_kfold(spark, sf_dir):
    return splits.kfold(scenes_per_bag(spark, sf_dir), 3, seed=7, strict=True)


@query(f"""with recursive {_SEEDED}, total as (select cast(sum(n_scenes) as bigint) as t from bags),
tg as (select t, cast(floor(t * 0.7::double) as bigint) as a, cast(floor(t * 0.2::double) as bigint) as b from total),
f as (select cast(0 as bigint) as rn, [a, b, t - a - b] as lack, cast(null as varchar) as bag_stem, cast(0 as bigint) as n_scenes, cast(0 as bigint) as i from tg
  union all select b.rn, list_transform(range(1, 4), lambda i: lack[i] - case when i = list_position(lack, list_max(lack)) then b.n_scenes else 0 end), b.bag_stem, b.n_scenes, list_position(lack, list_max(lack)) from f join bags b on b.rn = f.rn + 1)
select bag_stem, n_scenes, ['train', 'val', 'test'][i] as split from f where rn > 0""", "scene_meta")
def seeded_split(spark, sf_dir):
    return splits.balanced_split(scenes_per_bag(spark, sf_dir), seed=7, whole=True)


_FILES = """select kind, split, concat('/d/', kind, 's/', split, '/', unique_scene, case when kind = 'image' then '.png' else '.txt' end) as path
from (select distinct unique_scene, split from pose_label_lines) s cross join (values ('image'), ('label')) v(kind) where kind = 'image' or not unique_scene like '%7'"""


@query(_SEEDED_FOLDS + f""", fi as ({_FILES}), st as (select regexp_extract(path, '([^/]*)\\.[a-z]*$', 1) as stem, case when split = 'test' then 'test' else 'cv' end as part, max(path) filter (kind = 'image') as image, max(path) filter (kind = 'label') as label from fi group by 1, 2 having count(distinct kind) = 2),
pl as (select st.*, fold - 1 as own from st left join f on f.bag_stem = regexp_extract(stem, '^(.*)__', 1) where part = 'test' or f.bag_stem is not null),
ev as (select pl.*, cast(k as integer) as fold, case when part = 'test' then 'test' when own = k then 'val' else 'train' end as role from pl cross join range(3) r(k))
select fold, role, kind, case when kind = 'image' then image else label end as source, concat('/o/fold_', fold, '/', kind, 's/', role, '/', stem, case when kind = 'image' then '.png' else '.txt' end) as target from ev cross join (values ('image'), ('label')) v(kind)""", "scene_meta", "pose_label_lines")
def fold_files(spark, sf_dir):
    relation(spark, sf_dir, "pose_label_lines").createOrReplaceTempView("pose_label_lines")
    return splits.fold_files(spark.sql(_FILES), seeded_kfold(spark, sf_dir), 3, "/o")


_STATUS = """select unique_scene, split, case when bad then 'invalid' when n % 5 = 0 then 'remapped' when n % 7 = 0 then 'missing' when n % 11 = 0 then 'skipped' else 'written' end as status
from (select unique_scene, split, count(*) as n, max(line_no) % 13 = 0 as bad from pose_label_lines group by unique_scene, split) q"""


@query(f"""with s as ({_STATUS}), c as (select count(*) as seen, count(*) filter (status not in ('invalid', 'skipped')) as valid, {', '.join(f"count(*) filter (status = '{x}') as {x}" for x in ('written', 'remapped', 'missing', 'invalid', 'skipped'))}, {', '.join(f"count(*) filter (split = '{x}' and status not in ('invalid', 'skipped')) as in_{x}" for x in splits.SPLITS)} from s),
t as (select *, cast(floor(valid * 0.7::double) as bigint) as a, cast(floor(valid * 0.2::double) as bigint) as b from c)
select concat('{{"config":{{"mode":"bags"}},"kp_order":["nose","tail","wing"],"target_scene_counts":{{"train":', a, ',"val":', b, ',"test":', valid - a - b, '}},"actual_scene_counts":{{"train":', in_train, ',"val":', in_val, ',"test":', in_test, '}},"total_scenes_seen":', seen, ',"total_valid_scenes":', valid,
  ',"reuse_labels_written":', written, ',"reuse_labels_remapped":', remapped, ',"reuse_labels_missing":', missing, ',"reuse_labels_invalid":', invalid, ',"reuse_labels_skipped":', skipped, '}}') as manifest from t""", "pose_label_lines")
def run_manifest(spark, sf_dir):
    relation(spark, sf_dir, "pose_label_lines").createOrReplaceTempView("pose_label_lines")
    return runs.run_manifest(spark.sql(_STATUS), new_folder(spark), (0.7, 0.2, 0.1), _NAMES, {"mode": "bags"})


_PX = "px_ as (select unique_scene, line_no, list_transform(case line_no % 3 when 0 then k[1:13] when 1 then k[1:9] else k end, lambda t: cast(t as double)) as v from (select unique_scene, line_no, string_split(text, ' ') as k from pose_label_lines) q), pn as (select *, len(v) - 5 as rest, [v[1]] || list_transform(range(2, 6), lambda i: case when v[i] <= 1 then v[i] * case when i % 2 = 0 then 64 else 16 end else v[i] end) as b from px_)"


@query(f"""with {_PX}, cr as (select *, list_transform([b[2] - b[4] / 2, b[3] - b[5] / 2, b[2] + b[4] / 2, b[3] + b[5] / 2], lambda x: round_even(x, 0)) as c, rest % 3 = 0 or rest % 2 = 0 as good, case when rest % 3 = 0 then 3 else 2 end as step from pn)
select unique_scene, line_no, case when not good then 'keypoints are neither triplets nor pairs' end as error, case when good then cast(greatest(least(c[1], 63), 0) as integer) end as x1, case when good then cast(greatest(least(c[4], 15), 0) as integer) end as y2, case when good then cast(rest // step as bigint) end as n_kps,
  case when good then round(case when v[5 + step + 1] <= 1 then v[5 + step + 1] * 64 else v[5 + step + 1] end, 6) end as second_x, case when good then case when step = 3 then v[8] else 1 end end as first_v from cr""", "pose_label_lines")
def pose_lines_in_pixels(spark, sf_dir):
    """Pose lines of which a third is cut to pairs and a third to what is neither."""
    k = F.split("text", " ")
    rows = relation(spark, sf_dir, "pose_label_lines")
    cut = rows.withColumn("text", F.array_join(F.when(F.col("line_no") % 3 == 0, F.slice(k, 1, 13)).when(F.col("line_no") % 3 == 1, F.slice(k, 1, 9)).otherwise(k), " "))
    parsed = cut.withColumn("l", labels.parse_pose_line_px(F.col("text"), WIDTH, HEIGHT))
    return parsed.select("unique_scene", "line_no", "l.error", "l.x1", "l.y2", F.when(F.col("l.error").isNull(), F.size("l.kps")).cast("bigint").alias("n_kps"), F.round(F.get("l.kps", 1)["x"], 6).alias("second_x"), F.get("l.kps", 0)["v"].alias("first_v"))


@query("""with n as (select *, greatest(0.0, least(63.0, least(x1, x2))) as a, greatest(0.0, least(63.0, greatest(x1, x2))) as c, greatest(0.0, least(15.0, least(y1, y2))) as b, greatest(0.0, least(15.0, greatest(y1, y2))) as d from (select unique_scene, det_source, det_idx, case when det_idx % 2 = 0 then x2 else x1 end as x1, y1, case when det_idx % 2 = 0 then x1 else x2 end as x2, y2 from detections) q),
g as (select *, case when c - a < 2 then greatest(0.0, (a + c) / 2 - 1) else a end as e, case when c - a < 2 then least(63.0, (a + c) / 2 + 1) else c end as f, case when d - b < 2 then greatest(0.0, (b + d) / 2 - 1) else b end as h, case when d - b < 2 then least(15.0, (b + d) / 2 + 1) else d end as i from n)
select unique_scene, det_source, det_idx, cast(e as double) as x1, cast(h as double) as y1, cast(f as double) as x2, cast(i as double) as y2, cast(a as integer) as left_px, cast(d as integer) as bottom_px from g where f > e and i > h""", "detections")
def normal_boxes(spark, sf_dir):
    """Boxes whose corners are in any order, put in order, moved into the image and grown to two pixels."""
    swapped = relation(spark, sf_dir, "detections").withColumn("_a", F.when(F.col("det_idx") % 2 == 0, F.col("x2")).otherwise(F.col("x1"))).withColumn("_b", F.when(F.col("det_idx") % 2 == 0, F.col("x1")).otherwise(F.col("x2")))
    box = boxes2d.normal_xyxy(F.col("_a"), F.col("y1"), F.col("_b"), F.col("y2"), F.lit(WIDTH), F.lit(HEIGHT))
    left, _, _, bottom = boxes2d.clip_swapped(F.col("_a"), F.col("y1"), F.col("_b"), F.col("y2"), F.lit(WIDTH), F.lit(HEIGHT))
    return swapped.select("unique_scene", "det_source", "det_idx", box.alias("b"), left.alias("left_px"), bottom.alias("bottom_px")).where("b is not null").select("unique_scene", "det_source", "det_idx", "b.*", "left_px", "bottom_px")
