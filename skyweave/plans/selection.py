"""Queries on the choice of files, profiles, records and instances, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyweave.functions import names
from skyweave.operators import selection
from skyweave.plans.catalogue import query
from skyweave.sources.relations import relation

_TOKEN = r"case when regexp_matches(s, '(?i)^movement_(.+?)(?:__|$)') then regexp_extract(s, '(?i)^movement_(.+?)(?:__|$)', 1) else s end"
_SPELLED = r"""[{0}, regexp_replace({0}, '([A-Za-z])([0-9])', '\1_\2', 'g'), regexp_replace({0}, '([0-9])([A-Za-z])', '\1_\2', 'g'), case when regexp_matches({0}, '^[bB][0-9]') then substr({0}, 2) end]"""


@query(rf"""with b as (select distinct bag_stem as s, concat('B', substr(profile, 2), ' split') as p from scene_meta), t as (select s, p, {_TOKEN} as k from b),
e as (select s, unnest(list_concat({_SPELLED.format('p')}, {_SPELLED.format('k')})) as c, unnest(range(8)) as i from t),
g as (select s, i, regexp_replace(regexp_replace(lower(trim(c)), '[^a-z0-9+]+', '_', 'g'), '^_+|_+$', '', 'g') as slug from e where c is not null),
v as (select s, i * 3 as i, slug from g union all select s, i * 3 + 1, replace(slug, 'max_', 'max') from g union all select s, i * 3 + 2, left(slug, length(slug) - 6) from g where slug like '%\_split' escape '\'),
m as (select s, slug, min(i) as i from v where slug <> '' group by 1, 2)
select s as bag_stem, slug, cast(row_number() over (partition by s order by i) - 1 as integer) as at from m""", "scene_meta")
def slug_candidates(spark, sf_dir):
    bags = relation(spark, sf_dir, "scene_meta").select("bag_stem", F.concat(F.lit("B"), F.expr("substr(profile, 2)"), F.lit(" split")).alias("p")).distinct()
    return bags.select("bag_stem", F.posexplode(selection.slug_candidates(F.col("bag_stem"), F.col("p"))).alias("at", "slug"))


_STEMS = "select distinct case when scene_key % 3 = 0 then concat('site-', replace(profile, '_', '-'), '-', scene_key % 7) when scene_key % 3 = 1 then concat('movement_', profile, '_split__run', scene_key % 5) else bag_stem end as stem from scene_meta"
_KNOWN = "select * from (values ('A380 800'), ('777-300-er'), ('737_max_8'), ('787-9')) t(profile)"
_PARTED = r"""[{0}, case when regexp_matches({0}, '^[bB][0-9]') then substr({0}, 2) end, regexp_replace({0}, '([0-9])([A-Za-z])', '\1_\2', 'g'), regexp_replace({0}, '([A-Za-z])([0-9])', '\1_\2', 'g'), regexp_replace({0}, '([A-Za-z]+)([0-9]+)$', '\1_\2', 'g')]"""


@query(rf"""with st as ({_STEMS}), kn as ({_KNOWN}),
w as (select stem, [t for t in regexp_split_to_array(stem, '[^A-Za-z0-9]+') if t <> ''] as ws from st),
seeds as (select stem, 0 as a, 0 as b, regexp_replace(regexp_extract(stem, '(?i)^movement_(.+?)(?:__|$)', 1), '(?i)(_+(split|fix))+_*$', '') as seed from st union all select stem, 0, 1, stem from st
  union all select stem, i, 3 - n, array_to_string(ws[i : i + n - 1], '_') from w, range(1, 12) r(i), range(1, 4) q(n) where i + n - 1 <= len(ws) and regexp_matches(array_to_string(ws[i : i + n - 1], '_'), '[0-9]')),
tried as (select stem, a, b, unnest({_PARTED.format('seed')}) as k, unnest(range(5)) as c from seeds),
met as (select stem, profile, row_number() over (partition by stem order by a, b, c, profile) as rn from tried join kn on replace(replace(lower(trim(profile)), '-', '_'), ' ', '_') = replace(replace(lower(trim(k)), '-', '_'), ' ', '_') where k <> '')
select st.stem, profile from st left join (select * from met where rn = 1) m on m.stem = st.stem""", "scene_meta")
def infer_profile(spark, sf_dir):
    relation(spark, sf_dir, "scene_meta").createOrReplaceTempView("scene_meta")
    return selection.infer_profile(spark.sql(_STEMS), spark.sql(_KNOWN))


_IMAGES = "select det_idx, case when det_idx % 13 = 0 then replace(unique_scene, '__', '-') else unique_scene end as stem from detections"
_SOURCES = "select concat(case when scene_key % 2 = 0 then '/b/' else '/a/' end, bag_stem, case when scene_key % 3 = 0 then '.H5' else '.h5' end) as path from scene_meta where profile <> 'a320'"


@query(f"""with im as ({_IMAGES}), so as (select regexp_extract(path, '([^/]*)\\.[^./]*$', 1) as bag, min(path) as path from ({_SOURCES}) q group by 1),
k as (select det_idx, stem, case when contains(stem, '__') then regexp_extract(stem, '^(.*)__', 1) end as bag, case when contains(stem, '__') then regexp_extract(stem, '^.*__(.*)$', 1) end as scene from im)
select det_idx, stem, scene, path, case when k.bag is null then 'bad_stem' when path is null then 'missing_source' else 'ok' end as reason from k left join so on so.bag = k.bag""", "detections", "scene_meta")
def match_scene_requests(spark, sf_dir):
    relation(spark, sf_dir, "detections").createOrReplaceTempView("detections")
    return selection.match_scene_requests(spark.sql(_IMAGES), spark.sql(_SOURCES))


_FILES = """select distinct concat(case line_no % 7 when 0 then '/r/labels/train/' when 1 then '/r/labels/' when 2 then '/r/val/' when 3 then '/r/' when 4 then '/r/old/labels/' when 5 then '/r/old/val/x/' else '/r/zz/labels/val/' end, unique_scene, '.txt') as path
from pose_label_lines where split <> 'train'"""
_WANTED = "select unique_scene, case when scene_key % 2 = 0 then 'train' else 'val' end as split from scene_meta"


@query(f"""with f as (select path, regexp_extract(path, '([^/]*)\\.txt$', 1) as unique_scene from ({_FILES}) q), s as ({_WANTED}),
m as (select s.unique_scene, split, path, case when path = concat('/r/labels/', split, '/', s.unique_scene, '.txt') then 4 when path = concat('/r/labels/', s.unique_scene, '.txt') then 3 when path = concat('/r/', split, '/', s.unique_scene, '.txt') then 2 when path = concat('/r/', s.unique_scene, '.txt') then 1 else 0 end as tier,
  case when contains(path, '/labels/') then 10 else 0 end + case when contains(path, concat('/', split, '/')) then 5 else 0 end as score from s left join f on f.unique_scene = s.unique_scene)
select unique_scene, split, path, case when path is not null then tier > 0 end as direct from (select *, row_number() over (partition by unique_scene order by tier desc, score desc, length(path), path desc) as rn from m) q where rn = 1""", "pose_label_lines", "scene_meta")
def reuse_labels(spark, sf_dir):
    relation(spark, sf_dir, "pose_label_lines").createOrReplaceTempView("pose_label_lines")
    return selection.reuse_labels(spark.sql(_WANTED), spark.sql(_FILES), "/r")


@query(f"""with f as ({_FILES}), c as (select unique_scene, unnest(['/r/labels/train/', '/r/old/labels/', '/r/']) as folder, unnest(range(3)) as i from scene_meta),
m as (select unique_scene, path, i, row_number() over (partition by unique_scene order by i) as rn from c join f on path = concat(folder, unique_scene, '.txt'))
select s.unique_scene, path, cast(i as integer) as tried_at from scene_meta s left join (select * from m where rn = 1) m on m.unique_scene = s.unique_scene""", "pose_label_lines", "scene_meta")
def resolve_candidates(spark, sf_dir):
    relation(spark, sf_dir, "pose_label_lines").createOrReplaceTempView("pose_label_lines")
    options = F.array(*(F.concat(F.lit(folder), "unique_scene", F.lit(".txt")) for folder in ("/r/labels/train/", "/r/old/labels/", "/r/")))
    return selection.resolve_candidates(relation(spark, sf_dir, "scene_meta").select("unique_scene"), options, spark.sql(_FILES), "unique_scene")


@query("select bag_stem, case when line_no % 7 = 0 then 0 else cast(line_no % 50 as integer) end as n_scenes, split from (select *, row_number() over (partition by bag_stem order by line_no) as rn from pose_label_lines) q where rn = 1", "pose_label_lines")
def dedupe_bags(spark, sf_dir):
    count = F.when(F.col("line_no") % 7 == 0, "some").otherwise(F.concat(F.lit(" "), (F.col("line_no") % 50).cast("string")))
    rows = relation(spark, sf_dir, "pose_label_lines").select("bag_stem", "line_no", count.alias("n_scenes"), F.upper("split").alias("split"))
    return selection.dedupe_bags(rows, "line_no")


_RECORDS = """select det_idx, case det_idx % 4 when 0 then '' when 1 then regexp_extract(unique_scene, '__(scene_[0-9]+)$', 1) when 2 then unique_scene end as scene_name, case when det_idx % 5 = 0 then unique_scene else ' ' end as unique_scene,
case when det_idx % 3 = 0 then regexp_extract(unique_scene, '^(.*)__scene_', 1) else '' end as bag_name, concat('/out/', unique_scene, '.pcd') as pcd_file, case det_idx % 6 when 0 then 'Yes' when 1 then '' when 2 then '1' when 3 then 'no' else 'detected' end as final_graph_detected from detections"""


@query(f"""with r as ({_RECORDS}), a as (select det_idx, pcd_file, trim(coalesce(scene_name, '')) as sn, trim(unique_scene) as us, bag_name as bn, final_graph_detected as fg, lower(final_graph_detected) in ('yes', '1', 'detected') as ok from r),
b as (select *, case when sn <> '' then sn else regexp_extract(pcd_file, '([^/]*)\\.pcd$', 1) end as sc from a), c as (select *, case when us <> '' then us when bn <> '' and sc like 'scene\\_%' escape '\\' then concat(bn, '__', sc) else sc end as uq from b)
select det_idx, case when sn <> '' then sn when contains(sc, '__scene_') then regexp_extract(sc, '^.*?__(.*)$', 1) else sc end as scene_name, uq as unique_scene, case when bn <> '' then bn when contains(uq, '__scene_') then regexp_extract(uq, '^(.*)__scene_', 1) else '' end as bag_name, pcd_file,
case when fg <> '' then fg else 'not_detected' end as final_graph_detected, case when ok then 'PASS' else 'FAIL' end as pose_result, case when ok then 'ok' else 'no_final_graph' end as pose_reason from c""", "detections")
def normalize_pose_records(spark, sf_dir):
    relation(spark, sf_dir, "detections").createOrReplaceTempView("detections")
    return selection.normalize_pose_records(spark.sql(_RECORDS))


@query("select det_idx, unique_scene from detections order by det_idx limit 40 offset 25", "detections")
def page(spark, sf_dir):
    return selection.page(relation(spark, sf_dir, "detections").select("det_idx", "unique_scene"), ["det_idx"], 25, 40)


@query("select det_idx, unique_scene from detections order by det_idx offset 300", "detections")
def page_to_the_end(spark, sf_dir):
    return selection.page(relation(spark, sf_dir, "detections").select("det_idx", "unique_scene"), ["det_idx"], 300)


@query("select unique_scene, det_idx, cls from detections where cls in (1, 3)", "detections")
def class_filter(spark, sf_dir):
    return selection.class_filter(relation(spark, sf_dir, "detections").select("unique_scene", "det_idx", "cls"), "3, 1,3")


_MASKS = "select d.unique_scene, d.det_idx, p.row_idx, p.col_idx from detections d join px p on p.unique_scene = d.unique_scene and p.col_idx between d.x1 and d.x2 and p.row_idx between d.y1 and d.y2"


def _masks(spark, sf_dir):
    """Instances and masks: each detection holds its box's pixels."""
    relation(spark, sf_dir, "px").createOrReplaceTempView("px")
    detections = relation(spark, sf_dir, "detections")
    detections.createOrReplaceTempView("detections")
    return detections, spark.sql(_MASKS)


@query("with t as (select * from (select *, row_number() over (partition by unique_scene order by conf desc, det_idx) as rn from detections) q where rn = 1) select t.unique_scene, row_idx, col_idx, conf as score, cast(1 as bigint) as n_used from t join px p on p.unique_scene = t.unique_scene and p.col_idx between t.x1 and t.x2 and p.row_idx between t.y1 and t.y2", "detections", "px")
def select_best_instance(spark, sf_dir):
    """Masks are made of the best instances alone."""
    relation(spark, sf_dir, "px").createOrReplaceTempView("px")
    best = selection.best_instances(relation(spark, sf_dir, "detections"))
    best.createOrReplaceTempView("best")
    return selection.select_instances(best, spark.sql(_MASKS.replace("from detections d", "from best d")))


@query(f"with m as (select distinct unique_scene, row_idx, col_idx from ({_MASKS}) q), t as (select unique_scene, max(conf) as score, count(*) as n_used from detections group by 1) select m.*, score, n_used from m join t on t.unique_scene = m.unique_scene", "detections", "px")
def merge_instances(spark, sf_dir):
    return selection.select_instances(*_masks(spark, sf_dir), "merge")


_UNION = f"u as (select distinct m.unique_scene, d.cls, m.row_idx, m.col_idx from ({_MASKS}) m join detections d on d.unique_scene = m.unique_scene and d.det_idx = m.det_idx where conf >= 0.25 and cls in (0, 1, 2))"


@query(f"with {_UNION} select * from u", "detections", "px")
def class_masks(spark, sf_dir):
    return selection.class_masks(*_masks(spark, sf_dir), 0.25, "0,1,2")


@query(f"with {_UNION} select p.unique_scene, p.row_idx, p.col_idx, any_value(x) as x, any_value(y) as y, any_value(z) as z, string_agg(cast(cls as varchar), ',' order by cls) as classes from u join px p on p.unique_scene = u.unique_scene and p.row_idx = u.row_idx and p.col_idx = u.col_idx group by 1, 2, 3", "detections", "px")
def mask_points(spark, sf_dir):
    found = selection.mask_points(class_masks(spark, sf_dir), relation(spark, sf_dir, "px"))
    return found.withColumn("classes", F.array_join(F.transform("classes", lambda c: c.cast("string")), ","))


@query("with f as (select unique_scene, row_idx, col_idx, unnest(['range_m', 'intensity', 'reflectivity']) as f, unnest([range_m, intensity, reflectivity]) as v from px) select r.unique_scene, r.row_idx, r.col_idx, concat(r.f, '-', g.f, '-', b.f) as combo, r.v as red, g.v as green, b.v as blue from f r join f g using (unique_scene, row_idx, col_idx) join f b using (unique_scene, row_idx, col_idx)", "px")
def field_combos(spark, sf_dir):
    return selection.field_combos(relation(spark, sf_dir, "px"), ["range_m", "intensity", "reflectivity"])


@query("select unique_scene, row_idx, col_idx, reflectivity as v from px", "px")
def select_field(spark, sf_dir):
    px = relation(spark, sf_dir, "px")
    return px.select("unique_scene", "row_idx", "col_idx", selection.select_field(px, ["ambient", "reflectivity", "intensity"], "range_m").alias("v"))


@query("""with c as (select split, count(distinct unique_scene) as a, count(distinct bag_stem) as b from pose_label_lines group by 1)
select concat('{"names":["aircraft","engine"],"targets":{"train":0.7,"val":0.2},"splits":[', string_agg(concat('{"split":"', split, '","n_scenes":', a, ',"n_bags":', b, '}'), ',' order by split), ']}') as manifest from c""", "pose_label_lines")
def dataset_manifest(spark, sf_dir):
    return selection.dataset_manifest(relation(spark, sf_dir, "pose_label_lines"), ["aircraft", "engine"], {"train": 0.7, "val": 0.2})


@query(f"with f as ({_FILES}) select path, coalesce(list_filter(string_split(lower(path), '/'), lambda p: p in ('train', 'val', 'test'))[-1], 'val') as split from f", "pose_label_lines")
def split_from_path(spark, sf_dir):
    relation(spark, sf_dir, "pose_label_lines").createOrReplaceTempView("pose_label_lines")
    return spark.sql(_FILES).select("path", names.split_from_path(F.col("path")).alias("split"))
