"""Queries that write derived relations as text formats into the shared folder and read them back, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyweave.plans.catalogue import query
from skyweave.sources import clouds, text
from skyweave.sources.relations import relation
from skyweave.sources.shared import new_folder


_CLOUD = "select unique_scene, cast(row_number() over (partition by unique_scene order by row_idx, col_idx) - 1 as integer) as idx, x, y, z from px where is_aircraft"


def _aircraft(spark, sf_dir):
    return relation(spark, sf_dir, "px").where("is_aircraft").select("unique_scene", "row_idx", "col_idx", "x", "y", "z")


@query(_CLOUD, "px")
def pcd_files(spark, sf_dir):
    path = new_folder(spark)
    text.write_pcd(_aircraft(spark, sf_dir), ["row_idx", "col_idx"], path)
    return text.scan_pcd(spark, path).select("unique_scene", "idx", "x", "y", "z")


@query(_CLOUD, "px")
def ply_files(spark, sf_dir):
    path = new_folder(spark)
    text.write_ply(_aircraft(spark, sf_dir), ["row_idx", "col_idx"], path)
    return text.scan_ply(spark, path).select("unique_scene", "idx", "x", "y", "z")


_MARKED = f"""c as ({_CLOUD}), n as (select unique_scene, count(*) as n from c group by 1), k as (select p.*, n, row_number() over (partition by p.unique_scene order by kp_name) - 1 as i from kp3d p join n on n.unique_scene = p.unique_scene),
pal as (select unnest(range(10)) as i, unnest([{', '.join(map(str, (c[0] for c in clouds.PALETTE)))}]) as red, unnest([{', '.join(map(str, (c[1] for c in clouds.PALETTE)))}]) as green, unnest([{', '.join(map(str, (c[2] for c in clouds.PALETTE)))}]) as blue)"""


def _written(spark, sf_dir) -> str:
    path = new_folder(spark)
    clouds.write_marked_ply(_aircraft(spark, sf_dir), ["row_idx", "col_idx"], relation(spark, sf_dir, "kp3d").select("unique_scene", "kp_name", "x", "y", "z"), path)
    return path


@query(f"with {_MARKED} select unique_scene, count(*) as n, count(*) filter (red = 145 and green = 145) as n_grey, round(sum(x), 3) as x, sum(cast(red as bigint)) as red, sum(cast(green as bigint)) as green, sum(cast(blue as bigint)) as blue, max(idx) as last from (select unique_scene, idx, x, 145 as red, 145 as green, 145 as blue from c union all select unique_scene, cast(n + k.i * 19 + m as integer), x, red, green, blue from k join pal on pal.i = k.i % 10 cross join range(19) r(m)) v group by 1", "px", "kp3d")
def marked_clouds(spark, sf_dir):
    """Coloured clouds with markers, written and read back."""
    read = text.scan_ply(spark, f"{_written(spark, sf_dir)}/clouds")
    sums = [F.sum(c).alias(c) for c in ("red", "green", "blue")]
    return read.groupBy("unique_scene").agg(F.count("*").alias("n"), F.count_if((F.col("red") == 145) & (F.col("green") == 145)).alias("n_grey"), F.round(F.sum("x"), 3).alias("x"), *sums, F.max("idx").alias("last"))


@query(f"with {_MARKED} select unique_scene, kp_name, x, y, z from k", "px", "kp3d")
def marked_legends(spark, sf_dir):
    read = text.read_legend(spark, f"{_written(spark, sf_dir)}/legends")
    return read.select(text.scene_of(F.col("path")).alias("unique_scene"), "kp_name", "x", "y", "z")


@query("select unique_scene, cast(row_number() over (partition by unique_scene order by line_no) - 1 as integer) as line_no, text from pose_label_lines", "pose_label_lines")
def label_files(spark, sf_dir):
    path = new_folder(spark)
    text.write_labels(relation(spark, sf_dir, "scene_meta"), relation(spark, sf_dir, "pose_label_lines"), path)
    return text.scan_label_lines(spark, path).select("unique_scene", "line_no", "text")


@query("select kp_name, count(*) as n, format('{:.6f}', avg(error_l2_m)) as mean from kp_error where status = 'ok' group by 1", "kp_error")
def report_file(spark, sf_dir):
    path = new_folder(spark)
    report = relation(spark, sf_dir, "kp_error").where("status = 'ok'").groupBy("kp_name").agg(F.count("*").alias("n"), F.avg("error_l2_m").alias("mean"))
    text.write_report_csv(report, path)
    return spark.read.csv(path, header=True, schema="kp_name string, n bigint, mean string")


@query("select bag_stem, name, warning_level, x, sy, cast(0 as double) as rz from crop_boxes c join (select distinct bag_stem, profile from scene_meta) b on b.profile = c.profile", "scene_meta", "crop_boxes")
def box_catalogue_files(spark, sf_dir):
    """One catalogue for each recording."""
    path = new_folder(spark)
    boxes = relation(spark, sf_dir, "crop_boxes").join(relation(spark, sf_dir, "scene_meta").select("bag_stem", "profile").distinct(), "profile")
    value = F.to_json(F.collect_list(F.struct("name", "warning_level", "x", "y", "z", "sx", "sy", "sz")))
    boxes.groupBy(F.col("bag_stem").alias("unique_scene")).agg(value.alias("value")).write.partitionBy("unique_scene").text(path)
    found = text.scan_crop_boxes(spark, path, "*.txt")
    return found.select(text.scene_of(F.col("path")).alias("bag_stem"), "name", "warning_level", "x", "sy", "rz")


@query("select unique_scene, kp_name, x, y, z from kp3d", "kp3d")
def legend_files(spark, sf_dir):
    path = new_folder(spark)
    line = F.format_string("%s: xyz=(%.6f, %.6f, %.6f)", "kp_name", "x", "y", "z")
    legends = relation(spark, sf_dir, "kp3d").select("unique_scene", F.col("kp_idx").alias("line_no"), line.alias("text"))
    text.write_labels(legends.select("unique_scene"), legends, path)
    return text.read_legend(spark, path).select(text.scene_of(F.col("path")).alias("unique_scene"), "kp_name", "x", "y", "z")


@query("select unique_scene, cast(kp_idx as integer) as idx, kp_name as name from kp3d", "kp3d")
def class_name_files(spark, sf_dir):
    path = new_folder(spark)
    kps = relation(spark, sf_dir, "kp3d").select("unique_scene", F.col("kp_idx").cast("int").alias("line_no"), F.concat(F.lit("  - "), "kp_name").alias("text"))
    heads = kps.select("unique_scene").distinct()
    fixed = [(-3, "kind: pose"), (-2, "keypoints:"), (-1, "# first to last"), (1000, "other:"), (1001, "- not a name")]
    extra = heads.select("unique_scene", F.explode(F.array(*(F.struct(F.lit(n).alias("line_no"), F.lit(t).alias("text")) for n, t in fixed))).alias("e")).select("unique_scene", "e.*")
    text.write_labels(heads, kps.unionByName(extra), path)
    return text.scan_class_names(spark, path).select(text.scene_of(F.col("path")).alias("unique_scene"), "idx", "name")


@query("with m as (select distinct split, bag_stem from pose_label_lines), r as (select *, row_number() over (partition by split order by bag_stem) as rn from m) select cast(rn as integer) as rn, max(bag_stem) filter (split = 'train') as train, max(bag_stem) filter (split = 'val') as val, max(bag_stem) filter (split = 'test') as test from r group by 1", "pose_label_lines")
def split_columns(spark, sf_dir):
    return text.split_columns(relation(spark, sf_dir, "pose_label_lines"))


@query("select key, bag_stem from (select key, bag_stem, row_number() over (partition by key order by bag_stem) as rn from (select replace(bag_stem, '-', '_') as key, bag_stem from scene_meta union select profile, bag_stem from scene_meta) k) q where rn = 1", "scene_meta")
def profile_keys(spark, sf_dir):
    rows = relation(spark, sf_dir, "scene_meta").select("bag_stem", F.col("bag_stem").alias("profile_name"), F.col("profile").alias("aircraft")).distinct()
    return text.profile_keys(rows, ["bag_stem"]).select("key", "bag_stem")


@query("select unique_scene, cast(sum(length(text) + 1) as bigint) as length from pose_label_lines group by 1", "pose_label_lines")
def list_files(spark, sf_dir):
    path = new_folder(spark)
    text.write_labels(relation(spark, sf_dir, "scene_meta"), relation(spark, sf_dir, "pose_label_lines"), path)
    return text.list_files(spark, path, "*.{txt,TXT}").where("length > 1").select(text.scene_of(F.col("path")).alias("unique_scene"), "length")


@query("select bag_stem, cast(count(*) as varchar) as n_scenes, 'train' as split from scene_meta group by 1", "scene_meta")
def commented_csv_files(spark, sf_dir):
    """A file for each recording, with remarks before the header and blanks around the values."""
    path = new_folder(spark)
    bags = relation(spark, sf_dir, "scene_meta").groupBy("bag_stem").agg(F.count("*").cast("string").alias("n"))
    lines = F.array(F.lit("# recordings"), F.lit("# and their scenes"), F.lit("bag_stem, n_scenes ,split"), F.concat(F.lit(" "), "bag_stem", F.lit(" , "), "n", F.lit(", train ")))
    rows = bags.select(F.col("bag_stem").alias("unique_scene"), F.posexplode(lines).alias("line_no", "text"))
    text.write_labels(rows.select("unique_scene"), rows, path)
    return text.scan_commented_csv(spark, path, "bag_stem string, n_scenes string, split string").select("bag_stem", "n_scenes", "split")


@query("""with r as (select bag_stem, profile, row_number() over (partition by profile order by bag_stem) as rn from (select distinct bag_stem, profile from scene_meta) q),
k as (select replace(profile, '_', '-') as profile, profile as key, bag_stem from r where rn = 1) select key, bag_stem from k union all select replace(bag_stem, '-', '_'), bag_stem from (select distinct bag_stem from scene_meta) b""", "scene_meta")
def profile_files(spark, sf_dir):
    """One table of all recordings, in order; keys are its profiles and recordings."""
    path = new_folder(spark)
    bags = relation(spark, sf_dir, "scene_meta").select("bag_stem", "profile").distinct()
    line = F.concat_ws(",", "bag_stem", F.replace("profile", F.lit("_"), F.lit("-")), F.concat(F.lit("B"), "bag_stem"))
    table = bags.select(F.lit("profiles").alias("unique_scene"), F.concat(F.lit("1"), "bag_stem").alias("line_no"), line.alias("text"))
    head = table.limit(1).select("unique_scene", F.lit("0").alias("line_no"), F.lit("profile_name,aircraft,note").alias("text"))
    text.write_labels(table.select("unique_scene"), head.unionByName(table), path)
    return text.scan_profiles(spark, path, "profile_name string, aircraft string, note string").select("key", F.col("profile_name").alias("bag_stem"))


_PX = "select unique_scene, row_idx, col_idx, x, y, z, range_m as range, is_ground, is_aircraft from px"


@query(_PX, "px")
def px_files(spark, sf_dir):
    """Columns named freely, the mask as a number; and some rows without a place, which are left out."""
    path = new_folder(spark)
    px = relation(spark, sf_dir, "px").selectExpr("unique_scene as Unique_Scene", "row_idx", "col_idx", "x as `X `", "y as Y", "z as ` z`", "range_m as RANGE", "cast(is_ground as double) * 0.7 as Is_Ground", "if(is_aircraft, 0.9D, 0.4D) as Aircraft_Mask")
    px.unionByName(px.where("row_idx = 0").withColumn("Y", F.lit(float("nan")))).write.parquet(path)
    return text.scan_px(spark, path).select("unique_scene", "row_idx", "col_idx", "x", "y", "z", "range", "is_ground", "is_aircraft")


@query(_PX, "px")
def px_files_without_names(spark, sf_dir):
    path = new_folder(spark)
    parts = ("x", "y", "z", "range_m", "intensity", "reflectivity", "0D", "cast(is_ground as double)", "cast(is_aircraft as double)")
    relation(spark, sf_dir, "px").selectExpr("unique_scene", "row_idx", "col_idx", f"array({', '.join(parts)}) as values").write.parquet(path)
    return text.scan_px(spark, path).select("unique_scene", "row_idx", "col_idx", "x", "y", "z", "range", "is_ground", "is_aircraft")


@query("select bag_stem, scene_key, case when scene_key % 3 = 0 then 'engine_left,front' when scene_key % 3 = 1 then concat(profile, ',b c') else '' end as names from scene_meta", "scene_meta")
def box_filters(spark, sf_dir):
    listed = F.expr("case scene_key % 3 when 0 then \"['engine_left', 'front', ' ']\" when 1 then ' ' end")
    piped = F.expr("case when scene_key % 3 < 2 then concat(profile, ' | b c||') end")
    return relation(spark, sf_dir, "scene_meta").select("bag_stem", "scene_key", F.array_join(text.parse_box_filters(listed, piped), ",").alias("names"))
