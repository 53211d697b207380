"""Point clouds in text files of any size: lines are read where they lie, and a cloud is written with coloured markers and a legend."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyweave.operators.poses import marker_points
from skyweave.sources.scene_files import write_by_scene

# The header of a coloured polygon file, the grey of its points and the colours of its markers.
PLY_HEAD = "ply\nformat ascii 1.0\nelement vertex {n}\nproperty float x\nproperty float y\nproperty float z\nproperty uchar red\nproperty uchar green\nproperty uchar blue\nend_header"
GREY = 145
PALETTE = ((255, 50, 50), (50, 220, 50), (50, 120, 255), (255, 180, 40), (255, 70, 220), (40, 230, 230), (255, 255, 70), (180, 120, 255), (255, 140, 110), (120, 255, 170))


def numbered_lines(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, at, line): the lines of the files under root but blank ones, with their place in their file. A large file is read in splits by many tasks: a
    line's place is that in its split and the number of lines in the splits before it."""
    read = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(root)
    lines = read.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_split"), F.trim("value").alias("line")).where("line <> ''")
    lines = lines.withColumn("_id", F.monotonically_increasing_id())  # a split lies in one partition, its lines one after another
    splits = lines.groupBy("path", "_split").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1))
    starts = splits.select("path", "_split", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    return lines.join(starts, ["path", "_split"]).select("path", (F.col("_id") - F.col("_first") + F.col("_before")).alias("at"), "line")


def cloud_lines(spark: SparkSession, root: str, glob: str, count: str, start: str, readable: str) -> DataFrame:
    """(path, idx, line, error): the lines after each file's `start` line, at most as many as the number in its `count` line says. A file without a line that
    shows that it is readable has one row with an error, one without any byte has none."""
    lines = numbered_lines(spark, root, glob)
    first = lambda pattern: F.min(F.when(F.col("line").rlike(pattern), F.col("at")))
    n = F.min_by(F.when(F.col("line").rlike(count), F.regexp_extract("line", count, 1)).try_cast("bigint"), F.when(F.col("line").rlike(count), F.col("at")))
    heads = lines.groupBy("path").agg(first(start).alias("_start"), first(readable).alias("_readable"), n.alias("_n"))
    body = lines.join(heads.where("_readable is not null").select("path", "_start", "_n"), "path").withColumn("idx", F.col("at") - F.col("_start") - 1)
    held = body.where("idx >= 0 and (_n is null or idx < _n)").select("path", F.col("idx").cast("int").alias("idx"), "line", F.lit(None).cast("string").alias("error"))
    return held.unionByName(heads.where("_readable is null").select("path", F.lit(None).cast("int").alias("idx"), F.lit(None).cast("string").alias("line"), F.lit("not an ascii file").alias("error")))


def write_marked_ply(points: DataFrame, order: list[str], kps: DataFrame, path: str, size: float = 0.22) -> None:
    """For each scene of points (unique_scene, the order's columns, x, y, z) a polygon file under {path}/clouds: its points in grey and in order, then 19
    points around each of its keypoints (unique_scene, kp_name, x, y, z) in the colour of the name's place; and under {path}/legends a file with a
    line for each keypoint. Keypoints without finite coordinates keep their place but aren't written; scenes without points have no files."""
    ranked = kps.withColumn("_k", F.row_number().over(Window.partitionBy("unique_scene").orderBy("kp_name")) - 1)
    finite = (F.abs("x") < float("inf")) & (F.abs("y") < float("inf")) & (F.abs("z") < float("inf"))
    colour = F.get(F.array(*(F.array(*map(F.lit, c)) for c in PALETTE)), F.col("_k") % len(PALETTE))
    shown = ranked.where(finite).withColumn("_c", colour).join(points.select("unique_scene").distinct(), "unique_scene", "left_semi")
    own = F.struct(*order)
    grey = points.select("unique_scene", F.lit(1).alias("_part"), own.alias("_at"), F.lit(0).alias("_k"), "x", "y", "z", F.array(*[F.lit(GREY)] * 3).alias("_c"))
    nothing = F.lit(None).cast(grey.schema["_at"].dataType)
    marks = marker_points(shown.select("unique_scene", "_k", "x", "y", "z", "_c"), size)
    vertices = grey.unionByName(marks.select("unique_scene", F.lit(2).alias("_part"), nothing.alias("_at"), "_k", "x", "y", "z", "_c"))
    body = vertices.select("unique_scene", "_part", "_at", "_k", F.format_string("%.6f %.6f %.6f %d %d %d", "x", "y", "z", *(F.get("_c", i) for i in range(3))).alias("value"))
    n = vertices.groupBy("unique_scene").agg(F.count("*").cast("string").alias("n"))
    head = n.select("unique_scene", F.lit(0).alias("_part"), nothing.alias("_at"), F.lit(0).alias("_k"), F.replace(F.lit(PLY_HEAD), F.lit("{n}"), F.col("n")).alias("value"))
    write_by_scene(head.unionByName(body), ["_part", "_at", "_k", "value"], f"{path}/clouds")
    said = F.format_string("%s: xyz=(%.3f,%.3f,%.3f) rgb=(%d,%d,%d)", "kp_name", "x", "y", "z", *(F.get("_c", i) for i in range(3)))
    write_by_scene(shown.select("unique_scene", "_k", said.alias("value")), ["_k"], f"{path}/legends")
