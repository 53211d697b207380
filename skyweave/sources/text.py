"""Text formats: point clouds, label files, name lists, catalogues and reports, read and written by Spark.

Point clouds are read line by line, so that a file may have any size; other files are read whole, one row each, so that one has to fit in a task and under
2 GB. All are taken apart with column expressions, and written by scene, so that any number of tasks can write them. Every reader gives `path`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweave.functions.names import norm_name, split_from_path
from skyweave.sources.clouds import cloud_lines
from skyweave.sources.scene_files import write_by_scene

# Headers of the formats.
PCD_HEAD = "# .PCD v0.7 - Point Cloud Data file format\nVERSION 0.7\nFIELDS x y z\nSIZE 4 4 4\nTYPE F F F\nCOUNT 1 1 1\nWIDTH {n}\nHEIGHT 1\nVIEWPOINT 0 0 0 1 0 0 0\nPOINTS {n}\nDATA ascii"
PLY_HEAD = "ply\nformat ascii 1.0\nelement vertex {n}\nproperty float x\nproperty float y\nproperty float z\nend_header"


# Columns of a pixel table without names, and those that hold the aircraft mask, in order of preference.
PIXEL_COLUMNS = ("x", "y", "z", "range", "intensity", "reflectivity", "ambient", "is_ground", "is_aircraft")
MASKS = ("is_aircraft", "aircraft_mask", "mask_aircraft", "aircraft")


def scan_px(spark: SparkSession, path: str, values: str = "values") -> DataFrame:
    """Pixel rows of a Parquet table: names trimmed and in lower case, numbers that aren't finite null, is_ground and is_aircraft booleans (values
    above 0.5; is_aircraft from the first of MASKS; null where there is none). A table that holds its columns as one array of numbers, without
    names, has PIXEL_COLUMNS. Rows without x, y or z, and all rows of a table without these columns, are left out."""
    px = spark.read.parquet(path)
    px = px.toDF(*(c.strip().lower() for c in px.columns))
    if values in px.columns:
        px = px.select("*", *(F.get(values, i).alias(c) for i, c in enumerate(PIXEL_COLUMNS) if c not in px.columns)).drop(values)
    finite = [F.when(~F.isnan(c) & (F.abs(c) < float("inf")), F.col(c)).alias(c) if t in ("double", "float") else F.col(c) for c, t in px.dtypes]
    px = px.select(*finite)
    flag = lambda c: F.col(c) if dict(px.dtypes)[c] == "boolean" else F.col(c) > 0.5
    mask = next((c for c in MASKS if c in px.columns), None)
    none = F.lit(None).cast("boolean")
    flags = {"is_aircraft": flag(mask) if mask else none, "is_ground": flag("is_ground") if "is_ground" in px.columns else none}
    px = px.withColumns(flags).drop(*(c for c in MASKS[1:]))
    return px.dropna(subset=["x", "y", "z"]) if {"x", "y", "z"} <= set(px.columns) else px.where("false")


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """path and length of the files under root whose name matches, in all folders below; no content is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    return found.select("path", "length")


def _whole(spark: SparkSession, root: str, glob: str) -> DataFrame:
    read = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    return read.text(root, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value"))


def _lines(files: DataFrame) -> DataFrame:
    return files.select("path", F.posexplode(F.split("value", r"\r?\n")).alias("at", "line")).withColumn("line", F.trim("line"))


def scene_of(path: Column) -> Column:
    """The scene in a path's last `unique_scene=` folder, else its file name without extension."""
    folder = F.regexp_extract(path, "^.*unique_scene=([^/]+)/", 1)  # tried from one place only, as paths are long
    return F.url_decode(F.when(folder != "", folder).otherwise(F.regexp_extract(F.substring_index(path, "/", -1), r"^(.+?)(\.[^.]*)?$", 1)))


def _cloud(spark: SparkSession, root: str, glob: str, count: str, start: str, readable: str) -> DataFrame:
    fields = F.split("line", r"\s+")
    number = lambda i: F.get(fields, i).try_cast("double")
    return cloud_lines(spark, root, glob, count, start, readable).select("path", scene_of(F.col("path")).alias("unique_scene"), "idx", *(number(i).alias(k) for i, k in enumerate("xyz")), "error", F.col("line").alias("_line"))


def scan_pcd(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Points (path, unique_scene, idx, x, y, z) of ASCII point clouds, no more of a file than its header counts; other files have one row with an error. A
    file of any size is read by many tasks."""
    return _cloud(spark, root, glob, r"(?i)^points\s+(\d+)", r"(?i)^data.*ascii", r"(?i)^data.*ascii").drop("_line")


def scan_ply(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """As scan_pcd, for ASCII polygon files: their vertices, with red, green and blue where a vertex has six numbers."""
    colour = lambda i: F.get(F.split("_line", r"\s+"), i).try_cast("int")
    found = _cloud(spark, root, glob, r"(?i)^element\s+vertex\s+(\d+)", r"(?i)^end_header", r"(?i)^format\s+ascii")
    return found.withColumns({k: colour(i) for i, k in enumerate(("red", "green", "blue"), 3)}).drop("_line")


def _write_cloud(points: DataFrame, order: list[str], path: str, head: str) -> None:
    line = F.format_string("%.6f %.6f %.6f", "x", "y", "z")
    body = points.select("unique_scene", F.lit(1).alias("_part"), F.struct(*order).alias("_at"), line.alias("value"))
    n = points.groupBy("unique_scene").agg(F.count("*").cast("string").alias("n"))
    nothing = F.lit(None).cast(body.schema["_at"].dataType)
    header = n.select("unique_scene", F.lit(0).alias("_part"), nothing.alias("_at"), F.replace(F.lit(head), F.lit("{n}"), F.col("n")).alias("value"))
    write_by_scene(header.unionByName(body), ["_part", "_at"], path)


def write_pcd(points: DataFrame, order: list[str], path: str) -> None:
    """One ASCII point cloud per scene, its points in the given order; a scene's file is one task's work."""
    _write_cloud(points, order, path, PCD_HEAD)


def write_ply(points: DataFrame, order: list[str], path: str) -> None:
    """As write_pcd, as polygon files of vertices."""
    _write_cloud(points, order, path, PLY_HEAD)


def scan_label_lines(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, split, unique_scene, line_no, text) of label files, blank lines left out; split is the last path part that names one, else val."""
    lines = _lines(_whole(spark, root, glob)).where("line <> ''")
    return lines.select("path", split_from_path(F.col("path")).alias("split"), scene_of(F.col("path")).alias("unique_scene"), F.col("at").alias("line_no"), F.col("line").alias("text"))


def write_labels(scenes: DataFrame, lines: DataFrame, path: str) -> None:
    """One label file per scene with its lines (unique_scene, line_no, text) in order; scenes without lines have a file with
    a blank line only."""
    joined = scenes.select("unique_scene").distinct().join(lines.select("unique_scene", "line_no", "text"), "unique_scene", "left")
    write_by_scene(joined.withColumn("value", F.coalesce("text", F.lit(""))), ["line_no"], path)


def scan_class_names(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, idx, name) of the bullets after a line `keypoints:` or `names:`, up to the first line that is neither bullet, comment nor blank."""
    lines = _lines(_whole(spark, root, glob))
    w = Window.partitionBy("path").orderBy("at")
    heading = F.col("line").isin("keypoints:", "names:")
    other = ~F.col("line").startswith("- ") & (F.col("line") != "") & ~F.col("line").startswith("#")
    last = F.max(F.when(heading, F.struct("at", F.lit(True).alias("open"))).when(other, F.struct("at", F.lit(False).alias("open")))).over(w)
    bullets = lines.withColumn("_last", last).where("_last.open").where(F.col("line").startswith("- ")).withColumn("name", F.trim(F.substring("line", 3, 1 << 20))).where("name <> ''")
    return bullets.select("path", (F.row_number().over(w) - 1).alias("idx"), "name")


_BOX = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("warning_level", T.IntegerType()), *(T.StructField(k, T.DoubleType()) for k in ("x", "y", "z", "rx", "ry", "rz", "sx", "sy", "sz"))]))


def scan_crop_boxes(spark: SparkSession, root: str, glob: str = "*.json") -> DataFrame:
    """(path, name, warning_level, x .. sz) of box catalogues, each a JSON list: a missing level is -1, missing rotations and sizes are 0, boxes without
    a centre have no row."""
    boxes = _whole(spark, root, glob).select("path", F.explode(F.from_json("value", _BOX)).alias("b")).select("path", "b.*").where("x is not null and y is not null and z is not null")
    return boxes.fillna(-1, ["warning_level"]).fillna(0.0, ["rx", "ry", "rz", "sx", "sy", "sz"])


def scan_commented_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A CSV table whose header follows `#` lines, values stripped. A folder without files needs a schema, and has no rows."""
    return spark.read.csv(path, schema, comment="#", header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)


def scan_profiles(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The rows of CSV profile tables with a header, each once for each of its keys, the normalised profile_name and aircraft; of rows with the
    same key the first in order of files and lines. A folder without files needs a schema, and has no rows."""
    rows = spark.read.csv(path, schema, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    for c in ("profile_name", "aircraft"):
        rows = rows if c in rows.columns else rows.withColumn(c, F.lit(None).cast("string"))
    order = ["_file", "_block", "_line"]  # lines of one block are numbered in order
    placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"))
    return profile_keys(placed, order).drop(*order)


def profile_keys(profiles: DataFrame, order: list[str]) -> DataFrame:
    """Adds key: each row once for its normalised profile_name and aircraft; the first row of a key in the given order wins."""
    keys = F.array_distinct(F.filter(F.array(*(norm_name(F.col(c)) for c in ("profile_name", "aircraft"))), lambda k: k.isNotNull() & (k != "")))
    each = profiles.withColumn("key", F.explode(keys))
    return each.withColumn("_rn", F.row_number().over(Window.partitionBy("key").orderBy(*order))).where("_rn = 1").drop("_rn")


def parse_box_filters(listed: Column, piped: Column) -> Column:
    """The names of a list literal; else those of a text with `|` between them; else none."""
    text = F.trim(F.coalesce(listed, F.lit("")))
    from_list = F.when(text.startswith("["), F.from_json(F.translate(text, "'", '"'), "array<string>"))
    strip = lambda a: F.filter(F.transform(a, lambda s: F.trim(s)), lambda s: s != "")
    return F.coalesce(strip(from_list), strip(F.split(F.coalesce(piped, F.lit("")), r"\|")))


def read_legend(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """(path, kp_name, x, y, z) of the lines `name: xyz=(x, y, z)`; the last line of a name counts."""
    number = r"\s*([-+0-9.eE]+)\s*"
    pattern = rf"^\s*([^:]+?)\s*:\s*xyz=\({number},{number},{number}\)"
    lines = _lines(_whole(spark, root, glob)).where(F.col("line").rlike(pattern))
    part = lambda i: F.regexp_extract("line", pattern, i)
    points = lines.select("path", "at", part(1).alias("kp_name"), *(part(i).try_cast("double").alias(k) for i, k in ((2, "x"), (3, "y"), (4, "z")))).dropna()
    return points.groupBy("path", "kp_name").agg(F.max_by(F.struct("x", "y", "z"), "at").alias("p")).select("path", "kp_name", "p.*")


def write_report_csv(report: DataFrame, path: str) -> None:
    """The report with a header, blanks for nulls and six decimals."""
    columns = [F.when(F.col(c).isNotNull() & ~F.isnan(c), F.format_string("%.6f", c)).alias(c) if t == "double" else F.col(c) for c, t in report.dtypes]
    report.select(*columns).write.csv(path, header=True, nullValue="", emptyValue="")


def split_columns(members: DataFrame) -> DataFrame:
    """(rn, train, val, test) from (split, bag_stem): each split's recordings in order, side by side, null below the shorter ones. The ranks of one
    split, a row per recording, are one task's work."""
    ranked = members.select("split", "bag_stem").distinct().withColumn("rn", F.row_number().over(Window.partitionBy("split").orderBy("bag_stem")))
    return ranked.groupBy("rn").pivot("split", ["train", "val", "test"]).agg(F.first("bag_stem"))
