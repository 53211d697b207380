"""Picks, coverage and error reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def best_per_class(detections: DataFrame) -> DataFrame:
    """The detection of highest confidence of each scene and class, the first on ties, its corners rounded half to even."""
    w = Window.partitionBy("unique_scene", "cls").orderBy(F.desc("conf"), "det_idx")
    best = detections.withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    return best.select("unique_scene", "cls", "det_source", "det_idx", "conf", *(F.rint(c).cast("int").alias(c) for c in ("x1", "y1", "x2", "y2")))


def bbox_coverage(px: DataFrame, boxes: DataFrame, scenes: DataFrame, threshold: float = 0.995) -> DataFrame:
    """How much of each scene's aircraft mask lies inside its box (unique_scene, x1, y1, x2, y2, clipped), with verdict and reason."""
    x, y = F.col("col_idx").between(F.col("x1"), F.col("x2")), F.col("row_idx").between(F.col("y1"), F.col("y2"))
    counts = px.where("is_aircraft").join(boxes, "unique_scene", "left").groupBy("unique_scene").agg(F.count("*").alias("total"), F.count_if(x & y).alias("inside"))
    joined = scenes.select("unique_scene").join(boxes, "unique_scene", "left").join(counts, "unique_scene", "left")
    total, inside = F.coalesce("total", F.lit(0)), F.coalesce("inside", F.lit(0))
    recall = F.when(total > 0, inside / total).otherwise(0.0)
    reason = F.when(F.col("x1").isNull(), "no_detection").when(total == 0, "no_aircraft_px").when(recall >= threshold, "ok").otherwise("partial")
    area = (F.col("x2") - F.col("x1") + 1) * (F.col("y2") - F.col("y1") + 1)
    return joined.select("unique_scene", F.when(reason == "ok", "PASS").otherwise("FAIL").alias("status"), reason.alias("reason"), total.alias("px_total"), inside.alias("px_inside"), F.round(recall, 6).alias("recall"), F.coalesce(area, F.lit(0)).cast("bigint").alias("area_px"))


def coverage_summary(coverage: DataFrame) -> DataFrame:
    """Scenes by status and reason, most first."""
    return coverage.groupBy("status", "reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")


def error_summary(errors: DataFrame) -> DataFrame:
    """Statistics of the errors of ok rows by keypoint and by scene, both in one pass."""
    ok = errors.where("status = 'ok' and error_l2_m is not null and not isnan(error_l2_m)")
    e = F.col("error_l2_m")
    stats = [F.count("*").alias("n"), F.avg(e), F.median(e), F.percentile(e, 0.9), F.percentile(e, 0.95), F.min(e), F.max(e), F.stddev_pop(e)]
    names = ["mean", "median", "p90", "p95", "min", "max", "std"]
    grouped = ok.groupingSets([[F.col("kp_name")], [F.col("unique_scene")]], "kp_name", "unique_scene")
    out = grouped.agg(stats[0], *(F.round(s, 9).alias(n) for s, n in zip(stats[1:], names, strict=True)))
    return out.select(F.when(F.col("kp_name").isNotNull(), "keypoint").otherwise("scene").alias("kind"), F.coalesce("kp_name", "unique_scene").alias("name"), "n", *names)


def status_counts(errors: DataFrame) -> DataFrame:
    """Rows by status and by truth source; a blank source is unknown."""
    source = F.when(F.trim("gt_source") == "", "unknown").otherwise(F.col("gt_source"))
    rows = errors.select(F.explode(F.array(F.struct(F.lit("status").alias("kind"), F.col("status").alias("name")), F.struct(F.lit("gt_source").alias("kind"), source.alias("name")))).alias("k"))
    return rows.groupBy("k.kind", "k.name").agg(F.count("*").alias("n"))


def error_histogram(errors: DataFrame, bins: int = 40) -> DataFrame:
    """Rows in bins of equal width between the least and largest ok error; the largest falls into the last bin."""
    ok = errors.where("status = 'ok'")
    ends = ok.agg(F.min("error_l2_m").alias("low"), F.max("error_l2_m").alias("high"))
    share = F.try_divide(F.col("error_l2_m") - F.col("low"), F.col("high") - F.col("low"))
    binned = ok.join(F.broadcast(ends)).select(F.least(F.floor(F.coalesce(share, F.lit(0.0)) * bins), F.lit(bins - 1)).cast("int").alias("bin"))
    return binned.groupBy("bin").agg(F.count("*").alias("n"))


def top_errors(errors: DataFrame, n: int) -> DataFrame:
    """The n largest ok errors."""
    return errors.where("status = 'ok'").orderBy(F.desc("error_l2_m"), "row_id").limit(max(1, n)).select("row_id", "unique_scene", "kp_name", "error_l2_m")


def ever_failed(errors: DataFrame) -> DataFrame:
    """Scenes with a row that isn't ok."""
    return errors.groupBy("unique_scene").agg(F.bool_or(F.col("status") != "ok").alias("f")).where("f").select("unique_scene")


def scenes_per_bag(scenes: DataFrame) -> DataFrame:
    return scenes.groupBy("bag_stem").agg(F.countDistinct("unique_scene").alias("n_scenes"))


def largest_box(detections: DataFrame) -> DataFrame:
    """The box of largest area of each scene and class, the first on ties."""
    area = (F.col("x2") - F.col("x1")) * (F.col("y2") - F.col("y1"))
    w = Window.partitionBy("unique_scene", "cls").orderBy(F.desc(area), "det_idx")
    return detections.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("unique_scene", "cls", "det_idx", area.alias("area"))


def scene_detections(best: DataFrame, width: int, height: int, classes: dict[str, int], needed: str = "aircraft") -> DataFrame:
    """One row per scene that has a clipped box of the needed class: for each class its box as a struct, or null, and its confidence."""
    from skyweave.functions.boxes2d import clip_xyxy

    clipped = best.withColumn("box", clip_xyxy(*map(F.col, ("x1", "y1", "x2", "y2")), F.lit(width), F.lit(height))).where("box is not null")
    one = lambda c, k: F.max(F.when(F.col("cls") == k, F.col(c)))
    wide = clipped.groupBy("unique_scene").agg(*(one(c, k).alias(f"{n}_{c}") for n, k in classes.items() for c in ("box", "conf")))
    return wide.where(F.col(f"{needed}_box").isNotNull())


def every_nth(rows: DataFrame, order: str, group: str, stride: int, cap: int | None = None) -> DataFrame:
    """Every stride-th row by a unique key, the first included, at most cap rows. group is a column that never falls as the key rises, such as the
    recording of a scene: rows are ranked inside their group, and only a row per group meets in one task."""
    before = Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(F.col(group).alias("_g")).agg(F.count("*").alias("_n")).select("_g", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = rows.withColumn("_rn", F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1)
    met = inside.join(starts, F.col(group).eqNullSafe(F.col("_g"))).withColumn("_rn", F.col("_rn") + F.col("_start")).where(F.col("_rn") % stride == 0)
    return (met if cap is None else met.where(F.col("_rn") < stride * cap)).drop("_rn", "_g", "_start")
