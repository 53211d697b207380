"""Checks of keypoints against the boxes they belong in, and the verdicts and reports that follow from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyweave.functions.names import target_box_key
from skyweave.functions.pixels import in_frame
from skyweave.operators.oriented import rotation_of
from skyweave.operators.poses import turn_boxes

_ENGINES = ("engine_left", "engine_right")


def box_specs(scenes: DataFrame, boxes: DataFrame, scale: float = 1.0, least_half: float = 0.25) -> DataFrame:
    """One row per scene and target box of its profile: box_key, centre and half sizes, no half size below least_half. Of several boxes with one key the
    first by name counts. Scenes that have a rotation (array of nine, row by row, local to world) and tx, ty, tz have their boxes, turned by
    rx, ry, rz, in the world, with their rotation; the others' boxes stand as the profile has them."""
    key = target_box_key(F.col("name"))
    half = lambda k: (F.greatest(F.abs(f"s{k}") / 2, F.lit(least_half)) * scale).alias(f"h{k}")
    if "rotation" in scenes.columns:
        keyed = boxes.withColumn("_key", key).where("_key is not null").withColumn("_rn", F.row_number().over(Window.partitionBy("profile", "_key").orderBy("name"))).where("_rn = 1")
        return turn_boxes(scenes, keyed.withColumn("name", F.col("_key")), scale, least_half)
    first = boxes.withColumn("box_key", key).where("box_key is not null").withColumn("_rn", F.row_number().over(Window.partitionBy("profile", "box_key").orderBy("name"))).where("_rn = 1")
    specs = first.select("profile", "box_key", *(F.col(k).alias(f"c{k}") for k in "xyz"), *map(half, "xyz"))
    return scenes.select("unique_scene", "profile").join(specs, "profile").drop("profile")


def build_checks(kps: DataFrame, specs: DataFrame, swap_engines: bool = False) -> DataFrame:
    """One row per keypoint with a target box in its scene: inside (bounds included within 1e-6), its distances from the centre along the box's axes
    ax, ay, az and the box's half sizes hx, hy, hz. Boxes without a rotation are upright."""
    return _checked(kps.withColumn("swapped", F.lit(swap_engines)).withColumn("box_key", target_box_key(F.col("kp_name"), swap_engines)), specs)


def _checked(keyed: DataFrame, specs: DataFrame) -> DataFrame:
    met = keyed.select("unique_scene", "kp_name", "x", "y", "z", "swapped", "box_key").join(specs, ["unique_scene", "box_key"])
    gaps = [F.col(k) - F.col(f"c{k}") for k in "xyz"]
    away = [F.abs(v) for v in (in_frame(gaps, rotation_of(specs)) if "rotation" in specs.columns else gaps)]
    inside = [a <= F.col(f"h{k}") + 1e-6 for a, k in zip(away, "xyz", strict=True)]
    return met.select("unique_scene", "kp_name", "box_key", (inside[0] & inside[1] & inside[2]).alias("inside"), *(a.alias(f"a{k}") for a, k in zip(away, "xyz", strict=True)), "hx", "hy", "hz", "swapped")


def auto_swap_lr(kps: DataFrame, specs: DataFrame) -> DataFrame:
    """The checks of each scene, with the engines' sides swapped in scenes that have both engine boxes and more checks inside that way."""
    sides = F.array(*(F.struct(F.lit(swapped).alias("swapped"), target_box_key(F.col("kp_name"), swapped).alias("box_key")) for swapped in (False, True)))
    both = _checked(kps.withColumn("_s", F.explode(sides)).select("unique_scene", "kp_name", "x", "y", "z", "_s.*"), specs)
    pairs = specs.where(F.col("box_key").isin(*_ENGINES)).groupBy("unique_scene").agg((F.count_distinct("box_key") == 2).alias("_pair"))
    score = lambda swapped: F.sum((F.col("inside") & (F.col("swapped") == swapped)).cast("int")).over(Window.partitionBy("unique_scene"))
    chosen = both.withColumn("_more", score(True) > score(False)).join(pairs, "unique_scene", "left")
    return chosen.where(F.col("swapped") == F.coalesce(F.col("_more") & F.col("_pair"), F.lit(False))).drop("_more", "_pair")


def _outside() -> Column:
    over = [F.greatest(F.col(f"a{k}") - F.col(f"h{k}"), F.lit(0.0)) for k in "xyz"]
    return F.sqrt(over[0] * over[0] + over[1] * over[1] + over[2] * over[2])


def near_margin_pass(checks: DataFrame, margin: float = 1.0) -> DataFrame:
    """Checks outside by at most margin become inside; inside_raw and near_pass keep what was."""
    near = ~F.col("inside") & (_outside() <= margin) & F.lit(margin > 0)
    return checks.withColumn("inside_raw", F.col("inside")).withColumn("near_pass", F.coalesce(near, F.lit(False))).withColumn("inside", F.col("inside") | F.col("near_pass"))


def skip_front_checks(checks: DataFrame, scenes: DataFrame, profile: str) -> DataFrame:
    """The checks without the front ones of scenes of that profile."""
    off = scenes.where(F.col("profile") == profile).select("unique_scene", F.lit("front_landing_gear").alias("box_key"))
    return checks.join(off, ["unique_scene", "box_key"], "left_anti")


def scene_verdict(scenes: DataFrame, checks: DataFrame) -> DataFrame:
    """One row per scene: verdict PASS if it has checks and none is outside, else FAIL; reason, n_inside, n_outside."""
    counts = checks.groupBy("unique_scene").agg(F.count_if("inside").alias("n_inside"), F.count_if(~F.col("inside")).alias("n_outside"))
    out = F.coalesce("n_outside", F.lit(0))
    reason = F.when(F.col("n_inside").isNull(), "no warning-box checks produced").when(out > 0, F.concat(out.cast("string"), F.lit(" outside warning box"))).otherwise("")
    joined = scenes.select("unique_scene").join(counts, "unique_scene", "left")
    return joined.select("unique_scene", F.when(reason == "", "PASS").otherwise("FAIL").alias("verdict"), reason.alias("reason"), F.coalesce("n_inside", F.lit(0)).alias("n_inside"), out.alias("n_outside"))


def verdict_summary(verdicts: DataFrame) -> DataFrame:
    """Rows (kind, name, verdict, n): each scene, all scenes, and the reasons of failure, in one aggregation."""
    rows = F.array(F.struct(F.lit("sample").alias("kind"), F.col("unique_scene").alias("name"), F.col("verdict").alias("verdict")), F.struct(F.lit("all").alias("kind"), F.lit("ALL").alias("name"), F.col("verdict").alias("verdict")), F.struct(F.lit("fail_reason").alias("kind"), F.col("reason").alias("name"), F.col("verdict").alias("verdict")))
    return verdicts.select(F.explode(rows).alias("r")).select("r.*").where("kind <> 'fail_reason' or name <> ''").groupBy("kind", "name", "verdict").agg(F.count("*").alias("n"))


def pass_by_inside_count(verdicts: DataFrame) -> DataFrame:
    """Scenes that pass by their number of checks."""
    return verdicts.where("verdict = 'PASS'").groupBy("n_inside").agg(F.count("*").alias("n"))


def pass_fail_rows(verdicts: DataFrame, checks: DataFrame, confidences: DataFrame, threshold: float | None = None) -> DataFrame:
    """One row per check with its confidence (unique_scene, kp_name, conf) and whether it counts at the threshold; scenes without checks have one
    summary row."""
    counted = F.col("conf").isNotNull() & (F.lit(True) if threshold is None else F.col("conf") >= threshold)
    met = checks.join(confidences, ["unique_scene", "kp_name"], "left").join(verdicts.select("unique_scene", "verdict"), "unique_scene")
    rows = met.select("unique_scene", "kp_name", "box_key", F.when(F.col("inside"), "PASS").otherwise("FAIL").alias("check_status"), F.col("verdict").alias("scene_result"), F.col("conf").alias("confidence"), F.coalesce(counted, F.lit(False)).alias("counted"))
    none = verdicts.join(checks.select("unique_scene").distinct(), "unique_scene", "left_anti")
    return rows.unionByName(none.select("unique_scene", F.lit("__scene__").alias("kp_name"), F.lit("scene_summary").alias("box_key"), F.col("verdict").alias("check_status"), F.col("verdict").alias("scene_result"), F.lit(None).cast("double").alias("confidence"), F.lit(False).alias("counted")))


def confidence_by_check(rows: DataFrame, threshold: float) -> DataFrame:
    """Of the check rows by status: mean confidence of those that count, how many count, lie below the threshold, or have no confidence."""
    real = rows.where("kp_name <> '__scene__'")
    return real.groupBy("check_status").agg(F.avg(F.when(F.col("counted"), F.col("confidence"))).alias("mean_conf"), F.count_if("counted").alias("n"), F.count_if(F.col("confidence") < threshold).alias("n_below"), F.count_if(F.col("confidence").isNull()).alias("n_missing"))


def box_distance(checks: DataFrame) -> DataFrame:
    """How far each check lies outside its box, signed distance (negative inside), margin and differences by axis; status names missing values."""
    known = F.lit(True)
    for c in ("ax", "ay", "az", "hx", "hy", "hz"):
        known = known & F.col(c).isNotNull() & ~F.isnan(c)
    margin = F.least(*(F.col(f"h{k}") - F.col(f"a{k}") for k in "xyz"))
    inside = margin >= 0
    values = {"outside_m": _outside(), "signed_m": F.when(inside, -margin).otherwise(_outside()), "margin_m": margin, **{f"d{k}_m": F.col(f"a{k}") - F.col(f"h{k}") for k in "xyz"}, "inside_box": inside.cast("int")}
    return checks.select("unique_scene", "kp_name", "box_key", *(F.when(known, v).alias(n) for n, v in values.items()), F.when(known, "ok").otherwise("missing_local_or_half_dims").alias("status"))


def confidence_wide(confidences: DataFrame, names: list[str]) -> DataFrame:
    """One row per scene: conf_<name> for each name, has_conf and num_conf."""
    best = [F.max(F.when(F.col("kp_name") == n, F.col("conf"))).alias(f"conf_{n}") for n in names]
    wide = confidences.groupBy("unique_scene").agg(*best)
    n = sum(F.col(f"conf_{n}").isNotNull().cast("int") for n in names)
    return wide.withColumn("num_conf", n).withColumn("has_conf", (n > 0).cast("int"))


def confidence_long(wide: DataFrame) -> DataFrame:
    """(unique_scene, kp_name, conf) from the conf_ columns; blank values and those that aren't numbers have no row."""
    columns = [c for c in wide.columns if c.startswith("conf_")]
    text = wide.select("unique_scene", *(F.col(c).cast("string").alias(c) for c in columns))
    long = text.unpivot("unique_scene", columns, "kp_name", "conf")
    return long.select("unique_scene", F.substring("kp_name", 6, 1 << 20).alias("kp_name"), F.col("conf").try_cast("double").alias("conf")).where("conf is not null")


def confidence_stats(long: DataFrame) -> DataFrame:
    """Count, mean, least and greatest confidence by keypoint."""
    return long.groupBy("kp_name").agg(F.count("*").alias("n"), F.avg("conf").alias("mean"), F.min("conf").alias("min"), F.max("conf").alias("max"))
