"""Joins by name, picks, overrides, morphology and points snapped into boxes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyweave.operators.oriented import inside_boxes


def pair_counts(images: DataFrame, labels: DataFrame, on: list[str]) -> DataFrame:
    """(kind, n): how many keys both sides have (pair), and how many only one has (image_only, label_only)."""
    a, b = images.select(*on).distinct().withColumn("_i", F.lit(True)), labels.select(*on).distinct().withColumn("_l", F.lit(True))
    kind = F.when(F.col("_i").isNull(), "label_only").when(F.col("_l").isNull(), "image_only").otherwise("pair")
    return a.join(b, on, "full").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def profile_lookup(rows: DataFrame, catalogue: DataFrame, first: Column, second: Column) -> DataFrame:
    """Adds entry and found_by: the catalogue's entry (key, entry) for the first key, else for the second."""
    keyed = rows.withColumn("_k1", first).withColumn("_k2", second)
    for n in (1, 2):
        keyed = keyed.join(catalogue.select(F.col("key").alias(f"_k{n}"), F.col("entry").alias(f"_e{n}")), f"_k{n}", "left")
    found = F.when(F.col("_e1").isNotNull(), "first").when(F.col("_e2").isNotNull(), "second")
    return keyed.withColumn("entry", F.coalesce("_e1", "_e2")).withColumn("found_by", found).drop("_k1", "_k2", "_e1", "_e2")


def pick_row(rows: DataFrame, key: list[str], first: Column, order: str) -> DataFrame:
    """One row per key: the first by order of those for which `first` holds, else of all."""
    w = Window.partitionBy(*key).orderBy(F.when(first, 0).otherwise(1), order)
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def match_alias(names: DataFrame, aliases: list[str], order: str) -> DataFrame:
    """One row per scene with a name that is an alias, or else holds one: exact matches first, then by the alias's place, then by the name's."""
    low = F.lower("kp_name")
    ranks = F.array(*(F.when(low == a, F.struct(F.lit(0).alias("tier"), F.lit(i).alias("at"))).when(low.contains(a), F.struct(F.lit(1).alias("tier"), F.lit(i).alias("at"))) for i, a in enumerate(aliases)))
    ranked = names.withColumn("_r", F.array_min(F.filter(ranks, lambda r: r.isNotNull()))).where("_r is not null")
    return ranked.groupBy("unique_scene").agg(F.min_by(F.struct("kp_name", "_r"), F.struct("_r", order)).alias("b")).select("unique_scene", "b.kp_name", F.col("b._r.tier").alias("tier"))


def resolve_gt_point(predictions: DataFrame, truth: DataFrame, aliases: dict[str, list[str]], midpoints: dict[str, tuple[str, str]]) -> DataFrame:
    """Adds gt (x, y, z) and gt_source: the scene's keypoint of the same name (exact), of the first alias it has (alias), or the middle of two
    others (midpoint). A scene's few keypoints travel as one map, so that it takes one join."""
    points = truth.groupBy("unique_scene").agg(F.map_from_entries(F.collect_list(F.struct("kp_name", F.struct("x", "y", "z")))).alias("_t"))
    at = lambda n: F.try_element_at("_t", n if isinstance(n, Column) else F.lit(n))
    name = F.col("kp_name")
    nothing = F.lit(None).cast("struct<x:double,y:double,z:double>")
    alias, middle = nothing, nothing
    for n, options in aliases.items():
        if options:
            alias = F.when(name == n, F.coalesce(*map(at, options))).otherwise(alias)
    for n, (a, b) in midpoints.items():
        mean = F.struct(*(((at(a)[k] + at(b)[k]) / 2).alias(k) for k in "xyz"))
        middle = F.when((name == n) & at(a).isNotNull() & at(b).isNotNull(), mean).otherwise(middle)
    joined = predictions.join(points, "unique_scene", "left").withColumn("_e", at(name)).withColumn("_a", alias).withColumn("_m", middle)
    source = F.when(F.col("_e").isNotNull(), "exact").when(F.col("_a").isNotNull(), "alias").when(F.col("_m").isNotNull(), "midpoint")
    return joined.withColumn("gt", F.coalesce("_e", "_a", "_m")).withColumn("gt_source", source).drop("_t", "_e", "_a", "_m")


def keypoint_error(resolved: DataFrame) -> DataFrame:
    """Adds error_l2_m, the distance of x, y, z from gt, and status: ok, gt_match_not_found, or prediction_missing."""
    distance = F.sqrt(sum((F.col(k) - F.col(f"gt.{k}")) * (F.col(k) - F.col(f"gt.{k}")) for k in "xyz"))
    status = F.when(F.col("x").isNull() | F.col("y").isNull() | F.col("z").isNull(), "prediction_missing").when(F.col("gt").isNull(), "gt_match_not_found").otherwise("ok")
    return resolved.withColumn("error_l2_m", distance).withColumn("status", status)


def override_specs(specs: DataFrame, edits: DataFrame, key: list[str]) -> DataFrame:
    """The specs with each field that an edit gives replaced; keys that only the edits have are added with their fields."""
    fields = [c for c in specs.columns if c not in key]
    renamed = edits.select(*key, *(F.col(c).alias(f"_{c}") for c in fields))
    return specs.join(renamed, key, "full").select(*key, *(F.coalesce(f"_{c}", c).alias(c) for c in fields))


def dominant(rows: DataFrame, key: list[str], value: str, order: str) -> DataFrame:
    """The most common value of each key, the one seen first by order on ties."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count("*").alias("_n"), F.min(order).alias("_first"))
    return counts.groupBy(*key).agg(F.min_by(value, F.struct(-F.col("_n"), "_first")).alias(value), F.max("_n").alias("n"))


def class_summary(points: DataFrame, least: int) -> DataFrame:
    """(unique_scene, cls, n, enough): points of each class and, with class null, of the scene, in one pass."""
    grouped = points.groupingSets([[F.col("unique_scene"), F.col("cls")], [F.col("unique_scene")]], "unique_scene", "cls")
    return grouped.agg(F.count("*").alias("n")).withColumn("enough", F.col("n") >= least)


def keypoint_order(names: DataFrame, order: list[str], removed: list[str], added: list[str]) -> DataFrame:
    """(idx, kp_name): the names in the order in which they are first seen, without the removed ones, then the added ones. The window is over one row
    per distinct name."""
    seen = names.where(~F.col("kp_name").isin(*removed, *added)).groupBy("kp_name").agg(F.min(F.struct(*order)).alias("_at")).select("kp_name", F.lit(0).alias("_part"), "_at")
    at = seen.schema["_at"].dataType
    more = names.sparkSession.createDataFrame([(n, i + 1) for i, n in enumerate(added)], "kp_name string, _part int").withColumn("_at", F.lit(None).cast(at))
    return seen.unionByName(more).select((F.row_number().over(Window.orderBy("_part", "_at")) - 1).alias("idx"), "kp_name")


def _ellipse(size: int) -> list[tuple[int, int]]:
    r = (size | 1) // 2
    half = {dy: round(math.sqrt(r * r - dy * dy)) for dy in range(-r, r + 1)}
    return [(dy, dx) for dy, w in half.items() for dx in range(-w, w + 1)]


def _spread(mask: DataFrame, size: int, height: int, width: int) -> DataFrame:
    steps = F.array(*(F.struct(F.lit(a).alias("r"), F.lit(b).alias("c")) for a, b in _ellipse(size)))
    moved = mask.select("unique_scene", "row_idx", "col_idx", F.explode(steps).alias("s")).select("unique_scene", (F.col("row_idx") + F.col("s.r")).alias("row_idx"), (F.col("col_idx") + F.col("s.c")).alias("col_idx"))
    return moved.where(F.col("row_idx").between(0, height - 1) & F.col("col_idx").between(0, width - 1))


def dilate(mask: DataFrame, size: int, height: int, width: int) -> DataFrame:
    """The pixels (unique_scene, row_idx, col_idx) within an elliptic kernel of the mask's; even sizes count as the next odd one."""
    return _spread(mask, size, height, width).distinct()


def erode(mask: DataFrame, size: int, height: int, width: int) -> DataFrame:
    """The pixels all of whose neighbours in the image, by an elliptic kernel, are in the mask."""
    inside = sum((F.col("row_idx").between(-a, height - 1 - a) & F.col("col_idx").between(-b, width - 1 - b)).cast("int") for a, b in _ellipse(size))
    met = _spread(mask.distinct(), size, height, width).groupBy("unique_scene", "row_idx", "col_idx").agg(F.count("*").alias("_n"))
    return met.where(F.col("_n") == inside).drop("_n")


def snap_in_box(px: DataFrame, boxes: DataFrame, least: int = 8, grow: float = 1.2, drift: float = 1.25) -> DataFrame:
    """Adds px, py, pz to each box (unique_scene, box_name, centre, half sizes and perhaps a rotation): the median by axis of the points inside, of those
    in the grown box if fewer than least are inside, null if none; the centre if the median lies farther from it than drift."""
    own = [F.col(f"h{k}").alias(f"_o{k}") for k in "xyz"]
    grown = boxes.select("*", *own).withColumns({f"h{k}": F.col(f"h{k}") * max(grow, 1.0) for k in "xyz"})
    inside = F.lit(True)
    for k in "xyz":
        inside = inside & (F.col(f"_a{k}") <= F.col(f"_o{k}") + 1e-6)
    met = inside_boxes(px.select("unique_scene", "x", "y", "z"), grown, ["box_name", "_ox", "_oy", "_oz"]).withColumn("_in", inside).withColumnsRenamed({k: f"p{k}" for k in "xyz"})
    keys = ["unique_scene", "box_name"]
    medians = met.groupBy(*keys).agg(F.count_if("_in").alias("_n"), *(F.median(F.when(F.col("_in"), F.col(f"p{k}"))).alias(f"_a{k}") for k in "xyz"), *(F.median(f"p{k}").alias(f"_b{k}") for k in "xyz"))
    joined = boxes.join(medians, keys, "left")
    pick = {k: F.when(F.col("_n") >= least, F.col(f"_a{k}")).otherwise(F.col(f"_b{k}")) for k in "xyz"}
    away = F.sqrt(sum((pick[k] - F.col(f"c{k}")) * (pick[k] - F.col(f"c{k}")) for k in "xyz"))
    return joined.select(*boxes.columns, *(F.when(away > drift, F.col(f"c{k}")).otherwise(pick[k]).alias(f"p{k}") for k in "xyz"))
