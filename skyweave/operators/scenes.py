"""Per-scene operators on pixels: boxes, gaps, calibration, tone, voxels."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyweave.operators.oriented import as_specs, inside_boxes


def mask_bbox(px: DataFrame, mask: str = "is_aircraft") -> DataFrame:
    """Inclusive bounds and number of the mask's pixels in each scene; scenes without such pixels have no row."""
    ends = [f("row_idx" if k[0] == "y" else "col_idx").alias(k) for k, f in (("x1", F.min), ("y1", F.min), ("x2", F.max), ("y2", F.max))]
    return px.where(F.col(mask)).groupBy("unique_scene").agg(*ends, F.count("*").alias("n_px"))


def largest_empty_gap(px: DataFrame, width: int, mask: str = "is_aircraft") -> DataFrame:
    """The longest circular run of columns without the mask, the earliest on ties: gap_start, gap_len, seam, roll. Scenes whose columns are
    all occupied, or none, have roll 0 and no gap."""
    occupied = px.groupBy("unique_scene", "col_idx").agg(F.bool_or(mask).alias("m")).where("m")
    w = Window.partitionBy("unique_scene").orderBy("col_idx")
    first = F.min("col_idx").over(Window.partitionBy("unique_scene"))
    gaps = occupied.withColumn("len", F.coalesce(F.lead("col_idx").over(w), first + width) - F.col("col_idx") - 1).withColumn("start", F.pmod(F.col("col_idx") + 1, F.lit(width)))
    best = gaps.where("len > 0").groupBy("unique_scene").agg(F.max(F.struct("len", -F.col("start"))).alias("b")).select("unique_scene", (-F.col("b.col2")).cast("int").alias("gap_start"), F.col("b.len").cast("int").alias("gap_len"))
    seam = F.pmod(F.col("gap_start") + F.floor(F.col("gap_len") / 2), F.lit(width)).cast("int")
    found = px.select("unique_scene").distinct().join(best.withColumn("seam", seam), "unique_scene", "left")
    return found.withColumn("roll", F.coalesce(F.pmod(-F.col("seam"), F.lit(width)), F.lit(0)).cast("int"))


def wrap_aware_bbox(px: DataFrame, width: int, mask: str = "is_aircraft") -> DataFrame:
    """The mask's bounds after rolling to the largest gap where that makes the box narrower, and the roll used."""
    masked = px.where(F.col(mask)).join(largest_empty_gap(px, width, mask).select("unique_scene", "roll"), "unique_scene")
    rolled = F.pmod(F.col("col_idx") + F.col("roll"), F.lit(width))
    both = masked.groupBy("unique_scene").agg(F.first("roll").alias("roll"), F.min("col_idx").alias("a"), F.max("col_idx").alias("b"), F.min(rolled).alias("c"), F.max(rolled).alias("d"), F.min("row_idx").alias("y1"), F.max("row_idx").alias("y2"))
    narrower = F.col("d") - F.col("c") < F.col("b") - F.col("a")
    pick = lambda x, y: F.when(narrower, F.col(x)).otherwise(F.col(y))
    return both.select("unique_scene", pick("c", "a").alias("x1"), "y1", pick("d", "b").alias("x2"), "y2", F.when(narrower, F.col("roll")).otherwise(0).alias("roll"))


def width_gate(boxes: DataFrame, width: int, most: float = 0.6) -> DataFrame:
    """The scenes whose box is at most that share of the image wide."""
    return boxes.where((F.col("x2") - F.col("x1") + 1) / F.lit(width) <= most)


def row_calibration(px: DataFrame) -> DataFrame:
    """Median elevation of each scene's rows."""
    elevation = F.atan2("z", F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y")))
    return px.groupBy("unique_scene", "row_idx").agg(F.median(elevation).alias("elevation"))


def col_calibration(px: DataFrame) -> DataFrame:
    """Circular mean azimuth of each scene's columns."""
    a = F.atan2("y", "x")
    return px.groupBy("unique_scene", "col_idx").agg(F.atan2(F.avg(F.sin(a)), F.avg(F.cos(a))).alias("azimuth"))


def tone_map(px: DataFrame, field: str) -> DataFrame:
    """gray: v / 65535 rescaled from mean - 2 sigma .. mean + 2 sigma of its scene to 0 .. 1, then x / (1 + x)."""
    v = F.col(field) / 65535
    stats = px.groupBy("unique_scene").agg(F.avg(v).alias("_m"), F.stddev_pop(v).alias("_s"))
    low, high = F.col("_m") - 2 * F.col("_s"), F.col("_m") + 2 * F.col("_s")
    x = F.greatest(F.coalesce(F.try_divide(v - low, high - low), F.lit(0.0)), F.lit(0.0))
    return px.join(stats, "unique_scene").withColumn("gray", F.least(x / (1 + x), F.lit(1.0))).drop("_m", "_s")


def percentile_norm(px: DataFrame, field: str, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """gray: the field from its scene's low to high percentile as 0 .. 1, clipped; a flat field is clipped as it is."""
    stats = px.groupBy("unique_scene").agg(F.percentile(field, F.array(F.lit(low), F.lit(high))).alias("_p"))
    a, b = F.col("_p")[0], F.col("_p")[1]
    scaled = F.when(b > a, (F.col(field) - a) / F.nullif(b - a, F.lit(0.0))).otherwise(F.col(field))
    return px.join(stats, "unique_scene").withColumn("gray", F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0))).drop("_p")


def voxel_first(px: DataFrame, size: float, order: list[str | Column]) -> DataFrame:
    """The first point of each voxel of each scene, by the given order, which must be total."""
    cell = [F.floor(F.col(c) / size).alias(f"v{c}") for c in "xyz"]
    return px.groupBy("unique_scene", *cell).agg(F.min_by(F.struct("x", "y", "z"), F.struct(*order)).alias("p")).select("unique_scene", "vx", "vy", "vz", "p.*")


def subsample(px: DataFrame, n: int, key: list[str], seed: int = 1234) -> DataFrame:
    """At most n points of each scene, picked by hash of seed, scene and key; few rows of each task are sorted with others, as only ranks up to
    n are asked for."""
    w = Window.partitionBy("unique_scene").orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), "unique_scene", *(F.col(c).cast("string") for c in key))), *key)
    return px.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def points_in_boxes(px: DataFrame, boxes: DataFrame) -> DataFrame:
    """Points of each scene inside its boxes (box_name, centre x, y, z, size sx, sy, sz and perhaps a rotation), bounds included within 1e-6; a point
    in several boxes has several rows."""
    return inside_boxes(px, as_specs(boxes), ["box_name"]).select(*px.columns, "box_name")


def cloud_summary(px: DataFrame) -> DataFrame:
    """Count, bounds and centre of each scene's points."""
    ends = [f(c).alias(f"{n}_{c}") for c in "xyz" for n, f in (("min", F.min), ("max", F.max))]
    return px.groupBy("unique_scene").agg(F.count("*").alias("n_points"), *ends, *(F.avg(c).alias(f"mean_{c}") for c in "xyz"))


def overlap_count(left: DataFrame, right: DataFrame, scale: int = 1000) -> DataFrame:
    """Distinct points of each scene's two clouds, rounded to 1 / scale, and how many both have."""
    key = lambda df, side: df.select("unique_scene", *(F.rint(F.col(c) * scale).cast("bigint").alias(c) for c in "xyz"), F.lit(side).alias("side"))
    both = key(left, 1).unionByName(key(right, 2)).groupBy("unique_scene", "x", "y", "z").agg(F.bool_or(F.col("side") == 1).alias("a"), F.bool_or(F.col("side") == 2).alias("b"))
    return both.groupBy("unique_scene").agg(F.count_if("a").alias("n_left"), F.count_if("b").alias("n_right"), F.count_if(F.col("a") & F.col("b")).alias("n_both"))


def expand_radius(px: DataFrame, seeds: DataFrame, radius: float) -> DataFrame:
    """Points of each scene within radius of one of its seeds. Seeds go to the 27 cells around their own, so that the join is an
    equi-join on scene and cell."""
    cells = [F.floor(F.col(c) / radius).alias(f"g{c}") for c in "xyz"]
    near = seeds.select("unique_scene", *(F.col(c).alias(f"s{c}") for c in "xyz"), *cells).distinct()
    for c in "xyz":
        near = near.withColumn("_d", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1)))).withColumn(f"g{c}", F.col(f"g{c}") + F.col("_d")).drop("_d")
    distance = sum((F.col(c) - F.col(f"s{c}")) * (F.col(c) - F.col(f"s{c}")) for c in "xyz")
    keys = ["unique_scene", "gx", "gy", "gz"]
    placed, near = px.select("*", *cells), near.select(*(F.col(k).alias(f"_{k}") for k in keys), "sx", "sy", "sz")
    same = [placed[k] == near[f"_{k}"] for k in keys]
    return placed.join(near, [*same, distance <= radius * radius], "left_semi").drop("gx", "gy", "gz")


def ground_attenuate(px: DataFrame, field: str, factor: float) -> DataFrame:
    """The field scaled by factor where a pixel is ground and not aircraft."""
    return px.withColumn(field, F.when(F.col("is_ground") & ~F.col("is_aircraft"), F.col(field) * factor).otherwise(F.col(field)))


def range_encode(px: DataFrame, mode: str = "near_bright", gamma: float = 1.0, low: float = 0.01, high: float = 0.99) -> DataFrame:
    """gray: positive finite ranges from their scene's low to high percentile as 0 .. 1, to the power gamma; others 0. mode: log, linear, inverse
    (1 - linear), or else near_bright (1 - log)."""
    valid = (F.col("range_m") > 0) & (F.col("range_m") < float("inf"))
    v = F.when(valid, F.ln("range_m") if mode in ("log", "near_bright") else F.col("range_m"))
    stats = px.groupBy("unique_scene").agg(F.percentile(v, F.array(F.lit(low), F.lit(high))).alias("_p"))
    a, b = F.col("_p")[0], F.col("_p")[1]
    share = F.least(F.greatest(F.when(b > a, (v - a) / F.nullif(b - a, F.lit(0.0))).otherwise(v), F.lit(0.0)), F.lit(1.0))
    gray = F.pow(share if mode in ("log", "linear") else 1 - share, F.lit(max(gamma, 1e-6)))
    return px.join(stats, "unique_scene").withColumn("gray", F.when(valid, gray).otherwise(0.0)).drop("_p")


def row_band_correction(px: DataFrame, height: int, sigma: float, strength: float = 0.8, most: float = 0.12) -> DataFrame:
    """gray without horizontal bands: each row's median less its trend under a Gaussian over rows (edge rows repeated), cut to most and times
    strength, is taken off, and the scene's mean kept. Rows without pixels count as the median of the others."""
    medians = px.groupBy("unique_scene", "row_idx").agg(F.median("gray").alias("m"))
    profile = medians.groupBy("unique_scene").agg(F.map_from_entries(F.collect_list(F.struct(F.col("row_idx").cast("int"), "m"))).alias("m"), F.median("m").alias("fill"))
    reach = round(4 * sigma)
    weights = [(o, math.exp(-o * o / (2 * sigma * sigma))) for o in range(-reach, reach + 1)]
    total = sum(w for _, w in weights)
    dense = profile.select("unique_scene", F.transform(F.sequence(F.lit(0), F.lit(height - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.col("fill"))).alias("m"))
    at = lambda i: F.get("m", F.least(F.greatest(i, F.lit(0)), F.lit(height - 1)))
    trend = lambda i: sum(at(i + o) * w for o, w in weights) / total
    band = F.transform("m", lambda m, i: strength * F.least(F.greatest(m - trend(i), F.lit(-most)), F.lit(most)))
    placed = px.join(dense.select("unique_scene", band.alias("_band")), "unique_scene").withColumn("_b", F.get("_band", F.col("row_idx").cast("int")))
    means = placed.groupBy("unique_scene").agg(F.avg("_b").alias("_mean"))
    gray = F.least(F.greatest(F.col("gray") - F.col("_b") + F.col("_mean"), F.lit(0.0)), F.lit(1.0))
    return placed.join(means, "unique_scene").withColumn("gray", gray).drop("_band", "_b", "_mean")


def channel_balance(px: DataFrame, channels: list[str], least: float = 0.25, most: float = 2.0) -> DataFrame:
    """The channels, each scaled in each scene towards the median of the channels' means, by a gain between least and most; with fewer than two
    channels that aren't dark, none is scaled."""
    means = px.groupBy("unique_scene").agg(*(F.avg(c).alias(f"_{c}") for c in channels))
    lit = F.array_sort(F.filter(F.array(*(F.col(f"_{c}") for c in channels)), lambda m: m > 1e-6))
    n = F.size(lit)
    middle = (F.get(lit, F.floor((n - 1) / 2).cast("int")) + F.get(lit, F.floor(n / 2).cast("int"))) / 2
    gain = lambda c: F.when((n >= 2) & (F.col(f"_{c}") > 1e-6), F.least(F.greatest(middle / F.col(f"_{c}"), F.lit(least)), F.lit(most))).otherwise(1.0)
    gains = means.select("unique_scene", *(gain(c).alias(f"_{c}") for c in channels))
    scaled = {c: F.least(F.greatest(F.col(c) * F.col(f"_{c}"), F.lit(0.0)), F.lit(1.0)) for c in channels}
    return px.join(gains, "unique_scene").withColumns(scaled).drop(*(f"_{c}" for c in channels))
