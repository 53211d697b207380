"""Keypoints on range images: calibration, projection, visibility, and lifting of pixels to points.

Window searches explode the small keypoint side to the pixels it may meet, so that the join with the pixels is an equi-join on scene,
row and column.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyweave.functions.pixels import angles


def fill_nearest(values: DataFrame, keys: list[str], index: str, value: str, n: int) -> DataFrame:
    """A row for each index from 0 to n - 1 of each key: its value, or the one of the nearest index that has one, the lower on ties; 0 if none."""
    every = values.select(*keys).distinct().withColumn(index, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    dense = every.join(values.select(*keys, F.col(index).cast("int").alias(index), value), [*keys, index], "left")
    w = Window.partitionBy(*keys).orderBy(index)
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(index).alias("i"), F.col(value).alias("v")))
    back = F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(known, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    near = dense.withColumn("_b", back).withColumn("_a", ahead)
    pick = F.when(F.col("_a").isNull() | (F.col(index) - F.col("_b.i") <= F.col("_a.i") - F.col(index)), F.col("_b.v")).otherwise(F.col("_a.v"))
    return near.select(*keys, index, F.coalesce(pick, F.lit(0.0)).alias(value))


def project_keypoints(kps: DataFrame, rows: DataFrame, columns: DataFrame) -> DataFrame:
    """Row and column of each keypoint (unique_scene, kp_name, x, y, z): the row of nearest elevation and the column of nearest azimuth on the
    circle, the first on ties. A scene's rows and columns are kept as one array each, so that a keypoint isn't multiplied by them."""
    lists = lambda df, i, v, name: df.groupBy("unique_scene").agg(F.array_sort(F.collect_list(F.struct(F.col(i).cast("int").alias("i"), F.col(v).alias("v")))).alias(name))
    azimuth, elevation = angles(F.col("x"), F.col("y"), F.col("z"))
    placed = kps.withColumn("_az", azimuth).withColumn("_el", elevation)
    placed = placed.join(lists(rows, "row_idx", "elevation", "_rows"), "unique_scene").join(lists(columns, "col_idx", "azimuth", "_cols"), "unique_scene")
    turn = lambda v: F.abs(F.atan2(F.sin(F.col("_az") - v), F.cos(F.col("_az") - v)))
    nearest = lambda array, distance: F.array_min(F.transform(array, lambda s: F.struct(distance(s["v"]).alias("d"), s["i"].alias("i"))))["i"]
    return placed.withColumn("r", nearest("_rows", lambda v: F.abs(v - F.col("_el")))).withColumn("c", nearest("_cols", turn)).drop("_az", "_el", "_rows", "_cols")


def _around(points: DataFrame, radius: int) -> DataFrame:
    """Each point (r, c) once for each pixel within radius rows and columns; pixels outside the image match none later."""
    steps = F.sequence(F.lit(-radius), F.lit(radius))
    spread = points.withColumn("_dr", F.explode(steps)).withColumn("_dc", F.explode(steps))
    return spread.withColumn("row_idx", F.col("r") + F.col("_dr")).withColumn("col_idx", F.col("c") + F.col("_dc"))


def _window(points: DataFrame, px: DataFrame, radius: int, columns: list[str]) -> DataFrame:
    typed = px.select("unique_scene", F.col("row_idx").cast("int").alias("row_idx"), F.col("col_idx").cast("int").alias("col_idx"), *columns)
    return _around(points, radius).join(typed, ["unique_scene", "row_idx", "col_idx"])


def patch_min_depth(points: DataFrame, px: DataFrame, radius: int) -> DataFrame:
    """The points (unique_scene, kp_name, r, c, ...) with depth: the least range among the pixels within radius rows and columns, or null."""
    found = _window(points.select("unique_scene", "kp_name", "r", "c"), px.where("range_m > 0"), radius, ["range_m"])
    least = found.groupBy("unique_scene", "kp_name").agg(F.min("range_m").alias("depth"))
    return points.join(least, ["unique_scene", "kp_name"], "left")


def ray_visibility(points: DataFrame, tolerance: float = 1.5, exempt: tuple[str, ...] = (), need_hit: tuple[str, ...] = ()) -> DataFrame:
    """Adds visible: 0 for a keypoint that lies more than tolerance behind its patch's depth, that needs a hit and has none, or that is
    base_link in row 0. Exempt names are visible."""
    distance = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))
    name = F.col("kp_name")
    hidden = F.when((name == "base_link") & (F.col("r") == 0), True).when(name.isin(*exempt), False)
    hidden = hidden.when(F.col("depth").isNull(), name.isin(*need_hit)).otherwise(distance > F.col("depth") + tolerance)
    return points.withColumn("visible", F.when(hidden, 0).otherwise(1))


def snap_pixel(points: DataFrame, px: DataFrame, radius: int, weight: float = 0.02, reach: float | None = None) -> DataFrame:
    """Adds snap_r, snap_c: the valid pixel of the window with the least squared distance plus weight times range, in row order on ties. Without
    one, the nearest valid pixel of the scene within reach, if given, else the pixel itself."""
    ids, valid = ["unique_scene", "kp_name"], px.where("range_m > 0")
    best = lambda df, score: df.groupBy(*ids).agg(F.min(F.struct(score.alias("s"), F.col("row_idx").alias("r"), F.col("col_idx").alias("c"))).alias("b"))
    near = best(_window(points.select(*ids, "r", "c"), valid, radius, ["range_m"]), F.col("_dr") * F.col("_dr") + F.col("_dc") * F.col("_dc") + weight * F.col("range_m"))
    if reach is not None:
        left = points.select(*ids, "r", "c").join(near, ids, "left_anti")
        squared = F.col("_dr") * F.col("_dr") + F.col("_dc") * F.col("_dc")
        near = near.unionByName(best(_window(left, valid, math.floor(reach), ["range_m"]).where(squared <= reach * reach), squared.cast("double")))
    return points.join(near, ids, "left").withColumn("snap_r", F.coalesce("b.r", "r")).withColumn("snap_c", F.coalesce("b.c", "c")).drop("b")


def sample_xyz_nearest(points: DataFrame, px: DataFrame, radius: int) -> DataFrame:
    """Adds p (struct x, y, z, or null): the point of the nearest pixel within radius rows and columns, in row order on ties."""
    ids = ["unique_scene", "kp_name"]
    squared = F.col("_dr") * F.col("_dr") + F.col("_dc") * F.col("_dc")
    found = _window(points.select(*ids, "r", "c"), px, radius, ["x", "y", "z"]).groupBy(*ids).agg(F.min_by(F.struct("x", "y", "z"), F.struct(squared, "row_idx", "col_idx")).alias("p"))
    return points.join(found, ids, "left")


def sample_xyz_robust(points: DataFrame, px: DataFrame, radius: int, share: float = 0.8) -> DataFrame:
    """Adds p: a point from the window's pixels, aircraft pixels where there are any. Depth outliers beyond three scaled median deviations, or
    beyond 1.5 interquartile ranges where that deviation is 0, go; of five or more left, the mean of the share nearest to their
    median, of fewer their median."""
    ids = ["unique_scene", "kp_name"]
    w = Window.partitionBy(*ids)
    found = _window(points.select(*ids, "r", "c"), px, radius, ["x", "y", "z", "range_m", "is_aircraft"])
    found = found.withColumn("_any", F.max("is_aircraft").over(w)).where("is_aircraft or not _any")
    middle = found.groupBy(*ids).agg(F.percentile("range_m", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_q"))
    found = found.join(middle, ids).withColumn("_off", F.abs(F.col("range_m") - F.col("_q")[1]))
    spread = found.groupBy(*ids).agg(F.median("_off").alias("_mad"))
    fence = 1.5 * (F.col("_q")[2] - F.col("_q")[0])
    inlier = F.when(F.col("_mad") > 0, F.col("_off") <= 3 * 1.4826 * F.col("_mad")).otherwise(F.col("range_m").between(F.col("_q")[0] - fence, F.col("_q")[2] + fence))
    kept = found.join(spread, ids).where(inlier)
    medians = kept.groupBy(*ids).agg(*(F.median(k).alias(f"m{k}") for k in "xyz"), F.count("*").alias("n"))
    distance = sum((F.col(k) - F.col(f"m{k}")) * (F.col(k) - F.col(f"m{k}")) for k in "xyz")
    order = w.orderBy(distance, "row_idx", "col_idx")
    ranked = kept.join(medians, ids).withColumn("_rn", F.row_number().over(order)).where((F.col("n") < 5) | (F.col("_rn") <= F.ceil(F.col("n") * share)))
    picked = ranked.groupBy(*ids).agg(*(F.when(F.first("n") < 5, F.first(f"m{k}")).otherwise(F.avg(k)).alias(k) for k in "xyz"))
    return points.join(picked.select(*ids, F.struct("x", "y", "z").alias("p")), ids, "left")


def zbuffer_project(px: DataFrame, height: int, width: int, key: Column) -> DataFrame:
    """The nearest point of each cell of a height x width panorama of each scene, by key on ties. Rows span the 1st to 99th percentile of
    elevation, from the top down; columns span the full circle."""
    azimuth, elevation = angles(F.col("x"), F.col("y"), F.col("z"))
    seen = px.withColumn("_el", elevation)
    ends = seen.groupBy("unique_scene").agg(F.percentile("_el", F.array(F.lit(0.01), F.lit(0.99))).alias("_p"))
    share = F.coalesce(F.try_divide(F.col("_p")[1] - F.col("_el"), F.col("_p")[1] - F.col("_p")[0]), F.lit(0.0))
    cell = lambda v, n: F.least(F.greatest(F.floor(v * n), F.lit(0)), F.lit(n - 1)).cast("int")
    placed = seen.join(ends, "unique_scene").withColumn("r", cell(share, height)).withColumn("c", cell((azimuth + math.pi) / (2 * math.pi), width))
    distance = F.sqrt(F.col("x") * F.col("x") + F.col("y") * F.col("y") + F.col("z") * F.col("z"))
    return placed.groupBy("unique_scene", "r", "c").agg(F.min_by(F.struct("x", "y", "z"), F.struct(distance, key)).alias("p")).select("unique_scene", "r", "c", "p.*")


def cluster_adjust(points: DataFrame, px: DataFrame, near: float, far: float, band: float, least: int) -> DataFrame:
    """Moves each point to the mean of its scene's aircraft points lower than the lowest of them plus band within near, else within far, if
    there are at least that many; used tells whether it moved."""
    ids, craft = ["unique_scene", "kp_name"], px.where("is_aircraft").select("unique_scene", *(F.col(k).alias(f"p{k}") for k in "xyz"))
    low = craft.join(craft.groupBy("unique_scene").agg(F.min("pz").alias("_low")), "unique_scene").where(F.col("pz") < F.col("_low") + band)
    distance = F.sqrt(sum((F.col(f"p{k}") - F.col(k)) * (F.col(f"p{k}") - F.col(k)) for k in "xyz"))
    cell = lambda c: F.floor(c / far).cast("bigint")
    about = points.select(*ids, "x", "y", "z")
    for k in "xyz":  # each point meets its own cell and those next to it
        about = about.withColumn(f"_c{k}", F.explode(F.array(*(cell(F.col(k)) + i for i in (-1, 0, 1)))))
    placed = low.select("*", *(cell(F.col(f"p{k}")).alias(f"_c{k}") for k in "xyz"))
    met = about.join(placed, ["unique_scene", "_cx", "_cy", "_cz"]).withColumn("_d", distance).where(F.col("_d") < far)
    inner = lambda v: F.when(F.col("_d") < near, v)
    sums = met.groupBy(*ids).agg(F.count(inner(F.lit(1))).alias("n1"), F.count("*").alias("n2"), *(F.avg(inner(F.col(f"p{k}"))).alias(f"a{k}") for k in "xyz"), *(F.avg(f"p{k}").alias(f"b{k}") for k in "xyz"))
    joined = points.join(sums, ids, "left")
    pick = lambda k: F.when(F.col("n1") >= least, F.col(f"a{k}")).when(F.col("n2") >= least, F.col(f"b{k}")).otherwise(F.col(k)).alias(k)
    return joined.select(*ids, *map(pick, "xyz"), F.coalesce(F.col("n2") >= least, F.lit(False)).alias("used"))


# The keypoints that span a scene's frame.
FRAME = {"l": "left_wing_tip", "r": "right_wing_tip", "fl": "plane_front_left_wheel_link", "fr": "plane_front_right_wheel_link", "bl": "plane_rear_left_wheel_link", "br": "plane_rear_right_wheel_link"}


def frame_basis(kps: DataFrame) -> DataFrame:
    """The scene's axes as an array of nine, column by column: y from wing tip to wing tip, x from the rear to the front wheels and square to y, z
    upwards. Scenes that lack one of the six keypoints have no row."""
    at = {k: F.max(F.when(F.col("kp_name") == n, F.array("x", "y", "z"))).alias(k) for k, n in FRAME.items()}
    wide = kps.groupBy("unique_scene").agg(*at.values()).dropna(subset=list(at))
    vector = lambda f: F.array(*(f(i) for i in range(3)))
    dot = lambda a, b: sum(F.get(a, i) * F.get(b, i) for i in range(3))
    unit = lambda a: F.transform(a, lambda v: v / F.sqrt(dot(a, a)))
    col = lambda n, i: F.get(F.col(n), i)
    wide = wide.withColumn("_y", vector(lambda i: col("l", i) - col("r", i))).withColumn("_y", unit(F.col("_y")))
    wide = wide.withColumn("_g", vector(lambda i: 0.5 * (col("fl", i) + col("fr", i)) - 0.5 * (col("bl", i) + col("br", i)))).withColumn("_o", dot(F.col("_g"), F.col("_y")))
    wide = wide.withColumn("_x", vector(lambda i: col("_g", i) - F.col("_o") * col("_y", i))).withColumn("_x", unit(F.col("_x")))
    cross = vector(lambda i: col("_x", (i + 1) % 3) * col("_y", (i + 2) % 3) - col("_x", (i + 2) % 3) * col("_y", (i + 1) % 3))
    wide = wide.withColumn("_z", cross).withColumn("_z", unit(F.col("_z")))
    up = F.when(col("_z", 2) < 0, F.transform("_z", lambda v: -v)).otherwise(F.col("_z"))
    return wide.select("unique_scene", F.concat("_x", "_y", up).alias("basis"))
