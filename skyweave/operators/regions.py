"""Regions of points: clusters, verdicts, neighbours, ground, components, fitted and moved boxes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from skyweave.operators.graphs import least_reachable
from skyweave.sources.shared import materialize

_AXES = ("x", "y", "z")


def cluster_centers(points: DataFrame) -> DataFrame:
    """(unique_scene, region, cluster, candidate, n, x, y, z): the mean of each cluster's points, candidates numbered in each region by cluster."""
    means = points.groupBy("unique_scene", "region", "cluster").agg(F.count("*").alias("n"), *(F.avg(k).alias(k) for k in _AXES))
    w = Window.partitionBy("unique_scene", "region").orderBy("cluster")
    return means.withColumn("candidate", F.row_number().over(w) - 1)


def region_hypothesis(scenes: DataFrame, centers: DataFrame, least_engines: int = 1, need_front: bool = True, left: str = "engine_left", right: str = "engine_right", front: str = "front") -> DataFrame:
    """One row per scene: how many candidates its regions have, hypothesis_result PASS if enough engine regions and, if needed, a front one have any,
    and hypothesis_reason."""
    of = lambda r, n: F.count_if(F.col("region") == r).alias(n)
    counts = centers.groupBy("unique_scene").agg(of(left, "left_candidates"), of(right, "right_candidates"), of(front, "front_candidates"))
    names = ("left_candidates", "right_candidates", "front_candidates")
    wide = scenes.select("unique_scene").join(counts, "unique_scene", "left").fillna(0, list(names))
    engines = (F.col(names[0]) > 0).cast("int") + (F.col(names[1]) > 0).cast("int")
    reason = F.when(engines < least_engines, f"engine_regions_detected<{least_engines}").when(F.lit(need_front) & (F.col(names[2]) == 0), "front_gear_not_detected").otherwise("ok")
    return wide.withColumn("engine_regions_detected", engines).withColumn("hypothesis_reason", reason).withColumn("hypothesis_result", F.when(reason == "ok", "PASS").otherwise("FAIL"))


def name_tail_points(points: DataFrame, order: str, names: DataFrame, tail: int) -> DataFrame:
    """The last `tail` points of each scene by order, named in order by the scene's names (unique_scene, place, kp_name), else K<place>."""
    w = Window.partitionBy("unique_scene").orderBy(F.desc(order))
    last = points.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= tail)
    placed = last.withColumn("place", (F.count("*").over(Window.partitionBy("unique_scene")) - F.col("_rn")).cast("int")).drop("_rn")
    named = placed.join(names.select("unique_scene", F.col("place").cast("int").alias("place"), "kp_name"), ["unique_scene", "place"], "left")
    return named.withColumn("kp_name", F.coalesce("kp_name", F.concat(F.lit("K"), F.col("place").cast("string"))))


def region_verdict(boxed: DataFrame, detected: DataFrame, threshold: float, merge_at: float = 0.6, scale: float = 1000.0) -> DataFrame:
    """One row per scene with box points (unique_scene, side, x, y, z; side left or right): verdict and reason by the share of each box's distinct
    points, to 1 / scale, that the region detected for it holds. Detected sides that overlap by merge_at of the smaller are taken as one; the
    sides are swapped, or a single region goes to the other side, where that covers more."""
    cell = F.struct(*(F.rint(F.col(k) * scale).cast("bigint").alias(k) for k in _AXES)).alias("cell")
    has = lambda side: F.bool_or(F.col("side") == side)
    cells = lambda df, p: df.select("unique_scene", "side", cell).groupBy("unique_scene", "cell").agg(has("left").alias(f"{p}l"), has("right").alias(f"{p}r"))
    met = cells(boxed, "b").join(cells(detected, "d"), ["unique_scene", "cell"], "full").fillna(False)
    n = lambda *c: F.count_if(F.expr(" and ".join(c))).alias("".join(c))
    either = [F.count_if(F.expr(f"{b} and (dl or dr)")).alias(f"{b}e") for b in ("bl", "br")]
    wide = met.groupBy("unique_scene").agg(*(n(c) for c in ("bl", "br", "dl", "dr")), n("dl", "dr"), *(n(b, d) for b in ("bl", "br") for d in ("dl", "dr")), *either)
    both = (F.col("dl") > 0) & (F.col("dr") > 0)
    merged = both & (F.col("dldr") / F.least("dl", "dr") >= merge_at)
    share = lambda hit, box, seen: F.when((F.col(box) > 0) & seen, hit / F.col(box)).otherwise(-1.0)
    got = {(b, d): share(F.col(f"{b}{d}"), b, F.col(d) > 0) for b in ("bl", "br") for d in ("dl", "dr")}
    swap = got["bl", "dr"] + got["br", "dl"] > got["bl", "dl"] + got["br", "dr"]
    # what stands alone: the union of merged sides, else the only side there is
    alone = {b: F.when(merged, share(F.col(f"{b}e"), b, F.lit(True))).when(F.col("dl") > 0, got[b, "dl"]).when(F.col("dr") > 0, got[b, "dr"]).otherwise(-1.0) for b in ("bl", "br")}
    to_right = (alone["br"] > alone["bl"]) | ((alone["br"] == alone["bl"]) & (F.col("dl") == 0))  # on ties it keeps its own side
    nothing = F.lit(-1.0)
    left = F.when(both & ~merged, F.when(swap, got["bl", "dr"]).otherwise(got["bl", "dl"])).otherwise(F.when(to_right, nothing).otherwise(alone["bl"]))
    right = F.when(both & ~merged, F.when(swap, got["br", "dl"]).otherwise(got["br", "dr"])).otherwise(F.when(to_right, alone["br"]).otherwise(nothing))
    ratios = wide.where("bl > 0 or br > 0").select("unique_scene", left.alias("left_ratio"), right.alias("right_ratio"))
    low = lambda c: (F.col(c) >= 0) & (F.col(c) < threshold)
    failed = F.concat_ws(",", F.when(low("left_ratio"), "engine_left"), F.when(low("right_ratio"), "engine_right"))
    reason = F.when((F.col("left_ratio") < 0) & (F.col("right_ratio") < 0), "no detected engine region points for warning check")
    reason = reason.when(failed != "", F.concat(F.lit(f"below warning-box coverage threshold ({threshold:.2f}): "), failed)).otherwise("")
    return ratios.withColumn("reason", reason).withColumn("verdict", F.when(reason == "", "PASS").otherwise("FAIL"))


def _nearest_in_cells(k: int, most: int):
    """For mapInArrow over points sorted by cell, each cell's own and those around it (column own tells which): the mean distance of each own point to
    its k nearest, where these lie within its reach, inside which all points are there. Cells of more than `most` points are passed over."""

    def of(parts: list[pa.RecordBatch]) -> pa.Table:
        cell = pa.Table.from_batches(parts)
        at = [cell.column(a).to_numpy() for a in _AXES]
        own = np.flatnonzero(cell.column("own").to_numpy())
        reach, means, served = cell.column("reach").to_numpy()[own], np.empty(len(own)), np.zeros(len(own), bool)
        near = min(k, cell.num_rows - 1)
        step = max(1, 2_000_000 // cell.num_rows)
        for i in range(0, len(own) if near else 0, step):
            rows = own[i : i + step]
            squared = np.zeros((len(rows), cell.num_rows))
            for x in at:
                gap = x[rows, None] - x[None, :]
                squared += gap * gap
            squared[np.arange(len(rows)), rows] = np.inf
            best = np.sqrt(np.sort(np.partition(squared, near - 1, axis=1)[:, :near], axis=1))
            means[i : i + step] = best.mean(1)
            served[i : i + step] = np.isinf(reach[i : i + step]) | ((best[:, -1] <= reach[i : i + step] * (1 - 1e-9)) & (near == k))
        done = pa.array(own[served])
        return pa.table({"unique_scene": cell.column("unique_scene").take(done), "_of": cell.column("_id").take(done), "_m": pa.array(means[served])})

    def over(batches):
        held, n, last = [], 0, None
        for batch in batches:
            found = []
            keys = np.stack([batch.column(c).to_numpy() for c in ("_g", "_cx", "_cy", "_cz")], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if (key := tuple(keys[a].tolist())) != last:
                    found += [of(held)] if held else []
                    held, n, last = [], 0, key
                n += b - a
                held = [*held, batch.slice(a, b - a)] if n <= most else []
            if found:
                yield from pa.concat_tables(found).combine_chunks().to_batches()
        if held:
            yield from of(held).combine_chunks().to_batches()

    return over


def _near_means(pts: DataFrame, k: int, per_cell: int, halo: float, most: int) -> DataFrame:
    """(unique_scene, _of, _m) of the points whose k nearest lie in their cell or within `halo` of its side around it. A scene is cut into cubes that would
    hold per_cell points each if they were spread evenly; a cell that holds more than `most` with its surroundings is left out."""
    ends = [f(a).alias(f"_{n}{a}") for a in _AXES for n, f in (("a", F.min), ("b", F.max))]
    extent = pts.groupBy("unique_scene").agg(*ends, F.count("*").alias("_n"))
    widths = [F.col(f"_b{a}") - F.col(f"_a{a}") for a in _AXES]
    thin = F.greatest(*widths) * 0.01
    volume = F.greatest(widths[0], thin) * F.greatest(widths[1], thin) * F.greatest(widths[2], thin)
    side = F.when(volume > 0, F.cbrt(volume * per_cell / F.col("_n"))).otherwise(1.0)
    sided = extent.select("unique_scene", side.alias("_side"), *(F.col(f"_a{a}") for a in _AXES), *(F.floor((F.col(f"_b{a}") - F.col(f"_a{a}")) / side).cast("bigint").alias(f"_l{a}") for a in _AXES))
    placed = pts.join(sided, "unique_scene")
    reach = F.lit(float("inf"))
    for a in _AXES:
        spot = (F.col(a) - F.col(f"_a{a}")) / F.col("_side")
        placed = placed.withColumn(f"_c{a}", F.floor(spot).cast("bigint")).withColumn(f"_f{a}", spot - F.col(f"_c{a}"))
        low = F.when(F.col(f"_c{a}") > 0, F.col(f"_f{a}") + halo).otherwise(float("inf"))
        high = F.when(F.col(f"_c{a}") < F.col(f"_l{a}"), 1 - F.col(f"_f{a}") + halo).otherwise(float("inf"))
        reach = F.least(reach, low, high)
    sent = placed.withColumn("reach", reach * F.col("_side")).withColumn("own", F.lit(True))
    for a in _AXES:
        steps = F.array_compact(F.array(F.lit(0), F.when(F.col(f"_f{a}") < halo, -1), F.when(F.col(f"_f{a}") > 1 - halo, 1)))
        sent = sent.withColumn("_d", F.explode(steps)).withColumn(f"_c{a}", F.col(f"_c{a}") + F.col("_d")).withColumn("own", F.col("own") & (F.col("_d") == 0))
    cell = [F.col("unique_scene"), *(F.col(f"_c{a}") for a in _AXES)]
    keyed = sent.select(F.xxhash64(*cell).alias("_g"), *cell, "_id", *_AXES, "reach", "own").repartition("_g").sortWithinPartitions("_g", "_cx", "_cy", "_cz", "unique_scene")
    kinds = dict(pts.dtypes)
    return keyed.mapInArrow(_nearest_in_cells(k, most), f"unique_scene {kinds['unique_scene']}, _of {kinds['_id']}, _m double")


def knn_outlier(points: DataFrame, id_: str, k: int, spread: float, per_cell: int = 1024, cell: float = 0.25, levels: int = 9) -> DataFrame:
    """The points whose mean distance to their k nearest neighbours is at most the scene's mean of these plus `spread` deviations. Scenes of two points
    or fewer, or without deviation, stay whole; ids are unique in their scene.

    Each scene is cut into cells by its density; a cell gets the points around it, too, and most points find their k nearest there. The others, in
    crowded cells or far from all others, look in the smallest of nested grids (cell, 2 cell, ...) whose cell about them holds more than k
    points, through two cells in each direction, where k are, as the cell's diagonal is shorter; so the neighbours are exact. Points that no grid
    serves look through their scene; few are left there, as a coarse cell holds them only if it holds at most k points."""
    k = max(2, k)
    place, own = ["unique_scene", "level", "cx", "cy", "cz"], ["unique_scene", "_of"]
    pts = materialize(points.select("unique_scene", F.col(id_).alias("_id"), *_AXES))
    near = materialize(_near_means(pts, k, per_cell, 0.25, 16 * per_cell))
    rest = pts.withColumnRenamed("_id", "_of").join(near.select(*own), own, "left_anti")
    if rest.isEmpty():
        return _inliers(points, near.withColumnRenamed("_of", id_), id_, spread)
    others = pts.join(rest.select("unique_scene").distinct(), "unique_scene", "left_semi")
    at = lambda level: [F.floor(F.col(a) / (cell * 2.0**level)).cast("bigint") for a in _AXES]
    spot = lambda level: F.struct(F.lit(level).alias("level"), *(v.alias(f"c{a}") for v, a in zip(at(level), _AXES, strict=True)))
    spread_out = lambda df: df.select("*", F.explode(F.array(*map(spot, range(levels)))).alias("s")).select(*df.columns, "s.*")
    spots = spread_out(others)
    full = spots.groupBy(*place).agg(F.count("*").alias("n")).where(F.col("n") > k)
    chosen = spread_out(rest).join(full.select(*place), place).groupBy(*own).agg(F.min(F.struct("level", "cx", "cy", "cz", *(F.col(a).alias(f"_{a}") for a in _AXES))).alias("b")).select(*own, "b.*")
    gaps = [(F.col(a) - F.col(f"_{a}")) for a in _AXES]
    squared = gaps[0] * gaps[0] + gaps[1] * gaps[1] + gaps[2] * gaps[2]
    w = Window.partitionBy(*own).orderBy("d")

    def nearest(met: DataFrame) -> DataFrame:
        ranked = met.where("_of <> _id").select(*own, F.sqrt(squared).alias("d")).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)
        return ranked.groupBy(*own).agg(F.avg("d").alias("_m"))

    around = chosen
    for a in _AXES:
        around = around.withColumn("_d", F.explode(F.array(*map(F.lit, range(-2, 3))))).withColumn(f"c{a}", F.col(f"c{a}") + F.col("_d")).drop("_d")
    side = F.lit(2 * cell) * F.pow(F.lit(2.0), F.col("level"))
    wide = nearest(around.join(spots, place).where(squared <= side * side))
    alone = rest.join(chosen.select(*own), own, "left_anti").select(*own, *(F.col(a).alias(f"_{a}") for a in _AXES))
    means = near.unionByName(wide).unionByName(nearest(alone.join(others, "unique_scene")))
    return _inliers(points, means.withColumnRenamed("_of", id_), id_, spread)


def _inliers(points: DataFrame, means: DataFrame, id_: str, spread: float) -> DataFrame:
    """The points whose mean _m is at most that of their scene and `spread` deviations more."""
    stats = means.groupBy("unique_scene").agg(F.avg("_m").alias("_mu"), F.stddev_pop("_m").alias("_sd"), F.count("*").alias("_n"))
    kept = points.join(means, ["unique_scene", id_], "left").join(stats, "unique_scene", "left")
    degenerate = F.coalesce((F.col("_n") <= 2) | (F.col("_sd") <= 1e-12), F.lit(True))
    return kept.where(degenerate | (F.col("_m") <= F.col("_mu") + spread * F.col("_sd"))).drop("_m", "_mu", "_sd", "_n")


def ground_plane(points: DataFrame, tries: int = 400, near: float = 0.12, least_share: float = 0.08, least_nz: float = 0.65, seed: str = "plane") -> DataFrame:
    """The points with is_plane: whether they lie within `near` of the scene's plane of most points among planes through triples of points in an order by
    hash (at most `tries`), upright by at least least_nz; no point does where that plane holds under three points or least_share of the
    scene's. The planes of a scene travel as one array, and counts are summed before they are shuffled."""
    key = F.md5(F.concat_ws("|", F.lit(seed), "unique_scene", *(F.col(c).cast("string") for c in ("row_idx", "col_idx"))))
    w = Window.partitionBy("unique_scene").orderBy(key, "row_idx", "col_idx")
    drawn = points.select("unique_scene", *_AXES, (F.row_number().over(w) - 1).alias("_rn")).where(F.col("_rn") < 3 * tries)
    triples = drawn.groupBy("unique_scene", F.floor(F.col("_rn") / 3).cast("int").alias("t")).agg(F.array_sort(F.collect_list(F.struct("_rn", *_AXES))).alias("p")).where(F.size("p") == 3)
    u, v = ([F.col("p")[i][a] - F.col("p")[0][a] for a in _AXES] for i in (1, 2))
    normal = {"nx": u[1] * v[2] - u[2] * v[1], "ny": u[2] * v[0] - u[0] * v[2], "nz": u[0] * v[1] - u[1] * v[0]}
    length = F.sqrt(F.col("nx") * F.col("nx") + F.col("ny") * F.col("ny") + F.col("nz") * F.col("nz"))
    planes = triples.select("unique_scene", "t", "p", *(n.alias(c) for c, n in normal.items())).withColumn("_l", length).where("_l > 1e-10")
    planes = planes.select("unique_scene", "t", "p", *((F.col(c) / F.col("_l")).alias(c) for c in normal)).where(F.abs("nz") >= least_nz)
    offset = -(F.col("nx") * F.col("p")[0]["x"] + F.col("ny") * F.col("p")[0]["y"] + F.col("nz") * F.col("p")[0]["z"])
    planes = planes.select("unique_scene", F.struct("t", *normal, offset.alias("d")).alias("plane"))
    on = lambda p: F.abs(F.col("x") * p["nx"] + F.col("y") * p["ny"] + F.col("z") * p["nz"] + p["d"]) <= near
    lists = planes.groupBy("unique_scene").agg(F.collect_list("plane").alias("_p"))
    held = points.select("unique_scene", *_AXES).join(lists, "unique_scene").select("unique_scene", F.explode(F.filter("_p", on)).alias("plane")).groupBy("unique_scene", "plane").agg(F.count("*").alias("n"))
    best = held.groupBy("unique_scene").agg(F.max_by("plane", F.struct("n", -F.col("plane.t"))).alias("_plane"), F.max("n").alias("_n"))
    size = points.groupBy("unique_scene").agg(F.count("*").alias("_all"))
    met = points.join(best.join(size, "unique_scene").where(F.col("_n") >= F.greatest(F.lit(3), F.rint(least_share * F.col("_all")))), "unique_scene", "left")
    return met.withColumn("is_plane", F.coalesce(on(F.col("_plane")), F.lit(False))).drop("_plane", "_n", "_all")


def remove_ground(planed: DataFrame) -> DataFrame:
    """The points off the plane, or all of a scene's points if none is off it, with used_fallback."""
    fallback = planed.groupBy("unique_scene").agg(F.min("is_plane").alias("used_fallback"))
    return planed.join(fallback, "unique_scene").where("used_fallback or not is_plane").drop("is_plane")


def _runs(masks: DataFrame) -> DataFrame:
    w = Window.partitionBy("unique_scene", "cls", "row_idx").orderBy("col_idx")
    island = F.col("col_idx") - F.row_number().over(w)
    return masks.withColumn("_i", island).groupBy("unique_scene", "cls", "row_idx", "_i").agg(F.min("col_idx").alias("a"), F.max("col_idx").alias("b")).drop("_i")


def _label_runs(runs: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """Labels one image's runs (row, a, b), in order: those of neighbouring rows that touch, corners included, share the place of their first run
    and the number of their pixels."""
    root = list(range(len(runs)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    above = 0
    for i, (row, a, b) in enumerate(runs):
        while runs[above][0] < row - 1 or (runs[above][0] == row - 1 and runs[above][2] < a - 1):
            above += 1
        j = above
        while j < i and runs[j][0] == row - 1 and runs[j][1] <= b + 1:
            p, q = sorted((top(i), top(j)))
            root[q] = p
            j += 1
    tops = [top(i) for i in range(len(runs))]
    size = [0] * len(runs)
    for t, (_, a, b) in zip(tops, runs, strict=True):
        size[t] += b - a + 1
    return [(*run, runs[t][0], runs[t][1], size[t]) for t, run in zip(tops, runs, strict=True)]


def _labelled(batches):
    """For mapInArrow over runs sorted by scene, class, strip, row and column; one strip's runs are held at a time."""
    names, at, held, schema = ["unique_scene", "cls", "row_idx", "a", "b", "first_row", "first_col", "area"], None, [], None

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [schema.field(0).type, schema.field(1).type, *[pa.int64()] * 6]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

    for batch in batches:
        schema, rows = batch.schema, []
        for scene, cls, strip, *run in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            if (scene, cls, strip) != at:
                rows += [(*at[:2], *r) for r in _label_runs(held)] if held else []
                at, held = (scene, cls, strip), []
            held.append(tuple(run))
        yield table(rows)
    if held:
        yield table([(*at[:2], *r) for r in _label_runs(held)])


def _touching(runs: DataFrame, height: int, width: int = 1024) -> DataFrame:
    """(unique_scene, cls, a, b): the components of neighbouring strips that touch, corners included; runs of the two rows at a border meet by the columns
    of `width` pixels that they pass through."""
    column = lambda low, high: F.explode(F.sequence(F.floor(low / width), F.floor(high / width)))
    upper = runs.where((F.col("row_idx") + 1) % height == 0).select("unique_scene", "cls", (F.col("row_idx") + 1).alias("row_idx"), F.col("a").alias("_a"), F.col("b").alias("_b"), F.col("part").alias("_part"), column(F.col("a") - 1, F.col("b") + 1).alias("_c"))
    lower = runs.where(F.col("row_idx") % height == 0).select("unique_scene", "cls", "row_idx", "a", "b", "part", column(F.col("a"), F.col("b")).alias("_c"))
    met = lower.join(upper, ["unique_scene", "cls", "row_idx", "_c"]).where("_a <= b + 1 and a <= _b + 1")
    return met.select("unique_scene", "cls", F.col("part").alias("a"), F.col("_part").alias("b")).distinct()


def components(masks: DataFrame, strip: int = 512) -> DataFrame:
    """The runs of each class mask (unique_scene, cls, row_idx, a to b) with the 8-connected component they belong to, named by its first pixel in row
    order (first_row, first_col), and its area. Pixels become runs in Spark, runs of `strip` rows are labelled by one task, and components that touch
    across strips are joined by their least, so that an image of any height is the work of many tasks. Rows and columns lie in -2**31 .. 2**31 - 1."""
    runs = _runs(masks.select("unique_scene", "cls", F.col("row_idx").cast("bigint").alias("row_idx"), F.col("col_idx").cast("bigint").alias("col_idx")).distinct())
    types, keys = dict(runs.dtypes), ["unique_scene", "cls"]
    schema = ", ".join(f"{c} {types[c]}" for c in (*keys, "row_idx", "a", "b")) + ", first_row bigint, first_col bigint, area bigint"
    ordered = [*keys, "strip", "row_idx", "a", "b"]
    dealt = runs.withColumn("strip", F.floor(F.col("row_idx") / strip)).select(*ordered).repartition(*ordered[:3]).sortWithinPartitions(*ordered[:5])
    labelled = dealt.mapInArrow(_labelled, schema)
    tall = masks.agg(F.min(F.floor(F.col("row_idx") / strip)).alias("low"), F.max(F.floor(F.col("row_idx") / strip)).alias("high")).first()
    if tall.low == tall.high:
        return labelled
    part = F.shiftleft("first_row", 32) + F.col("first_col") + (1 << 31)  # in the order of rows, then columns
    labelled = materialize(labelled.withColumn("part", part))
    whole = least_reachable(_touching(labelled, strip), keys)
    named = labelled.select(*keys, "part", "area").distinct().join(whole.withColumnRenamed("node", "part"), [*keys, "part"], "left").withColumn("least", F.coalesce("least", "part"))
    named = named.join(named.groupBy(*keys, "least").agg(F.sum("area").alias("_all")), [*keys, "least"])
    joined = labelled.join(named.select(*keys, "part", "least", "_all"), [*keys, "part"])
    first_col = F.col("least").bitwiseAND((1 << 32) - 1) - (1 << 31)
    return joined.select(*keys, "row_idx", "a", "b", F.shiftright("least", 32).alias("first_row"), first_col.alias("first_col"), F.col("_all").alias("area"))


def min_area_components(masks: DataFrame, least: int) -> DataFrame:
    """The pixels (unique_scene, cls, row_idx, col_idx) of components of at least that many pixels."""
    large = components(masks).where(F.col("area") >= least)
    return large.select("unique_scene", "cls", "row_idx", F.explode(F.sequence("a", "b")).alias("col_idx"))


def _turned(vector: list[Column], rotation: Column, back: bool = False) -> list[Column]:
    """The vector times the rotation, an array of nine row by row, or times its transpose."""
    return [sum((vector[i] * F.get(rotation, 3 * j + i if back else 3 * i + j) for i in range(1, 3)), vector[0] * F.get(rotation, 3 * j if back else j)) for j in range(3)]


def fit_box(points: DataFrame, specs: DataFrame, grow: float = 1.0, many: int = 40) -> DataFrame:
    """Boxes (unique_scene, box_key, cx .. hz, rotation) whose points (unique_scene, box_key, x, y, z) moved and sized them in their own axes: from the 5th to
    the 95th percentile of `many` points or more, between the ends of fewer; under three points, reason is too_few_points and the box stays."""
    key = ["unique_scene", "box_key"]
    met = points.join(specs.select(*key, "cx", "cy", "cz", "rotation"), key)
    local = _turned([F.col(a) - F.col(f"c{a}") for a in _AXES], F.col("rotation"))
    met = met.select(*key, *(v.alias(f"l{a}") for v, a in zip(local, _AXES, strict=True)))
    ends = [f for a in _AXES for f in (F.percentile(f"l{a}", F.array(F.lit(0.05), F.lit(0.95))).alias(f"q{a}"), F.array(F.min(f"l{a}"), F.max(f"l{a}")).alias(f"e{a}"))]
    stats = met.groupBy(*key).agg(F.count("*").alias("n_points"), *ends)
    fitted = specs.join(stats, key, "left").withColumn("n_points", F.coalesce("n_points", F.lit(0)))
    use = F.col("n_points") >= 3
    end = {a: F.when(F.col("n_points") >= many, F.col(f"q{a}")).otherwise(F.col(f"e{a}")) for a in _AXES}
    moved = _turned([(end[a][0] + end[a][1]) * 0.5 for a in _AXES], F.col("rotation"), back=True)
    half = {f"h{a}": F.when(use, F.greatest((end[a][1] - end[a][0]) * 0.5 * grow, F.lit(1e-3))).otherwise(F.col(f"h{a}")) for a in _AXES}
    centre = {f"c{a}": F.when(use, F.col(f"c{a}") + m).otherwise(F.col(f"c{a}")) for a, m in zip(_AXES, moved, strict=True)}
    return fitted.withColumns({**centre, **half, "reason": F.when(use, "ok").otherwise("too_few_points")}).drop(*(f"{p}{a}" for p in "qe" for a in _AXES))


def _orthonormal(m: np.ndarray) -> np.ndarray:
    """The nearest rotations to n x 3 x 3 matrices."""
    u, _, vt = np.linalg.svd(m)
    u[:, :, 2] *= np.sign(np.linalg.det(u @ vt))[:, None]
    return u @ vt


@F.pandas_udf(ArrayType(DoubleType()))
def nearest_rotation(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """The nearest rotation to each 3 x 3 matrix, arrays of nine row by row."""
    for s in parts:
        found = _orthonormal(np.array(s.tolist(), dtype=float).reshape(-1, 3, 3)).reshape(-1, 9)
        yield pd.Series(list(found), index=s.index, dtype=object)


def _product(a: Column, b: Column, transposed: bool = False) -> Column:
    """a times b, or a transposed times b."""
    return F.array(*(sum((F.get(a, 3 * k + i if transposed else 3 * i + k) * F.get(b, 3 * k + j) for k in range(1, 3)), F.get(a, i if transposed else 3 * i) * F.get(b, j)) for i in range(3) for j in range(3)))


def propagate_edits(specs: DataFrame, edited: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """The boxes (bag_stem, unique_scene, box_key, cx .. hz, rotation) that change when each box of an edited scene (bag_stem, unique_scene, box_key, the
    same columns) passes on its shift, ratio of sizes and turn to the boxes of that key in all scenes of its recording. A recording has at most one edited
    scene."""
    names = [f"{p}{a}" for p in "ch" for a in _AXES]
    base = specs.select("unique_scene", "box_key", *(F.col(c).alias(f"_{c}") for c in (*names, "rotation")))
    change = edited.join(base, ["unique_scene", "box_key"]).select("bag_stem", "box_key", *((F.col(f"c{a}") - F.col(f"_c{a}")).alias(f"d{a}") for a in _AXES), *(F.greatest(F.col(f"h{a}") / F.greatest(F.abs(f"_h{a}"), F.lit(1e-9)), F.lit(1e-6)).alias(f"s{a}") for a in _AXES), nearest_rotation(_product(F.col("_rotation"), F.col("rotation"), True)).alias("turn"))
    met = specs.join(change, ["bag_stem", "box_key"])
    new = {**{f"c{a}": F.col(f"c{a}") + F.col(f"d{a}") for a in _AXES}, **{f"h{a}": F.greatest(F.col(f"h{a}") * F.col(f"s{a}"), F.lit(1e-6)) for a in _AXES}}
    moved = met.select("bag_stem", "unique_scene", "box_key", *(v.alias(c) for c, v in new.items()), nearest_rotation(_product(F.col("rotation"), F.col("turn"))).alias("rotation"), F.struct(*names, "rotation").alias("_old"))
    differs = F.exists(F.zip_with("rotation", "_old.rotation", lambda a, b: F.abs(a - b)), lambda d: d > tolerance)
    for c in names:
        differs = differs | (F.abs(F.col(c) - F.col(f"_old.{c}")) > tolerance)
    return moved.where(differs).drop("_old")


def rigid_fit(pairs: DataFrame) -> DataFrame:
    """(unique_scene, n_pairs, rotation, tx, ty, tz) that best takes local points (lx, ly, lz) to world points (x, y, z) in each scene of two pairs or more.
    Spark sums the means and products; only the 3 x 3 decomposition runs in a task's numpy."""
    both = [*(f"l{a}" for a in _AXES), *_AXES]
    means = pairs.groupBy("unique_scene").agg(F.count("*").alias("n_pairs"), *(F.avg(c).alias(f"m{c}") for c in both)).where("n_pairs >= 2")
    off = lambda c: F.col(c) - F.col(f"m{c}")
    cross = pairs.join(means, "unique_scene").groupBy("unique_scene", "n_pairs", *(f"m{c}" for c in both)).agg(F.array(*(F.sum(off(a) * off(f"l{b}")) for a in _AXES for b in _AXES)).alias("h"))
    fitted = cross.withColumn("rotation", nearest_rotation("h"))
    shift = _turned([F.col(f"ml{a}") for a in _AXES], F.col("rotation"), back=True)
    return fitted.select("unique_scene", "n_pairs", "rotation", *((F.col(f"m{a}") - s).alias(f"t{a}") for a, s in zip(_AXES, shift, strict=True)))
