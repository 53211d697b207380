"""Boxes turned with their scene, front boxes and their checks, rolls, truth points from labels, label variants, keypoint markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyweave.functions import labels as lines
from skyweave.functions.pixels import euler_xyz, in_frame
from skyweave.operators.oriented import rotation_of
from skyweave.operators.projection import sample_xyz_robust
from skyweave.operators.regions import _product, _turned
from skyweave.operators.scenes import largest_empty_gap, wrap_aware_bbox

_AXES = ("x", "y", "z")
FRONT_WHEELS = ("plane_front_left_wheel_link", "plane_front_right_wheel_link")


def turn_boxes(poses: DataFrame, boxes: DataFrame, scale: float = 1.0, least_half: float = 0.25) -> DataFrame:
    """The boxes of each scene's profile in the world: poses have unique_scene, profile, rotation (array of nine, row by row, local to world) and tx, ty,
    tz; boxes have profile, name, x .. z, angles rx .. rz and sizes sx .. sz. Gives box_key, centre, half sizes and rotation."""
    met = poses.join(boxes.withColumn("_own", euler_xyz(F.col("rx"), F.col("ry"), F.col("rz"))), "profile")
    centre = _turned([F.col(a) for a in _AXES], F.col("rotation"), back=True)
    half = [F.greatest(F.lit(least_half), 0.5 * F.abs(f"s{a}")) * scale for a in _AXES]
    placed = [(c + F.col(f"t{a}")).alias(f"c{a}") for c, a in zip(centre, _AXES, strict=True)]
    return met.select("unique_scene", F.col("name").alias("box_key"), *placed, *(h.alias(f"h{a}") for h, a in zip(half, _AXES, strict=True)), _product(F.col("rotation"), F.col("_own")).alias("rotation"))


def valid_keypoints(kps: DataFrame) -> DataFrame:
    """The keypoints whose point is finite; one without a name is named k and its place."""
    finite = F.lit(True)
    for a in _AXES:
        finite = finite & F.coalesce(F.abs(a) < float("inf"), F.lit(False))
    return kps.where(finite).withColumn("kp_name", F.coalesce(F.nullif(F.trim("kp_name"), F.lit("")), F.concat(F.lit("k"), F.col("kp_idx").cast("string"))))


def _middle(kps: DataFrame, first: str, second: str) -> DataFrame:
    """(unique_scene, m): the middle of two keypoints, of scenes that have both."""
    at = [F.max(F.when(F.col("kp_name") == n, F.struct(*_AXES))).alias(c) for n, c in ((first, "a"), (second, "b"))]
    wide = kps.where(F.col("kp_name").isin(first, second)).groupBy("unique_scene").agg(*at).dropna()
    return wide.select("unique_scene", F.struct(*((0.5 * (F.col(f"a.{k}") + F.col(f"b.{k}"))).alias(k) for k in _AXES)).alias("m"))


def front_midpoint(kps: DataFrame, boxes: DataFrame, nose: tuple[str, ...], wheels: tuple[str, str] = FRONT_WHEELS) -> DataFrame:
    """(unique_scene, x, y, z, source): the front point of each scene: its front box's centre (boxes: unique_scene, cx, cy, cz), else its nose keypoint, the
    first of these names, else the middle of its front wheels. Scenes with none have no row."""
    place = F.array_position(F.array(*map(F.lit, nose)), F.col("kp_name"))
    noses = kps.where(F.col("kp_name").isin(*nose)).groupBy("unique_scene").agg(F.min_by(F.struct(*_AXES), place).alias("n"))
    front = boxes.select("unique_scene", F.struct(*(F.col(f"c{a}").alias(a) for a in _AXES)).alias("f"))
    met = kps.select("unique_scene").distinct().join(front, "unique_scene", "left").join(noses, "unique_scene", "left").join(_middle(kps, *wheels), "unique_scene", "left")
    source = F.when(F.col("f").isNotNull(), "box").when(F.col("n").isNotNull(), "nose").when(F.col("m").isNotNull(), "wheels")
    return met.select("unique_scene", F.coalesce("f", "n", "m").alias("_point"), source.alias("source")).where("_point is not null").select("unique_scene", "_point.*", "source")


def derived_nose_specs(kps: DataFrame, half: float = 1.0) -> DataFrame:
    """An upright box (unique_scene, cx .. hz) about the middle of the front wheels, of scenes that have both."""
    return _middle(kps, *FRONT_WHEELS).select("unique_scene", *(F.col(f"m.{a}").alias(f"c{a}") for a in _AXES), *(F.lit(half).alias(f"h{a}") for a in _AXES))


def _against(point: list[Column], prefix: str = "") -> dict[str, Column]:
    """Distances from a box's centre by its axes, whether inside, and how far outside."""
    away = [F.abs(v) for v in in_frame([p - F.col(f"{prefix}c{a}") for p, a in zip(point, _AXES, strict=True)], F.col(f"{prefix}rotation"))]
    half = [F.col(f"{prefix}h{a}") for a in _AXES]
    over = [F.greatest(d - h, F.lit(0.0)) for d, h in zip(away, half, strict=True)]
    inside = (away[0] <= half[0] + 1e-6) & (away[1] <= half[1] + 1e-6) & (away[2] <= half[2] + 1e-6)
    return {"inside": inside, "outside": F.sqrt(over[0] * over[0] + over[1] * over[1] + over[2] * over[2]), **{f"a{a}": d for a, d in zip(_AXES, away, strict=True)}, **{f"h{a}": h for a, h in zip(_AXES, half, strict=True)}}


def _checked(rows: DataFrame) -> DataFrame:
    """Rows with a struct k (box_key, inside, outside, ax .. hz) as checks."""
    return rows.select("unique_scene", "kp_name", "k.box_key", "k.inside", *(f"k.{p}{a}" for p in "ah" for a in _AXES))


def _struct(key: str, prefix: str) -> Column:
    return F.struct(F.lit(key).alias("box_key"), *(v.alias(n) for n, v in _against([F.col(a) for a in _AXES], prefix).items()))


def derived_nose_remap(checks: DataFrame, kps: DataFrame, derived: DataFrame) -> DataFrame:
    """The checks, those of the front box moved to the derived nose box (unique_scene, cx .. hz) where the keypoint is strictly closer to it; scenes without
    a derived box keep theirs."""
    named = derived.select("unique_scene", *(F.col(f"{p}{a}").alias(f"_{p}{a}") for p in "ch" for a in _AXES), rotation_of(derived).alias("_rotation"))
    met = checks.join(kps.select("unique_scene", "kp_name", *_AXES), ["unique_scene", "kp_name"], "left").join(named, "unique_scene", "left")
    over = [F.greatest(F.col(f"a{a}") - F.col(f"h{a}"), F.lit(0.0)) for a in _AXES]
    now = F.struct("box_key", "inside", F.sqrt(over[0] * over[0] + over[1] * over[1] + over[2] * over[2]).alias("outside"), *(f"{p}{a}" for p in "ah" for a in _AXES))
    new = _struct("derived_nose_gear", "_")
    moves = (F.col("box_key") == "front_landing_gear") & F.col("_cx").isNotNull() & (new["outside"] < now["outside"])
    return _checked(met.withColumn("k", F.when(moves, new).otherwise(now)))


def ensure_front_check(checks: DataFrame, kps: DataFrame, front: DataFrame, derived: DataFrame) -> DataFrame:
    """The checks, and one for each front-like keypoint (front or nose in its name) without a front check, against the nearer of its scene's front and
    derived boxes (unique_scene, cx .. hz), the front one on ties."""
    named = lambda df, p: df.select("unique_scene", *(F.col(f"{c}{a}").alias(f"{p}{c}{a}") for c in "ch" for a in _AXES), rotation_of(df).alias(f"{p}rotation"))
    have = checks.where(F.col("box_key").isin("front_landing_gear", "derived_nose_gear")).select("unique_scene", "kp_name").distinct()
    low = F.lower("kp_name")
    missing = kps.where(low.contains("front") | low.contains("nose")).select("unique_scene", "kp_name", *_AXES).join(have, ["unique_scene", "kp_name"], "left_anti")
    met = missing.join(named(front, "_f"), "unique_scene", "left").join(named(derived, "_d"), "unique_scene", "left")
    f, d = _struct("front_landing_gear", "_f"), _struct("derived_nose_gear", "_d")
    take = F.when(F.col("_fcx").isNotNull() & (F.col("_dcx").isNull() | (f["outside"] <= d["outside"])), f).when(F.col("_dcx").isNotNull(), d)
    added = _checked(met.withColumn("k", take).where("k is not null"))
    return checks.select(added.columns).unionByName(added)


def pick_front_box(boxes: DataFrame, level: int) -> DataFrame:
    """One row per profile (name, warning_level, x .. sz): its front box at the warning level, else at the highest lower one. At a level an unsided box
    comes first, then the middle of a left and right pair, the one closest to the centreline, then a sided box; the first by name on ties."""
    low = F.lower("name")
    front = boxes.where(low.contains("front_landing_gear") | low.contains("landing_gear_front") | low.contains("nose_gear") | low.contains("front_gear"))
    front = front.where((F.col("warning_level") <= level) & (F.col("warning_level") >= 0))
    sizes = [*_AXES, *(f"s{a}" for a in _AXES)]
    side = F.when(low.contains("left"), "left").when(low.contains("right"), "right")
    single = front.select("profile", low.alias("name"), "warning_level", *sizes, F.when(side.isNull(), 0).otherwise(2).alias("tier"))
    of = lambda s: F.max(F.when(F.col("side") == s, F.struct(*sizes))).alias(s)
    sided = front.withColumn("side", side).withColumn("base", F.regexp_replace(low, "_(left|right)$", "")).groupBy("profile", "warning_level", "base").agg(of("left"), of("right")).dropna()
    pairs = sided.select("profile", F.concat("base", F.lit("_center")).alias("name"), "warning_level", *((0.5 * (F.col(f"left.{c}") + F.col(f"right.{c}"))).alias(c) for c in sizes), F.lit(1).alias("tier"))
    w = Window.partitionBy("profile").orderBy(F.desc("warning_level"), "tier", F.when(F.col("tier") == 1, F.abs("y")).otherwise(0.0), "name")
    return single.unionByName(pairs).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "tier")


def box_keypoints(specs: DataFrame, keys: tuple[str, ...] = ("front_landing_gear", "engine_left", "engine_right")) -> DataFrame:
    """The centres of each scene's boxes of these keys, as keypoints (unique_scene, kp_name, x, y, z)."""
    return specs.where(F.col("box_key").isin(*keys)).select("unique_scene", F.col("box_key").alias("kp_name"), *(F.col(f"c{a}").alias(a) for a in _AXES))


def export_roll(px: DataFrame, width: int, wide: float = 0.9, columns: int = 512, mask: str = "is_aircraft") -> DataFrame:
    """(unique_scene, roll, signed): by how many columns a scene's image is rolled: by the roll that narrows its mask's box, and, if the box still takes
    more than that share of the width, to the middle of the largest gap, else by `columns`. signed is at most half the width either way."""
    first = wrap_aware_bbox(px, width, mask).select("unique_scene", F.col("roll").alias("_r1"), ((F.col("x2") - F.col("x1") + 1) / F.lit(width)).alias("_share"))
    rolled = px.join(first.where(F.col("_share") > wide), "unique_scene").withColumn("col_idx", F.pmod(F.col("col_idx") + F.col("_r1"), F.lit(width)))
    second = largest_empty_gap(rolled, width, mask).select("unique_scene", F.when(F.col("roll") == 0, columns % width).otherwise(F.col("roll")).alias("_r2"))
    roll = F.pmod(F.col("_r1") + F.coalesce("_r2", F.lit(0)), F.lit(width)).cast("int")
    out = first.join(second, "unique_scene", "left").select("unique_scene", roll.alias("roll"))
    return out.withColumn("signed", F.when(F.col("roll") > width // 2, F.col("roll") - width).otherwise(F.col("roll")))


def gt_3d_from_2d(scenes: DataFrame, labels: DataFrame, px: DataFrame, names: list[str], width: int, height: int, radius: int = 2) -> DataFrame:
    """One row per scene and keypoint name: the point under the scene's label keypoint (labels: unique_scene, l, one per scene) and status: ok,
    scene_xyz_unavailable, label_not_found, kp_missing_in_label, kp_not_visible or xyz_not_found."""
    wanted = scenes.select("unique_scene", F.posexplode(F.array(*map(F.lit, names))).alias("kp_idx", "kp_name"))
    known = px.groupBy("unique_scene").agg(F.lit(True).alias("_px"))
    met = wanted.join(labels.select("unique_scene", F.lit(True).alias("_has"), "l.kps"), "unique_scene", "left").join(known, "unique_scene", "left")
    k = F.get("kps", F.col("kp_idx"))
    met = met.withColumn("_k", k).withColumn("c", F.rint(F.col("_k.x") * (width - 1)).cast("int")).withColumn("r", F.rint(F.col("_k.y") * (height - 1)).cast("int"))
    seen = met.where("_k.v > 0").select("unique_scene", "kp_name", "r", "c")
    found = sample_xyz_robust(seen, px, radius).select("unique_scene", "kp_name", "p")
    status = F.when(F.col("_px").isNull(), "scene_xyz_unavailable").when(F.col("_has").isNull(), "label_not_found").when(F.col("_k").isNull(), "kp_missing_in_label")
    status = status.when(F.col("_k.v") <= 0, "kp_not_visible").when(F.col("p").isNull(), "xyz_not_found").otherwise("ok")
    return met.join(found, ["unique_scene", "kp_name"], "left").select("unique_scene", "kp_name", "kp_idx", "r", "c", "p.x", "p.y", "p.z", status.alias("status"))


def label_variants(labels: DataFrame, rolls: list[int], scales: list[float], shifts: list[int], width: int, height: int) -> DataFrame:
    """Each label l of a stem once per variant, those that change nothing left out, with the stem's suffix: `_roll8`, `_scale0p90`, `_vshiftp2`."""
    variants = [(f"_roll{r % width}", lines.augment_roll(F.col("l"), r % width, width)) for r in rolls if r % width]
    variants += [(f"_scale{s:.2f}".replace(".", "p"), lines.augment_scale(F.col("l"), s)) for s in scales if abs(s - 1) >= 1e-3]
    variants += [(f"_vshift{'p' if d > 0 else 'm'}{abs(d)}", lines.augment_vshift(F.col("l"), d, height)) for d in shifts if d]
    made = F.array(*(F.struct(F.concat("stem", F.lit(suffix)).alias("stem"), label.alias("l")) for suffix, label in variants))
    rest = [c for c in labels.columns if c not in ("stem", "l")]
    return labels.select(*rest, F.explode(made).alias("k")).select(*rest, "k.stem", "k.l")


def marker_points(points: DataFrame, size: float = 0.22) -> DataFrame:
    """Each point and its neighbours at that distance along the axes and the diagonals of their planes, 19 in all, so that it shows in a dense cloud."""
    steps = F.sequence(F.lit(-1), F.lit(1))
    spread = points
    for a in _AXES:
        spread = spread.withColumn(f"_{a}", F.explode(steps))
    near = F.abs("_x") + F.abs("_y") + F.abs("_z") <= 2
    return spread.where(near).withColumns({a: F.col(a) + size * F.col(f"_{a}") for a in _AXES}).drop(*(f"_{a}" for a in _AXES))
