"""Boxes in images and scenes: derived and edited boxes, suggestions for missing ones, choice of a source, classes of points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyweave.functions.boxes2d import center_px, clip_xywhn
from skyweave.operators.oriented import inside_boxes

CORNERS = ("x1", "y1", "x2", "y2")


def boxes_from_keypoints(labels: DataFrame, parts: list[tuple[int, int, float, float]], width: int, height: int) -> DataFrame:
    """Boxes (cls, cx, cy, w, h) of each parsed label l: its own box as class 0, and for each part (class, keypoint, half width and half height in
    pixels) a box about the keypoint if it is visible. All are cut to the image; empty ones go."""
    box = lambda cls, when, *b: F.struct(F.lit(cls).alias("cls"), F.when(when, clip_xywhn(*b)).alias("b"))
    boxes = [box(0, F.lit(True), *(F.col(f"l.{c}") for c in ("cx", "cy", "w", "h")))]
    for cls, place, half_w, half_h in parts:
        k = F.get(F.col("l.kps"), place)
        boxes.append(box(cls, k["v"] > 0, k["x"], k["y"], F.lit(2 * half_w / width), F.lit(2 * half_h / height)))
    rest = [c for c in labels.columns if c != "l"]
    return labels.select(*rest, F.explode(F.array(*boxes)).alias("k")).where("k.b is not null").select(*rest, "k.cls", "k.b.*")


def edit_boxes(boxes: DataFrame, changes: dict[int, tuple[float, float, float]], every: tuple[float, float, float] = (1.0, 0.0, 0.0)) -> DataFrame:
    """Normalised boxes (cls, cx, cy, w, h) scaled and shifted by `every` (scale, shift x, shift y) and by their class's changes on top, cut to the
    image; boxes of scale 0 or less, or with nothing left, go."""

    def by_class(i: int, neutral: float) -> Column:
        out = F.lit(neutral)
        for cls, change in changes.items():
            out = F.when(F.col("cls") == cls, float(change[i])).otherwise(out)
        return out

    scale, dx, dy = every[0] * by_class(0, 1.0), every[1] + by_class(1, 0.0), every[2] + by_class(2, 0.0)
    edited = boxes.where(scale > 0).withColumn("_b", clip_xywhn(F.col("cx") + dx, F.col("cy") + dy, F.col("w") * scale, F.col("h") * scale))
    return edited.where("_b is not null").select(*(F.col(f"_b.{c}").alias(c) if c in ("cx", "cy", "w", "h") else F.col(c) for c in boxes.columns))


def _fitted(corners: list[Column], width: int, height: int, least: float = 2.0) -> Column:
    """Corners put in order and cut to the image, regrown about the middle to the least size; null if nothing is left."""
    out = {}
    for i, (a, b, n) in enumerate(((corners[0], corners[2], width), (corners[1], corners[3], height))):
        end = F.lit(float(n - 1))
        low, high = (F.least(F.greatest(v, F.lit(0.0)), end) for v in (F.least(a, b), F.greatest(a, b)))
        small, middle = high - low < least, (low + high) * 0.5
        out[CORNERS[i]] = F.when(small, F.greatest(middle - least / 2, F.lit(0.0))).otherwise(low)
        out[CORNERS[i + 2]] = F.when(small, F.least(middle + least / 2, end)).otherwise(high)
    return F.when((out["x2"] > out["x1"]) & (out["y2"] > out["y1"]), F.struct(*(out[c].alias(c) for c in CORNERS)))


def _largest(boxes: DataFrame, classes: dict[str, int]) -> DataFrame:
    """One row per image with the largest box of each class as a struct, the first by det_idx on ties."""
    area = F.greatest(F.col("x2") - F.col("x1"), F.lit(0.0)) * F.greatest(F.col("y2") - F.col("y1"), F.lit(0.0))
    pick = lambda k: F.max_by(F.when(F.col("cls") == k, F.struct(*CORNERS)), F.when(F.col("cls") == k, F.struct(area, -F.col("det_idx"))))
    return boxes.groupBy("unique_scene").agg(*(pick(k).alias(n) for n, k in classes.items()))


def suggest_missing_engine(boxes: DataFrame, width: int, height: int, aircraft: int = 0, left: int = 1, right: int = 2) -> DataFrame:
    """For images with an aircraft and boxes of one engine side only: a box of the other side, the largest box mirrored about the aircraft's middle."""
    wide = _largest(boxes, {"a": aircraft, "l": left, "r": right}).where("a is not null and (l is null) <> (r is null)")
    source, axis = F.coalesce("l", "r"), F.col("a.x1") + F.col("a.x2")
    box = _fitted([axis - source["x2"], source["y1"], axis - source["x1"], source["y2"]], width, height)
    return wide.select("unique_scene", F.when(F.col("l").isNull(), left).otherwise(right).alias("cls"), box.alias("b")).where("b is not null").select("unique_scene", "cls", "b.*")


def suggest_front_gear(boxes: DataFrame, width: int, height: int, dx: float, dy: float, w: float, h: float, left: int = 1, right: int = 2, front: int = 3) -> DataFrame:
    """For images with both engines and no front gear: its box, placed dx engine spans and dy engine heights from the engines' middle, w and h times the
    engines' mean size."""
    wide = _largest(boxes, {"l": left, "r": right, "f": front}).where("l is not null and r is not null and f is null")
    middle = lambda k: ((F.col(f"l.{k}1") + F.col(f"l.{k}2")) * 0.5, (F.col(f"r.{k}1") + F.col(f"r.{k}2")) * 0.5)
    (lx, rx), (ly, ry) = middle("x"), middle("y")
    extent = lambda k: F.greatest(sum(F.greatest(F.col(f"{s}.{k}2") - F.col(f"{s}.{k}1"), F.lit(2.0)) for s in "lr") * 0.5, F.lit(2.0))
    x = (lx + rx) * 0.5 + dx * F.greatest(F.abs(rx - lx), F.lit(2.0))
    y = (ly + ry) * 0.5 + dy * extent("y")
    bw, bh = F.greatest(w * extent("x"), F.lit(2.0)), F.greatest(h * extent("y"), F.lit(2.0))
    box = _fitted([x - 0.5 * bw, y - 0.5 * bh, x + 0.5 * bw, y + 0.5 * bh], width, height)
    return wide.select("unique_scene", F.lit(front).alias("cls"), box.alias("b")).where("b is not null").select("unique_scene", "cls", "b.*")


def normalize_engine_sides(wide: DataFrame) -> DataFrame:
    """Rows with structs aircraft, left, right (x1 .. y2, the sides may be null) and left_conf, right_conf: the sides ordered by middle x where both
    stand, a single one moved to its side of the aircraft's middle; reason tells what was done."""
    at = lambda c: center_px(*(F.col(f"{c}.{k}") for k in CORNERS))[0]
    both = F.col("left").isNotNull() & F.col("right").isNotNull()
    reason = F.when(both & (at("left") > at("right")), "swap_both_by_x_order")
    reason = reason.when(F.col("right").isNull() & (at("left") > at("aircraft")), "move_single_left_to_right_by_aircraft_center")
    reason = reason.when(F.col("left").isNull() & (at("right") < at("aircraft")), "move_single_right_to_left_by_aircraft_center").otherwise("none")
    swap = reason != "none"  # a side that isn't there is null, so each move is a swap as well
    pick = lambda a, b: F.when(swap, F.col(b)).otherwise(F.col(a)).alias(a)
    new = [pick("left", "right"), pick("right", "left"), pick("left_conf", "right_conf"), pick("right_conf", "left_conf")]
    return wide.select(*(c for c in wide.columns if c not in ("left", "right", "left_conf", "right_conf")), *new, reason.alias("reason"))


def choose_source(candidates: DataFrame, least_recall: float = 0.92) -> DataFrame:
    """One row per scene: of the candidates (unique_scene, det_source, recall, n_engines, conf) the image, unless it is missing, has no engine or a
    recall under least_recall, and another has a greater (recall, n_engines, conf)."""
    score = F.struct(F.coalesce("recall", F.lit(-1.0)).alias("recall"), F.col("n_engines"), F.col("conf"))
    of = lambda image: F.max_by(F.struct("det_source", "recall", "n_engines", "conf"), F.when((F.col("det_source") == "image") == image, score))
    top = lambda image: F.max(F.when((F.col("det_source") == "image") == image, score))
    wide = candidates.groupBy("unique_scene").agg(of(True).alias("a"), of(False).alias("b"), top(True).alias("sa"), top(False).alias("sb"))
    retry = F.col("sa").isNull() | (F.col("a.n_engines") <= 0) | F.coalesce(F.col("a.recall") < least_recall, F.lit(False))
    other = retry & F.col("sb").isNotNull() & F.coalesce(F.col("sb") > F.col("sa"), F.lit(True))
    return wide.select("unique_scene", F.when(other, F.col("b")).otherwise(F.col("a")).alias("k")).select("unique_scene", "k.*")


def select_boxes(boxes: DataFrame, level: int, filters: list[str]) -> DataFrame:
    """A profile's boxes of that warning level, or all if it has none; of these the ones whose name holds a filter, if there are any."""
    w = Window.partitionBy("profile")
    leveled = boxes.withColumn("_any", F.max(F.col("warning_level") == level).over(w)).where(f"not _any or warning_level = {int(level)}")
    named = F.lit(False)
    for f in filters:
        named = named | F.lower("name").contains(f.strip().lower())
    return leveled.withColumn("_named", named).withColumn("_any", F.max("_named").over(w)).where("_named or not _any").drop("_named", "_any")


def pick_engine_pair(boxes: DataFrame) -> DataFrame:
    """One row per profile with its left and right engine box: by side in the name, else by the sign of y; the one farthest from the centreline, the
    first by name on ties."""
    name, low = F.col("name"), F.lower("name")
    side = F.when(low.contains("left"), "left").when(low.contains("right"), "right").when(F.col("y") > 0, "left").when(F.col("y") < 0, "right")
    engines = boxes.where(low.contains("engine")).withColumn("_s", side)
    pick = lambda s: F.min(F.when(F.col("_s") == s, F.struct((-F.abs("y")).alias("d"), name.alias("name")))).getField("name").alias(f"{s}_box")
    return engines.groupBy("profile").agg(pick("left"), pick("right"))


def box_corners(boxes: DataFrame) -> DataFrame:
    """The eight corners of each box (centre x, y, z, size sx, sy, sz, rotation an array of nine, row by row), numbered by their signs."""
    corners = boxes.withColumn("corner", F.explode(F.sequence(F.lit(0), F.lit(7))))
    sign = lambda i: F.when(F.col("corner").bitwiseAND(1 << i) == 0, -0.5).otherwise(0.5)
    local = [sign(i) * F.col(f"s{k}") for i, k in enumerate("xyz")]
    world = [F.col(k) + sum(F.get(F.col("rotation"), 3 * i + j) * local[j] for j in range(3)) for i, k in enumerate("xyz")]
    return corners.select(*(c for c in boxes.columns if c not in ("x", "y", "z", "sx", "sy", "sz", "rotation")), "corner", *(v.alias(k) for v, k in zip(world, "xyz", strict=True)))


def assign_box_class(px: DataFrame, boxes: DataFrame, aircraft: int | None = None, fill_only: bool = True) -> DataFrame:
    """Adds cls: of the boxes of its scene (unique_scene, cls, centre, half sizes and perhaps a rotation) that hold a pixel's point, the one in which it
    lies most central by the box's axes, the lowest class on ties, else 0. Aircraft pixels get the aircraft's class, only where it is 0 if fill_only."""
    score = F.greatest(*(F.col(f"_a{k}") / F.greatest(F.col(f"_h{k}"), F.lit(1e-9)) for k in "xyz"))
    keys = ["unique_scene", "row_idx", "col_idx"]
    best = inside_boxes(px.select(*keys, "x", "y", "z"), boxes, ["cls"]).groupBy(*keys).agg(F.min_by("cls", F.struct(score, "cls")).alias("cls"))
    cls = F.coalesce("cls", F.lit(0))
    if aircraft is not None:
        cls = F.when(F.col("is_aircraft") & ((cls == 0) | F.lit(not fill_only)), aircraft).otherwise(cls)
    return px.join(best, keys, "left").withColumn("cls", cls)


def expand_vertical(px: DataFrame, seeds: DataFrame, dz: float) -> DataFrame:
    """Points of each scene within its seeds' bounds in x and y, and within dz of them in z."""
    ends = seeds.groupBy("unique_scene").agg(*(f(k).alias(f"_{n}{k}") for k in "xyz" for n, f in (("a", F.min), ("b", F.max))))
    pad = {"x": 0.0, "y": 0.0, "z": max(0.0, dz)}
    near = [F.col(k).between(F.col(f"_a{k}") - p, F.col(f"_b{k}") + p) for k, p in pad.items()]
    return px.join(ends, "unique_scene").where(near[0] & near[1] & near[2]).select(px.columns)


def crop_bbox(px: DataFrame, boxes: DataFrame, exclude: DataFrame | None = None) -> DataFrame:
    """Pixels of each scene inside its box (x1 .. y2, bounds included) with a finite point, and in none of the excluded boxes."""
    held = F.col("col_idx").between(F.col("_x1"), F.col("_x2")) & F.col("row_idx").between(F.col("_y1"), F.col("_y2"))
    named = lambda df: df.select("unique_scene", *(F.col(c).alias(f"_{c}") for c in CORNERS))
    finite = ~(F.isnan("x") | F.isnan("y") | F.isnan("z"))
    inside = px.where(finite).join(named(boxes), "unique_scene").where(held).select(px.columns)
    if exclude is None:
        return inside
    other = named(exclude).withColumnRenamed("unique_scene", "_scene")
    return inside.join(other, [inside["unique_scene"] == other["_scene"], held], "left_anti")
