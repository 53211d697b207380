"""Pose, detection and polygon label lines, and edits of parsed labels, as column expressions.

A pose label is a struct cls, cx, cy, w, h, kps (an array of x, y, v) and error: null, or why the line can't be read; then the other fields
are null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyweave.functions.boxes2d import clip_swapped

_KP = "array<struct<x:double,y:double,v:int>>"


def _point(x: Column, y: Column, v: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"), v.cast("int").alias("v"))


def _once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of the value, which is computed once however often f reads it."""
    return F.get(F.transform(F.array(value), f), 0)


def _numbers(text: Column) -> Column:
    """The fields of a line as doubles, null where they are none."""
    return F.transform(F.filter(F.split(F.trim(text), r"\s+"), lambda t: t != ""), lambda t: t.try_cast("double"))


def parse_pose_line(text: Column) -> Column:
    """The pose label of a line."""
    return _once(_numbers(text), lambda numbers: _pose(text, numbers))


def _pose(text: Column, numbers: Column) -> Column:
    n = F.size(numbers)
    error = F.when(n < 5, "too few fields").when((n - 5) % 3 != 0, "broken keypoint triplets").when(F.exists(numbers, lambda x: x.isNull()), "not a number")
    good = F.coalesce(error.isNull() & text.isNotNull(), F.lit(False))
    at = lambda i: F.when(good, F.get(numbers, i))
    steps = F.when(good & (n > 5), F.sequence(F.lit(0), F.floor((n - 5) / 3).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    kps = F.transform(steps, lambda i: _point(F.get(numbers, 5 + 3 * i), F.get(numbers, 6 + 3 * i), F.get(numbers, 7 + 3 * i)))
    return F.struct(at(F.lit(0)).cast("int").alias("cls"), *(at(F.lit(i)).alias(k) for i, k in enumerate(("cx", "cy", "w", "h"), 1)), F.when(good, kps.cast(_KP)).alias("kps"), F.when(text.isNull(), "no line").otherwise(error).alias("error"))


def parse_pose_line_px(text: Column, width: Column | int, height: Column | int) -> Column:
    """A pose line in pixels, as a viewer reads it: struct cls, x1, y1, x2, y2 (whole pixels inside the image), kps (array of x, y, v) and error. Values up
    to 1 are shares of the image, greater ones pixels. Keypoints are triplets, else pairs, which are visible."""
    return _once(_numbers(text), lambda numbers: _pose_px(text, numbers, F.lit(width), F.lit(height)))


def _pose_px(text: Column, numbers: Column, width: Column, height: Column) -> Column:
    n = F.size(numbers)
    rest = n - 5
    error = F.when(n < 5, "too few fields").when((rest % 3 != 0) & (rest % 2 != 0), "keypoints are neither triplets nor pairs").when(F.exists(numbers, lambda x: x.isNull()), "not a number")
    good = F.coalesce(error.isNull() & text.isNotNull(), F.lit(False))
    px = lambda i, size: F.when(F.get(numbers, i) <= 1, F.get(numbers, i) * size).otherwise(F.get(numbers, i))
    cx, cy, w, h = (px(F.lit(i), size) for i, size in enumerate((width, height, width, height), 1))
    corners = clip_swapped(F.rint(cx - w / 2), F.rint(cy - h / 2), F.rint(cx + w / 2), F.rint(cy + h / 2), width, height)
    by = F.when(rest % 3 == 0, 3).otherwise(2)
    steps = F.when(good & (rest > 0), F.sequence(F.lit(0), F.floor(rest / by).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    kps = F.transform(steps, lambda i: F.struct(px(5 + by * i, width).alias("x"), px(6 + by * i, height).alias("y"), F.when(by == 3, F.get(numbers, 7 + by * i)).otherwise(1.0).alias("v")))
    at = lambda v: F.when(good, v)
    return F.struct(at(F.rint(F.get(numbers, 0)).cast("int")).alias("cls"), *(at(v).alias(k) for k, v in zip(("x1", "y1", "x2", "y2"), corners, strict=True)), at(kps).alias("kps"), F.when(text.isNull(), "no line").otherwise(error).alias("error"))


def format_pose_line(label: Column) -> Column:
    """The line of a pose label, six decimals; hidden keypoints are written as zeros. Null for a label with an error."""
    shown = lambda k: F.when(k["v"] > 0, F.format_string("%.6f %.6f %d", k["x"], k["y"], k["v"])).otherwise("0.000000 0.000000 0")
    head = F.format_string("%d %.6f %.6f %.6f %.6f", *(label[k] for k in ("cls", "cx", "cy", "w", "h")))
    return F.when(label["error"].isNull(), F.concat_ws(" ", F.concat(F.array(head), F.transform(label["kps"], shown))))


def parse_det_line(text: Column) -> Column:
    """Struct cls, cx, cy, w, h of a five-field line, else null."""
    good = lambda numbers: (F.size(numbers) == 5) & ~F.exists(numbers, lambda x: x.isNull())
    box = lambda numbers: F.struct(F.get(numbers, 0).cast("int").alias("cls"), *(F.get(numbers, i).alias(k) for i, k in enumerate(("cx", "cy", "w", "h"), 1)))
    return _once(_numbers(text), lambda numbers: F.when(good(numbers), box(numbers)))


def format_det_line(box: Column) -> Column:
    """The five-field line of a box with cls, cx, cy, w, h; null for null."""
    return F.when(box.isNotNull(), F.format_string("%d %.6f %.6f %.6f %.6f", *(box[k] for k in ("cls", "cx", "cy", "w", "h"))))


def format_seg_line(polygon: Column, width: Column, height: Column) -> Column:
    """The line of a polygon with cls and points in pixels, as shares cut to 0 .. 1; null with fewer than three points."""
    share = lambda v, n: F.least(F.greatest(v / (n - 1), F.lit(0.0)), F.lit(1.0))
    points = F.transform(polygon["points"], lambda p: F.format_string("%.6f %.6f", share(p["x"], width), share(p["y"], height)))
    return F.when(F.size(points) >= 3, F.concat_ws(" ", polygon["cls"].cast("string"), F.array_join(points, " ")))


def parse_seg_line(text: Column, width: Column, height: Column) -> Column:
    """Struct cls and points (x, y in pixels) of a polygon line; null if the payload is odd or has fewer than three points."""
    return _once(_numbers(text), lambda numbers: _polygon(numbers, width, height))


def _polygon(numbers: Column, width: Column, height: Column) -> Column:
    n = F.size(numbers)
    good = (n >= 7) & (n % 2 == 1) & ~F.exists(numbers, lambda x: x.isNull())
    steps = F.when(good, F.sequence(F.lit(0), F.floor((n - 1) / 2).cast("int") - 1))
    points = F.transform(steps, lambda i: F.struct((F.get(numbers, 1 + 2 * i) * (width - 1)).alias("x"), (F.get(numbers, 2 + 2 * i) * (height - 1)).alias("y")))
    return F.when(good, F.struct(F.get(numbers, 0).cast("int").alias("cls"), points.alias("points")))


def drop_keypoints(kps: Column, places: list[int]) -> Column:
    """The keypoints but those at the given places."""
    return F.filter(kps, lambda k, i: ~i.isin(*places)) if places else kps


def remap_keypoints(kps: Column, source: list[str], target: list[str]) -> Column:
    """The keypoints in the target's order; names that the source lacks are hidden zeros; null if the count isn't the source's."""
    nothing = _point(F.lit(0.0), F.lit(0.0), F.lit(0))
    return F.when(F.size(kps) == len(source), F.array(*(F.get(kps, source.index(n)) if n in source else nothing for n in target)).cast(_KP))


def _with(label: Column, **new: Column) -> Column:
    return F.struct(*(new.get(k, label[k]).alias(k) for k in ("cls", "cx", "cy", "w", "h", "kps", "error")))


def augment_roll(label: Column, pixels: Column | int, width: int) -> Column:
    """The label after its image is rolled to the right: centre and visible keypoints move modulo the width."""
    share = (F.lit(pixels) if isinstance(pixels, int) else pixels) / F.lit(width)
    moved = F.transform(label["kps"], lambda k: _point(F.when(k["v"] > 0, F.pmod(k["x"] + share, F.lit(1.0))).otherwise(k["x"]), k["y"], k["v"]))
    return _with(label, cx=F.pmod(label["cx"] + share, F.lit(1.0)), kps=moved)


def augment_scale(label: Column, scale: float) -> Column:
    """The label after its image is scaled about the centre: the box is cut to the image, and keypoints that leave it become
    hidden zeros."""
    s = F.lit(float(scale))
    about = lambda v: (v - 0.5) * s + 0.5
    a, b = about(label["cx"] - label["w"] / 2), about(label["cy"] - label["h"] / 2)
    c, d = about(label["cx"] + label["w"] / 2), about(label["cy"] + label["h"] / 2)
    a, b, c, d = (F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0)) for v in (a, b, c, d))

    def point(k: Column) -> Column:
        x, y = about(k["x"]), about(k["y"])
        stays = (k["v"] > 0) & x.between(0, 1) & y.between(0, 1)
        return F.when(stays, _point(x, y, F.lit(1))).otherwise(_point(F.lit(0.0), F.lit(0.0), F.lit(0)))

    return _with(label, cx=(a + c) / 2, cy=(b + d) / 2, w=c - a, h=d - b, kps=F.transform(label["kps"], point))


def augment_vshift(label: Column, pixels: int, height: int) -> Column:
    """The label after its image is shifted down: centre and visible keypoints move, those that leave the image become hidden zeros."""
    share = F.lit(pixels / height)

    def point(k: Column) -> Column:
        y = k["y"] + share
        stays = (k["v"] > 0) & y.between(0, 1)
        return F.when(stays, _point(k["x"], y, k["v"])).otherwise(_point(F.lit(0.0), F.lit(0.0), F.lit(0)))

    return _with(label, cy=F.least(F.greatest(label["cy"] + share, F.lit(0.0)), F.lit(1.0)), kps=F.transform(label["kps"], point))
