"""Pixel and normalised boxes, as column expressions. Null in any part gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def xyxy_to_xywhn(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> list[Column]:
    """Centre and size as shares of the image; both corners are inside the box."""
    return [(x1 + x2 + 1) / 2 / width, (y1 + y2 + 1) / 2 / height, (x2 - x1 + 1) / width, (y2 - y1 + 1) / height]


def xywhn_to_xyxy(cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column, mode: str = "float") -> list[Column]:
    """Corners in pixels. mode: float; round (half to even, clamped); outer (floor and ceiling less one, clamped)."""
    corners = [(cx - w / 2) * width, (cy - h / 2) * height, (cx + w / 2) * width, (cy + h / 2) * height]
    if mode == "float":
        return corners
    ends = [width - 1, height - 1] * 2
    if mode == "round":
        whole = [F.rint(c) for c in corners]
    elif mode == "outer":
        whole = [F.floor(corners[0]), F.floor(corners[1]), F.ceil(corners[2]) - 1, F.ceil(corners[3]) - 1]
    else:
        raise ValueError(mode)
    return [F.least(F.greatest(c, F.lit(0)), e) for c, e in zip(whole, ends, strict=True)]


def clip_xyxy(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> Column:
    """The box's part inside the image as a struct of whole pixels, null if nothing is left."""
    a, b = (F.greatest(F.least(F.rint(v), e - 1), F.lit(0)).cast("int") for v, e in ((x1, width), (y1, height)))
    c, d = (F.greatest(F.least(F.rint(v), e - 1), F.lit(0)).cast("int") for v, e in ((x2, width), (y2, height)))
    return F.when((c > a) & (d > b), F.struct(a.alias("x1"), b.alias("y1"), c.alias("x2"), d.alias("y2")))


def clip_swapped(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> list[Column]:
    """Corners moved into the image as whole pixels, and put in order."""
    a, c = (F.greatest(F.least(v, F.lit(width) - 1), F.lit(0)).cast("int") for v in (x1, x2))
    b, d = (F.greatest(F.least(v, F.lit(height) - 1), F.lit(0)).cast("int") for v in (y1, y2))
    known = x1.isNotNull() & y1.isNotNull() & x2.isNotNull() & y2.isNotNull()
    return [F.when(known, v) for v in (F.least(a, c), F.least(b, d), F.greatest(a, c), F.greatest(b, d))]


def normal_xyxy(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column, least: float = 2.0) -> Column:
    """The box with its corners in order and inside the image, as a struct: a side shorter than `least` grows to it about its middle, as far as the image
    goes. Null if a side is left without length."""
    ends = []
    for low, high, size in ((x1, x2, width), (y1, y2, height)):
        last = F.lit(size) - 1.0
        a, b = (F.greatest(F.lit(0.0), F.least(last, v)) for v in (F.least(low, high), F.greatest(low, high)))
        middle, short = 0.5 * (a + b), b - a < least
        ends.append((F.when(short, F.greatest(F.lit(0.0), middle - least / 2)).otherwise(a), F.when(short, F.least(last, middle + least / 2)).otherwise(b)))
    (a, c), (b, d) = ends
    known = x1.isNotNull() & y1.isNotNull() & x2.isNotNull() & y2.isNotNull()
    return F.when(known & (c > a) & (d > b), F.struct(a.alias("x1"), b.alias("y1"), c.alias("x2"), d.alias("y2")))


def clip_xywhn(cx: Column, cy: Column, w: Column, h: Column) -> Column:
    """The normalised box cut to the image as a struct, null if nothing is left."""
    a, b = F.greatest(cx - w / 2, F.lit(0.0)), F.greatest(cy - h / 2, F.lit(0.0))
    c, d = F.least(cx + w / 2, F.lit(1.0)), F.least(cy + h / 2, F.lit(1.0))
    return F.when((c > a) & (d > b), F.struct(((a + c) / 2).alias("cx"), ((b + d) / 2).alias("cy"), (c - a).alias("w"), (d - b).alias("h")))


def center_px(x1: Column, y1: Column, x2: Column, y2: Column) -> list[Column]:
    """The middle, rounded half to even."""
    return [F.rint((x1 + x2) / 2).cast("int"), F.rint((y1 + y2) / 2).cast("int")]
