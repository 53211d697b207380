"""Pixel values and points, as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Colour maps as (share, red, green, blue).
STOPS = {
    "viridis": [(0.0, 68, 1, 84), (0.25, 59, 82, 139), (0.5, 33, 145, 140), (0.75, 94, 201, 98), (1.0, 253, 231, 37)],
    "plasma": [(0.0, 13, 8, 135), (0.25, 126, 3, 167), (0.5, 203, 71, 119), (0.75, 248, 149, 64), (1.0, 240, 249, 33)],
}


def clip01(v: Column) -> Column:
    return F.least(F.greatest(v, F.lit(0.0)), F.lit(1.0))


def angles(x: Column, y: Column, z: Column) -> list[Column]:
    """Azimuth and elevation in radians."""
    return [F.atan2(y, x), F.atan2(z, F.sqrt(x * x + y * y))]


def apply_transform(x: Column, y: Column, z: Column, matrix: Column) -> list[Column]:
    """The point under a homogeneous 4 x 4 matrix, row by row in an array of 16; the point itself if the matrix isn't one of 16 finite numbers."""
    finite = ~F.exists(matrix, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == math.inf))
    good = F.coalesce((F.size(matrix) == 16) & finite, F.lit(False))
    row = lambda i: F.get(matrix, 4 * i) * x + F.get(matrix, 4 * i + 1) * y + F.get(matrix, 4 * i + 2) * z + F.get(matrix, 4 * i + 3)
    return [F.when(good, row(i)).otherwise(p) for i, p in enumerate((x, y, z))]


def euler_xyz(rx: Column, ry: Column, rz: Column) -> Column:
    """The rotation about x, then y, then z, as an array of nine, row by row."""
    (ca, sa), (cb, sb), (cc, sc) = ((F.cos(a), F.sin(a)) for a in (rx, ry, rz))
    return F.array(cc * cb, cc * sb * sa - sc * ca, cc * sb * ca + sc * sa, sc * cb, sc * sb * sa + cc * ca, sc * sb * ca - cc * sa, -sb, cb * sa, cb * ca)


def in_frame(vector: list[Column], rotation: Column) -> list[Column]:
    """The vector along the axes that are the columns of a rotation, an array of nine row by row."""
    return [vector[0] * F.get(rotation, j) + vector[1] * F.get(rotation, 3 + j) + vector[2] * F.get(rotation, 6 + j) for j in range(3)]


def bright_band(v: Column, low: float, high: float, soft: float, outside: float, peak: float) -> Column:
    """peak between low and high, outside far from them, linear over soft on either side; 0 for values that aren't positive and finite."""
    rise = clip01(F.least((v - (low - soft)) / soft, ((high + soft) - v) / soft))
    return F.when((v > 0) & (v < math.inf), outside + rise * (peak - outside)).otherwise(0.0)


def far_boost(gray: Column, boost: Column, amount: float, gain: float = 1.0) -> Column:
    """Gray times gain, lifted towards 1 by amount times boost."""
    base = clip01(gray * gain)
    return clip01(base + amount * boost * (1 - base))


def colormap(gray: Column, name: str) -> Column:
    """Struct r, g, b of 0 .. 255, rounded half to even: viridis, plasma, jet, or else gray."""
    x = clip01(gray)
    if name == "jet":
        parts = [clip01(1.5 - F.abs(4.0 * x - k)) * 255 for k in (3.0, 2.0, 1.0)]
    elif name in STOPS:
        stops = STOPS[name]

        def between(channel: int) -> Column:
            picked = F.lit(float(stops[-1][channel]))
            for a, b in reversed(list(zip(stops, stops[1:], strict=False))):
                picked = F.when(x <= b[0], a[channel] + (x - a[0]) / (b[0] - a[0]) * (b[channel] - a[channel])).otherwise(picked)
            return picked

        parts = [between(k) for k in (1, 2, 3)]
    else:
        parts = [x * 255] * 3
    return F.struct(*(F.rint(p).cast("int").alias(n) for p, n in zip(parts, "rgb", strict=True)))


def mask_tint(rgb: Column, mask: Column, share: float = 0.5) -> Column:
    """The colour blended with red where the mask holds, cut down to whole numbers."""
    blend = lambda c, to: F.when(mask, F.floor(rgb[c] * (1 - share) + to * share).cast("int")).otherwise(rgb[c])
    return F.struct(blend("r", 255).alias("r"), blend("g", 0).alias("g"), blend("b", 0).alias("b"))
