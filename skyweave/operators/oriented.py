"""Boxes with a rotation: points are tested in the box's own frame, and found through the grid cells that the turned box covers.

A box has unique_scene, centre cx, cy, cz, half sizes hx, hy, hz and may have a rotation, an array of nine row by row whose columns are the box's
axes in the world; without one it is upright. A box looks for its points in cells of about its own size: the side is a power of two times `cell`,
at least half its extent, so that it covers 27 cells at most, less those that it only passes by. Points are placed in the grids that boxes
of their scene use, and scene, grid and cell are the join's key, so that no scene has to be one task's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.functions.pixels import in_frame

_AXES = ("x", "y", "z")
#: Within which a point counts as inside.
TOLERANCE = 1e-6


def rotation_of(boxes: DataFrame, prefix: str = "") -> Column:
    """A box's rotation, for boxes that have none that of the world's axes."""
    upright = F.array(*(F.lit(float(i % 4 == 0)) for i in range(9)))
    return F.coalesce(F.col(f"{prefix}rotation"), upright) if f"{prefix}rotation" in boxes.columns else upright


def as_specs(boxes: DataFrame) -> DataFrame:
    """Boxes given by centre x, y, z and sizes sx, sy, sz as such by centre and half sizes."""
    named = [*(F.col(a).alias(f"c{a}") for a in _AXES), *((F.col(f"s{a}") / 2).alias(f"h{a}") for a in _AXES)]
    return boxes.select(*(c for c in boxes.columns if c not in {*_AXES, *(f"s{a}" for a in _AXES)}), *named)


def _covered(boxes: DataFrame, cell: float) -> DataFrame:
    """Each box once for each cell that it may reach into: grid, kx, ky, kz."""
    r = lambda i, j: F.abs(F.get("_r", 3 * i + j))
    reach = [sum((r(i, j) * F.col(f"_h{_AXES[j]}") for j in range(3)), F.lit(TOLERANCE)) for i in range(3)]
    placed = boxes.withColumn("_e", F.array(*reach)).withColumn("grid", F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(*(F.get("_e", i) for i in range(3))) / cell))).cast("int"))
    side = F.lit(cell) * F.pow(F.lit(2.0), F.col("grid"))
    for i, a in enumerate(_AXES):
        ends = (F.floor((F.col(f"_c{a}") + s * F.get("_e", i)) / side).cast("bigint") for s in (-1, 1))
        placed = placed.withColumn(f"k{a}", F.explode(F.sequence(*ends)))
    middle = in_frame([(F.col(f"k{a}") + 0.5) * side - F.col(f"_c{a}") for a in _AXES], F.col("_r"))
    meets = F.lit(True)
    for j, (a, m) in enumerate(zip(_AXES, middle, strict=True)):
        meets = meets & (F.abs(m) <= F.col(f"_h{a}") + TOLERANCE + 0.5 * side * (r(0, j) + r(1, j) + r(2, j)) * (1 + 1e-9))
    return placed.where(meets).drop("_e")


def inside_boxes(px: DataFrame, boxes: DataFrame, keep: list[str], cell: float = 1.0) -> DataFrame:
    """Each point of px (unique_scene, x, y, z, ..) with each box of its scene that holds it, bounds included within 1e-6: the point's columns, the
    box's columns `keep`, its distances from the box's centre along the box's axes _ax, _ay, _az, and the half sizes _hx, _hy, _hz. Boxes
    with a null size, and points without coordinates, meet nothing."""
    own = boxes.select("unique_scene", *keep, *(F.col(f"{p}{a}").alias(f"_{p}{a}") for p in "ch" for a in _AXES), rotation_of(boxes).alias("_r"))
    covered = _covered(own, cell)
    grids = covered.groupBy("unique_scene").agg(F.collect_set("grid").alias("grid"))  # a few numbers a scene
    side = F.lit(cell) * F.pow(F.lit(2.0), F.col("grid"))
    place = ["unique_scene", "grid", *(f"k{a}" for a in _AXES)]
    known = ~(F.isnan("x") | F.isnan("y") | F.isnan("z"))
    points = px.where(known).join(grids, "unique_scene").withColumn("grid", F.explode("grid")).withColumns({f"k{a}": F.floor(F.col(a) / side).cast("bigint") for a in _AXES})
    met = points.join(covered, place)
    away = in_frame([F.col(a) - F.col(f"_c{a}") for a in _AXES], F.col("_r"))
    measured = met.withColumns({f"_a{a}": F.abs(v) for a, v in zip(_AXES, away, strict=True)})
    held = F.lit(True)
    for a in _AXES:
        held = held & (F.col(f"_a{a}") <= F.col(f"_h{a}") + TOLERANCE)
    return measured.where(held).select(*px.columns, *keep, *(f"_{p}{a}" for p in "ah" for a in _AXES))
