"""Names of scenes, recordings, profiles and boxes, as column expressions. Null gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scene_bag(stem: Column) -> Column:
    """What stands before the last `__`; null if there is none."""
    return F.nullif(F.regexp_extract(stem, "^(.*)__", 1), F.lit(""))


def scene_name(stem: Column) -> Column:
    """What stands after the last `__`; null if there is none."""
    return F.when(stem.contains("__"), F.substring_index(stem, "__", -1))


def norm_name(name: Column, mode: str = "key") -> Column:
    """Lower-case name. mode: key (dashes and spaces to `_`), collapse (also runs of `_` to one), strict (only a-z, 0-9 and `_`),
    slug (runs of other characters but `+` to `_`), file (unsafe characters to `_`, case kept)."""
    low = F.lower(F.trim(name))
    under = F.translate(low, "- ", "__")
    if mode == "key":
        return under
    if mode == "collapse":
        return F.regexp_replace(under, "_+", "_")
    if mode == "strict":
        return F.regexp_replace(under, "[^a-z0-9_]", "")
    if mode == "slug":
        return F.regexp_replace(F.regexp_replace(low, "[^a-z0-9+]+", "_"), "^_+|_+$", "")
    if mode == "file":
        return F.regexp_replace(F.trim(name), "[^A-Za-z0-9._-]+", "_")
    raise ValueError(mode)


def aircraft_token(bag: Column) -> Column:
    """The part of a recording's name after `movement_` up to `__`, else the whole name."""
    token = F.regexp_extract(bag, "(?i)^movement_(.+?)(?:__|$)", 1)
    return F.when(token != "", token).otherwise(bag)


def box_z_offset(name: Column, engine: float = 0.0, gear: float = 0.0, rear_wing: float = 0.0, wing: float = 0.0) -> Column:
    """The offset of the first kind found in the box's name, else 0."""
    low = F.lower(name)
    picked = F.when(low.contains("engine"), engine).when(low.contains("gear"), gear)
    return picked.when(low.contains("rear_wing"), rear_wing).when(low.contains("wing"), wing).otherwise(0.0)


def target_box_key(keypoint: Column, swap_engines: bool = False) -> Column:
    """Which box a keypoint belongs in: engine_left, engine_right, front_landing_gear, or null."""
    low = F.lower(keypoint)
    left, right = ("engine_right", "engine_left") if swap_engines else ("engine_left", "engine_right")
    engine = low.contains("engine")
    front = low.contains("front") | low.contains("nose")
    return F.when(engine & low.contains("left"), left).when(engine & low.contains("right"), right).when(front, "front_landing_gear")


def stem_filter(stem: Column, part: str) -> Column:
    """Whether the stem holds part, in any case; an empty part passes all."""
    return F.lower(stem).contains(part.strip().lower())


def split_from_path(path: Column) -> Column:
    """The last of a path's parts that names a split, else val."""
    parts = F.filter(F.split(F.lower(path), "/"), lambda p: p.isin("train", "val", "test"))
    return F.coalesce(F.try_element_at(parts, F.lit(-1)), F.lit("val"))
