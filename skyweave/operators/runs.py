"""Counters of a run, taken while its rows are written, and the manifest that reports them."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def write_counted(rows: DataFrame, path: str, counters: dict[str, Column]) -> dict[str, int]:
    """Writes the rows as Parquet and returns how many there are for which each condition holds; both are one pass over them."""
    seen = Observation()
    rows.observe(seen, *(F.count_if(c).alias(n) for n, c in counters.items())).write.parquet(path)
    return {n: int(seen.get[n]) for n in counters}


def whole_targets(total: int, ratios: tuple[float, float, float]) -> dict[str, int]:
    """Scenes that train, val and test are to have; what rounding down leaves goes to test."""
    train, val = (int(total * r) for r in ratios[:2])
    return {"train": train, "val": val, "test": total - train - val}


def run_manifest(scenes: DataFrame, path: str, ratios: tuple[float, float, float], keypoints: list[str], config: dict) -> DataFrame:
    """One row (manifest) of JSON for an export of scenes (split, status: written, remapped, missing, invalid or skipped, ..), which are written to the
    path: the configuration, keypoint order, target and actual numbers of scenes by split, and counters by status. Scenes whose status is skipped
    or invalid don't count as valid."""
    states = ("written", "remapped", "missing", "invalid", "skipped")
    valid = ~F.col("status").isin("invalid", "skipped")
    counters = {s: F.col("status") == s for s in states} | {"valid": valid, "seen": F.lit(True)} | {f"in_{s}": valid & (F.col("split") == s) for s in ("train", "val", "test")}
    got = write_counted(scenes, path, counters)
    told = {
        "config": config, "kp_order": keypoints, "target_scene_counts": whole_targets(got["valid"], ratios),
        "actual_scene_counts": {s: got[f"in_{s}"] for s in ("train", "val", "test")},
        "total_scenes_seen": got["seen"], "total_valid_scenes": got["valid"], **{f"reuse_labels_{s}": got[s] for s in states},
    }
    return scenes.sparkSession.createDataFrame([(json.dumps(told, separators=(",", ":")),)], "manifest string")
