"""Edits of label files, folds, counted writes and label variants on small cases."""

import json

import pytest
from pyspark.sql import functions as F

from skyweave.functions import boxes2d, labels
from skyweave.operators import edits, runs, splits
from skyweave.sources.shared import new_folder

NAMES = ["nose", "tail"]
GOOD = "0 .5 .5 .1 .1 .1 .2 1 .3 .4 2"


def test_one_broken_line_keeps_its_file(spark):
    rows = [("a", 0, GOOD), ("a", 1, f"  {GOOD}  "), ("a", 2, ""), ("a", 3, None), ("b", 0, GOOD), ("b", 1, "0 1 1 1 1 .5"), ("c", 0, " "), ("d", 0, GOOD + " .1 .1 1"), (None, 0, GOOD), ("e", 0, "0 1 1")]
    edited = edits.drop_from_files(spark.createDataFrame(rows, "path string, line_no int, text string"), NAMES, [" tail ", "tail"])
    got = {(r.path, r.line_no): (r.text, r.error, r.file_error, r.changed) for r in edited.collect()}
    short = "0 .5 .5 .1 .1 .1 .2 1"
    assert got == {
        ("a", 0): (short, None, False, True), ("a", 1): (short, None, False, True), ("a", 2): ("", None, False, False), ("a", 3): (None, None, False, False),
        ("b", 0): (GOOD, None, True, False), ("b", 1): ("0 1 1 1 1 .5", "broken keypoint triplets", True, False), ("c", 0): (" ", None, False, False),
        ("d", 0): (GOOD + " .1 .1 1", "keypoints: 3", True, False), (None, 0): (short, None, False, True), ("e", 0): ("0 1 1", "too few fields", True, False),
    }
    assert tuple(edits.edit_counts(edited).first()) == (6, 2, 3, 3)
    assert tuple(edits.edit_counts(edited.limit(0)).first()) == (0, 0, 0, 0)


@pytest.mark.parametrize(("remove", "message"), [(["nsoe"], "did you mean nose"), (["xyz"], "unknown"), (NAMES, "has to remain"), ([" "], "no keypoint")])
def test_names_are_checked(remove, message):
    with pytest.raises(ValueError, match=message):
        edits.places_of(NAMES, remove)


def test_seeds_decide_ties(spark):
    bags = spark.createDataFrame([(f"b{i}", 3) for i in range(9)] + [(None, 4)], "bag_stem string, n_scenes int")
    folds = [{r.bag_stem: r.fold for r in splits.kfold(bags, 3, seed=s).collect()} for s in (1, 1, 2)]
    assert folds[0] == folds[1] != folds[2] and sorted(folds[2].values()) == [0, 0, 0, 1, 1, 1, 2, 2, 2]
    assert {r.split for r in splits.balanced_split(bags, seed=3, whole=True).collect()} == {"train", "val", "test"}
    with pytest.raises(Exception, match="too few"):
        splits.kfold(bags.limit(2), 3, strict=True).collect()
    assert splits.kfold(bags.limit(0), 3, strict=True).count() == 0


def test_fold_files(spark):
    files = [(k, s, f"/d/{k}s/{s}/{n}.{'png' if k == 'image' else 'txt'}") for n, s in (("a__x__1", "train"), ("a__x__2", "val"), ("b__3", "train"), ("c__4", "test"), ("z__5", "train")) for k in ("image", "label")]
    files += [("image", "train", "/d/images/train/b__9.png"), ("label", "train", "/d/labels/train/a__x__2.txt")]
    folds = spark.createDataFrame([("a__x", 0), ("b", 1), ("c", 1)], "bag_stem string, fold int")
    rows = splits.fold_files(spark.createDataFrame(files, "kind string, split string, path string"), folds, 2, "/o").collect()
    got = {(r.fold, r.role, r.target.rsplit("/", 1)[1]) for r in rows}
    assert got == {(f, {"a": ("val", "train"), "b": ("train", "val"), "c": ("test", "test")}[n[0]][f], n + e) for f in (0, 1) for n in ("a__x__1", "a__x__2", "b__3", "c__4") for e in (".png", ".txt")}
    assert {r.source for r in rows if "a__x__2" in r.source} == {"/d/images/val/a__x__2.png", "/d/labels/val/a__x__2.txt"}
    assert all(r.role != "test" for r in splits.fold_files(spark.createDataFrame(files, "kind string, split string, path string"), folds, 2, "/o", with_test=False).collect())


def test_counters_are_taken_while_writing(spark):
    rows = spark.createDataFrame([("train", "written"), ("val", "invalid"), ("train", "remapped"), ("test", "missing"), (None, None)], "split string, status string")
    path = new_folder(spark)
    told = json.loads(runs.run_manifest(rows, path, (0.5, 0.25, 0.25), ["a"], {"x": 1}).first().manifest)
    assert spark.read.parquet(path).count() == 5
    assert told["reuse_labels_written"] == told["reuse_labels_invalid"] == told["reuse_labels_missing"] == 1 and told["total_scenes_seen"] == 5
    assert told["total_valid_scenes"] == 3 and told["target_scene_counts"] == {"train": 1, "val": 0, "test": 2} and told["actual_scene_counts"] == {"train": 2, "val": 0, "test": 1}
    assert json.loads(runs.run_manifest(rows.limit(0), new_folder(spark), (0.5, 0.25, 0.25), [], {}).first().manifest)["total_scenes_seen"] == 0


def test_pose_lines_in_pixels(spark):
    rows = [("1.2 0.5 0.5 0.25 0.5 0.1 0.2 1 30 8 0",), ("0 32 8 100 4 0.5 12",), ("0 .5 .5 .1 .1",), ("0 .5 .5 .1 .1 .3",), ("0 1",), (None,), ("0 x .5 .1 .1",)]
    got = [r.l for r in spark.createDataFrame(rows, "t string").coalesce(1).select(labels.parse_pose_line_px(F.col("t"), 64, 16).alias("l")).collect()]
    assert (got[0].cls, got[0].x1, got[0].y1, got[0].x2, got[0].y2) == (1, 24, 4, 40, 12) and [tuple(k) for k in got[0].kps] == [(6.4, 3.2, 1.0), (30.0, 8.0, 0.0)]
    assert (got[1].x1, got[1].x2) == (0, 63) and [tuple(k) for k in got[1].kps] == [(32.0, 12.0, 1.0)]
    assert got[2].kps == [] and [g.error for g in got] == [None, None, None, "keypoints are neither triplets nor pairs", "too few fields", "no line", "not a number"]


def test_normal_boxes(spark):
    box = lambda *v: spark.range(1).select(boxes2d.normal_xyxy(*map(F.lit, v), 64, 16).alias("b")).first().b
    assert tuple(box(9.0, 5.0, 3.0, 1.0)) == (3.0, 1.0, 9.0, 5.0)
    assert tuple(box(70.0, 5.0, 70.0, 5.5)) == (62.0, 4.25, 63.0, 6.25)
    assert tuple(box(-5.0, -5.0, -9.0, 90.0)) == (0.0, 0.0, 1.0, 15.0)
    assert box(None, 1.0, 2.0, 3.0) is None
