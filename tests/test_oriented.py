"""Turned boxes against a loop over all points and boxes."""

import random

import numpy as np
import pytest

from skyweave.operators import boxes, checks, oriented, poses, scenes


def _rotation(a, b, c):
    x = np.array([[1, 0, 0], [0, np.cos(a), -np.sin(a)], [0, np.sin(a), np.cos(a)]])
    y = np.array([[np.cos(b), 0, np.sin(b)], [0, 1, 0], [-np.sin(b), 0, np.cos(b)]])
    z = np.array([[np.cos(c), -np.sin(c), 0], [np.sin(c), np.cos(c), 0], [0, 0, 1]])
    return z @ y @ x


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(5)
    points = [(f"s{i % 3}", i, i % 7, *(rng.uniform(-6, 6) for _ in range(3)), i % 5 == 0) for i in range(900)]
    points += [("s0", 2000, 0, float("nan"), 0.0, 0.0, False), ("s9", 2001, 0, 0.0, 0.0, 0.0, False)]
    held = []
    for i in range(40):
        turn = _rotation(*(rng.uniform(-3, 3) for _ in range(3))) if i % 4 else np.eye(3)
        held.append((f"s{i % 3}", f"b{i}", i % 5 + 1, *(rng.uniform(-5, 5) for _ in range(3)), *(rng.choice([0.0, 0.05, 1.0, 3.0, 40.0]) for _ in range(3)), turn.ravel().tolist()))
    px = spark.createDataFrame(points, "unique_scene string, row_idx int, col_idx int, x double, y double, z double, is_aircraft boolean")
    specs = spark.createDataFrame(held, "unique_scene string, box_name string, cls int, cx double, cy double, cz double, hx double, hy double, hz double, rotation array<double>")
    return points, held, px, specs


def _inside(points, held):
    for p in points:
        for b in held:
            if p[0] == b[0]:
                away = np.abs((np.array(p[3:6]) - np.array(b[3:6])) @ np.array(b[9]).reshape(3, 3))
                if (away <= np.array(b[6:9]) + 1e-6).all():
                    yield p, b, away


@pytest.mark.parametrize("cell", [0.3, 1.0, 50.0])
def test_inside_boxes(world, cell):
    points, held, px, specs = world
    found = oriented.inside_boxes(px, specs, ["box_name"], cell)
    assert found.columns == [*px.columns, "box_name", "_ax", "_ay", "_az", "_hx", "_hy", "_hz"]
    got = {(r.unique_scene, r.row_idx, r.box_name): (r._ax, r._ay, r._az) for r in found.collect()}
    want = {(p[0], p[1], b[1]): away for p, b, away in _inside(points, held)}
    assert got.keys() == want.keys() and len(got) == found.count() > 300
    assert all(np.allclose(got[k], want[k], atol=1e-9) for k in got)


def test_joins_are_by_cell(world):
    _, _, px, specs = world
    plan = oriented.inside_boxes(px, specs, ["box_name"])._jdf.queryExecution().toString()
    joins = [line for line in plan.split("== Optimized Logical Plan ==")[1].split("\n") if "Join" in line]
    assert any("kx" in j and "ky" in j and "kz" in j for j in joins) and not any("Cartesian" in j or "NestedLoop" in j for j in joins)


def test_classes_and_upright_boxes(world):
    points, held, px, specs = world
    best = {}
    for p, b, away in _inside(points, held):
        score = (max(away / np.maximum(np.array(b[6:9]), 1e-9)), b[2])
        best[p[0], p[1]] = min(best.get((p[0], p[1]), score), score)
    got = {(r.unique_scene, r.row_idx): r.cls for r in boxes.assign_box_class(px, specs.drop("box_name")).collect()}
    assert got == {(p[0], p[1]): best.get((p[0], p[1]), (0, 0))[1] for p in points}
    upright = [(*b[:9], np.eye(3).ravel().tolist()) for b in held]
    sized = specs.drop("rotation").selectExpr("unique_scene", "box_name", "cx as x", "cy as y", "cz as z", "2 * hx as sx", "2 * hy as sy", "2 * hz as sz")
    assert sorted((r.row_idx, r.box_name) for r in scenes.points_in_boxes(px, sized).collect()) == sorted((p[1], b[1]) for p, b, _ in _inside(points, upright))


def test_empty_and_null_boxes(world, spark):
    _, _, px, specs = world
    assert oriented.inside_boxes(px, specs.limit(0), ["box_name"]).count() == 0
    assert oriented.inside_boxes(px.limit(0), specs, ["box_name"]).count() == 0
    nulls = spark.createDataFrame([("s0", "n", None, 0.0, 0.0, 1.0, 1.0, 1.0)], "unique_scene string, box_name string, cx double, cy double, cz double, hx double, hy double, hz double")
    assert oriented.inside_boxes(px, nulls, ["box_name"]).count() == 0


def test_checks_in_the_boxes_frame(spark):
    turn = _rotation(0.0, 0.0, 0.5)
    scene = spark.createDataFrame([("s", "p", turn.ravel().tolist(), 1.0, 2.0, 3.0)], "unique_scene string, profile string, rotation array<double>, tx double, ty double, tz double")
    box = spark.createDataFrame([("p", "engine_left", 4.0, 0.0, 0.0, 0.2, -0.3, 0.7, 6.0, 0.1, 2.0)], "profile string, name string, x double, y double, z double, rx double, ry double, rz double, sx double, sy double, sz double")
    own = turn @ _rotation(0.2, -0.3, 0.7)
    centre = turn @ np.array([4.0, 0, 0]) + np.array([1.0, 2.0, 3.0])
    point = centre + own @ np.array([2.9, 0.2, -1.2])
    specs = checks.box_specs(scene, box, scale=1.0)
    kps = spark.createDataFrame([("s", "left_engine", *map(float, point))], "unique_scene string, kp_name string, x double, y double, z double")
    row = checks.build_checks(kps, specs).first()
    assert np.allclose((row.ax, row.ay, row.az, row.hx, row.hy, row.hz), (2.9, 0.2, 1.2, 3.0, 0.25, 1.0)) and not row.inside
    near = checks.near_margin_pass(checks.build_checks(kps, specs), 0.25).first()
    assert near.inside and near.near_pass
    derived = poses.turn_boxes(scene, box.withColumn("name", box["name"]))
    assert derived.first().rotation == pytest.approx(own.ravel().tolist())
