"""Regions, selections and poses on small cases with known results."""

import random

import pytest
from pyspark.sql import functions as F

from skyweave.operators import poses, regions, reports, selection

POINT = "unique_scene string, idx int, x double, y double, z double"


def test_neighbour_filter_equals_all_distances(spark):
    rng = random.Random(3)
    rows = [("a", i, rng.gauss(0, 1), rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(150)] + [("a", 150, 900.0, -700.0, 3.0), ("a", 151, 40.0, 0.0, 0.0)]
    rows += [("same", i, 1.0, 1.0, 1.0) for i in range(12)] + [("two", i, float(i), 0.0, 0.0) for i in range(2)] + [("few", i, 2.0**i, 0.0, 0.0) for i in range(5)]
    got = {(r.unique_scene, r.idx) for r in regions.knn_outlier(spark.createDataFrame(rows, POINT), "idx", 6, 1.0).collect()}
    want = set()
    for scene in {r[0] for r in rows}:
        pts = [r for r in rows if r[0] == scene]
        means = {}
        for p in pts:
            d = sorted(sum((p[i] - q[i]) ** 2 for i in (2, 3, 4)) ** 0.5 for q in pts if q is not p)[:6]
            means[p[1]] = sum(d) / len(d)
        mu = sum(means.values()) / len(means)
        sd = (sum((m - mu) ** 2 for m in means.values()) / len(means)) ** 0.5
        want |= {(scene, i) for i, m in means.items() if len(pts) <= 2 or sd <= 1e-12 or m <= mu + sd}
    assert got == want


def test_components_touch_at_corners_and_around_holes(spark):
    picture = ["##..#", "..#..", "#...#", "#.###", "#####"]
    px = [("s", 1, r, c) for r, line in enumerate(picture) for c, ch in enumerate(line) if ch == "#"]
    df = spark.createDataFrame(px + px[:2], "unique_scene string, cls int, row_idx int, col_idx int")
    runs = regions.components(df).collect()
    assert sorted({(r.first_row, r.first_col) for r in runs}) == [(0, 0), (0, 4), (2, 0)]
    assert regions.min_area_components(df, 5).count() == 11 and regions.min_area_components(df, 3).count() == 14
    assert regions.min_area_components(df.where("false"), 1).count() == 0


def test_ground_is_found_and_a_scene_of_ground_only_is_kept(spark):
    flat = [("g", i // 6, i % 6, float(i % 6), float(i // 6), 0.0) for i in range(36)]
    tall = [("t", i // 6, i % 6, float(i % 6), float(i // 6), 0.0 if i < 30 else 5.0 + i * i) for i in range(36)]
    df = spark.createDataFrame(flat + tall + [("n", 0, 0, 1.0, 1.0, 1.0)], "unique_scene string, row_idx int, col_idx int, x double, y double, z double")
    kept = regions.remove_ground(regions.ground_plane(df)).groupBy("unique_scene", "used_fallback").count().collect()
    assert {tuple(r) for r in kept} == {("g", True, 36), ("t", False, 6), ("n", False, 1)}


def test_rigid_fit_turns_reflected_pairs_into_a_rotation(spark):
    local = [(0.0, 0.0, 0.0), (1.0, 0.0, 0.0), (0.0, 2.0, 0.0), (0.0, 0.0, 3.0)]
    rows = [("turn", *p, 5 - p[1], 7 + p[0], p[2]) for p in local] + [("mirror", *p, -p[0], p[1], p[2]) for p in local] + [("one", *local[0], 0.0, 0.0, 0.0)]
    got = {r.unique_scene: r for r in regions.rigid_fit(spark.createDataFrame(rows, "unique_scene string, lx double, ly double, lz double, x double, y double, z double")).collect()}
    assert set(got) == {"turn", "mirror"}
    assert [round(v, 9) + 0.0 for v in got["turn"].rotation] == [0, -1, 0, 1, 0, 0, 0, 0, 1]
    assert (round(got["turn"].tx, 9), round(got["turn"].ty, 9)) == (5, 7)
    m = got["mirror"].rotation
    det = m[0] * (m[4] * m[8] - m[5] * m[7]) - m[1] * (m[3] * m[8] - m[5] * m[6]) + m[2] * (m[3] * m[7] - m[4] * m[6])
    assert round(det, 9) == 1


def test_overlapping_regions_count_as_one(spark):
    grid = [("s", side, float(x), float(y), 0.0) for side, y in (("left", 1), ("right", -1)) for x in range(10)]
    boxed = spark.createDataFrame(grid, "unique_scene string, side string, x double, y double, z double")
    one = boxed.where("side = 'left'")
    both = one.unionByName(one.withColumn("side", F.lit("right")))
    swapped = boxed.withColumn("side", F.when(F.col("side") == "left", "right").otherwise("left"))
    verdict = lambda d: tuple(regions.region_verdict(boxed, d, 0.5).select("left_ratio", "right_ratio", "verdict").first())
    assert verdict(both) == (1.0, -1.0, "PASS")
    assert verdict(swapped) == (1.0, 1.0, "PASS")
    assert verdict(boxed.where("false")) == (-1.0, -1.0, "FAIL")
    assert verdict(boxed.where("x < 3")) == (0.3, 0.3, "FAIL")


@pytest.mark.parametrize("side", ["left", "right"])
def test_a_single_region_keeps_its_side_on_ties(spark, side):
    grid = [("s", s, float(x), float(y), 0.0) for s, y in (("left", 1), ("right", -1)) for x in range(10)]
    boxed = spark.createDataFrame(grid, "unique_scene string, side string, x double, y double, z double")
    alone = boxed.where("x < 6").withColumn("side", F.lit(side))
    got = regions.region_verdict(boxed, alone, 0.5).first()
    assert (got.left_ratio, got.right_ratio) == ((0.6, -1.0) if side == "left" else (-1.0, 0.6))


def test_every_nth_counts_over_groups(spark):
    rows = [(f"b{i // 7}", f"b{i // 7}_{i:03d}") for i in range(40)]
    df = spark.createDataFrame(rows, "bag string, k string")
    want = [k for _, k in rows][::3]
    assert sorted(r.k for r in reports.every_nth(df, "k", "bag", 3).collect()) == want
    assert sorted(r.k for r in reports.every_nth(df, "k", "bag", 3, 4).collect()) == want[:4]


def test_markers_pages_and_class_lists(spark):
    assert poses.marker_points(spark.createDataFrame([(0.0, 0.0, 0.0)], "x double, y double, z double")).distinct().count() == 19
    df = spark.range(30)
    first, again = ([r.id for r in selection.page(df, ["id"], 3, 10, 7).collect()] for _ in range(2))
    assert first == again and len(set(first)) == 10 and first != sorted(first)
    assert selection.int_set("3, 1,3,") == [3, 1] and selection.class_ids("a:1,b: 2") == {"a": 1, "b": 2}
    with pytest.raises(ValueError, match="1 to 255"):
        selection.class_ids("a:0")


@pytest.mark.parametrize("strip", [1, 2, 3, 7, 512])
def test_components_across_strips(spark, strip):
    """Random pictures, a spiral and a long diagonal against a flood fill, whatever the strips."""
    rng = random.Random(strip)
    pictures = {f"p{i}": {(rng.randint(-4, 24), rng.randint(-9, 15)) for _ in range(rng.choice([60, 200, 330]))} for i in range(6)}
    spiral, r, c, dr, dc = set(), 0, 0, 0, 1
    for side in range(20, 0, -2):
        for _ in range(2):
            for _ in range(side):
                spiral.add((r, c))
                r, c = r + dr, c + dc
            dr, dc = dc, -dr
    pictures |= {"spiral": spiral, "diagonal": {(i, 2000 - i) for i in range(60)}, "wide": {(i % 2, j) for i in range(1, 5) for j in range(1500)}}
    df = spark.createDataFrame([(s, 1, r, c) for s, px in pictures.items() for r, c in px], "unique_scene string, cls int, row_idx int, col_idx int")
    want = {}
    for s, px in pictures.items():
        left = set(px)
        while left:
            stack, held = [min(left)], set()
            left -= {stack[0]}
            while stack:
                r, c = stack.pop()
                held.add((r, c))
                near = {(r + i, c + j) for i in (-1, 0, 1) for j in (-1, 0, 1)} & left
                left -= near
                stack += near
            want |= {(s, *p): (*min(held), len(held)) for p in held}
    got = {(x.unique_scene, x.row_idx, c): (x.first_row, x.first_col, x.area) for x in regions.components(df, strip).collect() for c in range(x.a, x.b + 1)}
    assert got == want


def test_neighbours_in_crowded_and_lonely_cells(spark):
    """Points that cells can't serve, because they are crowded or alone, have the same neighbours as by all distances."""
    rng = random.Random(9)
    rows = [("a", i, *(rng.gauss(0, 0.01) for _ in range(3))) for i in range(200)] + [("a", 200 + i, *(rng.uniform(-50, 50) for _ in range(3))) for i in range(60)]
    rows += [("flat", i, rng.uniform(0, 9), rng.uniform(0, 9), 0.0) for i in range(150)] + [("line", i, 0.1 * i * i, 0.0, 0.0) for i in range(80)]
    df = spark.createDataFrame(rows, POINT)
    plain = regions.knn_outlier(df, "idx", 5, 1.0, per_cell=10**6)
    for per_cell in (1, 4, 30):
        found = regions.knn_outlier(df, "idx", 5, 1.0, per_cell=per_cell)
        assert sorted((r.unique_scene, r.idx) for r in found.collect()) == sorted((r.unique_scene, r.idx) for r in plain.collect())
    pts = df.select("unique_scene", df.idx.alias("_id"), "x", "y", "z")
    means = {(r.unique_scene, r._of): r._m for r in regions._near_means(pts, 5, 30, 0.25, 480).collect()}
    assert len(means) > 100
    for (scene, i), m in means.items():
        p = next(r for r in rows if r[:2] == (scene, i))
        d = sorted(sum((p[k] - q[k]) ** 2 for k in (2, 3, 4)) ** 0.5 for q in rows if q[0] == scene and q[1] != i)[:5]
        assert m == pytest.approx(sum(d) / 5, abs=1e-9)


def test_ranks_and_pages(spark):
    rows = [(i * 7919 % 1009, f"v{i}") for i in range(1009)]
    df = spark.createDataFrame(rows, "n int, v string").repartition(5)
    want = sorted(rows)
    assert [tuple(r) for r in selection.page(df, ["n"], 400).orderBy("n").collect()] == want[400:]
    assert [tuple(r) for r in selection.page(df, ["n"], 5, 10).collect()] == want[5:15]
    assert selection.page(df, ["n"], 2000).count() == 0 and selection.page(df.limit(0), ["n"], 3).count() == 0
    plan = selection.page(df, ["n"], 400)._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and "CollectLimit" not in plan
    deep = selection.page(df, ["n"], 10, 200_000)
    assert [r.n for r in deep.orderBy("n").collect()] == [n for n, _ in want[10:]]
