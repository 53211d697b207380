"""Every query that has SQL equals DuckDB's result at sf0.001; without SQL: properties."""

import math

import duckdb
import pytest

from skyweave.plans import edits, files, geometry, joins, oriented, poses, regions, selection  # noqa: F401
from skyweave.plans.catalogue import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("supplier", "lineitem", "orders", "events"):
        c.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def _plain(v):
    return None if v is None or isinstance(v, float) and math.isnan(v) else round(v, 6) + 0.0 if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    want = duck.sql(SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    key = lambda r: tuple(map(repr, r))
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in df.collect()), key=key)
    assert got == sorted((tuple(_plain(r[i]) for i in at) for r in want.fetchall()), key=key)


def test_folds_are_those_of_a_loop(spark):
    bags = {r.bag_stem: r.n_scenes for r in QUERIES["scenes_per_bag"](spark, DATA).collect()}
    load, want = [0] * 5, {}
    for n, b in sorted((-n, b) for b, n in bags.items()):
        want[b] = load.index(min(load))
        load[want[b]] -= n
    assert {r.bag_stem: r.fold for r in QUERIES["kfold"](spark, DATA).collect()} == want
    assert {r.bag_stem for r in QUERIES["balanced_split"](spark, DATA).collect()} == set(bags)


def test_gap_of_full_and_wrapped_rings(spark):
    from skyweave.operators.scenes import largest_empty_gap

    rows = [("full", i, True) for i in range(8)] + [("wrap", i, 2 <= i <= 4) for i in range(8)] + [("none", 0, False)]
    px = spark.createDataFrame(rows, "unique_scene string, col_idx int, is_aircraft boolean")
    got = {r.unique_scene: (r.gap_start, r.gap_len, r.seam, r.roll) for r in largest_empty_gap(px, 8).collect()}
    assert got == {"full": (None, None, None, 0), "wrap": (5, 5, 7, 1), "none": (None, None, None, 0)}


def test_labels_round_trip_and_bad_lines(spark):
    from pyspark.sql import functions as F

    from skyweave.functions import labels

    lines = ["0 0.500000 0.500000 0.250000 0.250000 0.125000 0.750000 1 0.000000 0.000000 0", "0 0.5 0.5 0.1", "0 0.5 0.5 0.1 0.1 0.2", "0 a 0.5 0.1 0.1", None]
    df = spark.createDataFrame([(x,) for x in lines], "text string").withColumn("l", labels.parse_pose_line(F.col("text")))
    rows = df.select("l.error", labels.format_pose_line(F.col("l")).alias("line"), labels.format_pose_line(labels.augment_roll(F.col("l"), 64, 64)).alias("rolled")).collect()
    assert rows[0].line == rows[0].rolled == lines[0]
    assert [r.error for r in rows] == [None, "too few fields", "broken keypoint triplets", "not a number", "no line"]


def test_pixel_tables_without_places_or_marks(spark, tmp_path):
    from skyweave.sources.text import scan_px

    spark.createDataFrame([(1.0, 2.0, 0.7), (None, 2.0, 0.1), (float("inf"), 2.0, 0.1)], "x double, y double, ` Aircraft` double").write.parquet(f"{tmp_path}/a")
    assert scan_px(spark, f"{tmp_path}/a").count() == 0
    spark.createDataFrame([(1.0, 2.0, 3.0, 0.7), (None, 2.0, 3.0, 0.1), (float("inf"), 2.0, 3.0, 0.1), (1.0, 2.0, 3.0, 0.5)], "X double, y double, Z double, ` Aircraft` double").write.parquet(f"{tmp_path}/b")
    assert sorted(tuple(r) for r in scan_px(spark, f"{tmp_path}/b").select("x", "is_aircraft", "is_ground").collect()) == [(1.0, False, None), (1.0, True, None)]


def test_first_profile_of_a_key_wins(spark, tmp_path):
    from skyweave.sources.text import scan_profiles

    (tmp_path / "p.csv").write_text("profile_name,aircraft,n\nB787-9,B787 9,1\nb787_9,,2\n ,A320,3\n,,4\n")
    assert sorted((r.key, r.n) for r in scan_profiles(spark, str(tmp_path)).collect()) == [("a320", "3"), ("b787_9", "1")]


def test_splits_of_no_recordings(spark):
    from skyweave.operators import splits

    none = spark.createDataFrame([], "bag_stem string, n_scenes bigint")
    assert splits.kfold(none, 3).count() == 0 and splits.balanced_split(none).count() == 0
    some = spark.createDataFrame([("a", 5), ("b", 5), ("c", 1), (None, 9)], "bag_stem string, n_scenes bigint")
    assert sorted(tuple(r) for r in splits.kfold(some, 2).collect()) == [("a", 5, 0), ("b", 5, 1), ("c", 1, 0)]
    assert sorted((r.bag_stem, r.split) for r in splits.balanced_split(some, (0.5, 0.5, 0.0)).collect()) == [("a", "train"), ("b", "val"), ("c", "train")]


def test_rotations_about_all_axes(spark):
    from pyspark.sql import functions as F

    from skyweave.functions.pixels import euler_xyz

    rx, ry, rz = 0.3, -0.8, 1.9
    c, s = math.cos, math.sin
    times = lambda a, b: [[sum(a[i][k] * b[k][j] for k in range(3)) for j in range(3)] for i in range(3)]
    x, y, z = [[1, 0, 0], [0, c(rx), -s(rx)], [0, s(rx), c(rx)]], [[c(ry), 0, s(ry)], [0, 1, 0], [-s(ry), 0, c(ry)]], [[c(rz), -s(rz), 0], [s(rz), c(rz), 0], [0, 0, 1]]
    got = spark.range(1).select(euler_xyz(F.lit(rx), F.lit(ry), F.lit(rz))).first()[0]
    assert got == pytest.approx([v for row in times(times(z, y), x) for v in row])


@pytest.mark.parametrize("name", ["subsample", "knn_outlier", "cluster_adjust", "snap_in_box", "parse_pose_line", "kfold"])
def test_plans_have_no_cartesian_product(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert name != "parse_pose_line" or plan.count("split(") <= 3


#: Queries that say something of empty tables, too: counts of nothing, rows made of lists of names, and boxes that the query itself adds.
OF_NOTHING = {"dataset_manifest", "pick_front_box", "run_manifest", "drop_preview", "keypoint_order", "pair_images_labels", "split_columns_csv"}


@pytest.fixture(scope="module")
def nothing(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("nothing")
    for t in ("supplier", "lineitem", "orders", "events"):
        spark.read.parquet(f"{DATA}/{t}.parquet").limit(0).write.parquet(f"{folder}/{t}.parquet")
    return str(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_over_empty_tables(nothing, spark, name):
    rows = QUERIES[name](spark, nothing).collect()
    assert not rows or name in OF_NOTHING, rows[:3]
