"""Point-cloud files read in splits, and coloured clouds with their legends."""

import pytest

from skyweave.sources import clouds, text
from skyweave.sources.shared import new_folder


@pytest.fixture
def small_splits(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def test_one_file_is_read_by_many_tasks(spark, small_splits, tmp_path):
    rows = [(i * 0.5, -i * 1.0, i % 7 * 1.0) for i in range(4000)]
    lines = [f"{x:.6f} {y:.6f} {z:.6f}" + ("\n\n" if i % 50 == 0 else "") for i, (x, y, z) in enumerate(rows)]
    head = "# x\nVERSION 0.7\nFIELDS x y z\nPOINTS 3990\nDATA ascii\n"
    (tmp_path / "big.pcd").write_text(head + "\n".join(lines) + "\n")
    (tmp_path / "win.pcd").write_bytes((head.replace("3990", "2") + "\n".join(lines[1:9])).replace("\n", "\r\n").encode())
    (tmp_path / "none.pcd").write_text("VERSION 0.7\nDATA binary\n\x01\x02")
    (tmp_path / "empty.pcd").write_text("")
    (tmp_path / "short.pcd").write_text("POINTS 5\nDATA ascii\n1 2\nx y z\n")
    found = text.scan_pcd(spark, str(tmp_path), "*.pcd")
    assert clouds.numbered_lines(spark, str(tmp_path), "big.pcd").rdd.getNumPartitions() > 1
    big = sorted((r.idx, r.x, r.y, r.z) for r in found.where("unique_scene = 'big'").collect())
    assert big == [(i, *p) for i, p in enumerate(rows[:3990])]
    assert sorted((r.idx, r.x) for r in found.where("unique_scene = 'win'").collect()) == [(0, 0.5), (1, 1.0)]
    assert sorted((r.unique_scene, r.idx, r.error) for r in found.where("error is not null").collect()) == [("none", None, "not an ascii file")]
    assert sorted((r.idx, r.x, r.y, r.z) for r in found.where("unique_scene = 'short'").collect()) == [(0, 1.0, 2.0, None), (1, None, None, None)]


def test_marked_clouds(spark):
    points = spark.createDataFrame([("s", 1, 1.0, 2.0, 3.0), ("s", 0, 4.0, 5.0, 6.0), ("t", 0, 0.0, 0.0, 0.0)], "unique_scene string, i int, x double, y double, z double")
    kps = [("s", "b", 1.0, 1.0, 1.0), ("s", "a", float("nan"), 0.0, 0.0), ("s", "c", -1.0, 0.0, 0.5), ("u", "a", 0.0, 0.0, 0.0)]
    path = new_folder(spark)
    clouds.write_marked_ply(points, ["i"], spark.createDataFrame(kps, "unique_scene string, kp_name string, x double, y double, z double"), path)
    read = {s: [r for r in text.scan_ply(spark, f"{path}/clouds").orderBy("idx").collect() if r.unique_scene == s] for s in "stu"}
    assert len(read["s"]) == 2 + 2 * 19 and len(read["t"]) == 1 and not read["u"]
    assert [(r.x, r.red, r.green, r.blue) for r in read["s"][:2]] == [(4.0, 145, 145, 145), (1.0, 145, 145, 145)]
    assert {(r.red, r.green, r.blue) for r in read["s"][2:21]} == {clouds.PALETTE[1]} and {(r.red, r.green, r.blue) for r in read["s"][21:]} == {clouds.PALETTE[2]}
    legend = text.read_legend(spark, f"{path}/legends")
    assert sorted((r.kp_name, r.x, r.y, r.z) for r in legend.collect()) == [("b", 1.0, 1.0, 1.0), ("c", -1.0, 0.0, 0.5)]
    lines = [r.value for r in spark.read.text(f"{path}/legends").collect()]
    assert sorted(lines) == ["b: xyz=(1.000,1.000,1.000) rgb=(50,220,50)", "c: xyz=(-1.000,0.000,0.500) rgb=(50,120,255)"]
