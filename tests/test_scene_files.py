"""One file per scene: its lines in order, under any name, without files beside it."""

from urllib.parse import unquote

import pytest

from skyweave.sources.scene_files import write_by_scene


@pytest.mark.parametrize("parts", [1, 7])
def test_files_of_scenes(spark, tmp_path, parts):
    names = ["plain", "a+b", "x/y=z", "50%", "ü ö", "q:*?", "a.b"]
    lines = [(s, i, f"{s} {i}" if i % 5 else None) for s in names for i in range(25)]
    df = spark.createDataFrame(lines, "unique_scene string, at int, value string").repartition(parts)
    write_by_scene(df, ["at"], f"{tmp_path}/out")
    files = [p for p in (tmp_path / "out").rglob("*") if p.is_file()]
    assert len(files) == len(names) and {p.suffix for p in files} == {".txt"}
    found = {unquote(p.stem): p.read_text() for p in files}
    assert found.keys() == set(names) and all(found[s] == "".join(f"{v or ''}\n" for n, _, v in lines if n == s) for s in names)


def test_no_lines_and_no_scene(spark, tmp_path):
    none = spark.createDataFrame([], "unique_scene string, value string")
    write_by_scene(none, [], f"file:{tmp_path}/none")
    assert spark.read.option("recursiveFileLookup", "true").text(f"{tmp_path}/none").count() == 0
    write_by_scene(spark.createDataFrame([(None, "b"), ("", "a")], none.schema), ["value"], f"{tmp_path}/null")
    assert [p.read_text() for p in (tmp_path / "null").rglob("*.txt")] in (["b\na\n"], ["a\nb\n"])


def test_table_readers_find_the_files(spark, tmp_path):
    lines = [(s, f"{s},{i}") for s in "abc" for i in range(3)]
    write_by_scene(spark.createDataFrame(lines, "unique_scene string, value string"), ["value"], f"{tmp_path}/csv")
    assert spark.read.csv(f"{tmp_path}/csv", "s string, i int").select("s", "i").distinct().count() == 9
