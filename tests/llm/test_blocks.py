"""Benchmarks of several blocks of items find the same as one block."""

from skyweave.llm import decontamination


def test_blocks_of_items_have_passes_of_their_own(spark, monkeypatch):
    items = [(i, f"item number {i} of the benchmark, with words of its own like {'abcdefghij'[i]}{i * 7919} and more besides") for i in range(10)]
    docs = [(i, f"some text before, {items[i % 10][1]}, and after") for i in range(0, 40, 4)] + [(100, "nothing of the kind"), (101, None), (102, ""), (100, "nothing of the kind")]
    df, bench = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, _found string, item_id int"), spark.createDataFrame(items, "item_id long, text string")
    one = sorted(map(tuple, decontamination.keep_clean(df, bench).collect()), key=repr)
    found = sorted(map(tuple, decontamination.contaminated(df, bench).collect()))
    monkeypatch.setattr(decontamination.blocks, "__defaults__", ("item_id", "text", 200))
    assert len(decontamination.blocks(bench)) > 2
    assert sorted(map(tuple, decontamination.keep_clean(df, bench).collect()), key=repr) == one and len(one) == 4
    assert sorted(map(tuple, decontamination.contaminated(df, bench).collect())) == found and len(found) == 10
    assert decontamination.keep_clean(df, bench).columns == df.columns
