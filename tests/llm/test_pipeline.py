"""The pipeline's stages on small data, each judged on what its predecessor kept."""

import re

import corpus_pipeline
from skyweave.llm import pii, quality_rules

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _fold(text):
    return " ".join(re.findall(r"[^\W_]+", text.lower()))


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    before, columns = {r.doc_id: r for r in docs.collect()}, docs.columns
    items = [_fold(r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    good = {r.doc_id for r in quality_rules.measure(docs).where("kept").collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.count() == len(after) and set(after) <= set(before)
        if name == "quality rules":
            assert set(after) == good
        elif name == "near duplicates":
            shingles = {}
            for d, r in before.items():
                words = WORD.findall(r.text.translate(LOWER))
                shingles[d] = {tuple(words[j : j + 5]) for j in range(max(1, len(words) - 4))}
            alike = {(a, b) for a in before for b in before if a < b and 5 * len(shingles[a] & shingles[b]) >= 4 * len(shingles[a] | shingles[b])}
            up = {d: d for d in before}
            for a, b in sorted(alike):
                x, y = a, b
                while up[x] != x:
                    x = up[x]
                while up[y] != y:
                    y = up[y]
                up[max(x, y)] = min(x, y)
            assert set(after) == {d for d in before if up[d] == d}
        elif name == "benchmark decontamination":
            assert set(after) == {d for d, r in before.items() if not any(x in _fold(r.text) for x in items)}
        elif name == "personal data":
            assert set(after) == set(before) and not any(pii.base_spans(r.text) for r in after.values())
        else:
            assert all(1 <= r.copies <= 3 and r.taken == r.copies * len(WORD.findall(before[r.doc_id].text)) for r in after.values())
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        before = after
    run = {(r.doc_id, r.copies) for r in corpus_pipeline.run(spark, DATA).collect()}
    assert run == {(r.doc_id, r.copies) for r in before.values()}


def test_stages_of_empty_tables_and_nulls(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    spark.read.parquet(f"{DATA}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    good = docs.where("length(text) > 1500").limit(6)
    nulls = spark.createDataFrame([(None, None, None, None, None), (9001, None, "en", "s", 0), (9002, "", None, None, 0), (9002, "", None, None, 0)], docs.schema)
    for n, table in enumerate((docs.limit(0), nulls, good.unionByName(good).unionByName(nulls))):
        rows = table
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, rows, str(tmp_path)).write.parquet(f"{tmp_path}/{n}-{i}")
            rows = spark.read.parquet(f"{tmp_path}/{n}-{i}")
            if i < 4:
                assert rows.columns == docs.columns
        assert rows.count() == 0 or n == 2
