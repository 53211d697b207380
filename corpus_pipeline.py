"""From documents to a training mix: quality rules, near duplicates, benchmark passages, personal data, source weights.

Each stage takes (spark, docs, sf_dir). All but the last return documents with all their columns; the last returns the
documents of the mix with the number of copies of each.

Null or empty texts don't pass the quality rules. Documents with a null doc_id stay where near duplicates are dropped. Rows that repeat a
doc_id are one document there, and rows of their own elsewhere. An empty table gives an empty one at every stage; without benchmark items nothing
is dropped. Extra columns are carried along, whatever their names, but for the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyweave.llm import decontamination, minhash, mixing, pii, quality_rules
from skyweave.sources.shared import new_folder, remove


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the repetition and symbol rules keep; null and empty texts go."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each group of near duplicates, by five-word shingles; of ties nothing is left open, as ids differ, and
    repeated rows stay together."""
    return minhash.one_of_each(docs, size=5)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no benchmark passage stands; those without text stay."""
    return decontamination.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their personal data replaced by marks; null texts stay null."""
    return pii.mask(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes: doc_id, source, size, source_size, target, copies, taken."""
    return mixing.mix(docs).where("copies > 0")


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("personal data", personal_data),
    ("source mix", source_mix),
]

#: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each written as Parquet and read again as the next one's documents; a stage's table goes once the next one is
    written, and the last one's stays among the application's intermediate tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = new_folder(spark)
    for i, (_, stage) in enumerate(STAGES):
        done = stage(spark, docs, sf_dir)
        done.write.parquet(f"{base}/{i}")
        docs = spark.read.schema(done.schema).parquet(f"{base}/{i}")
        if i:
            remove(spark, f"{base}/{i - 1}")
    return docs
