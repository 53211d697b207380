"""Splits of recordings: whole recordings go to one split or fold, so that no scene leaks.

The greedy choice is sequential: recordings, a row each, stream sorted through one task, which holds the loads only. Recordings of equal size come in
the order of their names, or with a seed in that of the hash of seed and name.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweave.operators.runs import whole_targets

SPLITS = ("train", "val", "test")


def _in_order(rows: DataFrame, seed: int | None = None) -> DataFrame:
    """Largest first in one partition; rows without a name before all."""
    ties = ["bag_stem"] if seed is None else [F.md5(F.concat(F.lit(f"{seed}|"), "bag_stem")), "bag_stem"]
    return rows.repartition(1).sortWithinPartitions(F.col("bag_stem").isNotNull(), F.desc("n_scenes"), *ties)


def kfold(bags: DataFrame, k: int, seed: int | None = None, strict: bool = False) -> DataFrame:
    """(bag_stem, n_scenes, fold): largest first to the lightest fold, the lowest fold on ties. Rows without a name are left out. If strict, fewer
    recordings than folds are an error when the folds are computed; an empty table gives no folds."""

    def deal(batches):
        load, seen = [0] * k, 0
        for batch in batches:
            seen += batch.num_rows
            folds = []
            for n in batch.column(1).to_pylist():
                folds.append(load.index(min(load)))
                load[folds[-1]] += n
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(folds, pa.int32())], ["bag_stem", "n_scenes", "fold"])
        if strict and seen < k:
            raise ValueError(f"{seen} recordings are too few for {k} folds")

    rows = bags.where("bag_stem is not null").select("bag_stem", F.col("n_scenes").cast("bigint").alias("n_scenes"))
    return _in_order(rows, seed).mapInArrow(deal, "bag_stem string, n_scenes bigint, fold int")


def balanced_split(bags: DataFrame, ratios: tuple[float, float, float] = (0.7, 0.2, 0.1), seed: int | None = None, whole: bool = False) -> DataFrame:
    """(bag_stem, n_scenes, split): largest first to the split that lacks most scenes; train, val, test on ties. Rows without a name are left
    out. If whole, the targets are whole scenes, of which test gets what rounding leaves."""

    def deal(batches):
        lack = None
        for batch in batches:
            bags_, sizes, to = [], [], []
            for bag, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lack is None:  # the first row is the total
                    lack = list(whole_targets(n, ratios).values()) if whole else [n * r for r in ratios]
                    continue
                i = lack.index(max(lack))
                lack[i] -= n
                bags_.append(bag)
                sizes.append(n)
                to.append(SPLITS[i])
            yield pa.RecordBatch.from_arrays([pa.array(bags_, pa.string()), pa.array(sizes, pa.int64()), pa.array(to, pa.string())], ["bag_stem", "n_scenes", "split"])

    rows = bags.where("bag_stem is not null").select("bag_stem", F.col("n_scenes").cast("bigint").alias("n_scenes"))
    total = rows.agg(F.coalesce(F.sum("n_scenes"), F.lit(0)).alias("n_scenes")).select(F.lit(None).cast("string").alias("bag_stem"), "n_scenes")
    return _in_order(rows.unionByName(total), seed).mapInArrow(deal, "bag_stem string, n_scenes bigint, split string")


def fold_members(scenes: DataFrame, folds: DataFrame, k: int) -> DataFrame:
    """(fold, role, unique_scene): for each fold, val are the scenes of its recordings, train those of the others."""
    placed = scenes.join(folds.select("bag_stem", F.col("fold").alias("own")), "bag_stem")
    every = placed.withColumn("fold", F.explode(F.array(*map(F.lit, range(k)))))
    return every.select("fold", F.when(F.col("own") == F.col("fold"), "val").otherwise("train").alias("role"), "unique_scene")


def fold_files(files: DataFrame, folds: DataFrame, k: int, out: str, with_test: bool = True) -> DataFrame:
    """(fold, role, kind, source, target): the files of each fold's folder, a row a link. files are images and labels (kind, split, path); a scene of train
    or val takes part if it has both, of several files of a kind the one of the greatest path. It is val in its recording's fold and train in the others;
    scenes of test are test in every fold if with_test. The recording is the name before its last double underscore; scenes of other recordings are left out."""
    stem = F.regexp_extract("path", r"([^/]*?)(\.[^./]*)?$", 1)
    part = F.when(F.col("split") == "test", "test").otherwise("cv")
    own = files.withColumn("stem", stem).withColumn("part", part).groupBy("stem", "part").agg(*(F.max(F.when(F.col("kind") == n, F.col("path"))).alias(n) for n in ("image", "label"))).dropna(subset=["image", "label"])
    named = own.withColumn("bag_stem", F.regexp_extract("stem", "^(.*)__", 1)).join(folds.select("bag_stem", F.col("fold").alias("own")), "bag_stem", "left")
    placed = named.where(((F.col("part") == "cv") & F.col("own").isNotNull()) | ((F.col("part") == "test") & F.lit(with_test)))
    every = placed.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    role = F.when(F.col("part") == "test", "test").when(F.col("own") == F.col("fold"), "val").otherwise("train")
    links = every.withColumn("role", role).withColumn("_f", F.explode(F.array(*(F.struct(F.lit(n).alias("kind"), F.col(n).alias("source")) for n in ("image", "label")))))
    target = F.concat_ws("/", F.lit(out), F.concat(F.lit("fold_"), F.col("fold").cast("string")), F.concat("_f.kind", F.lit("s")), "role", F.regexp_extract("_f.source", "([^/]*)$", 1))
    return links.select("fold", "role", "_f.kind", "_f.source", target.alias("target"))
