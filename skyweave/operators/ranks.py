"""Ranks over a whole table without a task that holds it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyweave.sources.shared import materialize


def ranked(rows: DataFrame, order: list[str | Column], name: str = "rank") -> DataFrame:
    """The rows with their place in the order, from 0 on: rows are dealt by range and sorted where they are, and each range starts where those before it
    end. The ranges' sizes, a number each, meet on the driver. The order has to be total; rows that are equal by it lie in one range."""
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(dealt.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_at")))
    starts, before = [], 0
    for r in placed.groupBy("_range").count().orderBy("_range").collect():
        starts.append((r["_range"], before))
        before += r["count"]
    begin = rows.sparkSession.createDataFrame(starts, "_range int, _before bigint")
    return placed.join(F.broadcast(begin), "_range").select(*(F.col(f"`{c}`") for c in rows.columns), (F.col("_before") + F.col("_at")).alias(name))
