"""Pixels are made from line items that are shuffled once, as they are."""

from skyweave.sources.relations import relation


def test_pixels_take_one_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = relation(spark, "/root/testdata/sf0.001", "px")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(dealt) == 2 and sum("l_suppkey" in line for line in dealt) == 1, dealt  # the other one deals the scenes
