"""Mergeable distinct counts against count distinct."""

from pyspark.sql import functions as F

from supplylens.functions import bitmaps as B
from supplylens.registry import queries


def test_states_merge_to_the_count_of_all_rows(spark):
    rows = spark.range(200_000).select((F.col("id") % 5).alias("day"), (F.col("id") * 7919 % 90_001 - 40_000).alias("v"))
    rows = rows.union(spark.createDataFrame([(0, None), (9, None)], "day long, v long"))
    state = B.distinct_state(rows, ["day"], "v")
    per_day = sorted(tuple(r) for r in B.counted(state, ["day"], "n").collect())
    assert per_day == sorted(tuple(r) for r in rows.where("v is not null").groupBy("day").agg(F.count_distinct("v")).collect())
    two = state.where("day in (1, 3)")  # two days' states, without their rows
    assert B.counted(B.merged(two, []), [], "n").first()[0] == rows.where("day in (1, 3)").select("v").distinct().count()
    assert state.groupBy("day").count().agg(F.max("count")).first()[0] <= 4


def test_two_distinct_counts_in_one_pass_do_not_expand(spark, small):
    plan = queries()["inventory_safety_stock"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "bitmap_construct_agg" in plan


def test_no_rows(spark):
    empty = spark.createDataFrame([], "day date, v long")
    assert B.rolling_distinct(B.distinct_state(empty, ["day"], "v"), "day", 7, "n").collect() == []
    assert B.counted(B.merged(B.distinct_state(empty, [], "v"), []), [], "n").first()[0] == 0
