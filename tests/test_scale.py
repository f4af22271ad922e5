"""Hot keys, plan shape and pushdown."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from supplylens import registry
from supplylens.operators.joins import skew_safe_join
from supplylens.operators.windows import index_within_key, latest_and_previous, previous_within_key
from supplylens.plans import certified as Q
from supplylens.sources.domain import SupplyTables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot(spark):
    """30,000 rows of which a third belong to key 0."""
    n = F.col("id")
    return spark.range(30000).select(
        n.alias("row_id"),
        F.when(n % 3 == 0, F.lit(0)).otherwise(n % 500).alias("key"),
        F.pmod(F.xxhash64("id"), F.lit(4000)).alias("t"),
        (n % 7 == 0).alias("flag"),
    )


def test_salted_join_equals_plain_join(spark, hot):
    one = spark.range(400).select(F.col("id").alias("key"), (F.col("id") * 10).alias("w"))
    for how in ("inner", "left"):
        some_null = hot.withColumn("key", F.when(F.col("row_id") % 5 != 0, F.col("key")))
        salted = skew_safe_join(some_null, one, "key", "row_id", how, max_share=0.01)
        plain = some_null.join(one, "key", how)
        assert salted.exceptAll(plain.select(*salted.columns)).count() == 0
        assert salted.count() == plain.count()


def test_blocked_position_equals_row_number(hot):
    got = index_within_key(hot, ["key"], F.floor(F.col("t") / 100), ["t", "row_id"], "i").select("row_id", "i")
    whole = Window.partitionBy("key").orderBy("t", "row_id")
    want = hot.withColumn("i", (F.row_number().over(whole) - 1).cast("bigint")).select("row_id", "i")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_blocked_previous_equals_lag(hot):
    got = previous_within_key(hot, ["key"], F.floor(F.col("t") / 100), ["t", "row_id"], "flag", "p").select("row_id", "p")
    whole = Window.partitionBy("key").orderBy("t", "row_id")
    want = hot.withColumn("p", F.lag("flag").over(whole)).select("row_id", "p")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_latest_two_limit_rows_before_the_shuffle(hot):
    text = plan(latest_and_previous(hot, ["key"], ["t", "row_id"], ["flag"]))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1


def test_hot_join_partitions_are_split(spark, hot):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        one = spark.range(400).select(F.col("id").alias("key"), (F.col("id") * 10).alias("w"))
        joined = hot.repartition(16).join(one, "key").groupBy("key", "w").agg(
            F.count("*").alias("n"), F.max(F.struct("t", "row_id")).alias("last")
        )
        assert joined.agg(F.sum("n")).collect()[0][0] == hot.where("key < 400").count()
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_month_filter_and_columns_reach_the_scan(spark, small):
    t = SupplyTables(spark, small)
    text = plan(Q.revenue_by_region_mom(t.sales_orders(), t.anchor))
    scans = [line for line in text.splitlines() if "FileScan" in line]
    orders = next(s for s in scans if "o_orderdate" in s)
    assert "GreaterThanOrEqual(o_orderdate" in orders and "LessThan(o_orderdate" in orders
    lines = next(s for s in scans if "l_orderkey" in s)
    schema = lines.split("ReadSchema")[1]
    assert "l_extendedprice" in schema and "l_partkey" not in schema and "l_comment" not in schema
    assert "part.parquet" not in text and "supplier.parquet" not in text
    late = plan(Q.late_delivery_by_region(t.shipments(), t.anchor))
    assert "GreaterThanOrEqual(l_shipdate" in late


# Queries whose call itself runs jobs to write something first.
@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_python_rows_and_no_cross_products(spark, small, name):
    text = plan(registry.queries()[name](spark, small))
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text, bad


def test_staged_facts_give_the_same_answers_and_prune_days(spark, small):
    from supplylens.plans.disruption import cost_of_disruption
    from supplylens.plans.reports import executive_kpis, supplier_risk_scorecard
    from supplylens.session import new_folder
    from supplylens.sources.staged import stage_facts

    direct = SupplyTables(spark, small)
    root, days = new_folder(spark, "staged"), [dt.date(1999, 11, 1), dt.date(1999, 12, 1), dt.date(2000, 1, 1)]
    stage_facts(direct, root, days[0], days[1])
    staged = stage_facts(direct, root, days[1], days[2])
    facts = lambda t: (t.sales_orders(), t.shipments(), t.vendor_slas(), t.inventory_ledger(), t.anchor)
    answers = [
        lambda t: cost_of_disruption(*facts(t)),
        lambda t: Q.revenue_by_family_mom(t.sales_orders(product=True), t.anchor, "ASIA"),
        lambda t: supplier_risk_scorecard(t.suppliers(), t.supplier_lead_times(), t.vendor_slas()),
        lambda t: executive_kpis(
            t.sales_orders(), t.inventory_ledger(), t.shipments(), t.supplier_orders(), t.vendor_slas(), t.anchor
        ),
    ]
    for answer in answers:
        a, b = answer(direct), answer(staged)
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))
    text = plan(Q.revenue_by_region_mom(staged.sales_orders(), staged.anchor))
    assert "Join" not in text and "PartitionFilters: [isnotnull(order_date" in text


@pytest.mark.parametrize("name", ["revenue_trend", "stockouts_by_region", "inventory_positions"])
def test_lines_are_dealt_by_their_number_before_they_are_grouped(spark, small, monkeypatch, name):
    monkeypatch.setattr("supplylens.sources.domain.LINES_PER_TASK", 500)
    lines = spark.read.parquet(f"{small}/lineitem.parquet").count()
    text = plan(registry.queries()[name](spark, small))
    assert text.count("REPARTITION_BY_NUM") == 1
    above, below = text.split(", REPARTITION_BY_NUM")
    assert above.endswith(f", {-(-lines // 500)})") and "HashAggregate" in above and "HashAggregate" not in below
