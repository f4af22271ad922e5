"""Hand-made edge cases the generated tables never contain."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from supplylens.functions import calendar as C
from supplylens.functions import measures as M
from supplylens.operators import actions as A
from supplylens.operators import derive
from supplylens.operators.joins import alias_values, fk_orphans, without_counterpart
from supplylens.operators.windows import latest_per_key, mean_of_group_means, with_previous_month
from supplylens.plans import certified as Q
from supplylens.plans import disruption as D
from supplylens.plans import reports as R

ANCHOR = dt.date(2026, 9, 1)
AUG, JUL = dt.date(2026, 8, 5), dt.date(2026, 7, 5)
SALES = "order_id long, order_date date, region string, sku_id long, amount_cents long, order_status string"
SHIP = "ship_date date, destination_region string, is_late boolean, delay_days long, cost_cents long"
SLA = "supplier_id long, is_breached boolean, penalty_amount double"
STOCK = (
    "warehouse_id long, sku_id long, region string, on_hand_qty long, days_of_supply double, "
    "stockout_flag boolean, below_safety_stock_flag boolean"
)


@pytest.fixture(scope="module")
def world(spark):
    sales = spark.createDataFrame(
        [
            (1, AUG, "Western", 1, 10000, "Fulfilled"),
            (1, AUG, "Western", 2, 5000, "Cancelled"),
            (2, AUG, "Western", 1, 2500, "Backordered"),
            (3, AUG, "Eastern", 1, 4000, "Fulfilled"),
            (4, JUL, "Western", 1, 20000, "Fulfilled"),
            (5, JUL, "Southern", 1, 9900, "Fulfilled"),
        ],
        SALES,
    )
    ships = spark.createDataFrame(
        [
            (AUG, "Western", True, 4, 700),
            (AUG, "Western", False, 0, 300),
            (AUG, "Central", True, 2, 500),
            (AUG, "Eastern", False, 0, 100),
        ],
        SHIP,
    )
    slas = spark.createDataFrame([(1, True, 100.0), (1, False, 0.0), (2, True, 50.5)], SLA)
    stock = spark.createDataFrame(
        [
            (1, 1, "Western", 0, 0.0, True, True),
            (2, 1, "Western", 0, 0.0, True, True),
            (1, 2, "Western", 5, 1.5, False, True),
            (3, 1, "Eastern", 50, 9.0, False, False),
        ],
        STOCK,
    )
    return sales, ships, slas, stock


def by(df, key="region"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_region_with_shipments_only_is_not_listed(world):
    sales, ships, _, stock = world
    rows = by(R.regional_performance_summary(sales, stock, ships, ANCHOR))
    assert set(rows) == {"Western", "Eastern"}
    assert rows["Western"]["total_orders"] == 2 and rows["Western"]["stockout_skus"] == 1
    assert rows["Western"]["late_shipment_pct"] == 50.0 and rows["Eastern"]["stockout_skus"] == 0


def test_cost_of_disruption_needs_orders_and_shipments(world):
    sales, ships, slas, stock = world
    rows = by(D.cost_of_disruption(sales, ships, slas, stock, ANCHOR))
    assert set(rows) == {"Western", "Eastern"}
    west = rows["Western"]
    assert west["cancelled_revenue"] == 50.0 and west["backordered_at_risk_revenue"] == 25.0
    assert west["wasted_logistics_spend"] == 7.0 and west["allocated_supplier_penalties"] == 75.25
    assert west["total_cost_of_disruption"] == 157.25
    assert west["revenue_at_risk_per_stockout_sku"] == 25.0
    assert rows["Eastern"]["revenue_at_risk_per_stockout_sku"] is None
    assert rows["Eastern"]["allocated_supplier_penalties"] == 0.0


def test_no_late_shipment_anywhere(world):
    sales, ships, slas, stock = world
    calm = ships.withColumn("is_late", F.lit(False))
    rows = by(D.cost_of_disruption(sales, calm, slas, stock, ANCHOR))
    assert rows["Western"]["allocated_supplier_penalties"] == 0.0
    assert rows["Western"]["total_cost_of_disruption"] == 75.0
    one = D.region_cost_of_disruption(sales, ships, slas, ANCHOR, "Western").collect()[0]
    assert one["total_cost_of_disruption"] == 157.25


def test_prior_month_without_revenue_gives_no_percentage(world):
    rows = by(Q.revenue_by_region_mom(world[0], ANCHOR))
    assert rows["Eastern"]["revenue_change_pct"] is None and rows["Eastern"]["revenue_change"] == 40.0
    assert rows["Western"]["revenue_change_pct"] == -12.5
    assert rows["Southern"]["revenue_last_month"] == 0.0
    assert rows["Western"]["last_month"] == "August 2026" and rows["Western"]["prior_month"] == "July 2026"


def test_stockout_counts_distinct_skus(world):
    rows = by(Q.inventory_positions(world[3]))
    assert rows["Western"]["positions_below_safety_stock"] == 3
    assert rows["Western"]["unique_skus_below_safety"] == 2
    assert rows["Western"]["stockout_positions"] == 2 and rows["Western"]["stockout_skus"] == 1


def test_scorecard_defaults_without_lead_time(spark):
    suppliers = spark.createDataFrame(
        [(1, "A", "X", "Asia", "High", 5.0), (2, "B", "Y", "Europe", "Low", 9.0)],
        "supplier_id long, supplier_name string, country string, continent string, risk_tier string, "
        "reliability_score double",
    )
    leads = spark.createDataFrame(
        [(dt.date(2026, 8, 1), 1, 40.0, 30.0, 40.0), (dt.date(2026, 7, 1), 2, 20.0, 1.0, 92.0)],
        "month date, supplier_id long, avg_actual_lead_time_days double, lead_time_variance_days double, "
        "on_time_delivery_pct double",
    )
    slas = spark.createDataFrame([(1, True, 10.0), (1, True, 5.0)], SLA)
    rows = by(R.supplier_risk_scorecard(suppliers, leads, slas), "supplier_id")
    assert rows[1]["composite_risk_score"] == 31.0 and rows[1]["sla_breaches"] == 2
    assert rows[2]["on_time_pct"] == 0.0 and rows[2]["composite_risk_score"] == 77.0
    assert [r["supplier_id"] for r in Q.top_risk_suppliers(R.supplier_risk_scorecard(suppliers, leads, slas), 1).collect()] == [1]


ITEMS = "action_id long, run_id string, category string, timeframe string, domain string, title string, priority long, status string, created_at timestamp"
EVALS = "evaluation_id long, action_id long, evaluated_at timestamp, recommendation string, practicality_score double, reasoning string"


@pytest.fixture(scope="module")
def actions(spark):
    at = dt.datetime(2026, 8, 1, 12)
    items = spark.createDataFrame(
        [(i, "r", "IMMEDIATE", "Next 7 Days", "demand", f"t{i}", i, "PENDING", at) for i in (1, 2, 3)], ITEMS
    )
    evals = spark.createDataFrame(
        [
            (10, 1, at, "PROCEED", 0.9, ""),
            (11, 1, at, "REJECT", 0.2, ""),
            (12, 2, at, "PROCEED_WITH_CAUTION", 0.5, ""),
            (13, None, at, "DEFER", 0.5, ""),
        ],
        EVALS,
    )
    return items, evals


def test_action_without_evaluation_is_high_risk_and_blue(actions):
    rows = by(A.action_tracker(*actions), "action_id")
    assert (rows[3]["risk_level"], rows[3]["status_color"]) == ("HIGH", "blue")
    assert (rows[1]["recommendation"], rows[1]["risk_level"]) == ("REJECT", "HIGH")
    assert (rows[2]["status_color"], rows[2]["risk_level"]) == ("orange", "MEDIUM")


def test_same_instant_is_ordered_by_id_and_single_evaluations_give_no_change(actions):
    rows = A.recommendation_changes(*actions).collect()
    assert [(r["action_id"], r["prev_rec"], r["curr_rec"], r["status"]) for r in rows] == [
        (1, "PROCEED", "REJECT", "CHANGED")
    ]


def test_null_keys_never_hide_pending_actions(actions):
    texts = {c: F.lit("x") for c in ("description", "specific_steps", "expected_impact")}
    items = actions[0].withColumns(texts)
    assert [r["action_id"] for r in A.pending_unevaluated(items, actions[1]).collect()] == [3]
    waiting = items.where("status = 'PENDING'").count()
    assert A.pending_unevaluated(items, actions[1], again=True).count() == waiting
    assert without_counterpart(actions[0], actions[1], "action_id").count() == 1


def test_queue_filter_and_kpis(spark):
    rows = [
        ("demand", "Next 7 Days", "", 1, "PROCEED", 0.8),
        ("demand", "Next 30 Days", "APPROVED", 3, "PROCEED_WITH_CAUTION", 0.5),
        ("finance", "Next 7 Days", None, 7, None, None),
    ]
    tracked = spark.createDataFrame(
        rows,
        "domain string, timeframe string, user_decision string, priority long, recommendation string, "
        "practicality_score double",
    )
    assert A.queue_filter(tracked).count() == 3
    assert A.queue_filter(tracked, domains=["demand"], state="undecided", band="critical").count() == 1
    assert A.queue_filter(tracked, state="decided", band="high").count() == 1
    assert A.queue_filter(tracked, timeframes=["Next 7 Days"], band="low").count() == 1
    k = A.queue_kpis(tracked).collect()[0]
    assert (k["total"], k["proceed"], k["caution"], k["decided"], k["pending"]) == (3, 1, 1, 1, 2)
    assert {r[0]: r[1] for r in A.recommendation_mix(tracked).collect()}["PENDING"] == 1


def test_calendar_functions(spark):
    days = [dt.date(2026, 7, 1), dt.date(2026, 6, 30), dt.date(2026, 8, 31), dt.date(2026, 9, 1), dt.date(2027, 1, 15)]
    d = F.col("d")
    out = (
        spark.createDataFrame([(x,) for x in days], "d date")
        .select(
            "d",
            C.period_label(d, ANCHOR).alias("p"),
            C.fiscal_quarter(d).alias("q"),
            C.fiscal_year(d).alias("y"),
        )
        .collect()
    )
    got = {r["d"]: (r["p"], r["q"], r["y"]) for r in out}
    assert got[days[0]] == ("Prior_Month", "Q1", 2027)
    assert got[days[1]] == ("Older", "Q4", 2026)
    assert got[days[2]] == ("Last_Month", "Q1", 2027)
    assert got[days[3]] == ("Older", "Q1", 2027)
    assert got[days[4]] == ("Older", "Q3", 2027)
    assert C.month_start(dt.date(2026, 1, 15), -2) == dt.date(2025, 11, 1)


def test_scalar_helpers(spark):
    row = spark.range(1).select(
        M.to_cents(F.lit(-1.004)).alias("negative"),
        M.to_cents(F.lit(-0.125) * 10).alias("half"),
        M.to_cents(F.lit(19.99)).alias("positive"),
        M.ratio_pct(F.lit(1), F.lit(0)).alias("nothing"),
        M.residual_rate(F.lit(75.0), F.lit(48), F.lit(100.0), F.lit(30)).alias("rest"),
        M.residual_rate(F.lit(75.0), F.lit(30), F.lit(75.0), F.lit(30)).alias("nobody"),
        M.residual_component(F.lit(10.0), F.lit(7.0), F.lit(5.0)).alias("left"),
        derive.line_amount(F.lit(3), F.lit(1.335)).alias("amount"),
        derive.replenishment_status(F.lit(4)).alias("repl"),
        derive.tracking_event(F.lit(9)).alias("late_event"),
        derive.tracking_note(F.lit("At_Hub"), F.lit(True), F.lit(2)).alias("note"),
        derive.budget_variance(F.lit(110), F.lit(100)).alias("over"),
        derive.concentration_risk(F.lit("Footwear")).alias("risk"),
    ).collect()[0]
    assert row["negative"] == -100
    assert row["half"] == -125 and row["positive"] == 1999 and row["nothing"] is None
    assert abs(row["rest"] - 33.333333) < 1e-5 and row["nobody"] == 0.0 and row["left"] == 0.0
    assert row["repl"] == "Low" and row["late_event"] == "Returned"
    assert row["note"] == "Shipment at hub - DELAYED" and row["over"] == 10.0 and row["risk"] == "High"


def test_past_actions_keep_fractions_ties_and_whole_lessons(spark):
    row = (1, "2000-01-01", "d", "t", "SUCCESS", 1250, "fill_rate", 4.2, 8.7, "x" * 400)
    history = spark.createDataFrame(
        [row],
        "history_id long, action_date string, domain string, title string, success_rating string, cost_cents long, "
        "metric_name string, metric_before float, metric_after float, lessons_learned string",
    )
    line = A.precedent_lines(history).collect()[0]["line"]
    assert "(+4.5). Lesson: " + "x" * 400 in line and "($12)" in line
    assert A.history_display(history).collect()[0]["cost"] == "$12"


def test_aliases_orphans_and_months(spark):
    spoken = spark.createDataFrame([("West",), (" western ",), ("the coast",), ("x",), ("",), ("  ",), (None,), ("e",)], "region string")
    mapped = alias_values(spoken, "region", {"the coast": "Western"}, ["Western", "Eastern", "Edge"], "stored")
    assert [r["stored"] for r in mapped.collect()] == ["Western", "Western", "Western", None, None, None, None, None]
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    parent = spark.createDataFrame([(2,)], "id long")
    r = fk_orphans("c.p", child, "k", parent, "id").collect()[0]
    assert (r["orphan_rows"], r["orphan_keys"]) == (2, 1)
    months = spark.createDataFrame(
        [(dt.date(2026, 1, 1), "a", 5), (dt.date(2026, 2, 1), "a", 6), (dt.date(2026, 4, 1), "a", 7)],
        "m date, k string, v long",
    )
    got = with_previous_month(months, ["k"], "m", "v", "before").collect()
    assert [(r["m"].month, r["before"]) for r in got] == [(2, 5)]
    means = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 3.0), ("a", "y", 8.0)], "g string, s string, v double")
    assert mean_of_group_means(means, ["s"], "g", "v", "m").collect()[0]["m"] == 5.0
    assert latest_per_key(months, ["k"], ["m"]).collect()[0]["v"] == 7
