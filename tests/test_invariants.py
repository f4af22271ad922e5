"""Identities that must hold whatever the data."""

import pytest
from pyspark.sql import functions as F

from supplylens.plans import certified as Q
from supplylens.plans import disruption as D
from supplylens.plans import metric_views as V
from supplylens.sources.domain import SupplyTables


@pytest.fixture(scope="module")
def t(spark, small):
    return SupplyTables(spark, small)


def test_family_changes_add_up_to_region_changes(t):
    rows = Q.product_reconciliation(t.sales_orders(product=True), t.anchor).collect()
    assert rows and all(r["matches"] for r in rows)


def test_on_time_and_late_rates_complement(t):
    for r in V.delivery_performance(t.shipments(), t.anchor).query(["region"]).collect():
        assert abs(r["on_time_delivery_rate"] + r["late_delivery_rate"] - 100) < 0.011


def test_allocations_exhaust_the_pool(t):
    shared = D.late_share_allocation(t.shipments(), t.vendor_slas(), t.anchor).collect()
    pool = Q.sla_penalty_total(t.vendor_slas()).collect()[0][0]
    assert abs(sum(r["allocated_supplier_penalties"] for r in shared) - pool) < 0.05
    assert abs(sum(r["pct_of_late_shipments"] for r in shared) - 100) < 0.01


def test_cost_is_the_sum_of_its_components(t):
    cost = D.cost_of_disruption(t.sales_orders(), t.shipments(), t.vendor_slas(), t.inventory_ledger(), t.anchor)
    for r in cost.collect():
        parts = (
            r["cancelled_revenue"]
            + r["backordered_at_risk_revenue"]
            + r["wasted_logistics_spend"]
            + r["allocated_supplier_penalties"]
        )
        assert abs(parts - r["total_cost_of_disruption"]) < 0.03


def test_status_shares_sum_to_hundred(t):
    rows = Q.order_status_breakdown(t.sales_orders(), t.anchor, "ASIA").collect()
    assert abs(sum(r["pct_of_orders"] for r in rows) - 100) < 0.3


def test_facts_keep_one_row_per_line(t):
    lines = t.table("lineitem").count()
    for fact in (t.sales_orders(product=True), t.shipments(origin=True), t.supplier_orders(), t.stock_movements()):
        assert fact.count() == lines


def test_metric_view_rejects_unknown_names(t):
    view = V.supplier_performance(t.supplier_orders(), t.anchor)
    with pytest.raises(KeyError):
        view.query(["planet"])
    assert view.query().columns == list(view.measures)
    assert view.query(["supplier_continent"], ["late_purchase_orders"]).columns == [
        "supplier_continent",
        "late_purchase_orders",
    ]


def test_metric_view_overall_equals_sum_of_groups(t):
    view = V.supplier_performance(t.supplier_orders(), t.anchor)
    total = view.query(measures=["total_purchase_orders"]).collect()[0][0]
    parts = view.query(["supplier_continent"]).agg(F.sum("total_purchase_orders")).collect()[0][0]
    assert total == parts
