"""The four governed metric views."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplylens.functions import bitmaps as B
from supplylens.functions import calendar as C
from supplylens.functions import measures as M
from supplylens.operators.metric_view import MetricView

# Declared synonyms of measures and dimensions.
DELIVERY_SYNONYMS = {
    "region": ["destination region", "delivery region"],
    "on_time_delivery_rate": ["OTD rate", "on-time rate"],
    "late_delivery_rate": ["late rate"],
    "wasted_freight_cost": ["wasted freight"],
}
REVENUE_SYNONYMS = {
    "revenue_last_month": ["august revenue", "last month revenue"],
    "revenue_change_dollars": ["revenue change", "MoM change"],
}
INVENTORY_SYNONYMS = {
    "region": ["inventory region", "warehouse region"],
    "positions_below_safety_stock": ["below safety stock count", "items below safety stock"],
    "unique_skus_in_stockout": ["unique stockout SKUs"],
}
SUPPLIER_SYNONYMS = {
    "supplier_continent": ["vendor continent", "supplier region"],
    "supplier_late_rate_pct": [
        "vendor late rate",
        "vendor late delivery percentage",
        "percentage of vendors delivered late",
        "vendor late pct",
    ],
    "avg_lead_time_variance": ["lead time variance"],
}


def delivery_performance(shipments: DataFrame, anchor: date) -> MetricView:
    late = F.col("is_late")
    return MetricView(
        "delivery_performance_by_region",
        shipments.where(C.month_window(F.col("ship_date"), anchor)),
        {"region": F.col("destination_region")},
        {
            "on_time_delivery_rate": M.rate_pct(~late),
            "late_delivery_rate": M.rate_pct(late),
            "avg_delay_days": M.avg_if(late, F.col("delay_days")),
            "total_shipments": F.count("*"),
            "late_shipments": M.sum_flag(late),
            "wasted_freight_cost": M.dollars(M.sum_if(late, F.col("cost_cents"))),
        },
        DELIVERY_SYNONYMS,
    )


def revenue_comparison(sales: DataFrame, anchor: date) -> MetricView:
    """The source is unfiltered; every measure carries its own month window.

    A caller that wants only the two months can pass rows already filtered with
    ``two_month_window``: the values are the same, the scan is smaller, and
    dimension members without recent revenue are left out.
    """
    day, cents = F.col("order_date"), F.col("amount_cents")
    last = M.sum_if(C.month_window(day, anchor), cents)
    prior = M.sum_if(C.prior_month_window(day, anchor), cents)
    return MetricView(
        "revenue_comparison_by_region",
        sales,
        {"region": F.col("region"), "product_family": F.col("product_family")},
        {
            "revenue_last_month": M.dollars(last),
            "revenue_prior_month": M.dollars(prior),
            "revenue_change_dollars": M.dollars(last - prior),
            "revenue_change_pct": M.change_pct(last, prior),
        },
        REVENUE_SYNONYMS,
    )


def delivery_from_sums(shipped: DataFrame, anchor: date) -> MetricView:
    """``delivery_performance`` from daily sums."""
    lines, late = F.sum("lines"), F.sum("late_lines")
    return MetricView(
        "delivery_performance_by_region",
        shipped.where(C.month_window(F.col("ship_date"), anchor)),
        {"region": F.col("destination_region")},
        {
            "on_time_delivery_rate": F.round((lines - late) / lines * 100, 2),
            "late_delivery_rate": F.round(late / lines * 100, 2),
            "avg_delay_days": F.round(F.sum("delay_days") / F.nullif(F.sum("delays"), F.lit(0)), 2),
            "total_shipments": lines,
            "late_shipments": late,
            "wasted_freight_cost": M.dollars(F.sum("late_cents")),
        },
        DELIVERY_SYNONYMS,
    )


def inventory_safety_stock(ledger: DataFrame) -> MetricView:
    out = F.col("stockout_flag")
    return MetricView(
        "inventory_safety_stock_metrics",
        ledger.where("below_safety_stock_flag"),
        {"region": F.col("region")},
        {
            "positions_below_safety_stock": F.coalesce(F.sum("_n"), F.lit(0)),
            "unique_skus_below_safety": B.distinct(F.col("_below")),
            "stockout_positions": F.sum("_out"),
            "unique_skus_in_stockout": B.distinct(F.col("_out_skus")),
            "avg_days_of_supply": F.round(F.sum("_supply") / F.sum("_supplied"), 2),
        },
        INVENTORY_SYNONYMS,
        bucket=B.bucket_of(F.col("sku_id")),
        partials={
            "_n": F.count("*"),
            "_below": B.members(F.col("sku_id")),
            "_out": M.sum_flag(out),
            "_out_skus": B.members(F.col("sku_id"), out),
            "_supply": F.sum("days_of_supply"),
            "_supplied": F.count("days_of_supply"),
        },
    )


def supplier_performance(supplier_orders: DataFrame, anchor: date) -> MetricView:
    late = F.col("is_late")
    return MetricView(
        "supplier_performance_by_continent",
        supplier_orders.where(C.month_window(F.col("order_date"), anchor)),
        {"supplier_continent": F.col("supplier_continent")},
        {
            "total_purchase_orders": F.count("*"),
            "late_purchase_orders": M.sum_flag(late),
            "supplier_late_rate_pct": M.rate_pct(late),
            "avg_lead_time_variance": F.round(F.avg("lead_time_variance_days"), 2),
        },
        SUPPLIER_SYNONYMS,
    )


def declared_terms(t) -> list[tuple[str, str, str]]:
    """Phrases of all four views; the views are only declared, nothing runs."""
    views = [
        delivery_performance(t.shipments(), t.anchor),
        revenue_comparison(t.sales_orders(product=True), t.anchor),
        inventory_safety_stock(t.inventory_ledger()),
        supplier_performance(t.supplier_orders(), t.anchor),
    ]
    return [term for view in views for term in view.terms()]
