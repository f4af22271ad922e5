"""Certified business questions over the domain tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplylens.functions import calendar as C
from supplylens.functions import measures as M
from supplylens.operators import derive
from supplylens.operators.windows import mean_of_group_means, top_k, with_share_of_total


def month_over_month(sales: DataFrame, anchor: date, key: str) -> DataFrame:
    """Last month, prior month, change and percentage change, in one pass.

    The two-month filter reaches the scan; members without sales in either month
    are not listed.
    """
    day, cents = F.col("order_date"), F.col("amount_cents")
    last = M.sum_if(C.month_window(day, anchor), cents)
    prior = M.sum_if(C.prior_month_window(day, anchor), cents)
    return (
        sales.where(C.two_month_window(day, anchor))
        .groupBy(key)
        .agg(
            M.dollars(last).alias("revenue_last_month"),
            M.dollars(prior).alias("revenue_prior_month"),
            M.dollars(last - prior).alias("revenue_change"),
            M.change_pct(last, prior).alias("revenue_change_pct"),
        )
    )


def revenue_by_region_mom(sales: DataFrame, anchor: date) -> DataFrame:
    return month_over_month(sales, anchor, "region").withColumns(
        {"last_month": C.month_name(anchor, -1), "prior_month": C.month_name(anchor, -2)}
    )


def revenue_by_family_mom(sales: DataFrame, anchor: date, region: str) -> DataFrame:
    return month_over_month(C.filter_dimension(sales, region=region), anchor, "product_family")


def worst_family_decline(sales: DataFrame, anchor: date, region: str) -> DataFrame:
    changes = revenue_by_family_mom(sales, anchor, region).select("product_family", "revenue_change")
    return top_k(changes, [F.col("revenue_change").asc(), F.col("product_family").asc()], 1)


def order_status_breakdown(sales: DataFrame, anchor: date, region: str) -> DataFrame:
    rows = C.filter_dimension(sales, region=region).where(C.month_window(F.col("order_date"), anchor))
    grouped = rows.groupBy("order_status").agg(
        F.count("*").alias("order_count"), M.dollars(F.sum("amount_cents")).alias("total_revenue")
    )
    return with_share_of_total(grouped, "order_count", "pct_of_orders")


def forecast_accuracy_latest(forecasts: DataFrame, region: str) -> DataFrame:
    return C.filter_dimension(C.latest_period_rows(forecasts, "forecast_month"), region=region).select(
        "region", "product_family", "forecast_demand_units", "actual_demand_units", "forecast_accuracy_pct", "bias"
    )


def stockouts_by_region(ledger: DataFrame) -> DataFrame:
    """SKU and position counts; positions collapse to one row per (region, SKU) first."""
    per_sku = ledger.groupBy("region", "sku_id").agg(
        F.max(F.col("stockout_flag").cast("bigint")).alias("_out"),
        F.sum(F.round(F.col("days_of_supply") * 10).cast("bigint")).alias("_tenths"),
        F.count("*").alias("_n"),
        M.sum_flag(F.col("below_safety_stock_flag")).alias("_below"),
    )
    return per_sku.groupBy("region").agg(
        F.sum("_out").alias("stockout_skus"),
        F.count("*").alias("total_skus"),
        F.round(F.sum("_tenths") / F.sum("_n") / 10.0, 1).alias("avg_days_of_supply"),
        F.sum("_below").alias("below_safety_stock_count"),
    )


def stock_net_flow(movements: DataFrame, anchor: date) -> DataFrame:
    quantity = F.col("quantity")
    return (
        movements.where(C.month_window(F.col("movement_date"), anchor))
        .groupBy("region")
        .agg(
            M.sum_if(quantity > 0, quantity).alias("total_inbound"),
            M.sum_if(quantity < 0, F.abs(quantity)).alias("total_outbound"),
            F.sum(quantity).alias("net_flow"),
        )
    )


def late_delivery_by_region(shipments: DataFrame, anchor: date) -> DataFrame:
    late = F.col("is_late")
    return (
        shipments.where(C.month_window(F.col("ship_date"), anchor))
        .groupBy("destination_region")
        .agg(
            F.count("*").alias("total_shipments"),
            M.sum_flag(late).alias("late_shipments"),
            M.rate_pct(late, 1).alias("late_pct"),
            M.avg_if(late, F.col("delay_days"), 1).alias("avg_delay_when_late"),
        )
    )


def delay_reason_share(shipments: DataFrame, anchor: date, region: str) -> DataFrame:
    """Reasons among late rows; a missing reason is a group of its own."""
    rows = shipments.where((F.col("destination_region") == region) & C.month_window(F.col("ship_date"), anchor))
    grouped = C.filter_flag(rows, "is_late").groupBy("delay_reason").agg(F.count("*").alias("cnt"))
    return with_share_of_total(grouped, "cnt", "pct")


def supplier_late_by_continent(supplier_orders: DataFrame, anchor: date) -> DataFrame:
    late = F.col("is_late")
    return (
        supplier_orders.where(C.month_window(F.col("order_date"), anchor))
        .groupBy("supplier_continent")
        .agg(
            F.count("*").alias("total_pos"),
            M.sum_flag(late).alias("late_pos"),
            M.rate_pct(late, 1).alias("late_pct"),
            F.round(F.avg("lead_time_variance_days"), 1).alias("avg_variance_days"),
        )
    )


def top_risk_suppliers(scorecard: DataFrame, k: int = 5) -> DataFrame:
    """Lowest composite scores, ties by supplier id."""
    columns = [
        "supplier_id",
        "supplier_name",
        "country",
        "risk_tier",
        "composite_risk_score",
        "sla_breaches",
        "total_penalty_usd",
        "lead_time_variance",
    ]
    return top_k(scorecard.select(*columns), [F.col("composite_risk_score").asc(), F.col("supplier_id").asc()], k)


def fulfilled_orders(sales: DataFrame, anchor: date, region: str) -> DataFrame:
    rows = C.filter_dimension(sales, region=region, order_status=derive.FULFILLED)
    return rows.where(C.month_window(F.col("order_date"), anchor)).agg(F.count("*").alias("fulfilled_orders"))


def fulfillment_rate(sales: DataFrame, anchor: date) -> DataFrame:
    status = F.col("order_status")
    return (
        sales.where(C.month_window(F.col("order_date"), anchor))
        .groupBy("region")
        .agg(
            M.ratio_pct(M.sum_flag(status == derive.FULFILLED), F.count("*")).alias("fulfillment_rate"),
            M.ratio_pct(M.sum_flag(status == derive.PARTIAL), F.count("*")).alias("partial_rate"),
        )
    )


def lead_time_variance(supplier_orders: DataFrame, anchor: date) -> DataFrame:
    """Average variance per continent and, on the row 'ALL', over every order."""
    grouped = (
        supplier_orders.where(C.month_window(F.col("order_date"), anchor))
        .groupBy("supplier_continent")
        .agg(F.sum("lead_time_variance_days").alias("_days"), F.count("*").alias("_n"))
    )
    scoped = grouped.select(F.explode(F.array("supplier_continent", F.lit("ALL"))).alias("scope"), "_days", "_n")
    return scoped.groupBy("scope").agg(F.round(F.sum("_days") / F.sum("_n"), 2).alias("avg_lead_time_variance"))


def vendor_late_pct(supplier_orders: DataFrame, anchor: date) -> DataFrame:
    """Late share per order, and for contrast the share of vendors with any late order."""
    per_vendor = (
        supplier_orders.where(C.month_window(F.col("order_date"), anchor))
        .groupBy("supplier_id")
        .agg(F.count("*").alias("_pos"), M.sum_flag(F.col("is_late")).alias("_late"))
    )
    return per_vendor.agg(
        M.ratio_pct(F.sum("_late"), F.sum("_pos")).alias("late_pct_per_order"),
        M.ratio_pct(M.sum_flag(F.col("_late") > 0), F.count("*")).alias("late_pct_per_vendor"),
    )


def sla_penalty_total(slas: DataFrame) -> DataFrame:
    return C.filter_flag(slas, "is_breached").agg(F.round(F.sum("penalty_amount"), 2).alias("total_sla_penalties"))


def inventory_positions(ledger: DataFrame) -> DataFrame:
    """Positions next to distinct SKUs below safety stock, from per-(region, SKU) rows."""
    per_sku = (
        C.filter_flag(ledger, "below_safety_stock_flag")
        .groupBy("region", "sku_id")
        .agg(F.count("*").alias("_n"), M.sum_flag(F.col("stockout_flag")).alias("_out"))
    )
    return per_sku.groupBy("region").agg(
        F.sum("_n").alias("positions_below_safety_stock"),
        F.count("*").alias("unique_skus_below_safety"),
        F.sum("_out").alias("stockout_positions"),
        M.sum_flag(F.col("_out") > 0).alias("stockout_skus"),
    )


def wasted_freight(shipments: DataFrame, anchor: date) -> DataFrame:
    rows = C.filter_flag(shipments, "is_late").where(C.month_window(F.col("ship_date"), anchor))
    return rows.groupBy("destination_region").agg(M.dollars(F.sum("cost_cents")).alias("wasted_freight_cost"))


def supplier_ontime_by_tier(scorecard: DataFrame) -> DataFrame:
    return scorecard.groupBy("continent", "risk_tier").agg(
        F.round(F.avg("on_time_pct"), 1).alias("avg_otd"),
        F.count("*").alias("suppliers"),
        F.sum("sla_breaches").alias("total_breaches"),
    )


def continent_ontime_mean(scorecard: DataFrame) -> DataFrame:
    return mean_of_group_means(scorecard, ["risk_tier"], "continent", "on_time_pct", "mean_otd")


# Fiscal quarter targets (quarter, year, calendar months, service level, on-time delivery, fill rate,
# description), fiscal year starting in July.
FISCAL_TARGETS = [
    ("Q1", 2027, "Jul 2026, Aug 2026, Sep 2026", 92.0, 85.0, 90.0, "FY2027 Q1: Ramp-up quarter."),
    ("Q2", 2027, "Oct 2026, Nov 2026, Dec 2026", 93.0, 88.0, 92.0, "FY2027 Q2: Holiday season."),
    ("Q3", 2027, "Jan 2027, Feb 2027, Mar 2027", 95.0, 92.0, 95.0, "FY2027 Q3: Peak performance target. Service level = 95%."),
    ("Q4", 2027, "Apr 2027, May 2027, Jun 2027", 94.0, 90.0, 93.0, "FY2027 Q4: Wind-down quarter."),
]
FISCAL_SCHEMA = (
    "fiscal_quarter string, fiscal_year int, calendar_months string, service_level_target_pct double, "
    "on_time_delivery_target_pct double, fill_rate_target_pct double, description string"
)


def fiscal_targets(spark) -> DataFrame:
    return spark.createDataFrame(FISCAL_TARGETS, FISCAL_SCHEMA)


def renewed_targets(targets: DataFrame, first: Column, last: Column) -> DataFrame:
    """The same targets set again for every fiscal year from ``first`` to ``last``."""
    years = F.explode(F.sequence(first, last)).alias("fiscal_year")
    return targets.drop("fiscal_year", "calendar_months", "description").select("*", years)


def service_level_gap(sales: DataFrame, targets: DataFrame) -> DataFrame:
    """Service level of every fiscal quarter against its target, with a colour band."""
    quarterly = sales.groupBy(
        C.fiscal_year(F.col("order_date")).alias("fiscal_year"),
        C.fiscal_quarter(F.col("order_date")).alias("fiscal_quarter"),
    ).agg(M.ratio_pct(M.sum_flag(F.col("order_status") == derive.FULFILLED), F.count("*"), 1).alias("service_level_pct"))
    gap = F.round(F.col("service_level_target_pct") - F.col("service_level_pct"), 1)
    return (
        quarterly.join(
            targets.select("fiscal_year", "fiscal_quarter", "service_level_target_pct"), ["fiscal_year", "fiscal_quarter"]
        )
        .withColumn("gap", gap)
        .withColumn("band", M.percentage_gap_band(F.col("gap")))
    )


def revenue_share_by_region(sales: DataFrame, anchor: date) -> DataFrame:
    grouped = (
        sales.where(C.month_window(F.col("order_date"), anchor))
        .groupBy("region")
        .agg(F.sum("amount_cents").alias("_cents"))
    )
    return (
        with_share_of_total(grouped, "_cents", "revenue_share_pct", 2)
        .select("region", M.dollars(F.col("_cents")).alias("total_revenue"), "revenue_share_pct")
        .orderBy(F.col("total_revenue").desc(), "region")
    )


def product_reconciliation(sales: DataFrame, anchor: date) -> DataFrame:
    """Per region: the family deltas must add up to the region's own, separately computed delta."""
    day, cents = F.col("order_date"), F.col("amount_cents")
    delta = M.sum_if(C.month_window(day, anchor), cents) - M.sum_if(C.prior_month_window(day, anchor), cents)
    window = sales.where(C.two_month_window(day, anchor))
    families = (
        window.groupBy("region", "product_family")
        .agg(delta.alias("_family"))
        .groupBy("region")
        .agg(F.sum("_family").alias("_sum"))
    )
    regions = window.groupBy("region").agg(delta.alias("_region"))
    return families.join(regions, "region").select(
        "region",
        M.dollars(F.col("_sum")).alias("sum_of_family_changes"),
        M.dollars(F.col("_region")).alias("region_change"),
        (F.col("_sum") == F.col("_region")).alias("matches"),
    )


def unfulfilled_revenue(sales: DataFrame, anchor: date) -> DataFrame:
    rows = sales.where(C.month_window(F.col("order_date"), anchor)).where(F.col("order_status") != derive.FULFILLED)
    return rows.groupBy("region").agg(
        F.count("*").alias("unfulfilled_orders"), M.dollars(F.sum("amount_cents")).alias("unfulfilled_revenue")
    )


def non_group_late_rate(supplier_orders: DataFrame, anchor: date, continent: str) -> DataFrame:
    """Late rate outside one continent, derived from the overall rate and its own."""
    here, late = F.col("supplier_continent") == continent, F.col("is_late")
    return (
        supplier_orders.where(C.month_window(F.col("order_date"), anchor))
        .agg(
            M.rate_pct(late).alias("overall_late_pct"),
            F.round(F.avg(F.when(here, late.cast("double"))) * 100, 2).alias("group_late_pct"),
            F.count("*").alias("total_pos"),
            M.count_if(here).alias("group_pos"),
        )
        .withColumn(
            "rest_late_pct",
            F.round(
                M.residual_rate(
                    F.col("overall_late_pct"), F.col("total_pos"), F.col("group_late_pct"), F.col("group_pos")
                ),
                2,
            ),
        )
    )
