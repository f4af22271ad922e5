"""Cost of disruption: what cancelled, delayed and late cost each region."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplylens.functions import calendar as C
from supplylens.functions import measures as M
from supplylens.operators import derive
from supplylens.operators.windows import with_share_of_total
from supplylens.plans.reports import stockout_skus_by_region


def demand_impact(sales: DataFrame, anchor: date) -> DataFrame:
    status, cents = F.col("order_status"), F.col("amount_cents")
    return (
        sales.where(C.month_window(F.col("order_date"), anchor))
        .groupBy("region")
        .agg(
            M.sum_if(status == derive.CANCELLED, cents).alias("cancelled_cents"),
            M.sum_if(status == derive.BACKORDERED, cents).alias("backordered_cents"),
            F.sum(cents).alias("revenue_cents"),
        )
    )


def logistics_impact(shipments: DataFrame, anchor: date) -> DataFrame:
    """Late freight and late counts by destination, with the count over all regions.

    The overall count is taken from the grouped rows (one per region) instead of a
    second pass over the shipments.
    """
    late = F.col("is_late")
    return (
        shipments.where(C.month_window(F.col("ship_date"), anchor))
        .groupBy(F.col("destination_region").alias("region"))
        .agg(
            M.sum_if(late, F.col("cost_cents")).alias("wasted_cents"),
            M.sum_flag(late).alias("late_shipment_count"),
        )
        .withColumn("all_late", F.sum("late_shipment_count").over(Window.partitionBy()))
    )


def penalty_pool(slas: DataFrame) -> Column:
    """Total penalties of breached SLAs as a scalar subquery."""
    breached = F.when(F.col("is_breached"), F.col("penalty_amount")).otherwise(F.lit(0.0))
    return slas.select(F.round(F.sum(breached), 2)).scalar()


def disruption_parts(
    sales: DataFrame, shipments: DataFrame, slas: DataFrame, anchor: date
) -> DataFrame:
    """Regions having both orders and shipments, with the unrounded parts in currency.

    Where no shipment is late at all the share has no denominator and the
    allocation is zero.
    """
    share = F.coalesce(F.col("late_shipment_count") / F.nullif(F.col("all_late"), F.lit(0)), F.lit(0.0))
    money = lambda name: F.col(name) / F.lit(100.0)
    return (
        demand_impact(sales, anchor)
        .join(logistics_impact(shipments, anchor), "region")
        .select(
            "region",
            money("cancelled_cents").alias("cancelled"),
            money("backordered_cents").alias("backordered"),
            money("wasted_cents").alias("wasted"),
            "late_shipment_count",
            (penalty_pool(slas) * share).alias("penalties"),
            money("revenue_cents").alias("revenue"),
        )
        .withColumn("exposed", F.col("cancelled") + F.col("backordered") + F.col("wasted"))
        .withColumn("total", F.col("exposed") + F.col("penalties"))
    )


def cost_of_disruption(
    sales: DataFrame, shipments: DataFrame, slas: DataFrame, ledger: DataFrame, anchor: date
) -> DataFrame:
    parts = disruption_parts(sales, shipments, slas, anchor)
    stockouts = stockout_skus_by_region(ledger)
    two = lambda name: F.round(F.col(name), 2)
    return parts.join(stockouts, "region", "left").select(
        "region",
        two("cancelled").alias("cancelled_revenue"),
        two("backordered").alias("backordered_at_risk_revenue"),
        two("wasted").alias("wasted_logistics_spend"),
        "late_shipment_count",
        two("penalties").alias("allocated_supplier_penalties"),
        two("total").alias("total_cost_of_disruption"),
        two("exposed").alias("revenue_at_risk_from_disruptions"),
        two("revenue").alias("total_region_revenue"),
        F.col("stockout_skus").alias("unique_stockout_skus"),
        M.ratio(F.col("backordered"), F.col("stockout_skus")).alias("revenue_at_risk_per_stockout_sku"),
        M.ratio(F.col("total"), F.col("revenue")).alias("disruption_to_revenue_ratio"),
    )


def late_share_allocation(shipments: DataFrame, slas: DataFrame, anchor: date) -> DataFrame:
    """Each region's share of late shipments and its part of the penalty pool."""
    late = (
        shipments.where(C.month_window(F.col("ship_date"), anchor))
        .groupBy(F.col("destination_region").alias("region"))
        .agg(M.count_if(F.col("is_late")).alias("late_shipment_count"))
    )
    shared = with_share_of_total(late, "late_shipment_count", "_share", None)
    return shared.select(
        "region",
        "late_shipment_count",
        F.round("_share", 4).alias("pct_of_late_shipments"),
        F.round(penalty_pool(slas) * F.col("_share") / 100, 2).alias("allocated_supplier_penalties"),
    )


def severity(total: Column, critical: float = 2_000_000, high: float = 1_000_000) -> Column:
    return F.when(total > critical, "CRITICAL").when(total > high, "HIGH").otherwise("MODERATE")


def disruption_severity(sales: DataFrame, shipments: DataFrame, slas: DataFrame, anchor: date) -> DataFrame:
    parts = disruption_parts(sales, shipments, slas, anchor)
    return parts.select(
        "region",
        F.round("total", 2).alias("total_cost_of_disruption"),
        severity(F.col("total")).alias("severity_level"),
    )


def region_cost_of_disruption(
    sales: DataFrame, shipments: DataFrame, slas: DataFrame, anchor: date, region: str
) -> DataFrame:
    """One region's total, from one-row aggregates over each table."""
    late, there = F.col("is_late"), F.col("destination_region") == region
    freight = shipments.where(C.month_window(F.col("ship_date"), anchor)).select(
        F.struct(
            M.dollars(M.sum_if(late & there, F.col("cost_cents"))).alias("wasted"),
            (M.count_if(late & there) / F.nullif(M.count_if(late), F.lit(0))).alias("share"),
        )
    )
    status, cents = F.col("order_status"), F.col("amount_cents")
    revenue = sales.where((F.col("region") == region) & C.month_window(F.col("order_date"), anchor)).agg(
        M.dollars(M.sum_if(status == derive.CANCELLED, cents)).alias("cancelled"),
        M.dollars(M.sum_if(status == derive.BACKORDERED, cents)).alias("backordered"),
    )
    joined = revenue.withColumns({"freight": freight.scalar(), "pool": penalty_pool(slas)})
    total = (
        F.col("cancelled") + F.col("backordered") + F.col("freight.wasted") + F.col("pool") * F.col("freight.share")
    )
    return joined.select(F.lit(region).alias("region"), F.round(total, 2).alias("total_cost_of_disruption"))


# Names of the stacked components.
COMPONENTS = {
    "cancelled_revenue": "cancelled",
    "backordered_at_risk_revenue": "backordered",
    "wasted_logistics_spend": "wasted_freight",
    "allocated_supplier_penalties": "sla_penalties",
}


def components_long(cost: DataFrame) -> DataFrame:
    """One row per region and component, missing amounts as zero."""
    filled = cost.select(
        "region",
        *[F.coalesce(F.col(c), F.lit(0.0)).alias(n) for c, n in COMPONENTS.items()],
        F.coalesce("total_cost_of_disruption", F.lit(0.0)).alias("total"),
    )
    return filled.unpivot(["region", "total"], list(COMPONENTS.values()), "component", "amount")


def other_component(cost: DataFrame, threshold: float = 10_000.0) -> DataFrame:
    """The part of each total the three charted components leave over, if it is material."""
    other = M.residual_component(
        F.col("total_cost_of_disruption"),
        F.col("wasted_logistics_spend"),
        F.col("allocated_supplier_penalties"),
        F.col("cancelled_revenue"),
    )
    return cost.select("region", F.round(other, 2).alias("other_amount")).where(F.col("other_amount") > threshold)


def derived_risk_metrics(cost: DataFrame, region: str) -> DataFrame:
    """Three derived values of one region as (test_id, description, gt_value) rows."""
    one = cost.where(F.col("region") == region)
    row = lambda tid, text, value: F.struct(
        F.lit(tid).alias("test_id"), F.lit(text).alias("description"), value.alias("gt_value")
    )
    return one.select(
        F.explode(
            F.array(
                row("H05", "Revenue at risk", F.col("revenue_at_risk_from_disruptions")),
                row("H06", "Revenue at risk per stockout SKU", F.col("revenue_at_risk_per_stockout_sku")),
                row("H07", "Cost of disruption to revenue", F.col("disruption_to_revenue_ratio")),
            )
        ).alias("m")
    ).select("m.*")
