"""Cross-domain reporting views."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplylens.functions import calendar as C
from supplylens.functions import measures as M
from supplylens.operators import derive


def stockout_skus_by_region(ledger: DataFrame) -> DataFrame:
    """Distinct stocked-out SKUs of every region, zero included.

    Each (region, SKU) pair is reduced to one flag first, so the distinct count
    becomes a plain sum.
    """
    per_sku = ledger.where(F.col("region").isNotNull()).groupBy("region", "sku_id").agg(
        F.max(F.col("stockout_flag").cast("bigint")).alias("_out")
    )
    return per_sku.groupBy("region").agg(F.sum("_out").alias("stockout_skus"))


def order_totals(sales: DataFrame) -> DataFrame:
    """Region totals with a distinct order count, from one row per (region, order)."""
    per_order = sales.groupBy("region", "order_id").agg(
        F.count("*").alias("_lines"),
        F.sum("amount_cents").alias("_cents"),
        M.sum_flag(F.col("order_status") == derive.FULFILLED).alias("_fulfilled"),
    )
    lines, cents = F.sum("_lines"), F.sum("_cents")
    return per_order.groupBy("region").agg(
        F.count("*").alias("total_orders"),
        F.round(cents / lines / 100.0, 2).alias("avg_order_value"),
        M.dollars(cents).alias("total_revenue"),
        M.ratio_pct(F.sum("_fulfilled"), lines, 1).alias("fulfillment_rate"),
    )


def regional_performance_summary(
    sales: DataFrame, ledger: DataFrame, shipments: DataFrame, anchor: date
) -> DataFrame:
    """Regions with orders last month, plus stockouts and late deliveries (0 when absent)."""
    orders = order_totals(sales.where(C.month_window(F.col("order_date"), anchor)))
    late = (
        shipments.where(C.month_window(F.col("ship_date"), anchor))
        .groupBy(F.col("destination_region").alias("region"))
        .agg(M.rate_pct(F.col("is_late"), 1).alias("late_shipment_pct"))
    )
    return (
        orders.join(stockout_skus_by_region(ledger), "region", "left")
        .join(late, "region", "left")
        .withColumns(
            {
                "stockout_skus": F.coalesce("stockout_skus", F.lit(0)),
                "late_shipment_pct": F.coalesce("late_shipment_pct", F.lit(0.0)),
            }
        )
    )


def revenue_trend(sales: DataFrame, anchor: date, parts: int) -> DataFrame:
    """Revenue and distinct orders by day, region and family.

    The lines are dealt by order into ``parts`` first, as an order has hardly two lines of a family: grouped in the
    task that joins them, they would stand beside the rows of the join.
    """
    keys = ["order_date", "region", "product_family"]
    per_order = sales.repartition(parts, "order_id").groupBy(*keys, "order_id").agg(F.sum("amount_cents").alias("_cents"))
    return (
        per_order.groupBy(*keys)
        .agg(M.dollars(F.sum("_cents")).alias("daily_revenue"), F.count("*").alias("order_count"))
        .withColumn("period", C.period_label(F.col("order_date"), anchor))
    )


def breached_totals(slas: DataFrame) -> DataFrame:
    return slas.where("is_breached").groupBy("supplier_id").agg(
        F.count("*").alias("sla_breaches"), F.round(F.sum("penalty_amount"), 2).alias("total_penalty_usd")
    )


def supplier_risk_scorecard(suppliers: DataFrame, lead_times: DataFrame, slas: DataFrame) -> DataFrame:
    """Composite score per supplier; a low score is risky.

    ``lead_times`` is read for its newest month and for that month's rows, so pass a
    stored table or the lead times of the newest month alone.
    """
    latest = C.latest_period_rows(lead_times, "month").select(
        "supplier_id", "avg_actual_lead_time_days", "lead_time_variance_days", "on_time_delivery_pct"
    )
    or_zero = lambda name: F.coalesce(F.col(name), F.lit(0.0))
    score = (
        F.coalesce("on_time_delivery_pct", F.lit(50.0)) * 0.4
        + F.col("reliability_score") * 10 * 0.3
        + (F.lit(100.0) - F.least(or_zero("lead_time_variance_days") * 5, F.lit(100.0))) * 0.3
    )
    return (
        suppliers.join(latest, "supplier_id", "left")
        .join(breached_totals(slas), "supplier_id", "left")
        .select(
            "supplier_id",
            "supplier_name",
            "country",
            "continent",
            "risk_tier",
            "reliability_score",
            or_zero("avg_actual_lead_time_days").alias("latest_lead_time_days"),
            or_zero("lead_time_variance_days").alias("lead_time_variance"),
            or_zero("on_time_delivery_pct").alias("on_time_pct"),
            F.coalesce("sla_breaches", F.lit(0)).alias("sla_breaches"),
            or_zero("total_penalty_usd").alias("total_penalty_usd"),
            F.round(score, 1).alias("composite_risk_score"),
        )
    )


def one_row(*parts: DataFrame) -> DataFrame:
    """Put the columns of several one-row results side by side without a join."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def executive_kpis(
    sales: DataFrame, ledger: DataFrame, shipments: DataFrame, supplier_orders: DataFrame, slas: DataFrame, anchor: date
) -> DataFrame:
    """Nine company-wide KPIs in one row, one conditional aggregate per table."""
    day, cents = F.col("order_date"), F.col("amount_cents")
    last, prior = C.month_window(day, anchor), C.prior_month_window(day, anchor)
    fulfilled = F.col("order_status") == derive.FULFILLED
    demand = sales.where(C.two_month_window(day, anchor)).agg(
        F.round(F.sum(F.when(last, cents)) / 100.0, 0).alias("revenue_last_month"),
        F.round(F.sum(F.when(prior, cents)) / 100.0, 0).alias("revenue_prior_month"),
        M.ratio_pct(M.sum_flag(last & fulfilled), M.count_if(last), 1).alias("service_level_pct"),
    )
    stock = (
        ledger.groupBy("sku_id")
        .agg(
            F.max(F.col("stockout_flag").cast("bigint")).alias("_out"),
            F.sum("days_of_supply").alias("_days"),
            F.count("days_of_supply").alias("_n"),
        )
        .agg(
            F.coalesce(F.sum("_out"), F.lit(0)).alias("total_stockout_skus"),
            F.round(F.sum("_days") / F.nullif(F.sum("_n"), F.lit(0)), 1).alias("avg_days_of_supply"),
        )
    )
    late = F.col("is_late")
    delivery = shipments.where(C.month_window(F.col("ship_date"), anchor)).agg(
        M.rate_pct(late, 1).alias("late_delivery_pct_last_month"),
        M.avg_if(late, F.col("delay_days"), 1).alias("avg_delay_days_last_month"),
    )
    vendors = supplier_orders.where(last).agg(M.rate_pct(late, 1).alias("supplier_late_pct_last_month"))
    breaches = slas.agg(M.count_if(F.col("is_breached")).alias("total_sla_breaches"))
    return one_row(demand, stock, delivery, vendors, breaches)
