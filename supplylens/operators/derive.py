"""Derived fact columns: amounts, flags, lateness, stock cover and variances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of statuses, recommendations, movements and event types.
FULFILLED = "Fulfilled"
PARTIAL = "Partially_Fulfilled"
BACKORDERED = "Backordered"
CANCELLED = "Cancelled"
EVENT_TYPES = ["Picked_Up", "In_Transit", "At_Hub", "Out_For_Delivery", "Delivered", "Exception", "Returned"]
CONCENTRATED_FAMILIES = ["Apparel", "Electronics", "Footwear"]


def order_status(state: Column, returned: Column) -> Column:
    return (
        F.when(state == "F", FULFILLED)
        .when(state == "P", PARTIAL)
        .when(returned == "R", CANCELLED)
        .otherwise(BACKORDERED)
    )


def line_amount(quantity: Column, price: Column) -> Column:
    return F.round(quantity * price, 2)


def forecast_quality(df: DataFrame) -> DataFrame:
    """Accuracy and bias of forecast against actual units."""
    forecast, actual = F.col("forecast_demand_units"), F.col("actual_demand_units")
    low, high = F.least(forecast, actual), F.greatest(forecast, actual)
    return df.withColumns(
        {
            "forecast_accuracy_pct": F.round(low / F.nullif(high, F.lit(0)) * 100, 1),
            "bias": F.round((forecast - actual) / F.nullif(actual, F.lit(0)) * 100, 1),
        }
    )


def stock_flags(df: DataFrame) -> DataFrame:
    on_hand, safety = F.col("on_hand_qty"), F.col("safety_stock_level")
    return df.withColumns(
        {
            "stockout_flag": on_hand == 0,
            "below_safety_stock_flag": on_hand < safety,
            "reorder_point": safety * 2,
        }
    )


def days_of_supply(on_hand: Column, daily_demand: Column) -> Column:
    return F.round(on_hand / F.greatest(daily_demand, F.lit(1.0)), 1)


def available_qty(on_hand: Column, reserved: Column) -> Column:
    return F.greatest(F.lit(0), on_hand - reserved)


def replenishment_status(on_hand: Column) -> Column:
    return F.when(on_hand == 0, "Stockout").when(on_hand < 5, "Low").otherwise("Adequate")


def movement_type(line_status: Column, return_flag: Column) -> Column:
    return (
        F.when((line_status == "F") & (return_flag == "R"), "Return_Receipt")
        .when((line_status == "F") & (return_flag == "A"), "Transfer_In")
        .when(line_status == "F", "Inbound_Receipt")
        .when(return_flag == "A", "Transfer_Out")
        .otherwise("Outbound_Order")
    )


def signed_quantity(movement: Column, quantity: Column) -> Column:
    return F.when(movement.rlike("Inbound|Return|Transfer_In"), quantity).otherwise(-quantity)


def shipment_delay(df: DataFrame) -> DataFrame:
    actual, planned = F.col("actual_transit_days"), F.col("planned_transit_days")
    return df.withColumns(
        {"delay_days": F.greatest(F.lit(0), actual - planned), "is_late": actual > planned}
    )


def shipment_status(df: DataFrame, anchor: Column) -> DataFrame:
    """Delivered when the arrival is on or before the anchor; only then is it dated."""
    arrival = F.date_add(F.col("ship_date"), F.col("actual_transit_days").cast("int"))
    delivered = arrival <= anchor
    return df.withColumns(
        {
            "expected_delivery_date": F.date_add(F.col("ship_date"), F.col("planned_transit_days").cast("int")),
            "shipment_status": F.when(delivered, "Delivered").otherwise("In_Transit"),
            "actual_delivery_date": F.when(delivered, arrival),
        }
    )


def lead_time_variance(df: DataFrame) -> DataFrame:
    actual, contracted = F.col("actual_lead_time_days"), F.col("contracted_lead_time_days")
    return df.withColumns({"lead_time_variance_days": actual - contracted, "is_late": actual > contracted})


def monthly_lead_times(purchase_lines: DataFrame) -> DataFrame:
    """Supplier x month averages; on-time falls 8 points per day over, kept in 30..100."""
    slip = F.avg("lead_time_variance_days")
    return purchase_lines.groupBy(F.trunc("order_date", "MM").alias("month"), "supplier_id").agg(
        F.count("*").alias("order_count"),
        F.round(F.avg("actual_lead_time_days"), 1).alias("avg_actual_lead_time_days"),
        F.round(slip, 1).alias("lead_time_variance_days"),
        F.round(F.least(F.lit(100.0), F.greatest(F.lit(30.0), F.lit(100.0) - slip * 8)), 1).alias(
            "on_time_delivery_pct"
        ),
    )


def sla_evaluation(df: DataFrame, penalty_if_breached: Column) -> DataFrame:
    actual, target = F.col("actual_pct"), F.col("target_pct")
    breached = actual < target
    return df.withColumns(
        {
            "variance_pct": F.round(actual - target, 1),
            "is_breached": breached,
            "penalty_amount": F.when(breached, penalty_if_breached).otherwise(F.lit(0.0)),
        }
    )


def budget_variance(actual: Column, budget: Column) -> Column:
    return F.round((actual - budget) / F.nullif(budget, F.lit(0)) * 100, 1)


def concentration_risk(family: Column, concentrated: list[str] = CONCENTRATED_FAMILIES) -> Column:
    return F.when(family.isin(concentrated), "High").otherwise("Low")


def tracking_event(index: Column) -> Column:
    """Event type at a 0-based position, the last type repeating past the end."""
    names = F.array(*[F.lit(e) for e in EVENT_TYPES])
    return F.element_at(names, (F.least(index, F.lit(len(EVENT_TYPES) - 1)) + 1).cast("int"))


def tracking_note(event_type: Column, late: Column, index: Column) -> Column:
    words = F.replace(F.lower(event_type), F.lit("_"), F.lit(" "))
    return F.concat(F.lit("Shipment "), words, F.when(late & (index > 1), " - DELAYED").otherwise(""))


def uplift_price(price: Column, factors: list[tuple[Column, float]]) -> Column:
    """Price times every multiplier whose condition holds."""
    for condition, factor in factors:
        price = price * F.when(condition, F.lit(factor)).otherwise(F.lit(1.0))
    return price


def risk_tier(reliability: Column) -> Column:
    return F.when(reliability < 4, "High").when(reliability < 7, "Medium").otherwise("Low")


def recommendation_of_event(event_type: Column) -> Column:
    return (
        F.when(event_type == "purchase", "PROCEED")
        .when(event_type == "click", "PROCEED_WITH_CAUTION")
        .when(event_type == "view", "DEFER")
        .when(event_type == "error", "REJECT")
        .otherwise("UNKNOWN")
    )
