"""Ground-truth tables: KPI values as (id, metric, value) rows.

Every source table is read once and reduced to one row of sums and counts; those
rows are put side by side, and each metric is arithmetic on that single row. The
values stay numeric, since the text of a double differs between engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplylens.functions import calendar as C
from supplylens.functions import measures as M
from supplylens.operators import derive
from supplylens.plans.certified import FISCAL_TARGETS
from supplylens.plans.reports import one_row


def metric_rows(row: DataFrame, metrics: list[tuple[str, str, Column]], first: str) -> DataFrame:
    """Turn a one-row result into rows of (first, metric, value)."""
    entries = [
        F.struct(F.lit(a).alias(first), F.lit(name).alias("metric"), value.cast("double").alias("value"))
        for a, name, value in metrics
    ]
    return row.select(F.explode(F.array(*entries)).alias("_m")).select("_m.*")


def stack(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def sales_values(t, region: str) -> DataFrame:
    """Two months of orders by family, then over all families with the worst family change."""
    day, cents, status = F.col("order_date"), F.col("amount_cents"), F.col("order_status")
    here = F.col("region") == region
    last, prior = C.month_window(day, t.anchor), C.prior_month_window(day, t.anchor)
    of = lambda name: here & last & (status == name)
    counts = {
        "last_cents": M.sum_if(here & last, cents),
        "prior_cents": M.sum_if(here & prior, cents),
        "cancelled_cents": M.sum_if(of(derive.CANCELLED), cents),
        "backordered_cents": M.sum_if(of(derive.BACKORDERED), cents),
        "orders_n": M.count_if(here & last),
        "fulfilled_n": M.count_if(of(derive.FULFILLED)),
        "partial_n": M.count_if(of(derive.PARTIAL)),
        "backordered_n": M.count_if(of(derive.BACKORDERED)),
        "everywhere_n": M.count_if(last),
        "everywhere_fulfilled_n": M.count_if(last & (status == derive.FULFILLED)),
    }
    by_family = (
        t.sales_orders(product=True)
        .where(C.two_month_window(day, t.anchor))
        .groupBy("product_family")
        .agg(*[c.alias(n) for n, c in counts.items()])
    )
    change = F.col("last_cents") - F.col("prior_cents")
    return by_family.agg(*[F.sum(n).alias(n) for n in counts], F.min(change).alias("worst_cents"))


def shipment_values(t, region: str) -> DataFrame:
    late, here = F.col("is_late"), F.col("destination_region") == region
    return t.shipments().where(C.month_window(F.col("ship_date"), t.anchor)).agg(
        M.count_if(here).alias("shipments_n"),
        M.count_if(here & late).alias("late_n"),
        M.sum_if(here & late, F.col("delay_days")).alias("delay_sum"),
        M.sum_if(here & late, F.col("cost_cents")).alias("wasted_cents"),
        M.count_if(late).alias("everywhere_late_n"),
    )


def stock_values(t, region: str) -> DataFrame:
    """One row per SKU of the region first, so distinct counts are sums."""
    below, out = F.col("below_safety_stock_flag"), F.col("stockout_flag")
    per_sku = (
        C.filter_dimension(t.inventory_ledger(), region=region)
        .groupBy("sku_id")
        .agg(
            M.count_if(below).alias("below"),
            M.count_if(below & out).alias("out_below"),
            M.count_if(out).alias("out"),
            F.sum(F.when(below, F.col("days_of_supply"))).alias("days"),
        )
    )
    return per_sku.agg(
        F.sum("below").alias("below_n"),
        M.count_if(F.col("below") > 0).alias("below_skus"),
        F.sum("out_below").alias("out_n"),
        M.count_if(F.col("out_below") > 0).alias("out_below_skus"),
        M.count_if(F.col("out") > 0).alias("out_skus"),
        F.sum("days").alias("days_sum"),
    )


def purchase_values(t, continents: list[str]) -> DataFrame:
    """Counts, late counts and variance sums overall (suffix all) and per named continent."""
    late, days = F.col("is_late"), F.col("lead_time_variance_days")
    scopes = {"all": F.lit(True)} | {str(i): F.col("supplier_continent") == c for i, c in enumerate(continents)}
    measures = []
    for suffix, scope in scopes.items():
        measures += [
            M.count_if(scope).alias(f"po_n_{suffix}"),
            M.count_if(scope & late).alias(f"po_late_{suffix}"),
            M.sum_if(scope, days).alias(f"po_days_{suffix}"),
        ]
    return t.supplier_orders().where(C.month_window(F.col("order_date"), t.anchor)).agg(*measures)


def penalty_values(t) -> DataFrame:
    return t.vendor_slas().where("is_breached").agg(F.sum("penalty_amount").alias("penalty_sum"))


def base_values(t, region: str, continents: list[str]) -> DataFrame:
    return one_row(
        sales_values(t, region),
        shipment_values(t, region),
        stock_values(t, region),
        purchase_values(t, continents),
        penalty_values(t),
    )


def share(part: str, whole: str, digits: int = 2) -> Column:
    """Percentage in the order an averaged 0/1 flag gives: part / whole, then times 100."""
    return F.round(F.col(part) / F.nullif(F.col(whole), F.lit(0)) * 100, digits)


def mean(total: str, count: str, digits: int = 2) -> Column:
    return F.round(F.col(total) / F.nullif(F.col(count), F.lit(0)), digits)


def money(name: str) -> Column:
    return F.col(name) / F.lit(100.0)


def exposed() -> Column:
    return money("cancelled_cents") + money("backordered_cents") + money("wasted_cents")


def total_cost() -> Column:
    late = F.coalesce(F.col("late_n") / F.nullif(F.col("everywhere_late_n"), F.lit(0)), F.lit(0.0))
    return exposed() + F.round("penalty_sum", 2) * late


def ground_truth_kpis(t, region: str) -> DataFrame:
    """Nine primary metrics as (agent, metric, value)."""
    on_time = F.round((F.col("shipments_n") - F.col("late_n")) / F.nullif(F.col("shipments_n"), F.lit(0)) * 100, 1)
    return metric_rows(
        base_values(t, region, []),
        [
            ("demand-analysis", "Revenue MoM change", M.dollars(F.col("last_cents") - F.col("prior_cents"))),
            ("logistics-operations", "On-time delivery rate", on_time),
            ("logistics-operations", "Avg delay days", mean("delay_sum", "late_n", 1)),
            (
                "executive-reporting",
                "Fill rate",
                M.ratio_pct(F.col("everywhere_fulfilled_n"), F.col("everywhere_n"), 1),
            ),
            ("inventory-management", "Below safety stock positions", F.col("below_n")),
            ("inventory-management", "Stockout SKUs", F.col("out_skus")),
            ("supplier-risk", "Total vendor SLA penalties", F.round("penalty_sum", 1)),
            ("supplier-risk", "Vendor late delivery pct", share("po_late_all", "po_n_all", 1)),
            ("executive-reporting", "Cost of Disruption", F.round(total_cost(), 2)),
        ],
        "agent",
    )


def ground_truth_40(t, region: str, continents: list[str], quarter: str = "Q3") -> DataFrame:
    """The forty test values as (id, metric, value); the first three continents are tested."""
    target = F.lit(next(row[3] for row in FISCAL_TARGETS if row[0] == quarter))
    last, prior = F.col("last_cents"), F.col("prior_cents")
    on_time = F.round((F.col("shipments_n") - F.col("late_n")) / F.nullif(F.col("shipments_n"), F.lit(0)) * 100, 2)
    vendor_late = share("po_late_all", "po_n_all")
    variance = "avg_lead_time_variance (continent)"
    return metric_rows(
        base_values(t, region, continents),
        [
            ("A01", "on_time_delivery_rate", on_time),
            ("A02", "late_delivery_rate", share("late_n", "shipments_n")),
            ("A03", "avg_delay_days", mean("delay_sum", "late_n")),
            ("A04", "total_shipments", F.col("shipments_n")),
            ("A05", "late_shipments", F.col("late_n")),
            ("A06", "wasted_freight_cost", M.dollars(F.col("wasted_cents"))),
            ("B01", "revenue_last_month", M.dollars(last)),
            ("B02", "revenue_prior_month", M.dollars(prior)),
            ("B03", "revenue_change_dollars", M.dollars(last - prior)),
            ("B04", "revenue_change_pct", M.change_pct(last, prior)),
            ("C01", "positions_below_safety_stock", F.col("below_n")),
            ("C02", "unique_skus_below_safety", F.col("below_skus")),
            ("C03", "stockout_positions", F.col("out_n")),
            ("C04", "unique_skus_in_stockout", F.col("out_below_skus")),
            ("C05", "avg_days_of_supply", mean("days_sum", "below_n")),
            ("D01", "total_purchase_orders", F.col("po_n_all")),
            ("D02", "late_purchase_orders", F.col("po_late_all")),
            ("D03", "supplier_late_rate_pct", vendor_late),
            ("D04", "avg_lead_time_variance", mean("po_days_all", "po_n_all")),
            ("D05", "supplier_late_rate_pct (continent)", share("po_late_0", "po_n_0")),
            ("D06", variance, mean("po_days_0", "po_n_0")),
            ("D07", "total_purchase_orders (continent)", F.col("po_n_0")),
            ("E01", "fill_rate", M.ratio_pct(F.col("everywhere_fulfilled_n"), F.col("everywhere_n"), 1)),
            ("E02", "sla_penalties", F.round("penalty_sum", 2)),
            ("E03", "cost_of_disruption", F.round(total_cost(), 2)),
            ("F01", "revenue_last_month", M.dollars(last)),
            ("F02", "supplier_late_rate_pct", vendor_late),
            ("F03", "fulfilled_orders", F.col("fulfilled_n")),
            ("F04", "cancelled_revenue", M.dollars(F.col("cancelled_cents"))),
            ("F05", "backordered_orders", F.col("backordered_n")),
            ("F06", "worst_family_decline", F.abs(M.dollars(F.col("worst_cents")))),
            ("G01", "service_level_target", target),
            ("G02", "service_level_target", target),
            ("H01", variance, mean("po_days_1", "po_n_1")),
            ("H02", variance, mean("po_days_2", "po_n_2")),
            ("H03", "fulfillment_rate", M.ratio_pct(F.col("fulfilled_n"), F.col("orders_n"))),
            ("H04", "partial_rate", M.ratio_pct(F.col("partial_n"), F.col("orders_n"))),
            ("H05", "revenue_at_risk", F.round(exposed(), 2)),
            ("H06", "revenue_at_risk_per_stockout_sku", M.ratio(money("backordered_cents"), F.col("out_skus"))),
            ("H07", "disruption_to_revenue_ratio", M.ratio(total_cost(), money("last_cents"))),
        ],
        "id",
    )
