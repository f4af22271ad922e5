"""Metric views, reports, cost of disruption, certified questions and ground truth."""

from __future__ import annotations

from pyspark.sql import functions as F

from supplylens.plans import certified as Q
from supplylens.plans import disruption as D
from supplylens.plans import ground_truth as G
from supplylens.plans import metric_views as V
from supplylens.plans import reports as R
from supplylens.functions import calendar as C
from supplylens.registry.base import query
from supplylens.registry.ctes import BOTH, LAST, PRIOR, with_tables
from supplylens.sources.buckets import BucketStore
from supplylens.sources.sums import DailySums

REGION = "ASIA"
DAY = "order_date"

DELIVERY_SQL = """ROUND(AVG(CASE WHEN is_late = false THEN 1.0 ELSE 0.0 END) * 100, 2) AS on_time_delivery_rate,
    ROUND(AVG(CASE WHEN is_late THEN 1.0 ELSE 0.0 END) * 100, 2) AS late_delivery_rate,
    ROUND(AVG(CASE WHEN is_late THEN delay_days END), 2) AS avg_delay_days, COUNT(*) AS total_shipments,
    CAST(SUM(CASE WHEN is_late THEN 1 ELSE 0 END) AS BIGINT) AS late_shipments,
    ROUND(SUM(CASE WHEN is_late THEN cost_cents ELSE 0 END) / 100.0, 2) AS wasted_freight_cost"""
_LAST_SUM = f"SUM(CASE WHEN {LAST.format(DAY)} THEN amount_cents ELSE 0 END)"
_PRIOR_SUM = f"SUM(CASE WHEN {PRIOR.format(DAY)} THEN amount_cents ELSE 0 END)"


def mom_sql(change: str, pct: str) -> str:
    return f"""ROUND({_LAST_SUM} / 100.0, 2) AS revenue_last_month,
    ROUND({_PRIOR_SUM} / 100.0, 2) AS revenue_prior_month,
    ROUND(({_LAST_SUM} - {_PRIOR_SUM}) / 100.0, 2) AS {change},
    ROUND(CAST({_LAST_SUM} - {_PRIOR_SUM} AS DOUBLE) / NULLIF({_PRIOR_SUM}, 0) * 100, 2) AS {pct}"""


INVENTORY_SQL = """COUNT(*) AS positions_below_safety_stock, COUNT(DISTINCT sku_id) AS unique_skus_below_safety,
    CAST(SUM(CASE WHEN stockout_flag THEN 1 ELSE 0 END) AS BIGINT) AS stockout_positions"""
SUPPLIER_SQL = """COUNT(*) AS total_purchase_orders,
    CAST(SUM(CASE WHEN is_late THEN 1 ELSE 0 END) AS BIGINT) AS late_purchase_orders,
    ROUND(AVG(CASE WHEN is_late THEN 1.0 ELSE 0.0 END) * 100, 2) AS supplier_late_rate_pct,
    ROUND(AVG(variance), 2) AS avg_lead_time_variance"""


# metric views -----------------------------------------------------------------


@query("delivery_performance", with_tables("ship", f"""SELECT destination_region AS region, {DELIVERY_SQL}
    FROM ship WHERE {LAST.format('ship_date')} GROUP BY 1"""))
def _(t):
    return V.delivery_performance(t.shipments(), t.anchor).query(["region"])


@query("revenue_comparison", with_tables("sales", f"""SELECT region, product_family,
    {mom_sql('revenue_change_dollars', 'revenue_change_pct')} FROM sales GROUP BY 1, 2"""))
def _(t):
    return V.revenue_comparison(t.sales_orders(product=True), t.anchor).query(["region", "product_family"])


@query("stored_delivery_performance", with_tables("ship", f"""SELECT destination_region AS region, {DELIVERY_SQL}
    FROM ship WHERE {LAST.format('ship_date')} GROUP BY 1"""))
def _(t):
    sums = DailySums.build(BucketStore.new(t.spark, "sums"), t)
    return V.delivery_from_sums(sums.shipped(), t.anchor).query(["region"])


@query("stored_revenue_comparison", with_tables("sales", f"""SELECT region, product_family,
    {mom_sql('revenue_change_dollars', 'revenue_change_pct')} FROM sales GROUP BY 1, 2"""))
def _(t):
    sums = DailySums.build(BucketStore.new(t.spark, "sums"), t)
    return V.revenue_comparison(sums.sold(), t.anchor).query(["region", "product_family"])


@query("inventory_safety_stock", with_tables("inv", f"""SELECT region, {INVENTORY_SQL},
    COUNT(DISTINCT CASE WHEN stockout_flag THEN sku_id END) AS unique_skus_in_stockout,
    ROUND(AVG(days_of_supply), 2) AS avg_days_of_supply FROM inv WHERE below_safety_stock_flag GROUP BY 1"""))
def _(t):
    return V.inventory_safety_stock(t.inventory_ledger()).query(["region"])


@query("supplier_performance", with_tables("po", f"""SELECT supplier_continent, {SUPPLIER_SQL}
    FROM po WHERE {LAST.format(DAY)} GROUP BY 1"""))
def _(t):
    return V.supplier_performance(t.supplier_orders(), t.anchor).query(["supplier_continent"])


@query("metric_view_query", with_tables("po", f"SELECT {SUPPLIER_SQL} FROM po WHERE {LAST.format(DAY)}"))
def _(t):
    return V.supplier_performance(t.supplier_orders(), t.anchor).query()


# reports ------------------------------------------------------------------------


@query("regional_performance_summary", with_tables("sales inv ship", f"""SELECT d.region, total_orders, avg_order_value,
    total_revenue, fulfillment_rate, COALESCE(stockout_skus, 0) AS stockout_skus,
    COALESCE(late_shipment_pct, 0) AS late_shipment_pct
    FROM (SELECT region, COUNT(DISTINCT order_id) AS total_orders,
        ROUND(CAST(SUM(amount_cents) AS DOUBLE) / COUNT(*) / 100.0, 2) AS avg_order_value,
        ROUND(SUM(amount_cents) / 100.0, 2) AS total_revenue,
        ROUND(COUNT(CASE WHEN order_status = 'Fulfilled' THEN 1 END) * 100.0 / COUNT(*), 1) AS fulfillment_rate
      FROM sales WHERE {LAST.format(DAY)} GROUP BY region) d
    LEFT JOIN (SELECT region, COUNT(DISTINCT sku_id) AS stockout_skus FROM inv WHERE stockout_flag GROUP BY region) i
      ON d.region = i.region
    LEFT JOIN (SELECT destination_region,
        ROUND(COUNT(CASE WHEN is_late THEN 1 END) * 100.0 / COUNT(*), 1) AS late_shipment_pct
      FROM ship WHERE {LAST.format('ship_date')} GROUP BY 1) s ON d.region = s.destination_region"""))
def _(t):
    return R.regional_performance_summary(t.sales_orders(), t.inventory_ledger(), t.shipments(), t.anchor)


@query("revenue_trend", with_tables("sales", f"""SELECT order_date, region, product_family,
    ROUND(SUM(amount_cents) / 100.0, 2) AS daily_revenue, COUNT(DISTINCT order_id) AS order_count,
    CASE WHEN {LAST.format(DAY)} THEN 'Last_Month' WHEN {PRIOR.format(DAY)} THEN 'Prior_Month'
         ELSE 'Older' END AS period FROM sales GROUP BY order_date, region, product_family"""))
def _(t):
    return R.revenue_trend(t.sales_orders(product=True), t.anchor, t.line_parts())


def scorecard(t):
    """Scorecard over the lead times of the newest month; only that month's orders are read for them."""
    return R.supplier_risk_scorecard(t.suppliers(), t.supplier_lead_times(latest_only=True), t.vendor_slas())


@query("supplier_risk_scorecard", with_tables("scorecard", "SELECT * FROM scorecard"))
def _(t):
    return scorecard(t)


EXECUTIVE_SQL = f"""SELECT * FROM
    (SELECT ROUND(SUM(CASE WHEN {LAST.format(DAY)} THEN amount_cents END) / 100.0, 0) AS revenue_last_month,
       ROUND(SUM(CASE WHEN {PRIOR.format(DAY)} THEN amount_cents END) / 100.0, 0) AS revenue_prior_month,
       ROUND(COUNT(CASE WHEN {LAST.format(DAY)} AND order_status = 'Fulfilled' THEN 1 END) * 100.0
         / COUNT(CASE WHEN {LAST.format(DAY)} THEN 1 END), 1) AS service_level_pct FROM sales),
    (SELECT COUNT(DISTINCT CASE WHEN stockout_flag THEN sku_id END) AS total_stockout_skus,
       ROUND(AVG(days_of_supply), 1) AS avg_days_of_supply FROM inv),
    (SELECT ROUND(COUNT(CASE WHEN is_late THEN 1 END) * 100.0 / COUNT(*), 1) AS late_delivery_pct_last_month,
       ROUND(AVG(CASE WHEN is_late THEN delay_days END), 1) AS avg_delay_days_last_month FROM ship
       WHERE {LAST.format('ship_date')}),
    (SELECT ROUND(COUNT(CASE WHEN is_late THEN 1 END) * 100.0 / COUNT(*), 1) AS supplier_late_pct_last_month FROM po
       WHERE {LAST.format(DAY)}),
    (SELECT COUNT(CASE WHEN is_breached THEN 1 END) AS total_sla_breaches FROM sla)"""


def executive(t):
    return R.executive_kpis(
        t.sales_orders(places=False),
        t.inventory_ledger(),
        t.shipments(places=False),
        t.purchase_lines(),
        t.vendor_slas(),
        t.anchor,
    )


@query("executive_kpis", with_tables("sales inv ship po sla", EXECUTIVE_SQL))
def _(t):
    return executive(t)


# cost of disruption ---------------------------------------------------------------


def cost(t):
    return D.cost_of_disruption(t.sales_orders(), t.shipments(), t.vendor_slas(), t.inventory_ledger(), t.anchor)


@query("cost_of_disruption", with_tables("cod", "SELECT * FROM cod"))
def _(t):
    return cost(t)


@query("late_share_allocation", with_tables("ship sla", f"""SELECT l.region, l.n AS late_shipment_count,
    ROUND(l.share, 4) AS pct_of_late_shipments, ROUND(p.pool * l.share / 100, 2) AS allocated_supplier_penalties
    FROM (SELECT destination_region AS region, COUNT(CASE WHEN is_late THEN 1 END) AS n,
            CAST(COUNT(CASE WHEN is_late THEN 1 END) AS DOUBLE) * 100.0
              / SUM(COUNT(CASE WHEN is_late THEN 1 END)) OVER () AS share
          FROM ship WHERE {LAST.format('ship_date')} GROUP BY 1) l
    CROSS JOIN (SELECT ROUND(SUM(penalty_amount), 2) AS pool FROM sla WHERE penalty_amount > 0) p"""))
def _(t):
    return D.late_share_allocation(t.shipments(), t.vendor_slas(), t.anchor)


@query("disruption_severity", with_tables("cod_parts", """SELECT region,
    ROUND(cancelled + backordered + wasted + penalties, 2) AS total_cost_of_disruption,
    CASE WHEN cancelled + backordered + wasted + penalties > 2000000 THEN 'CRITICAL'
         WHEN cancelled + backordered + wasted + penalties > 1000000 THEN 'HIGH' ELSE 'MODERATE' END
      AS severity_level FROM cod_parts"""))
def _(t):
    return D.disruption_severity(t.sales_orders(), t.shipments(), t.vendor_slas(), t.anchor)


@query("cod_single_region", with_tables("cod", f"""SELECT region, total_cost_of_disruption FROM cod
    WHERE region = '{REGION}'"""))
def _(t):
    return D.region_cost_of_disruption(t.sales_orders(), t.shipments(), t.vendor_slas(), t.anchor, REGION)


@query("cod_components_long", with_tables("cod", """SELECT region, total_cost_of_disruption AS total, component, amount
    FROM (SELECT region, total_cost_of_disruption, 'cancelled' AS component, cancelled_revenue AS amount FROM cod
    UNION ALL SELECT region, total_cost_of_disruption, 'backordered', backordered_at_risk_revenue FROM cod
    UNION ALL SELECT region, total_cost_of_disruption, 'wasted_freight', wasted_logistics_spend FROM cod
    UNION ALL SELECT region, total_cost_of_disruption, 'sla_penalties', allocated_supplier_penalties FROM cod)"""))
def _(t):
    return D.components_long(cost(t)).orderBy(F.col("total").desc(), "region", "component")


@query("residual_component", with_tables("cod", """SELECT region, ROUND(GREATEST(0, total_cost_of_disruption
    - wasted_logistics_spend - allocated_supplier_penalties - cancelled_revenue), 2) AS other_amount FROM cod
    WHERE total_cost_of_disruption - wasted_logistics_spend - allocated_supplier_penalties
      - cancelled_revenue > 10000"""))
def _(t):
    return D.other_component(cost(t))


@query("derived_risk_metrics", with_tables("cod", f"""SELECT 'H05' AS test_id, 'Revenue at risk' AS description,
    revenue_at_risk_from_disruptions AS gt_value FROM cod WHERE region = '{REGION}'
    UNION ALL SELECT 'H06', 'Revenue at risk per stockout SKU', revenue_at_risk_per_stockout_sku FROM cod
    WHERE region = '{REGION}'
    UNION ALL SELECT 'H07', 'Cost of disruption to revenue', disruption_to_revenue_ratio FROM cod
    WHERE region = '{REGION}'"""))
def _(t):
    return D.derived_risk_metrics(cost(t), REGION)


# certified questions ----------------------------------------------------------------


@query("revenue_by_region_mom", with_tables("sales", f"""SELECT region,
    {mom_sql('revenue_change', 'revenue_change_pct')}, 'December 1999' AS last_month, 'November 1999' AS prior_month
    FROM sales WHERE {BOTH.format(DAY)} GROUP BY 1"""))
def _(t):
    return Q.revenue_by_region_mom(t.sales_orders(), t.anchor)


@query("revenue_by_family_mom", with_tables("sales", f"""SELECT product_family,
    {mom_sql('revenue_change', 'revenue_change_pct')} FROM sales
    WHERE region = '{REGION}' AND {BOTH.format(DAY)} GROUP BY 1"""))
def _(t):
    return Q.revenue_by_family_mom(t.sales_orders(product=True), t.anchor, REGION)


@query("worst_family_decline", with_tables("sales", f"""SELECT product_family,
    ROUND(({_LAST_SUM} - {_PRIOR_SUM}) / 100.0, 2) AS revenue_change FROM sales
    WHERE region = '{REGION}' AND {BOTH.format(DAY)} GROUP BY 1 ORDER BY revenue_change, product_family LIMIT 1"""))
def _(t):
    return Q.worst_family_decline(t.sales_orders(product=True), t.anchor, REGION)


@query("order_status_breakdown", with_tables("sales", f"""SELECT order_status, COUNT(*) AS order_count,
    ROUND(SUM(amount_cents) / 100.0, 2) AS total_revenue,
    ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 1) AS pct_of_orders FROM sales
    WHERE region = '{REGION}' AND {LAST.format(DAY)} GROUP BY 1"""))
def _(t):
    return Q.order_status_breakdown(t.sales_orders(), t.anchor, REGION)


@query("forecast_accuracy_latest", with_tables("forecasts", f"""SELECT region, product_family, forecast_demand_units,
    actual_demand_units, forecast_accuracy_pct, bias FROM forecasts
    WHERE forecast_month = (SELECT MAX(forecast_month) FROM forecasts) AND region = '{REGION}'"""))
def _(t):
    return Q.forecast_accuracy_latest(t.demand_forecasts(latest_only=True), REGION).orderBy(
        F.col("bias").desc(), "product_family"
    )


@query("stockouts_by_region", with_tables("inv", """SELECT region,
    COUNT(DISTINCT CASE WHEN stockout_flag THEN sku_id END) AS stockout_skus, COUNT(DISTINCT sku_id) AS total_skus,
    ROUND(AVG(days_of_supply), 1) AS avg_days_of_supply,
    COUNT(CASE WHEN below_safety_stock_flag THEN 1 END) AS below_safety_stock_count FROM inv GROUP BY 1"""))
def _(t):
    return Q.stockouts_by_region(t.inventory_ledger())


@query("stock_net_flow", with_tables("moves", f"""SELECT region,
    CAST(SUM(CASE WHEN quantity > 0 THEN quantity ELSE 0 END) AS BIGINT) AS total_inbound,
    CAST(SUM(CASE WHEN quantity < 0 THEN ABS(quantity) ELSE 0 END) AS BIGINT) AS total_outbound,
    CAST(SUM(quantity) AS BIGINT) AS net_flow FROM moves WHERE {LAST.format('movement_date')} GROUP BY 1"""))
def _(t):
    return Q.stock_net_flow(t.stock_movements(), t.anchor)


@query("late_delivery_by_region", with_tables("ship", f"""SELECT destination_region, COUNT(*) AS total_shipments,
    CAST(SUM(CASE WHEN is_late THEN 1 ELSE 0 END) AS BIGINT) AS late_shipments,
    ROUND(AVG(CASE WHEN is_late THEN 1.0 ELSE 0.0 END) * 100, 1) AS late_pct,
    ROUND(AVG(CASE WHEN is_late THEN delay_days END), 1) AS avg_delay_when_late
    FROM ship WHERE {LAST.format('ship_date')} GROUP BY 1"""))
def _(t):
    return Q.late_delivery_by_region(t.shipments(), t.anchor)


@query("delay_reason_share", with_tables("ship", f"""SELECT delay_reason, COUNT(*) AS cnt,
    ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 1) AS pct FROM ship
    WHERE destination_region = '{REGION}' AND {LAST.format('ship_date')} AND is_late GROUP BY 1"""))
def _(t):
    return Q.delay_reason_share(t.shipments(), t.anchor, REGION)


@query("supplier_late_by_continent", with_tables("po", f"""SELECT supplier_continent, COUNT(*) AS total_pos,
    CAST(SUM(CASE WHEN is_late THEN 1 ELSE 0 END) AS BIGINT) AS late_pos,
    ROUND(AVG(CASE WHEN is_late THEN 1.0 ELSE 0.0 END) * 100, 1) AS late_pct,
    ROUND(AVG(variance), 1) AS avg_variance_days FROM po WHERE {LAST.format(DAY)} GROUP BY 1"""))
def _(t):
    return Q.supplier_late_by_continent(t.supplier_orders(), t.anchor)


@query("top_risk_suppliers", with_tables("scorecard", """SELECT supplier_id, supplier_name, country, risk_tier,
    composite_risk_score, sla_breaches, total_penalty_usd, lead_time_variance FROM scorecard
    ORDER BY composite_risk_score, supplier_id LIMIT 5"""))
def _(t):
    return Q.top_risk_suppliers(scorecard(t))


@query("fulfilled_orders", with_tables("sales", f"""SELECT COUNT(*) AS fulfilled_orders FROM sales
    WHERE order_status = 'Fulfilled' AND region = '{REGION}' AND {LAST.format(DAY)}"""))
def _(t):
    return Q.fulfilled_orders(t.sales_orders(), t.anchor, REGION)


@query("fulfillment_rate", with_tables("sales", f"""SELECT region,
    ROUND(100.0 * SUM(CASE WHEN order_status = 'Fulfilled' THEN 1 ELSE 0 END) / COUNT(*), 2) AS fulfillment_rate,
    ROUND(100.0 * SUM(CASE WHEN order_status = 'Partially_Fulfilled' THEN 1 ELSE 0 END) / COUNT(*), 2) AS partial_rate
    FROM sales WHERE {LAST.format(DAY)} GROUP BY 1"""))
def _(t):
    return Q.fulfillment_rate(t.sales_orders(), t.anchor)


@query("lead_time_variance", with_tables("po", f"""SELECT supplier_continent AS scope,
    ROUND(AVG(variance), 2) AS avg_lead_time_variance FROM po WHERE {LAST.format(DAY)} GROUP BY 1
    UNION ALL SELECT 'ALL', ROUND(AVG(variance), 2) FROM po WHERE {LAST.format(DAY)}"""))
def _(t):
    return Q.lead_time_variance(t.supplier_orders(), t.anchor)


@query("vendor_late_pct", with_tables("po", f"""SELECT
    ROUND(100.0 * SUM(CASE WHEN is_late THEN 1 ELSE 0 END) / COUNT(*), 2) AS late_pct_per_order,
    ROUND(100.0 * COUNT(DISTINCT CASE WHEN is_late THEN supplier_id END) / COUNT(DISTINCT supplier_id), 2)
      AS late_pct_per_vendor FROM po WHERE {LAST.format(DAY)}"""))
def _(t):
    return Q.vendor_late_pct(t.supplier_orders(), t.anchor)


@query("sla_penalty_total", with_tables("sla", """SELECT ROUND(SUM(penalty_amount), 2) AS total_sla_penalties
    FROM sla WHERE is_breached"""))
def _(t):
    return Q.sla_penalty_total(t.vendor_slas())


@query("inventory_positions", with_tables("inv", f"""SELECT region, {INVENTORY_SQL},
    COUNT(DISTINCT CASE WHEN stockout_flag THEN sku_id END) AS stockout_skus
    FROM inv WHERE below_safety_stock_flag GROUP BY 1"""))
def _(t):
    return Q.inventory_positions(t.inventory_ledger())


@query("wasted_freight", with_tables("ship", f"""SELECT destination_region,
    ROUND(SUM(cost_cents) / 100.0, 2) AS wasted_freight_cost FROM ship
    WHERE is_late AND {LAST.format('ship_date')} GROUP BY 1"""))
def _(t):
    return Q.wasted_freight(t.shipments(), t.anchor)


TIER_SQL = """SELECT continent, risk_tier, ROUND(AVG(on_time_pct), 1) AS avg_otd, COUNT(*) AS suppliers,
    CAST(SUM(sla_breaches) AS BIGINT) AS total_breaches FROM scorecard GROUP BY 1, 2"""


@query("supplier_ontime_by_tier", with_tables("scorecard", TIER_SQL))
def _(t):
    return Q.supplier_ontime_by_tier(scorecard(t)).orderBy("avg_otd", "continent", "risk_tier")


@query("continent_ontime_mean", with_tables("scorecard", f"""SELECT continent, ROUND(AVG(avg_otd), 2) AS mean_otd
    FROM ({TIER_SQL}) GROUP BY 1"""))
def _(t):
    return Q.continent_ontime_mean(scorecard(t))


@query("service_level_gap", with_tables("sales", """SELECT fiscal_year, q.fiscal_quarter, service_level_pct,
    service_level_target_pct, ROUND(service_level_target_pct - service_level_pct, 1) AS gap,
    CASE WHEN ROUND(service_level_target_pct - service_level_pct, 1) > 10 THEN 'red'
         WHEN ROUND(service_level_target_pct - service_level_pct, 1) > 0 THEN 'orange' ELSE 'green' END AS band
    FROM (SELECT CAST(year(order_date + INTERVAL 6 MONTH) AS BIGINT) AS fiscal_year,
            'Q' || CAST(quarter(order_date + INTERVAL 6 MONTH) AS VARCHAR) AS fiscal_quarter,
            ROUND(SUM(CASE WHEN order_status = 'Fulfilled' THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 1)
              AS service_level_pct FROM sales GROUP BY 1, 2) q
    JOIN (VALUES ('Q1', CAST(92 AS DOUBLE)), ('Q2', 93), ('Q3', 95), ('Q4', 94))
      f(fiscal_quarter, service_level_target_pct) ON q.fiscal_quarter = f.fiscal_quarter"""))
def _(t):
    """The targets are renewed for each fiscal year of the orders."""
    orders = t.table("orders")
    year = lambda edge: orders.select(C.fiscal_year(edge("o_orderdate").cast("date"))).scalar()
    targets = Q.renewed_targets(Q.fiscal_targets(t.spark), year(F.min), year(F.max))
    return Q.service_level_gap(t.sales_orders(), targets)


@query("revenue_share_by_region", with_tables("sales", f"""SELECT region,
    ROUND(SUM(amount_cents) / 100.0, 2) AS total_revenue,
    ROUND(CAST(SUM(amount_cents) AS DOUBLE) * 100.0 / SUM(SUM(amount_cents)) OVER (), 2) AS revenue_share_pct
    FROM sales WHERE {LAST.format(DAY)} GROUP BY 1"""))
def _(t):
    return Q.revenue_share_by_region(t.sales_orders(), t.anchor)


@query("product_reconciliation", with_tables("sales", f"""SELECT region,
    ROUND(({_LAST_SUM} - {_PRIOR_SUM}) / 100.0, 2) AS sum_of_family_changes,
    ROUND(({_LAST_SUM} - {_PRIOR_SUM}) / 100.0, 2) AS region_change, true AS matches
    FROM sales WHERE {BOTH.format(DAY)} GROUP BY 1"""))
def _(t):
    return Q.product_reconciliation(t.sales_orders(product=True), t.anchor)


@query("unfulfilled_revenue", with_tables("sales", f"""SELECT region, COUNT(*) AS unfulfilled_orders,
    ROUND(SUM(amount_cents) / 100.0, 2) AS unfulfilled_revenue FROM sales
    WHERE order_status <> 'Fulfilled' AND {LAST.format(DAY)} GROUP BY 1"""))
def _(t):
    return Q.unfulfilled_revenue(t.sales_orders(), t.anchor)


@query("residual_rate", with_tables("po", f"""SELECT overall_late_pct, group_late_pct, total_pos, group_pos,
    ROUND(GREATEST(0, (overall_late_pct / 100 * total_pos - group_late_pct / 100 * group_pos)
      / (total_pos - group_pos) * 100), 2) AS rest_late_pct
    FROM (SELECT ROUND(AVG(CASE WHEN is_late THEN 1.0 ELSE 0.0 END) * 100, 2) AS overall_late_pct,
      ROUND(AVG(CASE WHEN supplier_continent = 'ASIA' THEN CAST(is_late AS DOUBLE) END) * 100, 2) AS group_late_pct,
      COUNT(*) AS total_pos, COUNT(CASE WHEN supplier_continent = 'ASIA' THEN 1 END) AS group_pos
      FROM po WHERE {LAST.format(DAY)})"""))
def _(t):
    return Q.non_group_late_rate(t.supplier_orders(), t.anchor, "ASIA")


# ground truth -------------------------------------------------------------------------



NINE_SQL = f"""
    SELECT 'demand-analysis' AS agent, 'Revenue MoM change' AS metric,
      ROUND(({_LAST_SUM} - {_PRIOR_SUM}) / 100.0, 2) AS value FROM sales WHERE region = '{REGION}'
    UNION ALL SELECT 'logistics-operations', 'On-time delivery rate',
      ROUND(COUNT(CASE WHEN NOT is_late THEN 1 END) * 100.0 / COUNT(*), 1)
      FROM ship WHERE {LAST.format('ship_date')} AND destination_region = '{REGION}'
    UNION ALL SELECT 'logistics-operations', 'Avg delay days', ROUND(AVG(CASE WHEN is_late THEN delay_days END), 1)
      FROM ship WHERE {LAST.format('ship_date')} AND destination_region = '{REGION}'
    UNION ALL SELECT 'executive-reporting', 'Fill rate',
      ROUND(COUNT(CASE WHEN order_status = 'Fulfilled' THEN 1 END) * 100.0 / COUNT(*), 1)
      FROM sales WHERE {LAST.format(DAY)}
    UNION ALL SELECT 'inventory-management', 'Below safety stock positions',
      CAST(COUNT(CASE WHEN below_safety_stock_flag THEN 1 END) AS DOUBLE) FROM inv WHERE region = '{REGION}'
    UNION ALL SELECT 'inventory-management', 'Stockout SKUs',
      CAST(COUNT(DISTINCT CASE WHEN stockout_flag THEN sku_id END) AS DOUBLE) FROM inv WHERE region = '{REGION}'
    UNION ALL SELECT 'supplier-risk', 'Total vendor SLA penalties',
      ROUND(SUM(CASE WHEN is_breached THEN penalty_amount END), 1) FROM sla
    UNION ALL SELECT 'supplier-risk', 'Vendor late delivery pct',
      ROUND(COUNT(CASE WHEN is_late THEN 1 END) * 100.0 / COUNT(*), 1) FROM po WHERE {LAST.format(DAY)}
    UNION ALL SELECT 'executive-reporting', 'Cost of Disruption', total_cost_of_disruption
      FROM cod WHERE region = '{REGION}'"""


@query("ground_truth_kpis", with_tables("sales ship inv sla po cod", NINE_SQL))
def _(t):
    return G.ground_truth_kpis(t, REGION)


CONTINENTS = ["ASIA", "EUROPE", "AMERICA"]


def _forty() -> str:
    ship = f"FROM ship WHERE {LAST.format('ship_date')} AND destination_region = '{REGION}'"
    inv = f"FROM inv WHERE below_safety_stock_flag AND region = '{REGION}'"
    po = f"FROM po WHERE {LAST.format(DAY)}"
    sale = f"FROM sales WHERE region = '{REGION}' AND {LAST.format(DAY)}"
    both = f"FROM sales WHERE region = '{REGION}'"
    cod = f"FROM cod WHERE region = '{REGION}'"
    rate = "ROUND(AVG(CASE WHEN {0} THEN 1.0 ELSE 0.0 END) * 100, 2)"
    share = "ROUND(SUM(CASE WHEN order_status = '{0}' THEN 1 ELSE 0 END) * 100.0 / COUNT(*), {1})"
    at = lambda name: f"{po} AND supplier_continent = '{name}'"
    rows = [
        ("A01", "on_time_delivery_rate", rate.format("NOT is_late"), ship),
        ("A02", "late_delivery_rate", rate.format("is_late"), ship),
        ("A03", "avg_delay_days", "ROUND(AVG(CASE WHEN is_late THEN delay_days END), 2)", ship),
        ("A04", "total_shipments", "COUNT(*)", ship),
        ("A05", "late_shipments", "COUNT(CASE WHEN is_late THEN 1 END)", ship),
        ("A06", "wasted_freight_cost", "ROUND(SUM(CASE WHEN is_late THEN cost_cents ELSE 0 END) / 100.0, 2)", ship),
        ("B01", "revenue_last_month", f"ROUND({_LAST_SUM} / 100.0, 2)", both),
        ("B02", "revenue_prior_month", f"ROUND({_PRIOR_SUM} / 100.0, 2)", both),
        ("B03", "revenue_change_dollars", f"ROUND(({_LAST_SUM} - {_PRIOR_SUM}) / 100.0, 2)", both),
        ("B04", "revenue_change_pct", f"ROUND(CAST({_LAST_SUM} - {_PRIOR_SUM} AS DOUBLE) / {_PRIOR_SUM} * 100, 2)", both),
        ("C01", "positions_below_safety_stock", "COUNT(*)", inv),
        ("C02", "unique_skus_below_safety", "COUNT(DISTINCT sku_id)", inv),
        ("C03", "stockout_positions", "COUNT(CASE WHEN stockout_flag THEN 1 END)", inv),
        ("C04", "unique_skus_in_stockout", "COUNT(DISTINCT CASE WHEN stockout_flag THEN sku_id END)", inv),
        ("C05", "avg_days_of_supply", "ROUND(AVG(days_of_supply), 2)", inv),
        ("D01", "total_purchase_orders", "COUNT(*)", po),
        ("D02", "late_purchase_orders", "COUNT(CASE WHEN is_late THEN 1 END)", po),
        ("D03", "supplier_late_rate_pct", rate.format("is_late"), po),
        ("D04", "avg_lead_time_variance", "ROUND(AVG(variance), 2)", po),
        ("D05", "supplier_late_rate_pct (continent)", rate.format("is_late"), at("ASIA")),
        ("D06", "avg_lead_time_variance (continent)", "ROUND(AVG(variance), 2)", at("ASIA")),
        ("D07", "total_purchase_orders (continent)", "COUNT(*)", at("ASIA")),
        ("E01", "fill_rate", share.format("Fulfilled", 1), f"FROM sales WHERE {LAST.format(DAY)}"),
        ("E02", "sla_penalties", "ROUND(SUM(penalty_amount), 2)", "FROM sla WHERE is_breached"),
        ("E03", "cost_of_disruption", "MAX(total_cost_of_disruption)", cod),
        ("F01", "revenue_last_month", f"ROUND({_LAST_SUM} / 100.0, 2)", both),
        ("F02", "supplier_late_rate_pct", rate.format("is_late"), po),
        ("F03", "fulfilled_orders", "COUNT(*)", f"{sale} AND order_status = 'Fulfilled'"),
        ("F04", "cancelled_revenue", "ROUND(SUM(amount_cents) / 100.0, 2)", f"{sale} AND order_status = 'Cancelled'"),
        ("F05", "backordered_orders", "COUNT(*)", f"{sale} AND order_status = 'Backordered'"),
        ("F06", "worst_family_decline", "ABS(MIN(c))", f"""FROM (SELECT ROUND(({_LAST_SUM} - {_PRIOR_SUM}) / 100.0, 2)
            AS c FROM sales WHERE region = '{REGION}' AND {BOTH.format(DAY)} GROUP BY product_family)"""),
        ("G01", "service_level_target", "95", ""),
        ("G02", "service_level_target", "95", ""),
        ("H01", "avg_lead_time_variance (continent)", "ROUND(AVG(variance), 2)", at("EUROPE")),
        ("H02", "avg_lead_time_variance (continent)", "ROUND(AVG(variance), 2)", at("AMERICA")),
        ("H03", "fulfillment_rate", share.format("Fulfilled", 2), sale),
        ("H04", "partial_rate", share.format("Partially_Fulfilled", 2), sale),
        ("H05", "revenue_at_risk", "MAX(revenue_at_risk_from_disruptions)", cod),
        ("H06", "revenue_at_risk_per_stockout_sku", "MAX(revenue_at_risk_per_stockout_sku)", cod),
        ("H07", "disruption_to_revenue_ratio", "MAX(disruption_to_revenue_ratio)", cod),
    ]
    return " UNION ALL ".join(
        f"SELECT '{i}' AS id, '{m}' AS metric, CAST({expr} AS DOUBLE) AS value {src}" for i, m, expr, src in rows
    )


@query("ground_truth_40", with_tables("sales ship inv sla po cod", _forty()))
def _(t):
    return G.ground_truth_40(t, REGION, CONTINENTS)
