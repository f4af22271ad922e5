"""Derived fact columns, calendar functions, ordering and key checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from supplylens.functions import calendar as C
from supplylens.functions import measures as M
from supplylens.operators import derive as V
from supplylens.operators.joins import alias_values, fk_orphans
from supplylens.operators.windows import index_within_key
from supplylens.registry.base import query
from supplylens.registry.ctes import with_tables


@query("line_amount", """SELECT l_orderkey, l_partkey, l_suppkey, ROUND(l_quantity * p_retailprice, 2) AS line_amount
    FROM lineitem JOIN part ON l_partkey = p_partkey""")
def _(t):
    lines = t.table("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    prices = t.table("part").select("p_partkey", "p_retailprice")
    return lines.join(prices, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        V.line_amount(F.col("l_quantity"), F.col("p_retailprice")).alias("line_amount"),
    )


@query("forecast_quality", with_tables("forecasts", "SELECT * FROM forecasts"))
def _(t):
    return t.demand_forecasts()


@query("stock_flags", with_tables("inv", """SELECT warehouse_id, sku_id, region, on_hand_qty, safety_stock_level,
    stockout_flag, below_safety_stock_flag, reorder_point, days_of_supply FROM inv"""))
def _(t):
    return t.inventory_ledger().drop("daily_demand")


@query("available_qty", with_tables("inv", """SELECT warehouse_id, sku_id,
    GREATEST(0, on_hand_qty - safety_stock_level) AS available_qty,
    CASE WHEN on_hand_qty = 0 THEN 'Stockout' WHEN on_hand_qty < 5 THEN 'Low' ELSE 'Adequate' END
      AS replenishment_status FROM inv"""))
def _(t):
    on_hand = F.col("on_hand_qty")
    return t.inventory_ledger().select(
        "warehouse_id",
        "sku_id",
        V.available_qty(on_hand, F.col("safety_stock_level")).alias("available_qty"),
        V.replenishment_status(on_hand).alias("replenishment_status"),
    )


@query("signed_quantity", with_tables("moves", """SELECT warehouse_id, movement_type, COUNT(*) AS movements,
    CAST(SUM(quantity) AS BIGINT) AS net_quantity FROM moves GROUP BY 1, 2"""))
def _(t):
    return t.stock_movements().groupBy("warehouse_id", "movement_type").agg(
        F.count("*").alias("movements"), F.sum("quantity").alias("net_quantity")
    )


@query("shipment_status", with_tables("ship", """SELECT order_id, line_number, supplier_id, sku_id, ship_date,
    delay_days, is_late, ship_date + CAST(planned_days AS INTEGER) AS expected_delivery_date,
    CASE WHEN ship_date + CAST(lead_days AS INTEGER) <= DATE '2000-01-01' THEN 'Delivered' ELSE 'In_Transit' END
      AS shipment_status,
    CASE WHEN ship_date + CAST(lead_days AS INTEGER) <= DATE '2000-01-01'
      THEN ship_date + CAST(lead_days AS INTEGER) END AS actual_delivery_date FROM ship"""))
def _(t):
    return V.shipment_status(t.shipments(), F.lit(t.anchor)).select(
        "order_id",
        "line_number",
        "supplier_id",
        "sku_id",
        "ship_date",
        "delay_days",
        "is_late",
        "expected_delivery_date",
        "shipment_status",
        "actual_delivery_date",
    )


@query("purchase_lead_variance", with_tables("po", """SELECT supplier_id, sku_id, order_date, supplier_country,
    lead_days AS actual_lead_time_days, variance AS lead_time_variance_days, is_late FROM po"""))
def _(t):
    return t.supplier_orders().select(
        "supplier_id",
        "sku_id",
        "order_date",
        "supplier_country",
        "actual_lead_time_days",
        "lead_time_variance_days",
        "is_late",
    )


@query("monthly_lead_times", with_tables("lead", "SELECT * FROM lead"))
def _(t):
    return t.supplier_lead_times()


@query("sla_evaluation", with_tables("sla", "SELECT * FROM sla"))
def _(t):
    return t.vendor_slas()


@query("budget_variance", with_tables("sales", """, m AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month,
    product_family, CAST(SUM(amount_cents) AS BIGINT) AS cents FROM sales GROUP BY 1, 2)
    SELECT a.month, a.product_family, ROUND(CAST(a.cents - b.cents AS DOUBLE) / b.cents * 100, 1) AS variance_pct,
    CASE WHEN a.product_family IN ('ECONOMY', 'PROMO') THEN 'High' ELSE 'Low' END AS geographic_concentration_risk
    FROM m a JOIN m b ON a.product_family = b.product_family AND a.month = b.month + INTERVAL 1 MONTH"""))
def _(t):
    return t.procurement().select(
        "month",
        "product_family",
        V.budget_variance(F.col("total_spend_cents"), F.col("budgeted_spend_cents")).alias("variance_pct"),
        V.concentration_risk(F.col("product_family"), ["ECONOMY", "PROMO"]).alias("geographic_concentration_risk"),
    )


@query("event_index", """SELECT event_id, user_id, i AS event_index, tracking_type,
    'Shipment ' || replace(lower(tracking_type), '_', ' ')
      || CASE WHEN late AND i > 1 THEN ' - DELAYED' ELSE '' END AS notes
    FROM (SELECT event_id, user_id, event_type = 'error' AS late, i,
      CASE LEAST(i, 6) WHEN 0 THEN 'Picked_Up' WHEN 1 THEN 'In_Transit' WHEN 2 THEN 'At_Hub'
        WHEN 3 THEN 'Out_For_Delivery' WHEN 4 THEN 'Delivered' WHEN 5 THEN 'Exception' ELSE 'Returned' END
        AS tracking_type
      FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i FROM events))""")
def _(t):
    placed = index_within_key(
        t.table("events").select("event_id", "user_id", "event_type", "ts"),
        ["user_id"],
        F.date_trunc("hour", "ts"),
        ["ts", "event_id"],
        "event_index",
    )
    index, late = F.col("event_index"), F.col("event_type") == "error"
    return placed.withColumn("tracking_type", V.tracking_event(index)).select(
        "event_id",
        "user_id",
        "event_index",
        "tracking_type",
        V.tracking_note(F.col("tracking_type"), late, index).alias("notes"),
    )


@query("region_of_warehouse", with_tables("supp", """SELECT l_suppkey AS warehouse_id, continent AS region,
    COUNT(*) AS movements FROM lineitem JOIN supp ON l_suppkey = s_suppkey GROUP BY 1, 2"""))
def _(t):
    counted = t.table("lineitem").groupBy(F.col("l_suppkey").alias("warehouse_id")).agg(
        F.count("*").alias("movements")
    )
    places = t.supplier_places().select(
        F.col("supplier_id").alias("warehouse_id"), F.col("continent").alias("region")
    )
    return counted.join(places, "warehouse_id")


@query("uplift_price", """SELECT p_partkey AS sku_id, p_retailprice * CASE WHEN p_type = 'PROMO' THEN
    CAST(0.85 AS DOUBLE) ELSE 1 END * CASE WHEN p_size > 25 THEN CAST(0.7 AS DOUBLE) ELSE 1 END AS unit_price
    FROM part""")
def _(t):
    factors = [(F.col("p_type") == "PROMO", 0.85), (F.col("p_size") > 25, 0.70)]
    return t.table("part").select(
        F.col("p_partkey").alias("sku_id"), V.uplift_price(F.col("p_retailprice"), factors).alias("unit_price")
    )


@query("fiscal_period", """SELECT 'Q' || CAST(quarter(o_orderdate + INTERVAL 6 MONTH) AS VARCHAR) AS fiscal_quarter,
    year(o_orderdate + INTERVAL 6 MONTH) AS fiscal_year, COUNT(*) AS orders FROM orders GROUP BY 1, 2""")
def _(t):
    day = F.col("o_orderdate").cast("date")
    return (
        t.table("orders")
        .groupBy(C.fiscal_quarter(day).alias("fiscal_quarter"), C.fiscal_year(day).alias("fiscal_year"))
        .agg(F.count("*").alias("orders"))
    )


@query("days_between", with_tables("po", """SELECT CAST(date_trunc('month', order_date) AS DATE) AS month,
    COUNT(*) AS lines, MIN(lead_days) AS shortest, MAX(lead_days) AS longest,
    MAX(order_date + CAST(lead_days AS INTEGER)) AS last_arrival FROM po GROUP BY 1"""))
def _(t):
    orders = t.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    lines = t.table("lineitem").select("l_orderkey", F.col("l_shipdate").cast("date").alias("ship_date"))
    days = C.days_between(F.col("ship_date"), F.col("order_date"))
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("order_date", days.alias("days"))
        .groupBy(F.trunc("order_date", "MM").alias("month"))
        .agg(
            F.count("*").alias("lines"),
            F.min("days").alias("shortest"),
            F.max("days").alias("longest"),
            F.max(C.date_plus_days(F.col("order_date"), F.col("days").cast("int"))).alias("last_arrival"),
        )
    )


@query("carrier_regions", with_tables("cust", """SELECT DISTINCT o_orderpriority AS carrier_id, region
    FROM orders JOIN cust ON o_custkey = c_custkey"""))
def _(t):
    return t.carriers().select("carrier_id", F.explode(F.split("service_regions", ",")).alias("region"))


@query("fk_check", """SELECT 'orders.customer' AS relationship, COUNT(*) AS orphan_rows,
      COUNT(DISTINCT o_custkey) AS orphan_keys FROM orders ANTI JOIN customer ON o_custkey = c_custkey
    UNION ALL SELECT 'lineitem.order', COUNT(*), COUNT(DISTINCT l_orderkey) FROM lineitem
      ANTI JOIN orders ON l_orderkey = o_orderkey
    UNION ALL SELECT 'lineitem.part', COUNT(*), COUNT(DISTINCT l_partkey) FROM lineitem
      ANTI JOIN part ON l_partkey = p_partkey
    UNION ALL SELECT 'lineitem.supplier', COUNT(*), COUNT(DISTINCT l_suppkey) FROM lineitem
      ANTI JOIN supplier ON l_suppkey = s_suppkey
    UNION ALL SELECT 'documents.labels', COUNT(*), COUNT(DISTINCT doc_id) FROM documents
      ANTI JOIN labels USING (doc_id)""")
def _(t):
    checks = [
        fk_orphans("orders.customer", t.table("orders"), "o_custkey", t.table("customer"), "c_custkey"),
        fk_orphans("lineitem.order", t.table("lineitem"), "l_orderkey", t.table("orders"), "o_orderkey"),
        fk_orphans("lineitem.part", t.table("lineitem"), "l_partkey", t.table("part"), "p_partkey"),
        fk_orphans("lineitem.supplier", t.table("lineitem"), "l_suppkey", t.table("supplier"), "s_suppkey"),
        fk_orphans("documents.labels", t.table("documents"), "doc_id", t.table("labels"), "doc_id"),
    ]
    out = checks[0]
    for check in checks[1:]:
        out = out.unionByName(check)
    return out


REGION_ALIASES = {"asian": "ASIA", "european": "EUROPE", "the americas": "AMERICA", "gulf": "MIDDLE EAST"}
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("alias_region", """SELECT c_custkey AS question_id, spoken, CASE lower(trim(spoken)) WHEN 'asian' THEN 'ASIA'
      WHEN 'european' THEN 'EUROPE' WHEN 'gulf' THEN 'MIDDLE EAST' WHEN 'afr' THEN 'AFRICA' WHEN 'middle' THEN
      'MIDDLE EAST' WHEN 'america' THEN 'AMERICA' END AS region
    FROM (SELECT c_custkey, CASE c_custkey % 7 WHEN 0 THEN ' Asian' WHEN 1 THEN 'European' WHEN 2 THEN 'Gulf '
      WHEN 3 THEN 'Afr' WHEN 4 THEN 'MIDDLE' WHEN 5 THEN 'America' ELSE 'Nowhere' END AS spoken FROM customer)""")
def _(t):
    words = F.array(*[F.lit(w) for w in (" Asian", "European", "Gulf ", "Afr", "MIDDLE", "America", "Nowhere")])
    spoken = t.table("customer").select(
        F.col("c_custkey").alias("question_id"),
        F.element_at(words, (F.pmod("c_custkey", F.lit(7)) + 1).cast("int")).alias("spoken"),
    )
    return alias_values(spoken, "spoken", REGION_ALIASES, REGIONS, "region")
