"""The single building blocks, each on its own over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from supplylens.functions import bitmaps as B
from supplylens.functions import calendar as C
from supplylens.functions import measures as M
from supplylens.operators import actions as A
from supplylens.operators import derive
from supplylens.operators import windows as W
from supplylens.operators.joins import left_join_filled, skew_safe_join, without_counterpart
from supplylens.plans import certified as Q
from supplylens.plans import disruption as D
from supplylens.plans import reports as R
from supplylens.registry.base import query
from supplylens.registry.ctes import BOTH, LAST, PRIOR, with_tables

DAY = "CAST(o_orderdate AS DATE)"


def order_day():
    return F.col("o_orderdate").cast("date")


def fulfilled():
    return F.col("order_status") == derive.FULFILLED


def orders(t):
    return t.table("orders").select("o_orderkey", "o_orderstatus", order_day().alias("order_date"))


def last_sales(t):
    return t.sales_orders().where(C.month_window(F.col("order_date"), t.anchor))


def last_shipments(t):
    return t.shipments().where(C.month_window(F.col("ship_date"), t.anchor))


# calendar and predicates ----------------------------------------------------------


@query("month_window", f"SELECT o_orderkey, o_orderstatus, {DAY} AS order_date FROM orders WHERE {LAST.format(DAY)}")
def _(t):
    return orders(t).where(C.month_window(F.col("order_date"), t.anchor))


@query("prior_month_window", f"SELECT o_orderkey, o_orderstatus, {DAY} AS order_date FROM orders WHERE {PRIOR.format(DAY)}")
def _(t):
    return orders(t).where(C.prior_month_window(F.col("order_date"), t.anchor))


@query("period_label", f"""SELECT CASE WHEN {LAST.format(DAY)} THEN 'Last_Month' WHEN {PRIOR.format(DAY)}
    THEN 'Prior_Month' ELSE 'Older' END AS period, COUNT(*) AS orders FROM orders GROUP BY 1""")
def _(t):
    label = C.period_label(F.col("order_date"), t.anchor)
    return orders(t).groupBy(label.alias("period")).agg(F.count("*").alias("orders"))


@query("month_name", "SELECT strftime(o_orderdate, '%B %Y') AS month_name, COUNT(*) AS orders FROM orders GROUP BY 1")
def _(t):
    return orders(t).groupBy(F.date_format("order_date", "MMMM yyyy").alias("month_name")).agg(
        F.count("*").alias("orders")
    )


@query("latest_period_rows", f"""SELECT o_orderkey, o_orderstatus, {DAY} AS order_date FROM orders
    WHERE {DAY} = (SELECT MAX({DAY}) FROM orders)""")
def _(t):
    return C.latest_period_rows(orders(t), "order_date")


@query("date_plus_days", f"SELECT o_orderkey, {DAY} + 30 AS expected_delivery_date FROM orders")
def _(t):
    return orders(t).select(
        "o_orderkey", C.date_plus_days(F.col("order_date"), 30).alias("expected_delivery_date")
    )


@query("filter_dimension", with_tables("cust", """SELECT c_custkey AS customer_id, state FROM cust
    WHERE region = 'ASIA' AND c_mktsegment = 'BUILDING'"""))
def _(t):
    return C.filter_dimension(t.customers(), region="ASIA", segment="BUILDING").select("customer_id", "state")


@query("filter_flag", with_tables("sla", "SELECT * FROM sla WHERE NOT is_breached"))
def _(t):
    return C.filter_flag(t.vendor_slas(), "is_breached", False)


@query("filter_in_list", with_tables("cust", """SELECT c_custkey AS customer_id, region FROM cust
    WHERE region IN ('ASIA', 'EUROPE')"""))
def _(t):
    return t.customers().where(C.in_list(F.col("region"), ["ASIA", "EUROPE"])).select("customer_id", "region")


@query("filter_priority_band", with_tables("items", "SELECT action_id, priority FROM items WHERE priority >= 5"))
def _(t):
    return t.action_items().where(C.priority_band(F.col("priority"), "low")).select("action_id", "priority")


@query("filter_decided", with_tables("tracked", """SELECT action_id, user_decision FROM tracked
    WHERE user_decision <> ''"""))
def _(t):
    tracked = A.actions_with_decisions(t.action_items(), t.action_decisions())
    return tracked.where(C.decided(F.col("user_decision"), "decided")).select("action_id", "user_decision")


@query("filter_not_null", with_tables("ship", """SELECT delay_reason, COUNT(*) AS shipments FROM ship
    WHERE delay_reason IS NOT NULL GROUP BY 1"""))
def _(t):
    return t.shipments().where(F.col("delay_reason").isNotNull()).groupBy("delay_reason").agg(
        F.count("*").alias("shipments")
    )


@query("filter_positive", with_tables("sla", "SELECT supplier_id, sla_metric, penalty_amount FROM sla WHERE penalty_amount > 0"))
def _(t):
    return t.vendor_slas().where(F.col("penalty_amount") > 0).select("supplier_id", "sla_metric", "penalty_amount")


@query("not_in_subquery", f"""SELECT c_custkey FROM customer WHERE c_custkey NOT IN
    (SELECT o_custkey FROM orders WHERE {LAST.format(DAY)})""")
def _(t):
    bought = t.table("orders").where(C.month_window(order_day(), t.anchor)).select(F.col("o_custkey").alias("c_custkey"))
    return without_counterpart(t.table("customer").select("c_custkey"), bought, "c_custkey")


# joins ---------------------------------------------------------------------------


@query("left_join_aggregates", with_tables("sales supp", f"""SELECT continent AS region, suppliers,
    COALESCE(revenue, 0) AS revenue FROM (SELECT continent, COUNT(*) AS suppliers FROM supp GROUP BY 1) s
    LEFT JOIN (SELECT region, ROUND(SUM(amount_cents) / 100.0, 2) AS revenue FROM sales
      WHERE {LAST.format('order_date')} GROUP BY 1) d ON s.continent = d.region"""))
def _(t):
    places = t.supplier_places().groupBy(F.col("continent").alias("region")).agg(F.count("*").alias("suppliers"))
    revenue = last_sales(t).groupBy("region").agg(M.dollars(F.sum(F.col("amount_cents"))).alias("revenue"))
    return places.join(revenue, "region", "left").withColumn("revenue", F.coalesce("revenue", F.lit(0.0)))


@query("dim_left_join", with_tables("suppliers sla", """SELECT s.supplier_id, country, COALESCE(n, 0) AS sla_breaches,
    COALESCE(p, 0) AS total_penalty_usd FROM suppliers s LEFT JOIN (SELECT supplier_id, COUNT(*) AS n,
      ROUND(SUM(penalty_amount), 2) AS p FROM sla WHERE is_breached GROUP BY 1) b ON s.supplier_id = b.supplier_id"""))
def _(t):
    breaches = R.breached_totals(t.vendor_slas())
    joined = left_join_filled(t.suppliers(), breaches, "supplier_id", {"sla_breaches": 0, "total_penalty_usd": 0.0})
    return joined.select("supplier_id", "country", "sla_breaches", "total_penalty_usd")


@query("inner_join_domains", with_tables("sales ship", f"""SELECT d.region, orders, shipments FROM
    (SELECT region, COUNT(*) AS orders FROM sales WHERE {LAST.format('order_date')} GROUP BY 1) d
    JOIN (SELECT destination_region, COUNT(*) AS shipments FROM ship WHERE {LAST.format('ship_date')} GROUP BY 1) s
    ON d.region = s.destination_region"""))
def _(t):
    demand = last_sales(t).groupBy("region").agg(F.count("*").alias("orders"))
    logistics = last_shipments(t).groupBy(F.col("destination_region").alias("region")).agg(
        F.count("*").alias("shipments")
    )
    return demand.join(logistics, "region")


@query("cross_join_scalar", with_tables("ship sla", f"""SELECT destination_region, late_n, pool FROM
    (SELECT destination_region, COUNT(CASE WHEN is_late THEN 1 END) AS late_n FROM ship
      WHERE {LAST.format('ship_date')} GROUP BY 1) CROSS JOIN
    (SELECT ROUND(SUM(CASE WHEN is_breached THEN penalty_amount ELSE 0 END), 2) AS pool FROM sla)"""))
def _(t):
    late = last_shipments(t).groupBy("destination_region").agg(M.count_if(F.col("is_late")).alias("late_n"))
    return late.withColumn("pool", D.penalty_pool(t.vendor_slas()))


@query("comma_cross_join", with_tables("sales ship", f"""SELECT backordered, late_n,
    ROUND(backordered / late_n, 2) AS backordered_per_late FROM
    (SELECT SUM(CASE WHEN order_status = 'Backordered' THEN amount_cents ELSE 0 END) / 100.0 AS backordered
      FROM sales WHERE {LAST.format('order_date')}),
    (SELECT COUNT(*) AS late_n FROM ship WHERE is_late AND {LAST.format('ship_date')})"""))
def _(t):
    held = last_sales(t).agg(
        (M.sum_if(F.col("order_status") == derive.BACKORDERED, F.col("amount_cents")) / 100.0).alias("backordered")
    )
    late = last_shipments(t).where(F.col("is_late")).agg(F.count("*").alias("late_n"))
    return R.one_row(held, late).withColumn(
        "backordered_per_late", M.ratio(F.col("backordered"), F.col("late_n"))
    )


@query("latest_per_key_join", with_tables("items evals", """SELECT i.action_id, i.domain, e.recommendation
    FROM items i LEFT JOIN evals e ON i.action_id = e.action_id AND e.rn = 1"""))
def _(t):
    return A.action_tracker(t.action_items(), t.action_evaluations()).select("action_id", "domain", "recommendation")


@query("self_join_prev", with_tables("evals", """SELECT l.action_id, l.recommendation AS curr_recommendation,
    p.recommendation AS prev_recommendation FROM evals l JOIN evals p ON l.action_id = p.action_id AND p.rn = 2
    WHERE l.rn = 1"""))
def _(t):
    return W.latest_and_previous(t.action_evaluations(), ["action_id"], A.NEWEST, ["recommendation"])


@query("fk_inner_join", with_tables("items evals", """SELECT domain, recommendation, COUNT(*) AS evaluations
    FROM evals e JOIN items i ON e.action_id = i.action_id GROUP BY 1, 2"""))
def _(t):
    counted = t.action_evaluations().groupBy("action_id", "recommendation").agg(F.count("*").alias("n"))
    joined = skew_safe_join(counted, t.action_items().select("action_id", "domain"), "action_id", "recommendation")
    return joined.groupBy("domain", "recommendation").agg(F.sum("n").alias("evaluations"))


@query("left_merge_fill", with_tables("items decisions", """SELECT i.action_id,
    COALESCE(d.decision, '') AS user_decision FROM items i LEFT JOIN decisions d ON i.action_id = d.action_id"""))
def _(t):
    chosen = t.action_decisions().select("action_id", F.col("decision").alias("user_decision"))
    return left_join_filled(t.action_items().select("action_id"), chosen, "action_id", {"user_decision": ""})


@query("anti_join", f"""SELECT p_partkey FROM part ANTI JOIN (SELECT l_partkey FROM lineitem
    WHERE {LAST.format('CAST(l_shipdate AS DATE)')}) ON p_partkey = l_partkey""")
def _(t):
    moved = t.table("lineitem").where(C.month_window(F.col("l_shipdate").cast("date"), t.anchor))
    return without_counterpart(
        t.table("part").select("p_partkey"), moved.select(F.col("l_partkey").alias("p_partkey")), "p_partkey"
    )


# aggregates -------------------------------------------------------------------------


def by_region(name: str, expr: str, measure) -> None:
    """Register one measure of last month's sales by region."""

    @query(name, with_tables("sales", f"SELECT region, {expr} AS value FROM sales WHERE {LAST.format('order_date')} GROUP BY 1"))
    def _(t):
        return last_sales(t).groupBy("region").agg(measure().alias("value"))


by_region("count_rows", "COUNT(*)", lambda: F.count("*"))
by_region("count_distinct", "COUNT(DISTINCT order_id)", lambda: F.count_distinct("order_id"))
by_region(
    "count_distinct_if",
    "COUNT(DISTINCT CASE WHEN order_status = 'Fulfilled' THEN sku_id END)",
    lambda: M.count_distinct_if(fulfilled(), F.col("sku_id")),
)
by_region("count_if", "COUNT(CASE WHEN order_status = 'Fulfilled' THEN 1 END)", lambda: M.count_if(fulfilled()))
by_region(
    "sum_flag", "CAST(SUM(CASE WHEN order_status = 'Fulfilled' THEN 1 ELSE 0 END) AS BIGINT)", lambda: M.sum_flag(fulfilled())
)
by_region("sum_amount", "ROUND(SUM(amount_cents) / 100.0, 2)", lambda: M.dollars(F.sum(F.col("amount_cents"))))
by_region(
    "sum_if",
    "ROUND(SUM(CASE WHEN order_status = 'Fulfilled' THEN amount_cents ELSE 0 END) / 100.0, 2)",
    lambda: M.dollars(M.sum_if(fulfilled(), F.col("amount_cents"))),
)
by_region("avg", "ROUND(AVG(quantity), 2)", lambda: F.round(F.avg("quantity"), 2))
by_region(
    "rate_pct", "ROUND(AVG(CASE WHEN order_status = 'Fulfilled' THEN 1.0 ELSE 0.0 END) * 100, 2)", lambda: M.rate_pct(fulfilled())
)
by_region(
    "ratio_pct",
    "ROUND(SUM(CASE WHEN order_status = 'Fulfilled' THEN 1 ELSE 0 END) * 100.0 / COUNT(*), 2)",
    lambda: M.ratio_pct(M.sum_flag(fulfilled()), F.count("*")),
)
by_region(
    "avg_if",
    "ROUND(AVG(CASE WHEN order_status = 'Fulfilled' THEN quantity END), 2)",
    lambda: M.avg_if(fulfilled(), F.col("quantity")),
)
by_region("max_value", "MAX(order_date)", lambda: F.max("order_date"))

_LAST_CENTS = f"SUM(CASE WHEN {LAST.format('order_date')} THEN amount_cents ELSE 0 END)"
_PRIOR_CENTS = f"SUM(CASE WHEN {PRIOR.format('order_date')} THEN amount_cents ELSE 0 END)"


@query("two_period_delta", with_tables("sales", f"""SELECT segment,
    ROUND(({_LAST_CENTS} - {_PRIOR_CENTS}) / 100.0, 2) AS revenue_change FROM sales
    WHERE {BOTH.format('order_date')} GROUP BY 1"""))
def _(t):
    return Q.month_over_month(t.sales_orders(), t.anchor, "segment").select("segment", "revenue_change")


@query("two_period_pct", with_tables("sales", f"""SELECT state,
    ROUND(CAST({_LAST_CENTS} - {_PRIOR_CENTS} AS DOUBLE) / NULLIF({_PRIOR_CENTS}, 0) * 100, 2) AS revenue_change_pct
    FROM sales WHERE {BOTH.format('order_date')} GROUP BY 1"""))
def _(t):
    return Q.month_over_month(t.sales_orders(), t.anchor, "state").select("state", "revenue_change_pct")


@query("scalar_kpi_row", f"""SELECT (SELECT COUNT(*) FROM orders WHERE {LAST.format(DAY)}) AS orders_last_month,
    (SELECT COUNT(*) FROM lineitem WHERE {LAST.format('CAST(l_shipdate AS DATE)')}) AS lines_last_month,
    (SELECT COUNT(DISTINCT user_id) FROM events) AS actions""")
def _(t):
    return R.one_row(
        t.table("orders").where(C.month_window(order_day(), t.anchor)).agg(F.count("*").alias("orders_last_month")),
        t.table("lineitem")
        .where(C.month_window(F.col("l_shipdate").cast("date"), t.anchor))
        .agg(F.count("*").alias("lines_last_month")),
        t.table("events").agg(F.count_distinct("user_id").alias("actions")),
    )


@query("mean_of_group_means", """SELECT p_type, ROUND(AVG(m), 2) AS mean_size FROM (SELECT p_type, p_brand,
    ROUND(AVG(p_size), 1) AS m FROM part GROUP BY 1, 2) GROUP BY 1""")
def _(t):
    return W.mean_of_group_means(t.table("part"), ["p_brand"], "p_type", "p_size", "mean_size")


@query("value_counts", """SELECT COALESCE(event_type, 'PENDING') AS event_type, COUNT(*) AS events FROM events
    GROUP BY 1""")
def _(t):
    return W.value_counts(t.table("events"), "event_type", "PENDING", "events")


@query("group_multi_key", with_tables("sales", """SELECT region, segment, order_status, COUNT(*) AS n FROM sales
    GROUP BY 1, 2, 3"""))
def _(t):
    return t.sales_orders().groupBy("region", "segment", "order_status").agg(F.count("*").alias("n"))


@query("global_agg", "SELECT COUNT(*) AS orders, ROUND(SUM(CAST(ROUND(o_totalprice * 100) AS BIGINT)) / 100.0, 2) AS total FROM orders")
def _(t):
    return t.table("orders").agg(
        F.count("*").alias("orders"), M.dollars(F.sum(M.to_cents(F.col("o_totalprice")))).alias("total")
    )


# windows and sorting ------------------------------------------------------------------


@query("latest_per_key", with_tables("evals", """SELECT evaluation_id, action_id, evaluated_at, recommendation,
    practicality_score, reasoning, risks, pros, cons, cost_estimate FROM evals WHERE rn = 1"""))
def _(t):
    return W.latest_per_key(t.action_evaluations(), ["action_id"], A.NEWEST)


@query("share_of_total", """SELECT o_orderstatus, COUNT(*) AS n,
    ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 1) AS pct FROM orders GROUP BY 1""")
def _(t):
    counted = t.table("orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return W.with_share_of_total(counted, "n", "pct")


@query("share_of_flagged", with_tables("po", """SELECT supplier_continent, COUNT(CASE WHEN is_late THEN 1 END) AS late_n,
    ROUND(COUNT(CASE WHEN is_late THEN 1 END) * 100.0 / SUM(COUNT(CASE WHEN is_late THEN 1 END)) OVER (), 2) AS pct
    FROM po GROUP BY 1"""))
def _(t):
    late = t.supplier_orders().groupBy("supplier_continent").agg(M.count_if(F.col("is_late")).alias("late_n"))
    return W.with_share_of_total(late, "late_n", "pct", 2)


@query("order_by", "SELECT p_partkey, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey")
def _(t):
    return t.table("part").select("p_partkey", "p_retailprice").orderBy(F.col("p_retailprice").desc(), "p_partkey")


@query("top_k", "SELECT s_suppkey, s_acctbal FROM supplier ORDER BY s_acctbal, s_suppkey LIMIT 5")
def _(t):
    rows = t.table("supplier").select("s_suppkey", "s_acctbal")
    return W.top_k(rows, [F.col("s_acctbal").asc(), F.col("s_suppkey").asc()], 5)


# mergeable distinct counts ----------------------------------------------------------------


@query("rolling_distinct_users", """SELECT d.day, COUNT(DISTINCT e.user_id) AS users_7d
    FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE user_id IS NOT NULL) d
    JOIN events e ON CAST(e.ts AS DATE) BETWEEN d.day - INTERVAL 6 DAY AND d.day GROUP BY 1""")
def _(t):
    events = t.table("events").select(F.col("ts").cast("date").alias("day"), "user_id")
    return B.rolling_distinct(B.distinct_state(events, ["day"], "user_id"), "day", 7, "users_7d")
