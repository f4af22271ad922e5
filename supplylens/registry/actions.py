"""Action tracking queries and keyed table maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from supplylens.operators import actions as A
from supplylens.operators.windows import nth_latest_per_key
from supplylens.registry.base import query
from supplylens.registry.ctes import LAST, with_tables
from supplylens.sources import buckets
from supplylens.sources import tables as T
from supplylens.sources import tags
from supplylens.session import new_folder

TRACKER_COLUMNS = """action_id, category, timeframe, domain, title, description, specific_steps, expected_impact,
    priority, action_status, recommendation, practicality_score, reasoning, risks, pros, cons, cost_estimate,
    evaluated_at, created_at, status_color, risk_level"""


def tracker(t):
    return A.action_tracker(t.action_items(), t.action_evaluations()).drop("run_id")


def tracked(t):
    return A.actions_with_decisions(tracker(t), t.action_decisions())


@query("action_tracker", with_tables("tracker", f"SELECT {TRACKER_COLUMNS} FROM tracker"))
def _(t):
    return tracker(t)


@query("eval_history", with_tables("items evals", """SELECT title, domain, category, recommendation,
    practicality_score, evaluated_at, reasoning, risks FROM evals e JOIN items i ON e.action_id = i.action_id"""))
def _(t):
    return A.eval_history(t.action_items(), t.action_evaluations())


@query("domain_summary", with_tables("items evals", """SELECT domain, category, COUNT(*) AS action_count,
    COUNT(CASE WHEN recommendation = 'PROCEED' THEN 1 END) AS proceed_count,
    COUNT(CASE WHEN recommendation = 'PROCEED_WITH_CAUTION' THEN 1 END) AS caution_count,
    COUNT(CASE WHEN recommendation = 'DEFER' THEN 1 END) AS defer_count,
    COUNT(CASE WHEN recommendation = 'REJECT' THEN 1 END) AS reject_count,
    ROUND(AVG(practicality_score), 2) AS avg_practicality
    FROM items i LEFT JOIN evals e ON i.action_id = e.action_id AND e.rn = 1 GROUP BY domain, category"""))
def _(t):
    return A.domain_summary(t.action_items(), t.action_evaluations())


CHANGES_SQL = """SELECT i.action_id, i.title, p.recommendation AS prev_rec, c.recommendation AS curr_rec,
    ROUND(p.practicality_score, 2) AS prev_score, ROUND(c.practicality_score, 2) AS curr_score,
    CASE WHEN p.recommendation <> c.recommendation THEN 'CHANGED' ELSE 'STABLE' END AS status
    FROM items i JOIN evals c ON c.action_id = i.action_id AND c.rn = 1
    JOIN evals p ON p.action_id = i.action_id AND p.rn = 2"""


@query("recommendation_changes", with_tables("items evals", CHANGES_SQL))
def _(t):
    return A.recommendation_changes(t.action_items(), t.action_evaluations())


@query("nth_latest_per_key", with_tables("evals", """SELECT evaluation_id, action_id, evaluated_at, recommendation,
    practicality_score, reasoning, risks, pros, cons, cost_estimate FROM evals WHERE rn = 2"""))
def _(t):
    return nth_latest_per_key(t.action_evaluations(), ["action_id"], A.NEWEST, 2)


PENDING_SQL = """SELECT c_custkey AS action_id, 'SHORT_TERM' AS category, 'demand' AS domain, 'Call ' || c_name AS title,
    'Segment ' || c_mktsegment AS description, 'Ask ' || c_name AS specific_steps,
    'Keeps ' || c_mktsegment AS expected_impact, c_custkey % 10 + 1 AS priority FROM customer
    WHERE c_custkey % 4 < 2"""


@query("pending_unevaluated", f"{PENDING_SQL} AND c_custkey NOT IN (SELECT user_id FROM events)")
def _(t):
    return A.pending_unevaluated(t.customer_actions(), t.action_evaluations())


@query("pending_again", f"{PENDING_SQL} AND c_custkey % 3 = 1")
def _(t):
    """All waiting actions of one run, evaluated or not."""
    return A.pending_unevaluated(t.customer_actions(), t.action_evaluations(), "run_1", again=True)


@query("context_snapshot", with_tables("inv po sales", f"""SELECT
    (SELECT COUNT(*) FROM inv WHERE stockout_flag) AS stockout_positions,
    (SELECT ROUND(AVG(days_of_supply), 2) FROM inv WHERE on_hand_qty > 0) AS avg_days_of_supply,
    (SELECT COUNT(*) FROM po WHERE is_late AND {LAST.format('order_date')}) AS late_pos,
    (SELECT ROUND(SUM(amount_cents) / 100.0, 2) FROM sales
      WHERE region = 'ASIA' AND {LAST.format('order_date')}) AS region_revenue"""))
def _(t):
    return A.context_snapshot(t.inventory_ledger(), t.supplier_orders(), t.sales_orders(), t.anchor, "ASIA")


@query("history_deltas", with_tables("history", """SELECT history_id, action_date, domain, success_rating,
    ROUND(cost_cents / 100.0, 2) AS cost_usd, COALESCE(metric_after, 0) - COALESCE(metric_before, 0) AS metric_delta
    FROM history"""))
def _(t):
    return A.history_deltas(t.action_history())


MONEY_SQL = "'$' || format('{:,}', CAST(round_even(cost_cents / 100.0, 0) AS BIGINT))"


@query("history_display", with_tables("history", f"""SELECT history_id, action_date, domain, title,
    {MONEY_SQL} AS cost, success_rating, metric_name,
    CAST(metric_before AS VARCHAR) || ' → ' || CAST(metric_after AS VARCHAR) AS metric_change FROM history"""))
def _(t):
    return A.history_display(t.action_history())


@query("precedent_summary", with_tables("history", f"""SELECT history_id, action_date,
    '- [' || success_rating || '] ' || title || ' (' || {MONEY_SQL} || '): ' || metric_name || ' '
    || COALESCE(CAST(metric_before AS VARCHAR), 'None') || '→' || CAST(metric_after AS VARCHAR)
    || format(' ({{:+.1f}}). Lesson: ', CAST(metric_after - COALESCE(metric_before, 0) AS DOUBLE))
    || lessons_learned AS line FROM history"""))
def _(t):
    return A.precedent_lines(t.action_history())


@query("actions_with_decisions", with_tables("tracked", f"""SELECT {TRACKER_COLUMNS}, user_decision, user_notes
    FROM tracked"""))
def _(t):
    return tracked(t)


@query("queue_filter", with_tables("tracked", f"""SELECT {TRACKER_COLUMNS}, user_decision, user_notes FROM tracked
    WHERE domain IN ('inventory', 'supplier') AND timeframe IN ('Next 7 Days', 'Next 30 Days')
    AND user_decision <> '' AND priority BETWEEN 3 AND 4"""))
def _(t):
    return A.queue_filter(
        tracked(t), ["inventory", "supplier"], ["Next 7 Days", "Next 30 Days"], "decided", "high"
    )


@query("queue_kpis", with_tables("tracked", """SELECT COUNT(*) AS total,
    COUNT(CASE WHEN recommendation = 'PROCEED' THEN 1 END) AS proceed,
    COUNT(CASE WHEN recommendation = 'PROCEED_WITH_CAUTION' THEN 1 END) AS caution,
    COUNT(CASE WHEN recommendation = 'DEFER' THEN 1 END) AS deferred, ROUND(AVG(practicality_score), 4) AS avg_score,
    COUNT(CASE WHEN user_decision <> '' THEN 1 END) AS decided,
    COUNT(CASE WHEN user_decision = '' THEN 1 END) AS pending FROM tracked"""))
def _(t):
    return A.queue_kpis(tracked(t))


@query("recommendation_mix", with_tables("tracker", """SELECT COALESCE(recommendation, 'PENDING') AS recommendation,
    COUNT(*) AS action_count FROM tracker GROUP BY 1"""))
def _(t):
    return A.recommendation_mix(tracker(t))


@query("decision_mix", with_tables("decisions", """SELECT decision, COUNT(*) AS action_count FROM decisions
    GROUP BY 1"""))
def _(t):
    return A.decision_mix(t.action_decisions())


@query("recommendation_class", with_tables("tracker", """SELECT action_id, recommendation,
    CASE WHEN recommendation LIKE '%CAUTION%' THEN 'rec-caution' WHEN recommendation LIKE '%PROCEED%' THEN 'rec-proceed'
         WHEN recommendation LIKE '%REJECT%' OR recommendation LIKE '%DEFER%' THEN 'rec-defer'
         ELSE 'rec-pending' END AS badge FROM tracker"""))
def _(t):
    return tracker(t).select(
        "action_id", "recommendation", A.recommendation_class(F.col("recommendation")).alias("badge")
    )


@query("score_ranking", with_tables("tracker", """SELECT action_id, title, domain, practicality_score FROM tracker
    WHERE practicality_score IS NOT NULL"""))
def _(t):
    return A.score_ranking(tracker(t))


@query("evaluated_actions", with_tables("items evals", """SELECT i.action_id, title, domain, priority, recommendation,
    practicality_score, risks, pros, cons FROM evals e JOIN items i ON e.action_id = i.action_id"""))
def _(t):
    return A.evaluated_actions(t.action_items(), t.action_evaluations())


# keyed maintenance: each query changes a stored table and returns what a reader then sees ----


def new_decisions(t):
    """Every purchase and error as a decision: several rows per action."""
    return t.table("events").where(F.col("event_type").isin("purchase", "error")).select(
        F.col("user_id").alias("action_id"),
        F.when(F.col("event_type") == "purchase", "APPROVED").otherwise("REJECTED").alias("decision"),
        F.col("ts").alias("decided_at"),
        "event_id",
    )


OLD_SQL = "SELECT user_id AS action_id, 'DEFERRED' AS decision, MIN(ts) AS decided_at, MIN(event_id) AS event_id FROM events WHERE event_type = 'view' GROUP BY 1"
NEW_SQL = """SELECT action_id, decision, decided_at, event_id FROM (SELECT user_id AS action_id,
    CASE event_type WHEN 'purchase' THEN 'APPROVED' ELSE 'REJECTED' END AS decision, ts AS decided_at, event_id,
    ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
    WHERE event_type IN ('purchase', 'error')) WHERE rn = 1"""


def old_decisions(t):
    return t.table("events").where(F.col("event_type") == "view").groupBy(F.col("user_id").alias("action_id")).agg(
        F.lit("DEFERRED").alias("decision"), F.min("ts").alias("decided_at"), F.min("event_id").alias("event_id")
    )


def stored(t, **tables):
    """A store with the given tables, keyed by action."""
    store = buckets.BucketStore.new(t.spark, "actions")
    for name, df in tables.items():
        store.create(name, df, "action_id")
    return store


@query("upsert_by_key", f"""WITH old AS ({OLD_SQL}), new AS ({NEW_SQL}) SELECT * FROM new
    UNION ALL SELECT * FROM old WHERE action_id NOT IN (SELECT action_id FROM new)""")
def _(t):
    store = stored(t, decisions=old_decisions(t))
    store.upsert("decisions", new_decisions(t), ["decided_at", "event_id"])
    return store.table("decisions")


@query("update_by_key", with_tables("items", f"""SELECT i.action_id, COALESCE(n.decision, i.status) AS status
    FROM items i LEFT JOIN ({NEW_SQL}) n ON i.action_id = n.action_id"""))
def _(t):
    store = stored(t, items=t.action_items().select("action_id", "status"))
    store.update("items", new_decisions(t), "status", "decision", ["decided_at", "event_id"])
    return store.table("items")


@query("delete_by_key", f"""SELECT * FROM ({OLD_SQL}) WHERE action_id NOT IN (SELECT action_id FROM ({NEW_SQL}))""")
def _(t):
    store = stored(t, decisions=old_decisions(t))
    store.delete("decisions", new_decisions(t))
    return store.table("decisions")


@query("replace_slice", with_tables("items", f"""SELECT action_id, domain, status FROM items WHERE domain <> 'demand'
    UNION ALL SELECT action_id, domain, 'COMPLETED' FROM items WHERE domain = 'demand'"""))
def _(t):
    store = stored(t, items=t.action_items().select("action_id", "domain", "status"))
    fresh = store.table("items").where("domain = 'demand'").withColumn("status", F.lit("COMPLETED"))
    store.replace_slice("items", fresh, "domain")
    return store.table("items")


@query("decision_upsert", with_tables("items", f"""SELECT i.action_id, COALESCE(n.decision, i.status) AS status,
    COALESCE(n.decision, o.decision) AS decision FROM items i LEFT JOIN ({NEW_SQL}) n ON i.action_id = n.action_id
    LEFT JOIN ({OLD_SQL}) o ON i.action_id = o.action_id"""))
def _(t):
    store = stored(t, items=t.action_items().select("action_id", "status"), decisions=old_decisions(t).drop("event_id"))
    buckets.decide(store, "items", "decisions", new_decisions(t).drop("event_id"))
    return store.table("items").join(store.table("decisions").select("action_id", "decision"), "action_id", "left")


@query("decision_reset", with_tables("items", f"""SELECT i.action_id,
    CASE WHEN n.action_id IS NULL THEN i.status ELSE 'PENDING' END AS status,
    CASE WHEN n.action_id IS NULL THEN o.decision END AS decision
    FROM items i LEFT JOIN ({NEW_SQL}) n ON i.action_id = n.action_id
    LEFT JOIN ({OLD_SQL}) o ON i.action_id = o.action_id"""))
def _(t):
    store = stored(t, items=t.action_items().select("action_id", "status"), decisions=old_decisions(t))
    buckets.reset_decisions(store, "items", "decisions", new_decisions(t))
    return store.table("items").join(store.table("decisions").select("action_id", "decision"), "action_id", "left")


REGION_SALES = """SELECT region, state, CAST(SUM(quantity) AS BIGINT) AS units FROM sales GROUP BY 1, 2"""


def region_sales(t):
    return t.sales_orders().groupBy("region", "state").agg(F.sum("quantity").alias("units"))


def namespace(t) -> str:
    """A database of its own in the shared folder, so that repeated runs do not meet."""
    folder = new_folder(t.spark, "kpidb")
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    T.ensure_namespace(t.spark, name, "KPI tables", folder)
    return name


@query("overwrite_table", with_tables("sales", REGION_SALES))
def _(t):
    name = f"{namespace(t)}.region_sales"
    T.overwrite_table(t.customers().groupBy("region").count(), name)
    T.overwrite_table(region_sales(t), name)
    return T.scan_table(t.spark, name)


@query("append_table", with_tables("sales", f"{REGION_SALES} UNION ALL {REGION_SALES}"))
def _(t):
    name = f"{namespace(t)}.region_sales"
    T.overwrite_table(region_sales(t), name)
    T.append_table(region_sales(t), name)
    return T.scan_table(t.spark, name)


@query("insert_into", with_tables("sales", REGION_SALES))
def _(t):
    name = f"{namespace(t)}.region_sales"
    T.create_typed_table(t.spark, name, "units BIGINT COMMENT 'Units sold', region STRING, state STRING", "Sales")
    T.insert_into(region_sales(t), name)
    return T.scan_table(t.spark, name)


@query("insert_select", with_tables("sales po", """SELECT 'demand' AS agent, region AS metric, COUNT(*) AS value
    FROM sales GROUP BY 2 UNION ALL SELECT 'supplier', supplier_continent, COUNT(*) FROM po GROUP BY 2"""))
def _(t):
    name = f"{namespace(t)}.metrics"
    T.create_typed_table(t.spark, name, "agent STRING, metric STRING, value BIGINT", "Metric counts")
    count = lambda df, agent, col: df.groupBy(F.col(col).alias("metric")).agg(
        F.lit(agent).alias("agent"), F.count("*").alias("value")
    )
    T.insert_select(
        t.spark,
        name,
        count(t.sales_orders(), "demand", "region"),
        count(t.supplier_orders(), "supplier", "supplier_continent"),
    )
    return T.scan_table(t.spark, name)


@query("create_view", with_tables("sales", REGION_SALES))
def _(t):
    T.create_view(region_sales(t), "region_sales_view")
    return t.spark.table("region_sales_view")


@query("table_exists", with_tables("sales", f"""SELECT r.*, true AS present, false AS other_present
    FROM ({REGION_SALES}) r"""))
def _(t):
    name = f"{namespace(t)}.region_sales"
    T.overwrite_table(region_sales(t), name)
    return T.scan_table(t.spark, name).withColumns(
        {
            "present": F.lit(T.table_exists(t.spark, name)),
            "other_present": F.lit(T.table_exists(t.spark, f"{name}_missing")),
        }
    )


@query("row_stamp", with_tables("sales", f"SELECT r.*, true AS is_stamped FROM ({REGION_SALES}) r"))
def _(t):
    fresh = T.stamped(region_sales(t))
    return fresh.withColumn("is_stamped", F.col("calculated_at").isNotNull()).drop("calculated_at")


@query("scan_table", "SELECT * FROM customer")
def _(t):
    return t.table("customer")


COLUMN_COMMENTS = {"region": "Stored region name", "state": "Nation within the region", "units": "Units sold"}


@query("apply_comments", """SELECT c.column_name, c.comment, n.table_rows FROM (VALUES
    ('region', 'Stored region name'), ('state', 'Nation within the region'), ('units', 'Units sold')) c(column_name, comment)
    CROSS JOIN (SELECT COUNT(*) AS table_rows FROM (SELECT DISTINCT c_nationkey FROM customer
      WHERE c_custkey IN (SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey))) n""")
def _(t):
    name = f"{namespace(t)}.region_sales"
    T.overwrite_table(region_sales(t), name)
    T.apply_comments(t.spark, name, "Units sold by region and nation", COLUMN_COMMENTS)
    rows = T.scan_table(t.spark, name).select(F.count("*")).scalar()
    return T.read_comments(t.spark, name).withColumn("table_rows", rows)


@query("asset_tags", with_tables("sales", """SELECT 'region:' || region AS asset FROM (SELECT region,
    SUM(amount_cents) AS c FROM sales GROUP BY 1) WHERE c > (SELECT AVG(c) FROM
    (SELECT SUM(amount_cents) AS c FROM sales GROUP BY region))"""))
def _(t):
    grouped = t.sales_orders().groupBy("region").agg(F.sum("amount_cents").alias("c"))
    mean = grouped.select(F.avg("c")).scalar()
    tag = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    tags = grouped.select(
        F.concat(F.lit("region:"), "region").alias("asset"),
        F.explode(
            F.array(
                tag("domain", F.lit("demand")),
                tag("size", F.when(F.col("c") > mean, "large").otherwise("small")),
            )
        ).alias("tag"),
    ).select("asset", "tag.*")
    return T.assets_with_tags(tags, domain="demand", size="large")


@query("catalog_tags", with_tables("sales", f"""SELECT 'region_sales' AS asset, 'table' AS kind, true AS inherited,
      COUNT(*) AS table_rows FROM ({REGION_SALES})
    UNION ALL SELECT 'large_sales', 'view', true, COUNT(*) FROM ({REGION_SALES}) WHERE units >= 1000
    UNION ALL SELECT 'order_states', 'table', false, COUNT(DISTINCT o_orderstatus) FROM orders"""))
def _(t):
    name = namespace(t)
    T.overwrite_table(region_sales(t), f"{name}.region_sales")
    T.overwrite_table(t.table("events").groupBy("event_type").count(), f"{name}.event_types")
    T.overwrite_table(t.table("orders").groupBy("o_orderstatus").count(), f"{name}.order_states")
    t.spark.sql(f"CREATE VIEW {name}.large_sales AS SELECT * FROM {name}.region_sales WHERE units >= 1000")
    tags.tag_schema(t.spark, name, domain="demand", business_unit="supply chain")
    tags.tag_table(t.spark, f"{name}.event_types", domain="assistant")
    tags.tag_table(t.spark, f"{name}.order_states", domain="demand", business_unit="supply chain")
    known = tags.catalog_tags(t.spark, [name])
    hits = T.assets_with_tags(known, domain="demand", business_unit="supply chain")
    found = known.where("kind <> 'schema' AND key = 'domain'").join(hits, "asset", "left_semi")
    sizes = None
    for asset in sorted(r["asset"] for r in hits.collect() if "." in r["asset"]):
        rows = t.spark.table(asset).agg(F.lit(asset).alias("asset"), F.count("*").alias("table_rows"))
        sizes = rows if sizes is None else sizes.union(rows)
    return found.join(sizes, "asset").select(
        F.element_at(F.split("asset", r"\."), -1).alias("asset"), "kind", "inherited", "table_rows"
    )
