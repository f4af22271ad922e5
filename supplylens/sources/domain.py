"""Supply-chain domain tables bound to a star schema of parquet files.

Every method returns a lazy DataFrame. Facts join only the dimensions the caller
asks for, the side that a date window shrinks comes first (orders for sales, lines
for shipments), and position tables are aggregated before any
dimension join. ``nation`` and ``region`` are fixed-size code tables; all other
dimensions grow with the data, so no join carries a broadcast hint and Spark
decides from measured sizes.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from supplylens.functions import measures as M
from supplylens.operators import derive
from supplylens.operators.windows import latest_per_key, with_previous_month

ANCHOR = date(2000, 1, 1)
PLANNED_LEAD_DAYS = 30
CURRENCY_SLA_RATE = 1000.0
#: Lines that a task groups on average. Keys of lines hardly repeat, so its memory follows its rows, not its groups.
LINES_PER_TASK = 250_000


@dataclass(frozen=True)
class SupplyTables:
    spark: SparkSession
    root: str
    anchor: date = ANCHOR
    _read: dict[str, DataFrame] = field(default_factory=dict, repr=False, compare=False)

    def table(self, name: str) -> DataFrame:
        """The table's scan; files are listed and the footer is read once per table."""
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._read[name]

    def line_parts(self) -> int:
        """Into how many parts lines are dealt before they are grouped; the count comes from the footers."""
        return max(1, -(-self.table("lineitem").count() // LINES_PER_TASK))

    # dimensions -------------------------------------------------------------

    def nations(self) -> DataFrame:
        region = self.table("region").select("r_regionkey", F.col("r_name").alias("region"))
        return (
            self.table("nation")
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("n_nationkey").alias("nation_id"), F.col("n_name").alias("nation"), "region")
        )

    def customers(self) -> DataFrame:
        return (
            self.table("customer")
            .join(self.nations(), F.col("c_nationkey") == F.col("nation_id"))
            .select(
                F.col("c_custkey").alias("customer_id"),
                F.col("c_name").alias("customer_name"),
                F.col("c_mktsegment").alias("segment"),
                F.col("nation").alias("state"),
                "region",
            )
        )

    def supplier_places(self) -> DataFrame:
        return (
            self.table("supplier")
            .join(self.nations(), F.col("s_nationkey") == F.col("nation_id"))
            .select(
                F.col("s_suppkey").alias("supplier_id"),
                F.col("nation").alias("country"),
                F.col("region").alias("continent"),
            )
        )

    def suppliers(self) -> DataFrame:
        """Suppliers with a 1..10 reliability scaled from the account balance."""
        supplier = self.table("supplier")
        low = supplier.select(F.min("s_acctbal")).scalar()
        high = supplier.select(F.max("s_acctbal")).scalar()
        # balances that are all alike say nothing: everybody stands in the middle
        spread = F.nullif(high - low, F.lit(0.0))
        reliability = F.coalesce(F.round(1 + 9 * (F.col("s_acctbal") - low) / spread, 1), F.lit(5.5))
        return (
            supplier.join(self.nations(), F.col("s_nationkey") == F.col("nation_id"))
            .select(
                F.col("s_suppkey").alias("supplier_id"),
                F.col("s_name").alias("supplier_name"),
                F.col("nation").alias("country"),
                F.col("region").alias("continent"),
                reliability.alias("reliability_score"),
            )
            .withColumn("risk_tier", derive.risk_tier(F.col("reliability_score")))
        )

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("sku_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("product_family"),
            F.col("p_brand").alias("product_category"),
            F.col("p_size").cast("bigint").alias("safety_stock_level"),
            M.to_cents(F.col("p_retailprice")).alias("unit_price_cents"),
        )

    # facts ------------------------------------------------------------------

    def order_heads(self) -> DataFrame:
        return self.table("orders").select(
            "o_orderkey",
            "o_custkey",
            "o_orderstatus",
            F.col("o_orderpriority").alias("channel"),
            F.col("o_orderdate").cast("date").alias("order_date"),
        )

    def latest_month(self) -> Column:
        """First day of the month of the newest order that has lines; orders may come before their lines."""
        lines = self.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
        filled = self.table("orders").join(lines, "o_orderkey", "left_semi")
        return F.trunc(filled.select(F.max("o_orderdate").cast("date").alias("d")).scalar(), "MM")

    def order_places(self) -> DataFrame:
        customers = self.customers().select("customer_id", "segment", "state", "region")
        return self.order_heads().join(customers, F.col("o_custkey") == F.col("customer_id")).drop("o_custkey")

    def sales_orders(self, product: bool = False, places: bool = True, since: Column | None = None) -> DataFrame:
        """One row per order line with its status and amount in cents, with ``places`` also segment, region and state.

        ``since`` is a first day, for callers that need no older orders.
        """
        lines = self.table("lineitem").select(
            "l_orderkey",
            F.col("l_partkey").alias("sku_id"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            M.to_cents(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("amount_cents"),
            "l_returnflag",
        )
        orders = self.order_places() if places else self.order_heads().withColumnRenamed("o_custkey", "customer_id")
        if since is not None:
            orders = orders.where(F.col("order_date") >= since)
        where = ["segment", "region", "state"] if places else []
        sales = (
            orders
            .join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
            .select(
                F.col("o_orderkey").alias("order_id"),
                "order_date",
                "customer_id",
                *where,
                "channel",
                "sku_id",
                "quantity",
                "amount_cents",
                derive.order_status(F.col("o_orderstatus"), F.col("l_returnflag")).alias("order_status"),
            )
        )
        if product:
            families = self.products().select("sku_id", "product_family", "product_category")
            sales = sales.join(families, "sku_id")
        return sales

    def _lead_lines(self, *extra: Column) -> tuple[DataFrame, Column]:
        lines = self.table("lineitem").select(
            "l_orderkey",
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_partkey").alias("sku_id"),
            F.col("l_shipdate").cast("date").alias("ship_date"),
            "l_returnflag",
            *extra,
        )
        return lines, F.datediff("ship_date", "order_date").cast("bigint")

    def shipments(self, origin: bool = False, places: bool = True) -> DataFrame:
        """One row per shipped line: lead days, lateness and freight in cents, with ``places`` also the destination.

        The lines come first: a ship-date window then leaves few rows to carry
        through the order and customer joins.
        """
        lines, lead = self._lead_lines(
            M.to_cents(F.col("l_extendedprice") * F.col("l_tax")).alias("cost_cents"), F.col("l_linenumber")
        )
        orders = self.table("orders").select(
            "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_date")
        )
        shipped = (
            lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .withColumn("actual_transit_days", lead)
            .withColumn("planned_transit_days", F.lit(PLANNED_LEAD_DAYS).cast("bigint"))
        )
        destination = []
        if places:
            homes = self.customers().select("customer_id", "state", "region")
            shipped = shipped.join(homes, F.col("o_custkey") == F.col("customer_id"))
            destination = [F.col("region").alias("destination_region"), F.col("state").alias("destination_state")]
        shipped = derive.shipment_delay(shipped).select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").cast("bigint").alias("line_number"),
            "supplier_id",
            "sku_id",
            "ship_date",
            "order_date",
            *destination,
            "planned_transit_days",
            "actual_transit_days",
            "delay_days",
            "is_late",
            F.when(F.col("is_late"), F.col("l_returnflag")).alias("delay_reason"),
            "cost_cents",
        )
        if origin:
            places = self.supplier_places().select("supplier_id", F.col("continent").alias("origin_region"))
            shipped = shipped.join(places, "supplier_id")
        return shipped

    def purchase_lines(self, since: Column | None = None) -> DataFrame:
        """Supplier orders before the supplier dimension is attached, from the day ``since`` on."""
        orders = self.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
        if since is not None:
            orders = orders.where(F.col("order_date") >= since)
        lines, lead = self._lead_lines()
        joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
            "supplier_id",
            "sku_id",
            "order_date",
            "l_returnflag",
            F.lit(PLANNED_LEAD_DAYS).cast("bigint").alias("contracted_lead_time_days"),
            lead.alias("actual_lead_time_days"),
        )
        return derive.lead_time_variance(joined)

    def supplier_orders(self) -> DataFrame:
        places = self.supplier_places().select(
            "supplier_id",
            F.col("country").alias("supplier_country"),
            F.col("continent").alias("supplier_continent"),
        )
        return self.purchase_lines().join(places, "supplier_id")

    def supplier_lead_times(self, latest_only: bool = False) -> DataFrame:
        """Supplier x month summary of actual against contracted lead time, of all months or the newest."""
        return derive.monthly_lead_times(self.purchase_lines(self.latest_month() if latest_only else None))

    def vendor_slas(self) -> DataFrame:
        """Two service levels per supplier, evaluated against fixed targets."""
        per_supplier = self.purchase_lines().groupBy("supplier_id").agg(
            M.rate_pct(~F.col("is_late"), 1).alias("on_time"),
            M.rate_pct(F.col("l_returnflag") != "R", 1).alias("kept"),
        )
        measured = per_supplier.select(
            "supplier_id",
            F.explode(
                F.array(
                    F.struct(
                        F.lit("On_Time_Delivery").alias("sla_metric"),
                        F.lit(50.0).alias("target_pct"),
                        F.col("on_time").alias("actual_pct"),
                    ),
                    F.struct(
                        F.lit("Quality_Acceptance").alias("sla_metric"),
                        F.lit(66.0).alias("target_pct"),
                        F.col("kept").alias("actual_pct"),
                    ),
                )
            ).alias("sla"),
        ).select("supplier_id", "sla.*")
        shortfall = F.round((F.col("target_pct") - F.col("actual_pct")) * F.lit(CURRENCY_SLA_RATE), 2)
        return derive.sla_evaluation(measured, shortfall)

    def inventory_ledger(self, product: bool = False) -> DataFrame:
        """One row per warehouse x SKU; the lines collapse before dimensions join.

        They are dealt by position first: grouping them where they are read would hold a split's positions in one task.
        """
        inbound = F.col("l_linestatus") == "F"
        quantity = F.col("l_quantity").cast("bigint")
        positions = (
            self.table("lineitem")
            .repartition(self.line_parts(), "l_suppkey", "l_partkey")
            .groupBy(F.col("l_suppkey").alias("warehouse_id"), F.col("l_partkey").alias("sku_id"))
            .agg(
                F.greatest(F.lit(0), F.sum(F.when(inbound, quantity).otherwise(-quantity))).alias("on_hand_qty"),
                F.coalesce(F.avg(F.when(~inbound, quantity)), F.lit(0.0)).alias("daily_demand"),
            )
        )
        places = self.supplier_places().select(
            F.col("supplier_id").alias("warehouse_id"), F.col("continent").alias("region")
        )
        dims = ["sku_id", "safety_stock_level"] + (["product_family"] if product else [])
        ledger = positions.join(places, "warehouse_id").join(self.products().select(*dims), "sku_id")
        return derive.stock_flags(ledger).withColumn(
            "days_of_supply", derive.days_of_supply(F.col("on_hand_qty"), F.col("daily_demand"))
        )

    def stock_movements(self) -> DataFrame:
        places = self.supplier_places().select(
            F.col("supplier_id").alias("warehouse_id"), F.col("continent").alias("region")
        )
        lines = self.table("lineitem").select(
            F.col("l_suppkey").alias("warehouse_id"),
            F.col("l_partkey").alias("sku_id"),
            F.col("l_shipdate").cast("date").alias("movement_date"),
            derive.movement_type(F.col("l_linestatus"), F.col("l_returnflag")).alias("movement_type"),
            F.col("l_quantity").cast("bigint").alias("moved"),
        )
        return (
            lines.join(places, "warehouse_id")
            .withColumn("quantity", derive.signed_quantity(F.col("movement_type"), F.col("moved")))
            .drop("moved")
        )

    def demand_forecasts(self, latest_only: bool = False) -> DataFrame:
        """Month x region x family units; the forecast is the previous month's actual.

        The newest month alone needs the orders of two months.
        """
        monthly = (
            self.sales_orders(product=True, since=F.add_months(self.latest_month(), -1) if latest_only else None)
            .groupBy(F.trunc("order_date", "MM").alias("forecast_month"), "region", "product_family")
            .agg(F.sum("quantity").alias("actual_demand_units"))
        )
        paired = with_previous_month(
            monthly, ["region", "product_family"], "forecast_month", "actual_demand_units", "forecast_demand_units"
        )
        return derive.forecast_quality(paired)

    def carriers(self) -> DataFrame:
        """Carrier with the comma-joined list of regions it serves (at most the region table)."""
        return (
            self.order_places()
            .groupBy(F.col("channel").alias("carrier_id"))
            .agg(F.array_join(F.sort_array(F.collect_set("region")), ",").alias("service_regions"))
        )

    def procurement(self) -> DataFrame:
        """Month x family spend against the previous month's spend as budget."""
        monthly = (
            self.sales_orders(product=True)
            .groupBy(F.trunc("order_date", "MM").alias("month"), "product_family")
            .agg(F.sum("amount_cents").alias("total_spend_cents"))
        )
        return with_previous_month(
            monthly, ["product_family"], "month", "total_spend_cents", "budgeted_spend_cents"
        )

    # actions ----------------------------------------------------------------

    def action_items(self) -> DataFrame:
        """One recommended action per user seen in the event log."""
        uid = F.col("user_id")
        names = F.array(*[F.lit(v) for v in ("inventory", "logistics", "supplier", "demand", "finance")])
        kinds = F.array(*[F.lit(v) for v in ("IMMEDIATE", "SHORT_TERM", "STRATEGIC")])
        spans = F.array(*[F.lit(v) for v in ("Next 7 Days", "Next 30 Days", "Next 90 Days")])
        states = F.array(*[F.lit(v) for v in ("PENDING", "PENDING", "IN_PROGRESS", "COMPLETED")])
        pick = lambda options, n: F.element_at(options, (F.pmod(uid, F.lit(n)) + 1).cast("int"))
        return (
            self.table("events")
            .groupBy("user_id")
            .agg(F.min("ts").alias("created_at"), F.count("*").cast("string").alias("_seen"))
            .select(
                uid.alias("action_id"),
                F.concat(F.lit("run_"), F.pmod(uid, F.lit(3)).cast("string")).alias("run_id"),
                pick(kinds, 3).alias("category"),
                pick(spans, 3).alias("timeframe"),
                pick(names, 5).alias("domain"),
                F.concat(F.lit("Action "), uid.cast("string")).alias("title"),
                F.concat(F.lit("Follow up on user "), uid.cast("string")).alias("description"),
                F.concat(F.lit("Review "), "_seen", F.lit(" events")).alias("specific_steps"),
                F.concat(F.lit("Settles "), "_seen", F.lit(" events")).alias("expected_impact"),
                (F.pmod(uid, F.lit(10)) + 1).alias("priority"),
                pick(states, 4).alias("status"),
                "created_at",
            )
        )

    def customer_actions(self) -> DataFrame:
        """One action per customer; those whose number is a user of the event log have evaluations."""
        cid = F.col("c_custkey")
        return self.table("customer").select(
            cid.alias("action_id"),
            F.concat(F.lit("run_"), F.pmod(cid, F.lit(3)).cast("string")).alias("run_id"),
            F.lit("SHORT_TERM").alias("category"),
            F.lit("demand").alias("domain"),
            F.concat(F.lit("Call "), "c_name").alias("title"),
            F.concat(F.lit("Segment "), "c_mktsegment").alias("description"),
            F.concat(F.lit("Ask "), "c_name").alias("specific_steps"),
            F.concat(F.lit("Keeps "), "c_mktsegment").alias("expected_impact"),
            (F.pmod(cid, F.lit(10)) + 1).alias("priority"),
            F.when(F.pmod(cid, F.lit(4)) < 2, "PENDING").otherwise("COMPLETED").alias("status"),
        )

    def action_evaluations(self) -> DataFrame:
        key = F.get_json_object("props", "$.k")
        return self.table("events").select(
            F.col("event_id").alias("evaluation_id"),
            F.col("user_id").alias("action_id"),
            F.col("ts").alias("evaluated_at"),
            derive.recommendation_of_event(F.col("event_type")).alias("recommendation"),
            F.least(F.col("value") / 100, F.lit(1.0)).alias("practicality_score"),
            F.col("props").alias("reasoning"),
            F.concat(F.lit("risk "), key).alias("risks"),
            F.concat(F.lit("pro "), "event_type").alias("pros"),
            F.concat(F.lit("con "), "event_type").alias("cons"),
            F.concat(F.lit("cost "), key).alias("cost_estimate"),
        )

    def action_decisions(self) -> DataFrame:
        """Latest purchase or error per user, read as an approval or a rejection."""
        chosen = self.table("events").where(F.col("event_type").isin("purchase", "error"))
        latest = latest_per_key(chosen, ["user_id"], ["ts", "event_id"])
        return latest.select(
            F.col("user_id").alias("action_id"),
            F.when(F.col("event_type") == "purchase", "APPROVED").otherwise("REJECTED").alias("decision"),
            F.col("props").alias("notes"),
            F.col("ts").alias("decided_at"),
        )

    def action_history(self) -> DataFrame:
        """Past actions with a metric before and after, one per order."""
        okey = F.col("o_orderkey")
        return self.table("orders").select(
            okey.alias("history_id"),
            F.col("o_orderdate").cast("date").alias("action_date"),
            F.element_at(
                F.array(*[F.lit(v) for v in ("inventory", "logistics", "supplier", "demand", "finance")]),
                (F.pmod(okey, F.lit(5)) + 1).cast("int"),
            ).alias("domain"),
            F.concat(F.lit("Past action "), okey.cast("string")).alias("title"),
            F.when(F.col("o_orderstatus") == "F", "SUCCESS")
            .when(F.col("o_orderstatus") == "P", "PARTIAL")
            .otherwise("FAILED")
            .alias("success_rating"),
            M.to_cents(F.col("o_totalprice")).alias("cost_cents"),
            F.lit("fill_rate").alias("metric_name"),
            F.when(F.pmod(okey, F.lit(11)) != 0, F.pmod(okey, F.lit(60)) + 20).alias("metric_before"),
            (F.pmod(F.col("o_custkey"), F.lit(70)) + 25).alias("metric_after"),
            F.concat(F.lit("Lesson from "), F.col("o_orderpriority")).alias("lessons_learned"),
        )
