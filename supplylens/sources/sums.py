"""Daily sums of the facts, kept in a bucketed store and refreshed by day.

Month questions add up a few sums per day and dimension member. They are computed once from the joined facts; a day whose
facts changed is computed again alone, and its buckets of all tables are replaced in one commit. A question then reads as
many rows as there are days and members, and no order line.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplylens.functions import measures as M
from supplylens.sources.buckets import BucketStore
from supplylens.sources.tables import deleted


def shipped_by_day(shipments: DataFrame) -> DataFrame:
    """Per ship date and destination: lines, late ones, days and freight of the late ones."""
    late = F.col("is_late")
    return shipments.groupBy("ship_date", "destination_region").agg(
        F.count("*").alias("lines"),
        M.count_if(late).alias("late_lines"),
        F.count(F.when(late, F.col("delay_days"))).alias("delays"),
        F.sum(F.when(late, F.col("delay_days"))).cast("bigint").alias("delay_days"),
        M.sum_if(late, F.col("cost_cents")).alias("late_cents"),
    )


def sold_by_day(sales: DataFrame) -> DataFrame:
    """Per order date, region and product family: lines, units and amount."""
    return sales.groupBy("order_date", "region", "product_family").agg(
        F.count("*").alias("lines"), F.sum("quantity").alias("units"), F.sum("amount_cents").alias("amount_cents")
    )


#: Tables of the store: day column, facts and their sums.
TABLES = {
    "shipped": ("ship_date", lambda t: t.shipments(), shipped_by_day),
    "sold": ("order_date", lambda t: t.sales_orders(product=True), sold_by_day),
}


class DailySums:
    """Sums of ``TABLES`` in a store; ``buckets`` of days each."""

    def __init__(self, store: BucketStore):
        self.store = store

    @classmethod
    def build(cls, store: BucketStore, t, buckets: int = 16) -> DailySums:
        for name, (day, facts, sums) in TABLES.items():
            store.create(name, sums(facts(t)), day, buckets)
        return cls(store)

    def refresh(self, t, days: Sequence[date]) -> None:
        """Compute the given days again, from the facts of these days; a day without facts has no sums any more."""
        base = self.store.manifest()
        staged = []
        for name, (day, facts, sums) in TABLES.items():
            changed = self.store.spark.createDataFrame([(d,) for d in days], f"{day} date")
            fresh = sums(facts(t).where(F.col(day).isin(list(days))))
            staged.append(
                self.store.changed(
                    base, name, changed, lambda rows, fresh=fresh, changed=changed, day=day: deleted(rows, changed, day).unionByName(fresh)
                )
            )
        self.store.commit(base, staged)

    def shipped(self) -> DataFrame:
        return self.store.table("shipped")

    def sold(self) -> DataFrame:
        return self.store.table("sold")
