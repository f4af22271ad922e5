"""Facts written once, by day, and read back as domain tables.

The direct bindings join line items to orders in every query. A warehouse that
answers many questions writes the joined facts once instead: one folder per day,
so that a month window prunes to some thirty folders, and no join is left at
query time. The rebalance hint lets Spark size the files, splitting a busy day
over several tasks and merging quiet ones.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplylens.session import drop_folder
from supplylens.sources.domain import SupplyTables

DAILY = {"sales_orders": "order_date", "shipments": "ship_date", "supplier_orders": "order_date"}
WHOLE = ["supplier_lead_times", "vendor_slas", "inventory_ledger", "suppliers"]


def stage_facts(
    t: SupplyTables, root: str, since: date | None = None, until: date | None = None
) -> "StagedTables":
    """Write the facts of the days in [since, until), replacing just those days' folders."""
    facts = {
        "sales_orders": t.sales_orders(product=True),
        "shipments": t.shipments(origin=True),
        "supplier_orders": t.supplier_orders(),
    }
    for name, df in facts.items():
        day = F.col(DAILY[name])
        if since:
            df = df.where(day >= F.lit(since))
        if until:
            df = df.where(day < F.lit(until))
        (
            df.hint("rebalance", DAILY[name])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DAILY[name])
            .parquet(f"{root}/{name}")
        )
        drop_empty_days(df, DAILY[name], f"{root}/{name}", since, until)
    for name in WHOLE:
        getattr(t, name)().write.mode("overwrite").parquet(f"{root}/{name}")
    return StagedTables(t.spark, t.root, t.anchor, staged=root)


def drop_empty_days(df: DataFrame, day: str, path: str, since: date | None, until: date | None) -> None:
    """Remove the folders of days in the range that have no rows any more: writing replaces only days that have some.

    Both lists have one entry per day.
    """
    spark = df.sparkSession
    stored = spark.read.parquet(path).select(F.col(day).cast("date").alias("d")).distinct()
    if since:
        stored = stored.where(F.col("d") >= F.lit(since))
    if until:
        stored = stored.where(F.col("d") < F.lit(until))
    for row in stored.join(df.select(F.col(day).alias("d")).distinct(), "d", "left_anti").collect():
        drop_folder(spark, f"{path}/{day}={row['d'].isoformat()}")


@dataclass(frozen=True)
class StagedTables(SupplyTables):
    """The domain tables with their facts read from a staged folder."""

    staged: str = ""

    def _fact(self, name: str) -> DataFrame:
        key = f"staged/{name}"
        if key not in self._read:
            self._read[key] = self.spark.read.parquet(f"{self.staged}/{name}")
        return self._read[key]

    def sales_orders(self, product: bool = False, places: bool = True, since: Column | None = None) -> DataFrame:
        sales = self._fact("sales_orders")
        return sales if since is None else sales.where(F.col("order_date") >= since)

    def shipments(self, origin: bool = False, places: bool = True) -> DataFrame:
        return self._fact("shipments")

    def supplier_orders(self) -> DataFrame:
        return self._fact("supplier_orders")

    def purchase_lines(self, since: Column | None = None) -> DataFrame:
        lines = self._fact("supplier_orders")
        return lines if since is None else lines.where(F.col("order_date") >= since)

    def supplier_lead_times(self, latest_only: bool = False) -> DataFrame:
        return self._fact("supplier_lead_times")

    def vendor_slas(self) -> DataFrame:
        return self._fact("vendor_slas")

    def inventory_ledger(self, product: bool = False) -> DataFrame:
        return self._fact("inventory_ledger")

    def suppliers(self) -> DataFrame:
        return self._fact("suppliers")
