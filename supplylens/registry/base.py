"""Registration of runnable queries next to their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from supplylens.sources.domain import SupplyTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def prepare(spark: SparkSession) -> None:
    """Runtime settings the plans rely on; both are ordinary session options.

    Skewed join partitions are split even where the split costs one more shuffle,
    and the session clock is UTC so that dates mean the same on every executor.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``, with the SQL that must give the same rows."""

    def add(fn: Callable[[SupplyTables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(SupplyTables(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return add
