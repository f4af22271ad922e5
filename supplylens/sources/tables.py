"""Writing, replacing and maintaining tables with plain Spark writers.

Parquet tables have no row-level DML. A keyed change is therefore a new version:
the next state is computed from the current one, written to a folder of its own,
and the view that readers use is pointed at it in one statement. A task or
executor that is lost half way leaves the old version in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from supplylens.operators.windows import latest_per_key
from supplylens.session import new_folder


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def rows_inferred(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Small reference data from dictionaries; types inferred, columns in written order."""
    return spark.createDataFrame(rows).select(*rows[0])


def rows_typed(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def stamped(df: DataFrame, name: str = "calculated_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def ensure_namespace(spark: SparkSession, name: str, comment: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} COMMENT '{comment}' LOCATION '{location}'")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_typed_table(spark: SparkSession, name: str, columns: str, comment: str) -> None:
    """``columns`` is a DDL column list; it may carry NOT NULL, DEFAULT and COMMENT."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet COMMENT '{comment}'")


def overwrite_table(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").option("overwriteSchema", "true").saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    df.write.mode("append").saveAsTable(name)


def insert_into(df: DataFrame, name: str) -> None:
    """Positional insert with the columns put into the target's order first."""
    df.select(*df.sparkSession.table(name).columns).write.insertInto(name)


def insert_select(spark: SparkSession, name: str, *parts: DataFrame) -> None:
    """Append several results as one insert, matched by column name."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    insert_into(stacked, name)


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def publish(df: DataFrame, view: str) -> DataFrame:
    """Write a new version and point the view at it."""
    return publish_together({view: df})[view]


def publish_together(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Write new versions of several tables, and only when all are there point their views at them."""
    versions = {}
    for view, df in tables.items():
        folder = new_folder(df.sparkSession, view)
        df.write.parquet(folder)
        versions[view] = df.sparkSession.read.schema(df.schema).parquet(folder)
    for view, version in versions.items():
        version.createOrReplaceTempView(view)
    return versions


def upserted(target: DataFrame, source: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Target rows replaced or extended by the source; its newest row wins per key."""
    changes = latest_per_key(source, [key], order)
    kept = target.join(changes.select(key), key, "left_anti")
    return kept.unionByName(changes)


def updated(
    target: DataFrame, changes: DataFrame, key: str, column: str, value: str, order: list[str] | None = None
) -> DataFrame:
    """Target with ``column`` set from ``changes[value]`` where the key matches.

    Of several changes for one key the newest by ``order`` counts, the largest value without one.
    """
    new = latest_per_key(changes, [key], order or [value]).select(key, F.col(value).alias("_new"), F.lit(True).alias("_hit"))
    return target.join(new, key, "left").select(
        *[
            F.when(F.col("_hit"), F.col("_new")).otherwise(F.col(column)).alias(column) if c == column else F.col(c)
            for c in target.columns
        ]
    )


def deleted(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return target.join(keys.select(key), key, "left_anti")


def replaced_slice(target: DataFrame, slice_rows: DataFrame, key: str) -> DataFrame:
    """Drop every row of the slice's key values, then add the new rows."""
    return deleted(target, slice_rows.select(key).distinct(), key).unionByName(slice_rows)


def decide(items_view: str, decisions_view: str, new: DataFrame) -> None:
    """Record decisions and carry each into its action's status.

    Both next states are computed from the same input before either view moves.
    """
    spark = new.sparkSession
    choices = latest_per_key(new, ["action_id"], ["decided_at", "decision"])
    decisions = upserted(spark.table(decisions_view), choices, "action_id", ["decided_at"])
    items = updated(spark.table(items_view), choices, "action_id", "status", "decision")
    publish_together({decisions_view: decisions, items_view: items})


def reset_decisions(items_view: str, decisions_view: str, keys: DataFrame, status: str = "PENDING") -> None:
    """Withdraw decisions and put their actions back in the queue."""
    spark = keys.sparkSession
    back = keys.select("action_id").distinct().withColumn("_status", F.lit(status))
    decisions = deleted(spark.table(decisions_view), back, "action_id")
    items = updated(spark.table(items_view), back, "action_id", "status", "_status")
    publish_together({decisions_view: decisions, items_view: items})


def apply_comments(spark: SparkSession, table: str, comment: str, columns: dict[str, str]) -> None:
    quote = lambda text: text.replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {table} IS '{quote(comment)}'")
    for column, text in columns.items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN {column} COMMENT '{quote(text)}'")


def read_comments(spark: SparkSession, table: str) -> DataFrame:
    """Column comments as rows."""
    return spark.sql(f"DESCRIBE TABLE {table}").select(
        F.col("col_name").alias("column_name"), F.coalesce("comment", F.lit("")).alias("comment")
    )


def assets_with_tags(tags: DataFrame, **wanted: str) -> DataFrame:
    """Assets carrying all the given tags, from an (asset, key, value) table."""
    pairs = [(F.col("key") == k) & (F.col("value") == v) for k, v in wanted.items()]
    any_pair = pairs[0]
    for pair in pairs[1:]:
        any_pair = any_pair | pair
    hits = tags.where(any_pair).groupBy("asset").agg(F.count_distinct("key").alias("_n"))
    return hits.where(F.col("_n") == len(wanted)).select("asset")
