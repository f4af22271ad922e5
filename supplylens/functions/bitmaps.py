"""Exact distinct counts that merge: one bitmap for every 32,768 numbers.

A distinct count over days cannot be added up from the counts of the days, and two of them in one aggregation make Spark
write every row once for each. Bitmaps can be stored per day, or-ed over any set of days and counted, and several of
them are built in one pass. They need whole numbers; a key of another type is numbered first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bucket_of(value: Column) -> Column:
    return F.bitmap_bucket_number(value)


def members(value: Column, condition: Column | None = None) -> Column:
    """Aggregate: the bitmap of the values of one bucket, of those that meet the condition; nulls are in none."""
    chosen = value if condition is None else F.when(condition, value)
    return F.bitmap_construct_agg(F.bitmap_bit_position(chosen))


def distinct(bits: Column) -> Column:
    """Aggregate over the buckets of a group: how many different values there are."""
    return F.coalesce(F.sum(F.bitmap_count(bits)), F.lit(0)).cast("bigint")


def distinct_state(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mergeable state of the distinct values of each key: keys, bucket and bits."""
    rows = df.where(F.col(value).isNotNull())
    return rows.groupBy(*keys, bucket_of(F.col(value)).alias("bucket")).agg(members(F.col(value)).alias("bits"))


def merged(state: DataFrame, keys: list[str]) -> DataFrame:
    """One state by coarser or other keys: bits of equal buckets or-ed."""
    return state.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(state: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Distinct values per key of a state with one row for each key and bucket."""
    return state.groupBy(*keys).agg(distinct(F.col("bits")).alias(name))


def rolling_distinct(state: DataFrame, day: str, days: int, name: str) -> DataFrame:
    """Distinct values of the ``days`` days up to each day that has any, from the states of single days."""
    reach = F.explode(F.sequence(F.col(day), F.date_add(day, days - 1))).alias("_until")
    spread = state.select(reach, "bucket", "bits").withColumnRenamed("_until", day)
    known = state.select(day).distinct()
    return counted(merged(spread.join(known, day, "left_semi"), [day]), [day], name)
