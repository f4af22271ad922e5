"""Latest-row, ordering and share operators that hold up when one key is hot.

A plain ``row_number`` over a key sorts all rows of that key in one task. The
top-k forms below filter on the rank, for which Spark adds a per-task limit
before the shuffle, so a hot key sends at most k rows per task. Positions and
neighbours inside a key are found block by block: rows are ranked inside a
(key, block) group and only one summary row per block is ranked per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def ranked_latest(df: DataFrame, keys: list[str], order: list[str], k: int, rank: str = "rn") -> DataFrame:
    """The k newest rows per key with their rank; ``order`` must end in a unique id."""
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn(rank, F.row_number().over(newest_first)).where(F.col(rank) <= k)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return ranked_latest(df, keys, order, 1, "_rn").drop("_rn")


def nth_latest_per_key(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    return ranked_latest(df, keys, order, n, "_rn").where(F.col("_rn") == n).drop("_rn")


def latest_and_previous(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Values of the newest row and of the one before it, for keys that have both.

    Ranks and pairs on the same partitioning, so there is one shuffle and no self join.
    """
    top = ranked_latest(df, keys, order, 2, "_rn")
    sides = []
    for value in values:
        sides.append(F.max(F.when(F.col("_rn") == 1, F.col(value))).alias(f"curr_{value}"))
        sides.append(F.max(F.when(F.col("_rn") == 2, F.col(value))).alias(f"prev_{value}"))
    paired = top.groupBy(*keys).agg(F.max("_rn").alias("_n"), *sides)
    return paired.where(F.col("_n") == 2).drop("_n")


def index_within_key(df: DataFrame, keys: list[str], block: Column, order: list[str], name: str) -> DataFrame:
    """0-based position of each row in its key, ``block`` rising with ``order``.

    The position is the row's place in its block plus the sizes of earlier blocks.
    """
    blocked = df.withColumn("_block", block)
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        blocked.groupBy(*keys, "_block")
        .agg(F.count("*").alias("_size"))
        .withColumn("_offset", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .drop("_size")
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(*order)
    placed = blocked.withColumn("_place", F.row_number().over(inside) - 1)
    return (
        placed.join(offsets, [*keys, "_block"])
        .withColumn(name, (F.col("_place") + F.col("_offset")).cast("bigint"))
        .drop("_block", "_place", "_offset")
    )


def previous_within_key(
    df: DataFrame, keys: list[str], block: Column, order: list[str], value: str, name: str
) -> DataFrame:
    """The preceding row's value inside each key, carried across block borders."""
    blocked = df.withColumn("_block", block)
    position = F.struct(*order)
    by_block = Window.partitionBy(*keys).orderBy("_block")
    carried = (
        blocked.groupBy(*keys, "_block")
        .agg(F.max_by(F.struct(F.col(value).alias("v")), position).alias("_last"))
        .withColumn("_carried", F.lag("_last").over(by_block))
        .select(*keys, "_block", F.col("_carried.v").alias("_carried"))
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(*order)
    near = blocked.withColumn("_first", F.row_number().over(inside) == 1).withColumn(
        "_near", F.lag(value).over(inside)
    )
    return (
        near.join(carried, [*keys, "_block"])
        .withColumn(name, F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_near")))
        .drop("_block", "_first", "_near", "_carried")
    )


def with_previous_month(df: DataFrame, keys: list[str], month: str, value: str, name: str) -> DataFrame:
    """Value of the calendar month before, on monthly totals; months without one are left out."""
    by_month = Window.partitionBy(*keys).orderBy(month)
    return (
        df.withColumn("_before", F.lag(month).over(by_month))
        .withColumn(name, F.lag(value).over(by_month))
        .where(F.col("_before") == F.add_months(month, -1))
        .drop("_before")
    )


def with_share_of_total(grouped: DataFrame, value: str, name: str, digits: int | None = 1) -> DataFrame:
    """Percentage of the overall total on already grouped rows.

    The window has no partition key, so it is for report rows (one per region,
    status or reason), never for facts.
    """
    total = F.sum(value).over(Window.partitionBy())
    share = F.col(value).cast("double") * 100.0 / F.nullif(total, F.lit(0))
    return grouped.withColumn(name, share if digits is None else F.round(share, digits))


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def value_counts(df: DataFrame, col: str, missing: str, name: str = "action_count") -> DataFrame:
    return df.groupBy(F.coalesce(F.col(col), F.lit(missing)).alias(col)).agg(F.count("*").alias(name))


def mean_of_group_means(df: DataFrame, inner: list[str], outer: str, value: str, name: str) -> DataFrame:
    """Unweighted mean over ``outer`` of the averages taken at the finer grain."""
    means = df.groupBy(outer, *inner).agg(F.round(F.avg(value), 1).alias("_mean"))
    return means.groupBy(outer).agg(F.round(F.avg("_mean"), 2).alias(name))


def last_known_within_key(
    df: DataFrame, keys: list[str], block: Column, order: list[str], value: str, name: str
) -> DataFrame:
    """The newest non-null value up to each row inside its key, the row's own included.

    Carried on two levels: inside a (key, block), and from the blocks before by one row per block.
    """
    blocked = df.withColumn("_block", block)
    stated = F.when(F.col(value).isNotNull(), F.struct(*order))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        blocked.groupBy(*keys, "_block")
        .agg(F.max_by(value, stated).alias("_last"))
        .withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier))
        .drop("_last")
    )
    inside = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        blocked.withColumn("_near", F.last(value, ignorenulls=True).over(inside))
        .join(carried, [*keys, "_block"])
        .withColumn(name, F.coalesce("_near", "_carried"))
        .drop("_block", "_near", "_carried")
    )
