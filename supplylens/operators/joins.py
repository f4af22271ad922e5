"""Joins beyond the plain keyed join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def skew_safe_join(
    many: DataFrame, one: DataFrame, key: str, spread_by: str, how: str = "inner", max_share: float = 0.001
) -> DataFrame:
    """Join a fact to a table with one row per key when single keys may dominate.

    Keys holding more than ``max_share`` of the fact's rows are found by a counted
    aggregate over the key column. There can be at most ``1 / max_share`` of them,
    which bounds the broadcast. Their fact rows are spread over several salts and
    their single row is repeated once per salt; every other key keeps salt 0. Rows
    without a key match nothing and are spread at will. The fact is read for its
    key column once more, so pass a stored table or a scan rather than a long plan.
    """
    total = many.select(F.count("*")).scalar()
    hot = (
        many.groupBy(key)
        .agg(F.count("*").alias("_rows"))
        .where(F.col("_rows") > total * F.lit(max_share))
        .select(key, F.ceil(F.col("_rows") / (total * F.lit(max_share))).cast("int").alias("_salts"))
    )
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    keyless = F.when(F.col(key).isNull(), F.lit(int(1 / max_share)))
    spread = (
        many.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.coalesce(keyless, salts)).cast("int"))
        .drop("_salts")
    )
    repeated = (
        one.join(F.broadcast(hot), key, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_salts")
    )
    return spread.join(repeated, [key, "_salt"], how).drop("_salt")


def left_join_filled(left: DataFrame, right: DataFrame, key: str, fill: dict[str, object]) -> DataFrame:
    """Left join with the right side's missing values replaced."""
    return left.join(right, key, "left").fillna(fill)


def without_counterpart(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows whose key is absent from the other table; nulls there never hide rows."""
    return left.join(right.select(key), key, "left_anti")


def fk_orphans(name: str, child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """One row per relationship: referencing rows whose key has no parent.

    Child keys are counted first, so a hot key crosses the join once.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).agg(
        F.count("*").alias("_rows")
    )
    missing = keys.join(parent.select(F.col(parent_key).alias("_key")), "_key", "left_anti")
    return missing.agg(
        F.lit(name).alias("relationship"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_rows"),
        F.count("*").alias("orphan_keys"),
    )


def alias_values(df: DataFrame, column: str, aliases: dict[str, str], known: list[str], name: str) -> DataFrame:
    """Map spoken values to stored ones: alias table first, then a prefix that fits one known value only.

    A blank value, or one that fits several, stays null.
    """
    spoken = F.lower(F.trim(F.col(column)))
    pairs = [F.lit(x) for item in aliases.items() for x in item]
    mapped: Column = F.try_element_at(F.create_map(*pairs), spoken) if pairs else F.lit(None).cast("string")
    fits = F.filter(F.array(*[F.lit(v) for v in known]), lambda v: F.startswith(F.lower(v), spoken) & (spoken != ""))
    return df.withColumn(name, F.coalesce(mapped, F.when(F.size(fits) == 1, F.try_element_at(fits, F.lit(1)))))
