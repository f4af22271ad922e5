"""Aggregate and scalar expression builders shared by the KPI plans.

Money is held as integer cents: integer sums are exact whatever the order in
which partial aggregates arrive, and are turned into currency once at the end.
Rates use double arithmetic on purpose, because decimal averages change type
and precision with the size of the input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_cents(amount: Column) -> Column:
    """Whole cents, halves away from zero.

    ``floor`` stays in generated code, where ``round`` on a double builds a decimal
    object per row.
    """
    cents = amount * 100
    return F.when(cents < 0, F.ceil(cents - 0.5)).otherwise(F.floor(cents + 0.5))


def dollars(cents: Column, digits: int = 2) -> Column:
    return F.round(cents / F.lit(100.0), digits)


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def sum_flag(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def sum_if(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(0))


def avg_if(condition: Column, value: Column, digits: int = 2) -> Column:
    return F.round(F.avg(F.when(condition, value)), digits)


def count_distinct_if(condition: Column, key: Column) -> Column:
    return F.count_distinct(F.when(condition, key))


def rate_pct(condition: Column, digits: int = 2) -> Column:
    """Share of rows for which the condition is true, as a percentage."""
    return F.round(F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))) * 100, digits)


def ratio_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole, null where whole is zero."""
    return F.round(part.cast("double") * 100.0 / F.nullif(whole, F.lit(0)), digits)


def change_pct(last: Column, prior: Column, digits: int = 2) -> Column:
    return F.round((last - prior).cast("double") / F.nullif(prior, F.lit(0)) * 100, digits)


def ratio(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(part / F.nullif(whole, F.lit(0)), digits)


def residual_rate(rate: Column, count: Column, part_rate: Column, part_count: Column) -> Column:
    """Rate of everybody outside a group, from the overall rate and the group's rate.

    Zero when the group is everybody, and never negative.
    """
    rest = count - part_count
    hits = rate / 100 * count - part_rate / 100 * part_count
    return F.when(rest > 0, F.greatest(F.lit(0.0), hits / F.nullif(rest, F.lit(0)) * 100)).otherwise(F.lit(0.0))


def residual_component(total: Column, *known: Column) -> Column:
    """What the known parts leave unexplained, floored at zero."""
    left = total
    for part in known:
        left = left - part
    return F.greatest(F.lit(0.0), left)


def percentage_gap_band(gap: Column, wide: float = 10.0) -> Column:
    return F.when(gap > wide, "red").when(gap > 0, "orange").otherwise("green")
