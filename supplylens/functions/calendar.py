"""Calendar windows relative to an anchor date, and row predicates.

All windows are half open and calendar aligned: offset -1 is the month before
the anchor's month, offset -2 the one before that. Date columns must be DATE or
TIMESTAMP typed so that the comparison reaches the parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_start(anchor: date, offset: int = 0) -> date:
    """First day of the month ``offset`` months away from the anchor's month."""
    months = anchor.year * 12 + anchor.month - 1 + offset
    return date(months // 12, months % 12 + 1, 1)


def month_window(col: Column, anchor: date, offset: int = -1) -> Column:
    """True for dates inside the calendar month at ``offset``."""
    return (col >= F.lit(month_start(anchor, offset))) & (col < F.lit(month_start(anchor, offset + 1)))


def prior_month_window(col: Column, anchor: date) -> Column:
    return month_window(col, anchor, -2)


def two_month_window(col: Column, anchor: date) -> Column:
    """Last and prior month together: the scan filter of a month-over-month plan."""
    return (col >= F.lit(month_start(anchor, -2))) & (col < F.lit(month_start(anchor, 0)))


def period_label(col: Column, anchor: date) -> Column:
    return (
        F.when(month_window(col, anchor, -1), "Last_Month")
        .when(month_window(col, anchor, -2), "Prior_Month")
        .otherwise("Older")
    )


def month_name(anchor: date, offset: int = -1) -> Column:
    return F.date_format(F.lit(month_start(anchor, offset)), "MMMM yyyy")


def fiscal_quarter(col: Column, first_month: int = 7) -> Column:
    """Quarter label of a fiscal year that starts in ``first_month``."""
    return F.concat(F.lit("Q"), F.quarter(F.add_months(col, 13 - first_month)).cast("string"))


def fiscal_year(col: Column, first_month: int = 7) -> Column:
    return F.year(F.add_months(col, 13 - first_month)).cast("bigint")


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def date_plus_days(start: Column, days: Column | int) -> Column:
    return F.date_add(start, days)


def latest_period_rows(df: DataFrame, period: str) -> DataFrame:
    """Rows whose period equals the largest one, found by a scalar subquery.

    The subquery runs first, so the comparison becomes an ordinary pushed filter.
    """
    return df.where(F.col(period) == df.select(F.max(period)).scalar())


def filter_dimension(df: DataFrame, **equals: object) -> DataFrame:
    for name, value in equals.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def filter_flag(df: DataFrame, flag: str, value: bool = True) -> DataFrame:
    return df.where(F.col(flag) if value else ~F.col(flag))


def in_list(col: Column, values: Iterable[object] | None) -> Column:
    """Multi-select membership; an empty selection keeps everything."""
    chosen = list(values or [])
    return col.isin(chosen) if chosen else F.lit(True)


def priority_band(col: Column, band: str | None) -> Column:
    """Critical <= 2, High 3..4, Low >= 5 on a value coerced to a number."""
    number = col.cast("string").try_cast("double")
    bands = {"critical": number <= 2, "high": number.between(3, 4), "low": number >= 5}
    return bands[band] if band else F.lit(True)


def decided(col: Column, state: str | None) -> Column:
    blank = F.coalesce(col, F.lit("")) == ""
    return {"decided": ~blank, "undecided": blank}[state] if state else F.lit(True)
