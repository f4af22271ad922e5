"""Report texts derived from the fact tables: one narrative per supplier and month.

The texts carry the shapes the text operators read: headings, labelled numbers,
a pipe table, a fenced SQL block, verdict lines, a JSON list of actions and the
values a reader should find. They grow with the line items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplylens.functions import measures as M
from supplylens.operators.scoring import with_numbers
from supplylens.sources.domain import SupplyTables


def whole(value: Column) -> Column:
    return value.cast("string")


def with_commas(value: Column) -> Column:
    return F.format_number(value, 0)


def cents_text(cents: Column) -> Column:
    units = F.floor(cents / F.lit(100)).cast("bigint")
    return F.concat(with_commas(units), F.lit("."), F.lpad(whole(F.pmod(cents, F.lit(100))), 2, "0"))


def supplier_months(t: SupplyTables) -> DataFrame:
    late = F.col("l_returnflag") == "R"
    freight = M.to_cents(F.col("l_extendedprice") * F.col("l_tax"))
    month = F.trunc(F.col("l_shipdate").cast("date"), "MM")
    return (
        t.table("lineitem")
        .groupBy(F.col("l_suppkey").alias("supplier_id"), month.alias("month"))
        .agg(
            F.count("*").alias("n"),
            M.sum_flag(late).alias("late_n"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("units"),
            F.sum(M.to_cents(F.col("l_extendedprice"))).alias("cents"),
            M.sum_if(late, freight).alias("freight_cents"),
        )
        .withColumn(
            "response_id",
            F.col("supplier_id") * 1000000 + F.year("month") * 100 + F.month("month"),
        )
    )


def responses(t: SupplyTables) -> DataFrame:
    m, sid = F.col, F.col("supplier_id")
    tenths = F.floor((m("n") - m("late_n")) * 1000 / m("n")).cast("bigint")
    rate = F.concat(whole(F.floor(tenths / 10).cast("bigint")), F.lit("."), whole(F.pmod(tenths, F.lit(10))))
    draft = F.concat(
        F.lit("Summary for supplier "), whole(sid), F.lit("\n## Delivery report\nTotal shipments: "), whole(m("n")),
        F.when(F.pmod(sid, F.lit(3)) != 0, F.concat(F.lit("\nLate shipments: "), whole(m("late_n")))).otherwise(""),
        F.lit("\nOn-time delivery rate: "), rate, F.lit(" %"),
    )
    select = F.concat(
        F.lit("SELECT region, COUNT(*) AS shipments FROM shipments WHERE region = EUROPE AND ship_date >= DATE "),
        whole(m("month")),
    )
    second = F.when(F.pmod(sid, F.lit(4)) == 1, "```sql\nSELECT COUNT(*) AS total FROM orders\n```\n").otherwise("")
    statements = F.when(F.pmod(sid, F.lit(7)) == 3, F.concat(select, F.lit("\n\n"))).otherwise(
        F.concat(F.lit("```sql\n"), select, F.lit("\n```\n"), second)
    )
    rest = F.concat(
        F.lit("\n## Revenue\nAugust revenue: $"), cents_text(m("cents")),
        F.lit("\nWasted freight: $"), cents_text(m("freight_cents")),
        F.lit("\n1. **Expedite orders**\nCall the vendor.\n2. **Review stock**\nCount units: "), with_commas(m("units")),
        F.lit("\n\n| metric | value |\n|---|---|\n| shipments | "), whole(m("n")),
        F.lit(" |\n| units | "), whole(m("units")), F.lit(" |\n\n"), statements, F.lit("Done"),
    )
    actions = F.concat(
        F.lit('[{"category": "IMMEDIATE", "domain": "supplier", "title": "Ship '), whole(m("n")),
        F.lit(' lines", "priority": '), whole(F.pmod(sid, F.lit(9)) + 1),
        F.lit('}, {"title": "Audit", "description": "Units '), whole(m("units")), F.lit('"}]'),
    )
    exact = F.concat(whole(m("late_n")), F.lit(" of the **"), whole(m("n")), F.lit("** metrics were EXACT, "))
    verdict = (
        F.when(
            F.pmod(sid, F.lit(4)) == 0,
            F.concat(exact, whole(F.least(m("n"), F.pmod(sid, F.lit(5)))), F.lit(" metrics were CLOSE, no MISS")),
        )
        .when(F.pmod(sid, F.lit(4)) == 2, F.concat(exact, F.lit("1 metrics were MISS and 2 as NOT_FOUND")))
        .when(F.pmod(sid, F.lit(4)) == 3, "no CLOSE, 2 MISS, 1 NOT_FOUND")
        .otherwise("Revenue: EXACT\nFreight: NOT_FOUND\nUnits: EXACT\nRate: n/a")
    )
    return supplier_months(t).select(
        "response_id",
        "supplier_id",
        "month",
        draft.alias("draft"),
        F.concat(draft, rest).alias("text"),
        F.concat(F.lit("||supplier | month |"), F.when(m("late_n") > 0, " late |").otherwise(" |"), F.lit("|\n|1|2|"))
        .alias("tool_text"),
        F.when(F.pmod(sid, F.lit(5)) == 0, F.concat(F.lit('{"actions": '), actions, F.lit("}"))).otherwise(actions)
        .alias("actions_json"),
        verdict.alias("narration"),
        m("n").alias("total_metrics"),
        F.array(
            *[
                F.struct(F.lit(i).alias("id"), v.cast("double").alias("expected"))
                for i, v in (
                    ("A01", m("n")),
                    ("A02", m("late_n")),
                    ("B01", m("cents") / 100.0),
                    ("B02", F.round(m("freight_cents") * 1.05) / 100.0),
                    ("E01", F.round(m("cents") * 1.2) / 100.0),
                    ("F01", F.lit(0)),
                )
            ]
        ).alias("truths"),
    )


def expected_pairs(responses: DataFrame, text: str = "text") -> DataFrame:
    """One row per response and expected value, with the numbers of the text to search."""
    read = with_numbers(responses.select("response_id", "truths", F.col(text).alias("text")))
    return read.select("response_id", "_nums", "_abs", F.explode("truths").alias("e")).select(
        "response_id", "_nums", "_abs", F.col("e.id").alias("id"), F.col("e.expected").alias("expected")
    )
