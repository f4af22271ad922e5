"""A log of calls, answers and messages, derived from the reports on supplier months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from supplylens.sources.texts import responses, whole


def call_log(t) -> DataFrame:
    """conv_id, turn, role, name, arguments, text: one conversation a supplier, ten turns a month at most.

    A month brings a call (none every sixth month, two every fifth), its answer, a name every third month, a table and
    a draft. Arguments hold a query, another field, or no JSON.
    """
    sid, month = F.col("supplier_id"), F.month("month")
    who = F.array(*[F.lit(n) for n in ("demand", "inventory", "logistics", "evaluator")])
    kind = (sid + month) % 3
    arguments = (
        F.when(kind == 0, F.concat(F.lit('{"query": "Late shipments of '), whole(sid), F.lit('", "limit": 5}')))
        .when(kind == 1, F.lit('{"limit": 5}'))
        .otherwise(F.concat(F.lit("shipments "), whole(F.col("total_metrics"))))
    )
    none = F.lit(None).cast("string")
    row = lambda at, role, name, args, text: F.struct(
        F.lit(at).alias("at"), role.alias("role"), name.alias("name"), args.alias("arguments"), text.alias("text")
    )
    own = F.when(sid % 2 == 0, "logistics")
    rows = F.array(
        F.when(month % 6 != 0, row(0, none, who[((sid + month) % 4).cast("int")], arguments, none)),
        F.when(month % 5 == 0, row(1, none, F.lit("supplier"), F.lit('{"query": null}'), none)),
        row(2, F.lit("tool"), F.when(month % 6 == 0, own), none, F.when(month % 7 != 0, F.col("text")).otherwise("")),
        F.when(month % 3 == 0, row(3, F.lit("assistant"), none, none, F.concat(
            F.lit("<name>"), F.when(sid % 5 == 0, "").when(month % 2 == 0, "demand").otherwise("supplier"), F.lit("</name>")))),
        row(4, F.lit("assistant"), none, none, F.col("tool_text")),
        row(5, F.lit("assistant"), none, none, F.col("draft")),
    )
    turn = (F.year("month") * 12 + month) * 10 + F.col("r.at")
    return (
        responses(t)
        .select("supplier_id", "month", F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r"))
        .select(sid.alias("conv_id"), turn.cast("bigint").alias("turn"), "r.role", "r.name", "r.arguments", "r.text")
    )
