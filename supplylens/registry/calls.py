"""Queries over the log of calls, and counts of found metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from supplylens.functions import textual as X
from supplylens.operators import calls as C
from supplylens.operators import textops as O
from supplylens.registry.base import query
from supplylens.registry.ctes import register, with_tables
from supplylens.registry.text import DEFAULTS
from supplylens.sources.call_log import call_log
from supplylens.sources.texts import responses

register("call_log", ["resp"], """SELECT supplier_id AS conv_id, CAST((year(month) * 12 + month(month)) * 10 + step AS BIGINT) AS turn,
    CASE WHEN step IN (0, 1) THEN NULL WHEN step = 2 THEN 'tool' ELSE 'assistant' END AS role,
    CASE WHEN step = 0 THEN ['demand', 'inventory', 'logistics', 'evaluator'][(supplier_id + month(month)) % 4 + 1]
      WHEN step = 1 THEN 'supplier' WHEN step = 2 AND month(month) % 6 = 0 AND supplier_id % 2 = 0 THEN 'logistics' END AS name,
    CASE WHEN step = 0 THEN CASE (supplier_id + month(month)) % 3
        WHEN 0 THEN '{"query": "Late shipments of ' || supplier_id || '", "limit": 5}'
        WHEN 1 THEN '{"limit": 5}' ELSE 'shipments ' || n END
      WHEN step = 1 THEN '{"query": null}' END AS arguments,
    CASE step WHEN 2 THEN CASE WHEN month(month) % 7 <> 0 THEN text ELSE '' END
      WHEN 3 THEN '<name>' || CASE WHEN supplier_id % 5 = 0 THEN '' WHEN month(month) % 2 = 0 THEN 'demand' ELSE 'supplier' END
        || '</name>' WHEN 4 THEN tool_text WHEN 5 THEN draft END AS text
    FROM (SELECT *, UNNEST([0, 1, 2, 3, 4, 5]) AS step FROM resp)
    WHERE step IN (2, 4, 5) OR (step = 0 AND month(month) % 6 <> 0) OR (step = 1 AND month(month) % 5 = 0)
      OR (step = 3 AND month(month) % 3 = 0)""")


@query("call_inventory", with_tables("call_log", """SELECT conv_id, turn, name AS caller,
    CASE WHEN json_valid(arguments) THEN COALESCE(json_extract_string(arguments, '$.query'), arguments) ELSE arguments END
      AS query FROM call_log WHERE role IS NULL AND name IS NOT NULL AND arguments IS NOT NULL"""))
def _(t):
    return C.call_inventory(call_log(t))


@query("answered_calls", with_tables("call_log", r"""SELECT conv_id, caller, turn, content, sql_blocks FROM (
    SELECT conv_id, caller, turn, text AS content, array_to_string(CASE WHEN len(fenced) > 0 THEN fenced ELSE bare END, chr(10))
      AS sql_blocks, ROW_NUMBER() OVER (PARTITION BY conv_id, caller ORDER BY turn DESC) AS rn
    FROM (SELECT conv_id, turn, role, text, COALESCE(pending, name, 'unknown') AS caller,
        regexp_extract_all(text, '(?s)```sql\s*\n(.*?)\n\s*```', 1) AS fenced,
        list_transform(regexp_extract_all(text, '(?i)(SELECT\s+[\s\S]{10,}?FROM\s+\S+[\s\S]*?)(?:\n\n|\z)', 1),
          lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')) AS bare
      FROM (SELECT *, LAG(CASE WHEN role IS NULL THEN name END) OVER (PARTITION BY conv_id ORDER BY turn) AS pending
        FROM call_log WHERE role IS NULL OR role = 'tool'))
    WHERE role = 'tool' AND text <> '' AND caller NOT IN ('evaluator', 'unknown')) WHERE rn = 1"""))
def _(t):
    return C.answered_calls(call_log(t)).withColumn("sql_blocks", F.array_join("sql_blocks", "\n"))


@query("header_owners", with_tables("call_log", r"""SELECT conv_id, caller,
    CAST(generate_subscripts(c, 1) - 1 AS BIGINT) AS pos, UNNEST(c) AS column_name FROM (
      SELECT conv_id, caller, list_filter(list_transform(string_split(trim(string_split(text, chr(10))[1], '|'), '|'),
        lambda x: trim(x)), lambda x: x <> '') AS c,
        ROW_NUMBER() OVER (PARTITION BY conv_id, caller ORDER BY turn DESC) AS rn
      FROM (SELECT *, LAST_VALUE(CASE WHEN starts_with(text, '<name>') AND ends_with(text, '</name>')
          THEN replace(replace(text, '<name>', ''), '</name>', '') END IGNORE NULLS) OVER (PARTITION BY conv_id
          ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS caller FROM call_log WHERE role = 'assistant')
      WHERE starts_with(text, '||') AND caller <> '') WHERE rn = 1"""))
def _(t):
    return C.header_owners(call_log(t))


def _found_sql() -> str:
    found = {n: f"(regexp_extract(text, '(?i){p}', 1) <> '')::INT" for n, p in X.METRIC_LABELS.items()}
    defaulted = " + ".join(f"(1 - {found[n]})" for n in DEFAULTS)
    return f"SELECT response_id, CAST({' + '.join(found.values())} AS BIGINT) AS found, CAST({defaulted} AS BIGINT) AS defaulted FROM resp"


@query("metric_counts", with_tables("resp", _found_sql()))
def _(t):
    return O.metric_counts(responses(t), ["response_id"], "text", DEFAULTS)
