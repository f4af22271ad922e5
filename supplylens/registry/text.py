"""Text extraction, term lookup and scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from supplylens.functions import textual as X
from supplylens.operators import scoring as S
from supplylens.operators import textops as O
from supplylens.operators.metric_view import match_terms
from supplylens.plans import certified as Q
from supplylens.plans import metric_views as V
from supplylens.plans.ground_truth import metric_rows, stack
from supplylens.registry.base import query
from supplylens.registry.ctes import LAST, register, with_tables
from supplylens.sources.texts import expected_pairs, responses

register("sm", [], """SELECT l_suppkey AS supplier_id, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
    COUNT(*) AS n, CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS late_n,
    CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units,
    CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents,
    CAST(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(ROUND(l_extendedprice * l_tax * 100) AS BIGINT) ELSE 0 END)
      AS BIGINT) AS freight_cents FROM lineitem GROUP BY 1, 2""")
_CENTS = "format('{{:,}}', {0} // 100) || '.' || lpad(CAST({0} % 100 AS VARCHAR), 2, '0')"
register("resp0", ["sm"], f"""SELECT *, supplier_id * 1000000 + year(month) * 100 + month(month) AS response_id,
    'Summary for supplier ' || supplier_id || chr(10) || '## Delivery report' || chr(10) || 'Total shipments: ' || n
    || CASE WHEN supplier_id % 3 <> 0 THEN chr(10) || 'Late shipments: ' || late_n ELSE '' END
    || chr(10) || 'On-time delivery rate: ' || (((n - late_n) * 1000 // n) // 10) || '.'
    || (((n - late_n) * 1000 // n) % 10) || ' %' AS draft,
    '[{{"category": "IMMEDIATE", "domain": "supplier", "title": "Ship ' || n || ' lines", "priority": '
    || (supplier_id % 9 + 1) || '}}, {{"title": "Audit", "description": "Units ' || units || '"}}]' AS actions
    , 'SELECT region, COUNT(*) AS shipments FROM shipments WHERE region = EUROPE AND ship_date >= DATE '
    || CAST(month AS VARCHAR) AS statement FROM sm""".replace("{{", "{").replace("}}", "}"))
register("resp", ["resp0"], f"""SELECT response_id, supplier_id, month, n, late_n, cents, freight_cents, units, draft,
    draft || chr(10) || '## Revenue' || chr(10) || 'August revenue: $' || {_CENTS.format('cents')}
    || chr(10) || 'Wasted freight: $' || {_CENTS.format('freight_cents')}
    || chr(10) || '1. **Expedite orders**' || chr(10) || 'Call the vendor.' || chr(10) || '2. **Review stock**'
    || chr(10) || 'Count units: ' || format('{{:,}}', units) || chr(10) || chr(10) || '| metric | value |' || chr(10)
    || '|---|---|' || chr(10) || '| shipments | ' || n || ' |' || chr(10) || '| units | ' || units || ' |' || chr(10)
    || chr(10) || CASE WHEN supplier_id % 7 = 3 THEN statement || chr(10) || chr(10)
      ELSE '```sql' || chr(10) || statement || chr(10) || '```' || chr(10)
        || CASE WHEN supplier_id % 4 = 1 THEN '```sql' || chr(10) || 'SELECT COUNT(*) AS total FROM orders' || chr(10)
             || '```' || chr(10) ELSE '' END END || 'Done' AS text,
    '||supplier | month |' || CASE WHEN late_n > 0 THEN ' late |' ELSE ' |' END || '|' || chr(10) || '|1|2|'
      AS tool_text,
    CASE WHEN supplier_id % 5 = 0 THEN '{{"actions": ' || actions || '}}' ELSE actions END AS actions_json,
    CASE supplier_id % 4
      WHEN 0 THEN late_n || ' of the **' || n || '** metrics were EXACT, ' || LEAST(n, supplier_id % 5)
        || ' metrics were CLOSE, no MISS'
      WHEN 2 THEN late_n || ' of the **' || n || '** metrics were EXACT, 1 metrics were MISS and 2 as NOT_FOUND'
      WHEN 3 THEN 'no CLOSE, 2 MISS, 1 NOT_FOUND'
      ELSE 'Revenue: EXACT' || chr(10) || 'Freight: NOT_FOUND' || chr(10) || 'Units: EXACT' || chr(10) || 'Rate: n/a'
      END AS narration FROM resp0""".replace("{{", "{").replace("}}", "}"))
register("blocks", ["resp"], r"""SELECT response_id, supplier_id, CASE WHEN len(fenced) > 0 THEN fenced ELSE bare END AS b
    FROM (SELECT *, regexp_extract_all(text, '(?s)```sql\s*\n(.*?)\n\s*```', 1) AS fenced,
      list_transform(regexp_extract_all(text, '(?i)(SELECT\s+[\s\S]{10,}?FROM\s+\S+[\s\S]*?)(?:\n\n|\z)', 1),
        lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')) AS bare FROM resp)""")
_NUMS = r"""list_filter(list_transform(regexp_extract_all({0}, '-?[\d,]+\.?\d*'),
    lambda x: TRY_CAST(replace(x, ',', '') AS DOUBLE)), lambda x: x IS NOT NULL)"""


def _truths(text: str) -> str:
    return f"""SELECT response_id, e.id AS id, e.expected AS expected, {_NUMS.format(text)} AS nums FROM (SELECT *, UNNEST([
    {{'id': 'A01', 'expected': CAST(n AS DOUBLE)}}, {{'id': 'A02', 'expected': CAST(late_n AS DOUBLE)}},
    {{'id': 'B01', 'expected': cents / 100.0}}, {{'id': 'B02', 'expected': ROUND(freight_cents * CAST(1.05 AS DOUBLE)) / 100.0}},
    {{'id': 'E01', 'expected': ROUND(cents * CAST(1.2 AS DOUBLE)) / 100.0}}, {{'id': 'F01', 'expected': CAST(0 AS DOUBLE)}}]) AS e
    FROM resp)"""


def _scored(source: str, pairs: str) -> tuple[list[str], str]:
    """Position of the first exact number, the numbers read up to it, and the nearest of those."""
    return (
        [source],
        f"""SELECT *, list_min(list_transform(seen, lambda x: ABS(ROUND(ABS(x), 2) - target))) AS best_diff,
        list_extract(seen, list_position(list_transform(seen, lambda x: ABS(ROUND(ABS(x), 2) - target)),
          list_min(list_transform(seen, lambda x: ABS(ROUND(ABS(x), 2) - target))))) AS nearest
        FROM (SELECT *, CASE WHEN hit > 0 THEN list_slice(nums, 1, hit - 1) ELSE nums END AS seen,
          CASE WHEN hit > 0 THEN list_extract(nums, hit) END AS found
          FROM (SELECT *, ROUND(ABS(expected), 2) AS target,
            COALESCE(list_position(list_transform(nums, lambda x: ROUND(ABS(x), 2)), ROUND(ABS(expected), 2)), 0) AS hit
            FROM ({pairs})))""",
    )


register("scored", *_scored("resp", _truths("text")))
register("scored_draft", *_scored("resp", _truths("draft")))
_BANDS = """CASE WHEN hit > 0 THEN 'EXACT' WHEN target > 0 AND ABS(ROUND(ABS(nearest), 2) - target) / target < 0.10
    THEN 'CLOSE' WHEN target > 0 AND ABS(ROUND(ABS(nearest), 2) - target) / target < 0.30 THEN 'MISS'
    ELSE 'NOT_FOUND' END"""
_COVER = """CASE WHEN hit > 0 THEN 'FOUND' WHEN ABS(expected) > 0
    AND ABS(ABS(nearest) - ABS(expected)) / ABS(expected) < 0.05 THEN 'CLOSE' ELSE 'NOT_FOUND' END"""
register("bands", ["scored"], f"SELECT *, {_BANDS} AS status FROM scored")
register("covered", ["scored"], f"SELECT response_id, id, {_COVER} AS status FROM scored")
register("covered_draft", ["scored_draft"], f"SELECT response_id, id, {_COVER} AS status FROM scored_draft")


# conversations ----------------------------------------------------------------


@query("assistant_text", """SELECT conv_id, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position, turn, text
    FROM conversations WHERE role = 'assistant'""")
def _(t):
    return O.assistant_text(t.table("conversations"))


@query("text_after_exclusion", """SELECT conv_id, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position,
    turn, text FROM (SELECT *, role = 'system' OR (role = 'assistant' AND contains(text, 'question')) AS marks,
      LAG(role = 'system' OR (role = 'assistant' AND contains(text, 'question')))
        OVER (PARTITION BY conv_id ORDER BY turn) AS after
      FROM conversations WHERE role <> 'user')
    WHERE role = 'assistant' AND NOT marks AND NOT COALESCE(after, false)""")
def _(t):
    return O.text_after_exclusion(t.table("conversations"), ["system"], ["question"])


@query("role_call_counts", "SELECT conv_id, role, COUNT(*) AS calls FROM conversations GROUP BY 1, 2")
def _(t):
    return O.role_call_counts(t.table("conversations"))


@query("question_ids", "SELECT conv_id, turn, md5(text) AS question_id FROM conversations WHERE role = 'user'")
def _(t):
    asked = t.table("conversations").where("role = 'user'")
    return asked.select("conv_id", "turn", F.md5("text").alias("question_id"))


# documents and responses --------------------------------------------------------


@query("extract_numbers", rf"""SELECT doc_id, CAST(generate_subscripts(nums, 1) - 1 AS BIGINT) AS pos,
    UNNEST(nums) AS number FROM (SELECT doc_id, {_NUMS.format('text')} AS nums FROM documents)""")
def _(t):
    return O.extract_numbers(t.table("documents"), ["doc_id"], "text")


@query("extract_fenced_blocks", with_tables("blocks", """SELECT response_id,
    CAST(generate_subscripts(b, 1) - 1 AS BIGINT) AS pos, UNNEST(b) AS sql_block FROM blocks"""))
def _(t):
    return O.extract_sql(responses(t), ["response_id"], "text")


@query("pipe_header_columns", with_tables("resp", r"""SELECT response_id,
    CAST(generate_subscripts(c, 1) - 1 AS BIGINT) AS pos, UNNEST(c) AS column_name FROM (SELECT response_id,
    list_filter(list_transform(string_split(trim(string_split(tool_text, chr(10))[1], '|'), '|'), lambda x: trim(x)),
      lambda x: x <> '') AS c FROM resp WHERE starts_with(tool_text, '||'))"""))
def _(t):
    return O.header_columns(responses(t), ["response_id"], "tool_text")


DEFAULTS = {"q3_target": 95.0, "fill_rate": 80.7, "late_shipments": -1.0}


def _labels_sql() -> str:
    parts = []
    for name, pattern in X.METRIC_LABELS.items():
        value = f"TRY_CAST(replace(regexp_extract(text, '(?i){pattern}', 1), ',', '') AS DOUBLE)"
        default = DEFAULTS.get(name)
        value = value if default is None else f"COALESCE({value}, CAST({default} AS DOUBLE))"
        parts.append(f"SELECT response_id, '{name}' AS metric, {value} AS value FROM resp")
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE value IS NOT NULL"


@query("labelled_metrics", with_tables("resp", _labels_sql()))
def _(t):
    return O.labelled_metrics(responses(t), ["response_id"], "text", DEFAULTS)


@query("markdown_tables", with_tables("resp", r"""SELECT response_id, table_no, row_no,
    CAST(generate_subscripts(cells, 1) - 1 AS BIGINT) AS cell_no, UNNEST(cells) AS cell
    FROM (SELECT response_id, table_no, CAST(generate_subscripts(rws, 1) - 1 AS BIGINT) AS row_no, UNNEST(rws) AS cells
      FROM (SELECT response_id, table_no, list_filter(list_transform(list_filter(string_split(tab, chr(10)),
          lambda l: trim(l) <> ''), lambda l: list_transform(string_split(trim(trim(l), '|'), '|'), lambda c: trim(c))),
          lambda r: len(list_filter(r, lambda c: c <> '' AND NOT regexp_full_match(c, '[-:]+'))) > 0) AS rws
        FROM (SELECT response_id, CAST(generate_subscripts(tabs, 1) - 1 AS BIGINT) AS table_no, UNNEST(tabs) AS tab
          FROM (SELECT response_id,
            regexp_extract_all(text, '(\|[^\n]+\|\n\|[\s\-:|]+\|\n(?:\|[^\n]+\|\n?)+)', 1) AS tabs FROM resp))))"""))
def _(t):
    return O.markdown_tables(responses(t), ["response_id"], "text")


@query("sections", with_tables("resp", r"""SELECT response_id, section, arg_max(body, pos) AS body FROM (
    SELECT response_id, pos, regexp_replace(part, '^\s+|\s+$', '', 'g') AS body,
      CASE WHEN regexp_matches(string_split(part, chr(10))[1], '^(?:#{1,3}\s*|\d+\.\s*\*\*)(.*?)(?:\*\*)?$')
        THEN trim(regexp_extract(string_split(part, chr(10))[1], '^(?:#{1,3}\s*|\d+\.\s*\*\*)(.*?)(?:\*\*)?$', 1))
        ELSE 'section_' || pos END AS section
    FROM (SELECT response_id, generate_subscripts(p, 1) - 1 AS pos, UNNEST(p) AS part FROM (SELECT response_id,
      string_split(regexp_replace(text, '\n((?:#{1,3}\s|\d+\.\s*\*\*))', chr(1) || '\1', 'g'), chr(1)) AS p FROM resp)))
    GROUP BY 1, 2"""))
def _(t):
    return O.sections(responses(t), ["response_id"], "text")


@query("status_word_counts", with_tables("resp", """SELECT response_id,
    len(regexp_extract_all(narration, 'EXACT')) AS exact_count, len(regexp_extract_all(narration, 'CLOSE')) AS close_count,
    len(regexp_extract_all(narration, 'MISS')) AS miss_count,
    len(regexp_extract_all(lower(narration), 'n/a')) AS na_count FROM resp"""))
def _(t):
    return O.status_word_counts(responses(t), ["response_id"], "narration")


def _said(word: str) -> str:
    """A stated count that is not above the total; "no X" means zero."""
    count = rf"TRY_CAST(regexp_extract(t, '(\d+)\s+(?:(?:metrics?\s+)?(?:were|as)\s+)?{word}', 1) AS BIGINT)"
    return f"CASE WHEN NOT regexp_matches(t, '\\bno\\s+{word}') AND {count} <= n THEN {count} ELSE 0 END"


@query("parse_counts", with_tables("resp", rf"""SELECT response_id,
    CASE WHEN e + c + m + f0 = 0 THEN le ELSE e END AS exact, c AS close, m AS miss,
    CASE WHEN e + c + m + f0 = 0 THEN CASE WHEN le + lf = 0 THEN n ELSE lf END ELSE f0 END AS not_found
    FROM (SELECT *, CASE WHEN e > 0 AND c + m + f = 0 THEN GREATEST(0, n - e) ELSE f END AS f0 FROM (SELECT response_id, n,
      COALESCE(TRY_CAST(regexp_extract(t, '(\d+)\s+(?:of|out of)\s+(?:the\s+)?(\d+)\b.*?EXACT', 1) AS BIGINT), 0) AS e,
      {_said('CLOSE')} AS c, {_said('MISS')} AS m, {_said('NOT_FOUND')} AS f,
      len(regexp_extract_all(t, ':\s*EXACT\b')) AS le, len(regexp_extract_all(t, ':\s*NOT_FOUND\b')) AS lf
      FROM (SELECT *, replace(narration, '**', '') AS t FROM resp)))"""))
def _(t):
    return O.parse_counts(responses(t), ["response_id"], "narration", "total_metrics")


@query("requote_sql", with_tables("blocks", r"""SELECT response_id, pos,
    regexp_replace(regexp_replace(x, '=\s*(ASIA|EUROPE)\b', '= ''\1''', 'g'),
      'DATE\s+(\d{4}-\d{2}-\d{2})', 'DATE ''\1''', 'g') AS sql_block FROM (SELECT response_id,
      CAST(generate_subscripts(b, 1) - 1 AS BIGINT) AS pos, UNNEST(b) AS x FROM blocks)"""))
def _(t):
    return O.requote_sql(responses(t), ["response_id"], "text", ["ASIA", "EUROPE"], r"\d{4}-\d{2}-\d{2}")


@query("best_keyword_block", with_tables("blocks", r"""SELECT response_id, hits, x AS sql_block FROM (SELECT response_id, pos, x,
    len(list_filter(string_split(CASE WHEN supplier_id % 2 = 0 THEN 'late shipments by region' ELSE 'total orders' END, ' '),
      lambda w: len(w) > 3 AND contains(lower(x), w))) AS hits
    FROM (SELECT response_id, supplier_id, generate_subscripts(b, 1) AS pos, UNNEST(b) AS x FROM blocks))
    WHERE hits >= 2 QUALIFY ROW_NUMBER() OVER (PARTITION BY response_id ORDER BY hits DESC, pos) = 1"""))
def _(t):
    metric = F.when(F.pmod("supplier_id", F.lit(2)) == 0, "Late shipments by region").otherwise("Total orders")
    return O.best_keyword_block(responses(t), ["response_id"], "text", metric)


@query("parse_action_json", with_tables("resp", """SELECT response_id || '_action_' || lpad(CAST(i + 1 AS VARCHAR), 2, '0')
    AS action_id, response_id AS run_id, COALESCE(a->>'category', 'UNKNOWN') AS category,
    COALESCE(a->>'timeframe', 'Unknown') AS timeframe, COALESCE(a->>'domain', 'general') AS domain,
    COALESCE(a->>'title', 'Action ' || (i + 1)) AS title, COALESCE(a->>'description', '') AS description,
    COALESCE(a->>'specific_steps', '') AS specific_steps, COALESCE(a->>'expected_impact', '') AS expected_impact,
    COALESCE(CAST(a->>'priority' AS BIGINT), i + 1) AS priority, 'PENDING' AS status,
    CAST(month AS TIMESTAMP) AS created_at, CAST(month AS TIMESTAMP) AS updated_at
    FROM (SELECT response_id, month, generate_subscripts(js, 1) - 1 AS i, UNNEST(js) AS a FROM (SELECT response_id, month,
      CAST(CASE WHEN starts_with(actions_json, '{') THEN json_extract(actions_json, '$.actions') ELSE actions_json END
        AS JSON[]) AS js FROM resp))"""))
def _(t):
    return O.parse_action_json(responses(t), "response_id", "actions_json", F.col("month").cast("timestamp"))


# terms --------------------------------------------------------------------------------

# Spoken synonyms of stored columns, by table.
COLUMN_SYNONYMS = {
    "sales_orders": {
        "channel": ["sales channel", "order channel"],
        "order_date": ["date", "when ordered", "order time"],
        "order_status": ["status", "fulfillment status"],
        "product_family": ["family", "product line", "product group"],
        "region": ["geography", "area", "market"],
        "total_amount": ["revenue", "sales", "order value", "amount", "dollars"],
    },
    "demand_forecasts": {
        "bias": ["forecast bias", "over-forecast", "under-forecast"],
        "forecast_accuracy_pct": ["accuracy", "forecast accuracy"],
        "forecast_demand_units": ["forecast", "predicted demand"],
        "forecast_month": ["month", "period"],
    },
    "pos_data": {
        "quantity_sold": ["units sold", "volume"],
        "return_flag": ["returned", "return", "refund"],
        "total_sales": ["revenue", "sales amount", "pos revenue"],
        "transaction_date": ["date", "sale date"],
    },
    "inventory_ledger": {
        "below_safety_stock_flag": ["below safety stock", "low stock", "at risk"],
        "days_of_supply": ["days remaining", "supply days", "runway"],
        "on_hand_qty": ["on hand", "inventory level", "stock level", "quantity"],
        "product_family": ["family", "product line"],
        "region": ["geography", "area"],
        "safety_stock_level": ["safety stock", "minimum stock"],
        "stockout_flag": ["stockout", "out of stock", "zero inventory"],
    },
    "stock_movements": {
        "movement_date": ["date", "when"],
        "movement_type": ["type", "direction"],
        "quantity": ["units", "volume", "amount"],
        "region": ["geography"],
    },
    "shipments": {
        "carrier_id": ["carrier", "shipping company"],
        "delay_days": ["days delayed", "days late"],
        "delay_reason": ["cause of delay", "root cause"],
        "destination_region": ["region", "delivery region", "target region"],
        "is_late": ["late", "delayed", "overdue", "on-time", "on time delivery", "OTD"],
        "origin_region": ["source region", "ship from region"],
        "ship_date": ["shipment date", "date shipped"],
        "shipping_cost": ["freight cost", "logistics spend", "freight", "transport cost"],
    },
    "supplier_orders": {
        "actual_lead_time_days": ["actual lead time", "delivery time"],
        "contracted_lead_time_days": ["contracted lead time", "expected lead time"],
        "delay_reason": ["cause", "root cause"],
        "is_late": ["late", "delayed", "overdue"],
        "lead_time_variance_days": ["variance", "delay days", "slippage"],
        "quality_score": ["quality", "quality rating"],
        "quantity_received": ["received", "delivered qty"],
        "supplier_continent": ["continent", "geography", "source region"],
    },
    "vendor_slas": {
        "is_breached": ["breached", "violated", "failed"],
        "penalty_amount": ["penalty", "fine", "SLA penalty", "vendor penalty"],
        "sla_metric": ["metric", "kpi", "measure"],
        "supplier_id": ["vendor id", "vendor"],
        "supplier_name": ["vendor name", "vendor"],
    },
    "executive_kpis": {
        "late_delivery_pct_last_month": ["late delivery rate", "delivery delay rate"],
        "service_level_pct": ["fill rate", "fill_rate", "order fill rate", "service level"],
        "supplier_late_pct_last_month": ["vendor late rate", "supplier delay rate"],
    },
}
COLUMN_TERMS = [
    (phrase.lower(), table, column)
    for table, columns in COLUMN_SYNONYMS.items()
    for column, phrases in columns.items()
    for phrase in phrases
]


def values_sql(rows: list[tuple[str, ...]]) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)


@query("term_matches", f"""SELECT doc_id, phrase, table_name, column_name FROM documents
    JOIN ({values_sql(COLUMN_TERMS)}) s(phrase, table_name, column_name) ON contains(lower(text), phrase)""")
def _(t):
    texts = t.table("documents").select("doc_id", "text")
    return match_terms(texts, "text", COLUMN_TERMS, ["phrase", "table_name", "column_name"]).drop("text")


def asked(t):
    """A spoken question per customer, picking a phrase by customer number."""
    phrases = F.array(*[F.lit(p) for p in ASKED])
    return t.customers().select(
        F.col("customer_id").alias("question_id"),
        F.concat(
            F.lit("What is the "),
            F.element_at(phrases, (F.pmod("customer_id", F.lit(len(ASKED))) + 1).cast("int")),
            F.lit(" for "),
            F.lower("region"),
            F.lit("?"),
        ).alias("question"),
    )


ASKED = ["OTD rate", "wasted freight", "MoM change", "vendor late rate", "lead time variance", "weather"]
VIEW_TERMS = [
    (phrase.lower(), view, name)
    for view, synonyms in (
        ("delivery_performance_by_region", V.DELIVERY_SYNONYMS),
        ("revenue_comparison_by_region", V.REVENUE_SYNONYMS),
        ("inventory_safety_stock_metrics", V.INVENTORY_SYNONYMS),
        ("supplier_performance_by_continent", V.SUPPLIER_SYNONYMS),
    )
    for name, phrases in synonyms.items()
    for phrase in phrases
]


@query("measure_lookup", with_tables("cust", f"""SELECT c_custkey AS question_id, phrase, view_name, measure
    FROM (SELECT c_custkey, 'what is the ' || lower(list_extract({ASKED!r}, CAST(c_custkey % {len(ASKED)} + 1 AS INTEGER)))
      || ' for ' || lower(region) || '?' AS question FROM cust)
    JOIN ({values_sql(VIEW_TERMS)}) s(phrase, view_name, measure) ON contains(question, phrase)"""))
def _(t):
    names = ["phrase", "view_name", "measure"]
    return match_terms(asked(t), "question", VIEW_TERMS, names).drop("question")


# scoring --------------------------------------------------------------------------------


def banded(t):
    return S.score_bands(expected_pairs(responses(t)))


@query("find_value", with_tables("scored", """SELECT response_id, id, expected, hit > 0 AS is_match, found,
    COALESCE(found, nearest) AS closest, best_diff FROM scored"""))
def _(t):
    return S.find_value(expected_pairs(responses(t))).drop("nearest")


@query("score_bands", with_tables("bands", """SELECT response_id, id, expected, status,
    ROUND(CASE WHEN hit > 0 THEN found WHEN status IN ('CLOSE', 'MISS') THEN nearest END, 2) AS found_value,
    CASE WHEN nearest <> 0 THEN ROUND(best_diff / GREATEST(target, 0.001) * 100, 1) END AS pct_diff FROM bands"""))
def _(t):
    return banded(t)


@query("score_coverage", with_tables("covered", "SELECT response_id, id, status FROM covered"))
def _(t):
    return S.score_coverage(expected_pairs(responses(t))).select("response_id", "id", "status")


register("doc_scored", [], _scored("", f"""SELECT doc_id, id, expected, {_NUMS.format('text')} AS nums
    FROM documents JOIN (SELECT lang, 'docs' AS id, CAST(COUNT(*) AS DOUBLE) AS expected FROM documents GROUP BY lang
      UNION ALL SELECT lang, 'shortest', CAST(MIN(n_chars) AS DOUBLE) FROM documents GROUP BY lang) e
    ON documents.lang = e.lang""")[1])


@query("score_documents", with_tables("doc_scored", f"SELECT doc_id, id, expected, {_BANDS} AS status FROM doc_scored"))
def _(t):
    """Every text against the values expected of its language."""
    docs = t.table("documents")
    per_lang = docs.groupBy("lang").agg(
        F.count("*").cast("double").alias("docs"), F.min("n_chars").cast("double").alias("shortest")
    )
    truth = per_lang.unpivot("lang", ["docs", "shortest"], "id", "expected")
    texts = S.with_numbers(docs.select("doc_id", "lang", "text"))
    return S.score_bands(S.with_expected(texts, truth, ["lang"])).select("doc_id", "id", "expected", "status")


@query("scorecard_summary", with_tables("bands", """SELECT response_id, COUNT(CASE WHEN status = 'EXACT' THEN 1 END) AS exact,
    COUNT(CASE WHEN status = 'CLOSE' THEN 1 END) AS close, COUNT(CASE WHEN status = 'MISS' THEN 1 END) AS miss,
    COUNT(CASE WHEN status = 'NOT_FOUND' THEN 1 END) AS not_found, COUNT(*) AS total,
    CAST(round_even(COUNT(CASE WHEN status = 'EXACT' THEN 1 END) * 100.0 / COUNT(*), 0) AS BIGINT) AS pct_exact
    FROM bands GROUP BY 1"""))
def _(t):
    return S.scorecard_summary(banded(t), ["response_id"])


def runs(t):
    """The same expectations scored against the draft and against the whole response."""
    cover = lambda text: S.score_coverage(expected_pairs(responses(t), text)).select("response_id", "id", "status")
    return cover("draft"), cover("text")


@query("run_consistency", with_tables("covered covered_draft", """SELECT response_id, id,
    CASE WHEN d.status = 'FOUND' AND c.status = 'FOUND' THEN 'consistent' WHEN c.status = 'FOUND' THEN 'newly_found'
         WHEN d.status = 'FOUND' THEN 'regressed' ELSE 'missing' END AS outcome
    FROM covered_draft d FULL JOIN covered c USING (response_id, id)"""))
def _(t):
    return S.run_consistency(*runs(t), ["response_id", "id"])


@query("coverage_by_group", with_tables("covered covered_draft", """SELECT substr(c.id, 1, 1) AS metric_group,
    COUNT(CASE WHEN d.status = 'FOUND' THEN 1 END) AS hits_before,
    COUNT(CASE WHEN c.status = 'FOUND' THEN 1 END) AS hits_after, COUNT(*) AS total,
    COUNT(CASE WHEN c.status = 'FOUND' THEN 1 END) - COUNT(CASE WHEN d.status = 'FOUND' THEN 1 END) AS delta
    FROM covered c JOIN covered_draft d ON c.response_id = d.response_id AND c.id = d.id GROUP BY 1"""))
def _(t):
    return S.coverage_by_group(*runs(t), ["response_id", "id"])


@query("stage_progression", with_tables("bands", """, s AS (SELECT response_id % 1000000 // 100 AS stage,
      COUNT(CASE WHEN status = 'EXACT' THEN 1 END) AS passed, COUNT(*) AS total FROM bands GROUP BY 1)
    SELECT stage, CAST(SUM(passed) OVER (ORDER BY stage) AS BIGINT) AS passed_so_far, passed AS newly_passed,
      passed - COALESCE(LAG(passed) OVER (ORDER BY stage), 0) AS gain,
      CAST(floor(SUM(passed) OVER (ORDER BY stage) * 100 / SUM(total) OVER ()) AS BIGINT) AS pct FROM s"""))
def _(t):
    year = F.floor(F.pmod("response_id", F.lit(1000000)) / 100).cast("bigint")
    stages = banded(t).groupBy(year.alias("stage")).agg(
        F.count(F.when(F.col("status") == "EXACT", 1)).alias("passed"), F.count("*").alias("total")
    )
    return S.stage_progression(stages)


@query("failing_ids", with_tables("bands", "SELECT response_id, id, expected FROM bands WHERE status <> 'EXACT'"))
def _(t):
    pairs = expected_pairs(responses(t))
    return S.failing_subset(pairs, S.score_bands(pairs), ["response_id", "id"]).drop("_nums", "_abs")


@query("values_match", with_tables("bands", """SELECT response_id, id,
    COALESCE(ABS(nearest - expected) / GREATEST(ABS(expected), 0.001) < 0.01, false) AS matches FROM bands"""))
def _(t):
    found = S.find_value(expected_pairs(responses(t)))
    return found.select(
        "response_id", "id", S.values_match(F.col("nearest"), F.col("expected")).alias("matches")
    )


@query("verify_views", with_tables("sales ship", f"""SELECT keyword, metric, actual, expected,
    CASE WHEN ABS(actual - expected) / GREATEST(ABS(expected), 0.001) < 0.01 THEN 'EXACT' ELSE 'MISS' END AS status
    FROM (SELECT 'asia revenue' AS keyword, 'ASIA revenue' AS metric,
        (SELECT ROUND(SUM(amount_cents) / 100.0, 2) FROM sales WHERE region = 'ASIA' AND {LAST.format('order_date')}) AS actual,
        (SELECT ROUND(SUM(amount_cents) / 100.0, 2) FROM sales WHERE region = 'ASIA' AND {LAST.format('order_date')}) AS expected
      UNION ALL SELECT 'late delivery', 'ASIA late delivery rate',
        (SELECT ROUND(AVG(CASE WHEN is_late THEN 0.0 ELSE 1.0 END) * 100, 2) FROM ship
          WHERE destination_region = 'ASIA' AND {LAST.format('ship_date')}),
        (SELECT ROUND(AVG(CASE WHEN is_late THEN 1.0 ELSE 0.0 END) * 100, 2) FROM ship
          WHERE destination_region = 'ASIA' AND {LAST.format('ship_date')}))"""))
def _(t):
    """Two view values checked against certified values; the second one is wrong on purpose."""
    revenue = V.revenue_comparison(t.sales_orders(), t.anchor).query(["region"], ["revenue_last_month"])
    delivery = V.delivery_performance(t.shipments(), t.anchor).query(["region"])
    here = lambda df: df.where(F.col("region") == "ASIA")
    named = lambda df, col, keyword: df.select(F.lit(keyword).alias("keyword"), F.col(col).alias("actual"))
    checks = stack(
        [
            named(here(revenue), "revenue_last_month", "asia revenue"),
            named(here(delivery), "on_time_delivery_rate", "late delivery"),
        ]
    )
    certified = here(Q.month_over_month(t.sales_orders(), t.anchor, "region"))
    truth = stack(
        [
            metric_rows(certified, [("demand", "ASIA revenue", F.col("revenue_last_month"))], "agent"),
            metric_rows(here(delivery), [("logistics", "ASIA late delivery rate", F.col("late_delivery_rate"))], "agent"),
        ]
    )
    return S.verify_views(checks, truth, ["ASIA revenue", "ASIA late delivery rate"])
