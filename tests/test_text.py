"""Text and scoring operators on literal strings, against plain Python."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from supplylens.functions import textual as X
from supplylens.operators import scoring as S
from supplylens.operators import textops as O
from supplylens.operators.metric_view import match_terms


def one(spark, text):
    return spark.createDataFrame([(1, text)], "id long, text string")


def python_numbers(text):
    out = []
    for token in re.findall(r"-?[0-9,]+\.?[0-9]*", text):
        try:
            out.append(float(token.replace(",", "")))
        except ValueError:
            pass
    return out


def test_numbers_on_odd_tokens(spark):
    text = "Total 1,234.50, change -27.07 % , and 5. then -, ,, 7-8 no more"
    got = [r["number"] for r in O.extract_numbers(one(spark, text), ["id"], "text").collect()]
    assert got == python_numbers(text) == [1234.5, -27.07, 5.0, 7.0, -8.0]
    assert O.extract_numbers(one(spark, "no digits, none"), ["id"], "text").count() == 0


def python_score(text, expected):
    target, best, closest = round(abs(expected), 2), None, None
    for n in python_numbers(text):
        if round(abs(n), 2) == target:
            return "EXACT", n
        d = abs(round(abs(n), 2) - target)
        if best is None or d < best:
            best, closest = d, n
    if closest is not None and target > 0:
        off = abs(round(abs(closest), 2) - target) / target
        if off < 0.10:
            return "CLOSE", closest
        if off < 0.30:
            return "MISS", closest
    return "NOT_FOUND", None


WORDS = st.sampled_from(["12", "-27.07", "1,234.50", "100", "110", "125.5", ",", "-", "word", "0", "27.07", "1,000"])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.lists(WORDS, max_size=8).map(" ".join), st.sampled_from([0.0, 27.07, 100.0, 1234.5, -110.0, 3.5])),
        min_size=1,
        max_size=30,
    )
)
def test_score_bands_like_python(spark, pairs):
    df = spark.createDataFrame([(i, t, e) for i, (t, e) in enumerate(pairs)], "k long, text string, expected double")
    got = {r["k"]: (r["status"], r["found_value"]) for r in S.score_bands(S.with_numbers(df)).collect()}
    for i, (text, expected) in enumerate(pairs):
        status, value = python_score(text, expected)
        assert got[i] == (status, None if value is None else round(value, 2)), (text, expected)


def test_expected_zero_is_exact_or_not_found(spark):
    df = spark.createDataFrame([(1, "0.001 off", 0.0), (2, "about 3", 0.0)], "k long, text string, expected double")
    got = {r["k"]: r["status"] for r in S.score_bands(S.with_numbers(df)).collect()}
    assert got == {1: "EXACT", 2: "NOT_FOUND"}


def test_coverage_status_is_compared_exactly(spark):
    df = spark.createDataFrame([(1, "96", 100.0), (2, "100", 100.0), (3, "", 100.0)], "k long, text string, expected double")
    got = {r["k"]: r["status"] for r in S.score_coverage(S.with_numbers(df)).collect()}
    assert got == {1: "CLOSE", 2: "FOUND", 3: "NOT_FOUND"}


def test_reference_list_is_searched_in_every_text(spark):
    texts = spark.createDataFrame([(1, "g", "5 and 7"), (2, "g", "none"), (3, "h", "5")], "k long, q string, text string")
    truth = spark.createDataFrame([("g", "a", 5.0), ("g", "b", 8.0)], "q string, id string, expected double")
    got = S.score_bands(S.with_expected(S.with_numbers(texts), truth, ["q"])).collect()
    assert {(r["k"], r["id"]): r["status"] for r in got} == {
        (1, "a"): "EXACT", (1, "b"): "MISS", (2, "a"): "NOT_FOUND", (2, "b"): "NOT_FOUND",
    }


def test_labelled_metrics(spark):
    text = (
        "In August the total revenue: $3,341,062.58\nOn-time delivery rate: 5.43%\nAVG delay: 2.94 days\n"
        "Late shipments: 1,027\nSLA penalties: $1,185,043.10\nfill rate: . %"
    )
    got = {r["metric"]: r["value"] for r in O.labelled_metrics(one(spark, text), ["id"], "text", {"q3_target": 95.0}).collect()}
    assert got["revenue_aug"] == 3341062.58 and got["otd_rate"] == 5.43 and got["avg_delay_days"] == 2.94
    assert got["late_shipments"] == 1027.0 and got["sla_penalties"] == 1185043.10 and got["q3_target"] == 95.0
    assert "fill_rate" not in got and "cost_of_disruption" not in got


LABELLED = {
    "revenue_aug": ["AUGUST total: 7", "aug revenue $7"],
    "revenue_jul": ["July revenue: 7", "JUL saw a total 7"],
    "revenue_change_pct": ["Change: 7%", "DECLINE -7 %", "drop 7%", "decrease: 7%"],
    "revenue_change_dollars": ["change: $7", "decline 7", "DROP: 7", "Decrease $7"],
    "otd_rate": ["On-Time rate 7%", "on time delivery rate: 7 %"],
    "late_delivery_rate": ["LATE delivery rate 7%", "latedeliveryrate:7%"],
    "avg_delay_days": ["Average DELAY: 7 days", "avg delay 7 day"],
    "total_shipments": ["Total SHIPMENTS: 7"],
    "late_shipments": ["LATE shipments 7"],
    "wasted_freight": ["WASTED freight: $7"],
    "positions_below_ss": ["Position below SAFETY stock: 7"],
    "stockout_skus": ["unique SKUs in STOCKOUT 7", "SKU stockout: 7"],
    "days_of_supply": ["Avg day of SUPPLY: 7", "average days of supply 7"],
    "total_pos": ["TOTAL POs: 7", "total purchase orders 7"],
    "late_pos": ["LATE PO: 7", "late purchase orders 7"],
    "po_late_pct": ["PO share LATE 7%", "vendor was late by 7 %"],
    "asia_late_rate": ["ASIA came late, 7%"],
    "fill_rate": ["FILL rate: 7%"],
    "sla_penalties": ["SLA penalty: $7", "sla PENALTIES 7"],
    "cost_of_disruption": ["COST OF DISRUPTION: $7"],
    "q3_target": ["q3 service-level target 7%", "Q3 TARGET: 7 %"],
}


def test_every_wording_of_a_label_is_found(spark):
    said = [(f"{name}/{i}", name, text) for name, texts in LABELLED.items() for i, text in enumerate(texts)]
    found = O.labelled_metrics(spark.createDataFrame(said, "id string, name string, text string"), ["id", "name"], "text")
    got = {r["id"] for r in found.where("metric = name and abs(value) = 7").collect()}
    assert set(LABELLED) == set(X.METRIC_LABELS)
    assert got == {i for i, _, _ in said}


def test_sections_keep_the_last_body_of_a_repeated_title(spark):
    text = "intro\n## Alpha\none\n1. **Beta**\ntwo\n## Alpha\nthree \n#### not a heading"
    got = {r["section"]: r["body"] for r in O.sections(one(spark, text), ["id"], "text").collect()}
    assert got == {
        "section_0": "intro",
        "Alpha": "## Alpha\nthree \n#### not a heading",
        "Beta": "1. **Beta**\ntwo",
    }


def test_markdown_tables_drop_rules(spark):
    text = "x\n| a | b |\n|---|:-:|\n| 1 | |\n| 2 | z |\n\n| lone | line |\nend"
    got = [(r["table_no"], r["row_no"], r["cell_no"], r["cell"]) for r in O.markdown_tables(one(spark, text), ["id"], "text").collect()]
    assert got == [
        (0, 0, 0, "a"), (0, 0, 1, "b"), (0, 1, 0, "1"), (0, 1, 1, ""), (0, 2, 0, "2"), (0, 2, 1, "z"),
    ]


def test_sql_blocks_and_fallback(spark):
    fenced = "```sql\nSELECT 1\n```\ntext ```sql\n\nSELECT 2\n ``` ```sql\nSELECT 3\n``` ```sql\nSELECT 4\n```"
    got = [r["sql_block"] for r in O.extract_sql(one(spark, fenced), ["id"], "text").collect()]
    assert got == ["SELECT 1", "SELECT 2", "SELECT 3", "SELECT 4"]
    five = "".join(f"```sql\nSELECT {i}\n```\n" for i in range(5))
    assert O.extract_sql(one(spark, five), ["id"], "text").count() == 5
    bare = "use select region, count(*) FROM sales_orders\nGROUP BY region\n\nthen SELECT a FROM b"
    got = [r["sql_block"] for r in O.extract_sql(one(spark, bare), ["id"], "text").collect()]
    assert got == ["select region, count(*) FROM sales_orders\nGROUP BY region"]
    short = "\n\n".join(f"SELECT {i} AS column_{i} FROM t" for i in range(4))
    assert O.extract_sql(one(spark, short), ["id"], "text").count() == 4


def test_header_columns(spark):
    got = [r["column_name"] for r in O.header_columns(one(spark, "|| region | late || n |\n|1|"), ["id"], "text").collect()]
    assert got == ["region", "late", "n"]
    assert O.header_columns(one(spark, "| region |"), ["id"], "text").count() == 0


@pytest.mark.parametrize(
    ("text", "total", "counts"),
    [
        ("5 of the 9 metrics EXACT, 2 metrics were CLOSE, 1 MISS, 1 NOT_FOUND", 9, (5, 2, 1, 1)),
        ("**7** out of **9** were EXACT, no CLOSE", 9, (7, 0, 0, 2)),
        ("a: EXACT\nb: NOT_FOUND\nc: EXACT", 3, (2, 0, 0, 1)),
        ("nothing to read", 4, (0, 0, 0, 4)),
        ("3 of 9 EXACT, 12 CLOSE", 9, (3, 0, 0, 6)),
        ("2 of 9 EXACT, 3 MISS but no MISS, 4 NOT_FOUND", 9, (2, 0, 0, 4)),
    ],
)
def test_narrated_counts(spark, text, total, counts):
    df = one(spark, text).withColumn("total", F.lit(total).cast("bigint"))
    r = O.parse_counts(df, ["id"], "text", "total").collect()[0]
    assert (r["exact"], r["close"], r["miss"], r["not_found"]) == counts


def test_requote(spark):
    sql = "```sql\nSELECT 1 FROM t WHERE region =Western AND d >= DATE 2026-08-01 AND x = 'Eastern'\n```"
    got = O.requote_sql(one(spark, sql), ["id"], "text", ["Western", "Eastern"], r"20\d{2}-\d{2}-\d{2}").collect()
    assert got[0]["sql_block"] == "SELECT 1 FROM t WHERE region = 'Western' AND d >= DATE '2026-08-01' AND x = 'Eastern'"


def test_best_block_is_the_first_of_the_best(spark):
    text = "```sql\nSELECT late FROM x\n``` ```sql\nSELECT late FROM shipments\n``` ```sql\nSELECT late, shipments\n```"
    r = O.best_keyword_block(one(spark, text), ["id"], "text", F.lit("Western late shipments")).collect()[0]
    assert (r["hits"], r["sql_block"]) == (2, "SELECT late FROM shipments")
    assert O.best_keyword_block(one(spark, text), ["id"], "text", F.lit("fill rate")).count() == 0


def test_action_json_shapes(spark):
    rows = [
        ("r1", '[{"title": "A", "priority": 3}, {"category": "STRATEGIC"}]'),
        ("r2", '{"actions": [{"domain": "supplier"}]}'),
        ("r3", '{"title": "solo"}'),
        ("r4", "not json"),
    ]
    got = O.parse_action_json(spark.createDataFrame(rows, "run string, js string"), "run", "js").collect()
    found = {r["action_id"]: (r["title"], r["category"], r["domain"], r["priority"]) for r in got}
    assert found["r1_action_01"] == ("A", "UNKNOWN", "general", 3)
    assert found["r1_action_02"] == ("Action 2", "STRATEGIC", "general", 2)
    assert found["r2_action_01"] == ("Action 1", "UNKNOWN", "supplier", 1)
    assert found["r3_action_01"][0] == "solo"
    assert not any(k.startswith("r4") and v[0] != "Action 1" for k, v in found.items())


def test_exclusion_follows_markers_across_part_borders(spark):
    rows = [
        (1, 0, "user", "q"), (1, 1, "assistant", "a1"), (1, 2, "tool", "call"), (1, 3, "user", "u"),
        (1, 4, "assistant", "hidden"), (1, 5, "assistant", "a2"), (1, 6, "assistant", "<name>evaluator</name>"),
        (1, 7, "assistant", "hidden too"), (1, 8, "assistant", "a3"), (2, 5, "assistant", "other"),
        (3, 998, "tool", "call"), (3, 999, "search", "call"), (3, 1000, "assistant", "kept"), (3, 1001, "assistant", "too"),
    ]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for size in (2, 3, 1000):
        got = O.text_after_exclusion(df, ["tool"], ["<name>evaluator</name>"], size).orderBy("conv_id", "turn").collect()
        said = {}
        for r in got:
            said.setdefault(r["conv_id"], []).append((r["position"], r["text"]))
        numbered = lambda *texts: list(enumerate(texts))
        assert said == {1: numbered("a1", "a2", "a3"), 2: numbered("other"), 3: numbered("kept", "too")}


def test_terms_inside_and_across_others(spark):
    terms = [("late", "x"), ("late rate", "y"), ("rate", "z"), ("late", "w"), ("ate r", "v")]
    got = match_terms(one(spark, "the Late Rates"), "text", terms, ["phrase", "field"]).collect()
    assert {(r["phrase"], r["field"]) for r in got} == set(terms)
    assert match_terms(one(spark, "nothing"), "text", terms, ["phrase", "field"]).count() == 0


def test_values_match_and_runs(spark):
    r = spark.range(1).select(
        S.values_match(F.lit("100.5"), F.lit(100.0)).alias("near"),
        S.values_match(F.lit("102"), F.lit(100.0)).alias("far"),
        S.values_match(F.lit("abc"), F.lit("abc")).alias("text"),
        S.values_match(F.lit(None).cast("string"), F.lit("1")).alias("none"),
    ).collect()[0]
    assert (r["near"], r["far"], r["text"], r["none"]) == (True, False, True, False)
    run = lambda rows: spark.createDataFrame(rows, "id string, status string")
    before = run([("A1", "FOUND"), ("A2", "NOT_FOUND"), ("B1", "FOUND"), ("B2", "CLOSE")])
    after = run([("A1", "FOUND"), ("A2", "FOUND"), ("B1", "NOT_FOUND"), ("B2", "NOT_FOUND")])
    got = {r["id"]: r["outcome"] for r in S.run_consistency(before, after, ["id"]).collect()}
    assert got == {"A1": "consistent", "A2": "newly_found", "B1": "regressed", "B2": "missing"}
    groups = {r["metric_group"]: r["delta"] for r in S.coverage_by_group(before, after, ["id"]).collect()}
    assert groups == {"A": 1, "B": -1}
    stages = spark.createDataFrame([(0, 26, 40), (1, 8, 0), (2, 4, 0)], "stage int, passed long, total long")
    got = [(r["passed_so_far"], r["gain"], r["pct"]) for r in S.stage_progression(stages).orderBy("stage").collect()]
    assert got == [(26, 26, 65), (34, -18, 85), (38, -4, 95)]


def test_verify_views_without_match_is_a_miss(spark):
    checks = spark.createDataFrame([("otd", 5.4), ("nothing", 1.0)], "keyword string, actual double")
    truth = spark.createDataFrame([("Western OTD rate", 5.42)], "metric string, value double")
    got = {r["keyword"]: r["status"] for r in S.verify_views(checks, truth, ["Western OTD rate"]).collect()}
    assert got == {"otd": "EXACT", "nothing": "MISS"}
