"""Action tracking: latest evaluations, changes, decisions and queue views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplylens.functions import calendar as C
from supplylens.functions import measures as M
from supplylens.operators.joins import left_join_filled, skew_safe_join, without_counterpart
from supplylens.operators.windows import latest_and_previous, latest_per_key, value_counts
from supplylens.plans.reports import one_row

NEWEST = ["evaluated_at", "evaluation_id"]


def status_color(recommendation: Column) -> Column:
    return (
        F.when(recommendation == "PROCEED", "green")
        .when(recommendation == "PROCEED_WITH_CAUTION", "orange")
        .when(recommendation == "DEFER", "grey")
        .when(recommendation == "REJECT", "red")
        .otherwise("blue")
    )


def risk_level(score: Column) -> Column:
    """An action that was never evaluated counts as high risk."""
    return F.when(score >= 0.7, "LOW").when(score >= 0.4, "MEDIUM").otherwise("HIGH")


def recommendation_class(recommendation: Column) -> Column:
    """Badge class by substring; caution is tested before proceed."""
    text = F.upper(F.coalesce(recommendation, F.lit("")))
    return (
        F.when(text.contains("CAUTION"), "rec-caution")
        .when(text.contains("PROCEED"), "rec-proceed")
        .when(text.contains("REJECT"), "rec-defer")
        .when(text.contains("DEFER"), "rec-defer")
        .otherwise("rec-pending")
    )


def action_tracker(items: DataFrame, evaluations: DataFrame) -> DataFrame:
    """Every action with its newest evaluation.

    Evaluations shrink to one row per action before the join.
    """
    latest = latest_per_key(evaluations, ["action_id"], NEWEST).drop("evaluation_id")
    return (
        items.join(latest, "action_id", "left")
        .withColumnRenamed("status", "action_status")
        .withColumns(
            {
                "status_color": status_color(F.col("recommendation")),
                "risk_level": risk_level(F.col("practicality_score")),
            }
        )
    )


def eval_history(items: DataFrame, evaluations: DataFrame) -> DataFrame:
    """All evaluations with their action's attributes; a hot action is salted."""
    attributes = items.select("action_id", "title", "domain", "category")
    joined = skew_safe_join(evaluations, attributes, "action_id", "evaluation_id")
    return joined.select(
        "title", "domain", "category", "recommendation", "practicality_score", "evaluated_at", "reasoning", "risks"
    )


def evaluated_actions(items: DataFrame, evaluations: DataFrame) -> DataFrame:
    attributes = items.select("action_id", "title", "domain", "priority")
    joined = skew_safe_join(evaluations, attributes, "action_id", "evaluation_id")
    return joined.select(
        "action_id", "title", "domain", "priority", "recommendation", "practicality_score", "risks", "pros", "cons"
    )


def domain_summary(items: DataFrame, evaluations: DataFrame) -> DataFrame:
    latest = latest_per_key(evaluations, ["action_id"], NEWEST).select(
        "action_id", "recommendation", "practicality_score"
    )
    said = lambda what: M.sum_flag(F.col("recommendation") == what)
    return (
        items.join(latest, "action_id", "left")
        .groupBy("domain", "category")
        .agg(
            F.count("*").alias("action_count"),
            said("PROCEED").alias("proceed_count"),
            said("PROCEED_WITH_CAUTION").alias("caution_count"),
            said("DEFER").alias("defer_count"),
            said("REJECT").alias("reject_count"),
            F.round(F.avg("practicality_score"), 2).alias("avg_practicality"),
        )
    )


def recommendation_changes(items: DataFrame, evaluations: DataFrame) -> DataFrame:
    """Newest against previous evaluation of every action that has two."""
    pairs = latest_and_previous(evaluations, ["action_id"], NEWEST, ["recommendation", "practicality_score"])
    return change_rows(pairs).join(items.select("action_id", "title"), "action_id")


def change_rows(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        "action_id",
        F.col("prev_recommendation").alias("prev_rec"),
        F.col("curr_recommendation").alias("curr_rec"),
        F.round("prev_practicality_score", 2).alias("prev_score"),
        F.round("curr_practicality_score", 2).alias("curr_score"),
        F.when(F.col("prev_recommendation") != F.col("curr_recommendation"), "CHANGED")
        .otherwise("STABLE")
        .alias("status"),
    )


def pending_unevaluated(
    items: DataFrame, evaluations: DataFrame, run_id: str | None = None, again: bool = False
) -> DataFrame:
    """Waiting actions nobody has evaluated; with ``again`` all waiting ones, to be evaluated anew."""
    waiting = C.filter_dimension(items, status="PENDING")
    if run_id:
        waiting = C.filter_dimension(waiting, run_id=run_id)
    if not again:
        waiting = without_counterpart(waiting, evaluations, "action_id")
    return waiting.select(
        "action_id", "category", "domain", "title", "description", "specific_steps", "expected_impact", "priority"
    )


def history_deltas(history: DataFrame) -> DataFrame:
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    return history.select(
        "history_id",
        "action_date",
        "domain",
        "success_rating",
        M.dollars(F.col("cost_cents")).alias("cost_usd"),
        (zero("metric_after") - zero("metric_before")).alias("metric_delta"),
    )


def money_text(cents: Column) -> Column:
    """Currency rounded half to even to whole units, with thousands separators."""
    return F.concat(F.lit("$"), F.format_number(cents / F.lit(100.0), 0))


def history_display(history: DataFrame) -> DataFrame:
    before, after = F.col("metric_before").cast("string"), F.col("metric_after").cast("string")
    return history.select(
        "history_id",
        "action_date",
        "domain",
        "title",
        money_text(F.col("cost_cents")).alias("cost"),
        "success_rating",
        "metric_name",
        F.concat(before, F.lit(" → "), after).alias("metric_change"),
    )


def precedent_lines(history: DataFrame) -> DataFrame:
    """One text line per past action.

    The lines stay rows: gluing a growing history into one string would pull the
    whole table into one task, and a reader who sorts them by date gets the same text.
    """
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    delta = zero("metric_after") - zero("metric_before")
    line = F.concat(
        F.lit("- ["), F.col("success_rating"), F.lit("] "), F.col("title"),
        F.lit(" ("), money_text(F.col("cost_cents")), F.lit("): "), F.col("metric_name"), F.lit(" "),
        F.coalesce(F.col("metric_before").cast("string"), F.lit("None")), F.lit("→"),
        F.coalesce(F.col("metric_after").cast("string"), F.lit("None")),
        F.lit(" ("), F.format_string("%+.1f", delta.cast("double")), F.lit("). Lesson: "),
        F.col("lessons_learned"),
    )
    return history.select("history_id", "action_date", line.alias("line"))


def actions_with_decisions(tracker: DataFrame, decisions: DataFrame) -> DataFrame:
    chosen = decisions.select(
        "action_id", F.col("decision").alias("user_decision"), F.col("notes").alias("user_notes")
    )
    return left_join_filled(tracker, chosen, "action_id", {"user_decision": "", "user_notes": ""})


def queue_filter(
    tracked: DataFrame,
    domains: list[str] | None = None,
    timeframes: list[str] | None = None,
    state: str | None = None,
    band: str | None = None,
) -> DataFrame:
    return tracked.where(
        C.in_list(F.col("domain"), domains)
        & C.in_list(F.col("timeframe"), timeframes)
        & C.decided(F.col("user_decision"), state)
        & C.priority_band(F.col("priority"), band)
    )


def queue_kpis(tracked: DataFrame) -> DataFrame:
    rec = F.upper(F.coalesce("recommendation", F.lit("")))
    done = C.decided(F.col("user_decision"), "decided")
    return tracked.agg(
        F.count("*").alias("total"),
        M.count_if(rec == "PROCEED").alias("proceed"),
        M.count_if(rec == "PROCEED_WITH_CAUTION").alias("caution"),
        M.count_if(rec == "DEFER").alias("deferred"),
        F.round(F.avg(F.col("practicality_score").cast("string").try_cast("double")), 4).alias("avg_score"),
        M.count_if(done).alias("decided"),
        M.count_if(~done).alias("pending"),
    )


def recommendation_mix(tracked: DataFrame) -> DataFrame:
    return value_counts(tracked, "recommendation", "PENDING")


def decision_mix(decisions: DataFrame) -> DataFrame:
    return value_counts(decisions, "decision", "PENDING")


def score_ranking(tracked: DataFrame) -> DataFrame:
    """Actions by ascending score, those without a numeric score left out."""
    score = F.col("practicality_score").cast("string").try_cast("double")
    return (
        tracked.select("action_id", "title", "domain", score.alias("practicality_score"))
        .dropna(subset=["practicality_score"])
        .orderBy("practicality_score", "action_id")
    )


def context_snapshot(
    ledger: DataFrame, supplier_orders: DataFrame, sales: DataFrame, anchor, region: str
) -> DataFrame:
    """Current state in one row: stockouts, cover of held stock, late orders, one region's revenue."""
    held = F.when(F.col("on_hand_qty") > 0, F.col("days_of_supply"))
    stock = ledger.agg(
        M.count_if(F.col("stockout_flag")).alias("stockout_positions"),
        F.round(F.avg(held), 2).alias("avg_days_of_supply"),
    )
    late = supplier_orders.where(C.month_window(F.col("order_date"), anchor) & F.col("is_late"))
    revenue = C.filter_dimension(sales, region=region).where(C.month_window(F.col("order_date"), anchor))
    return one_row(
        stock,
        late.agg(F.count("*").alias("late_pos")),
        revenue.agg(M.dollars(F.sum("amount_cents")).alias("region_revenue")),
    )
