"""Scoring texts and runs against expected values.

The search for a value is row-local: the numbers of a text are an array, and the
first exact or the closest number is picked from it without exploding pairs of
numbers and expectations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from supplylens.functions import measures as M
from supplylens.functions import textual as X


def rounded_abs(value: Column) -> Column:
    return F.round(F.abs(value), 2)


def with_numbers(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace the text by its numbers and their two-decimal absolute values.

    Done once per text, before expected values multiply the rows.
    """
    numbered = df.withColumn("_nums", X.numbers(F.col(text))).drop(text)
    return numbered.withColumn("_abs", F.transform("_nums", rounded_abs))


def find_value(df: DataFrame, expected: str = "expected") -> DataFrame:
    """Adds is_match, found, closest, best_diff and nearest for each numbered row.

    A match has the same absolute value at two decimals. ``closest`` is the match
    itself or else the first of the nearest numbers; ``best_diff`` is the smallest
    distance among the numbers read before a match, or among all without one.
    """
    target = rounded_abs(F.col(expected))
    placed = df.withColumn("_target", target).withColumn("_hit", F.array_position("_abs", F.col("_target")))
    hit = F.coalesce(F.col("_hit") > 0, F.lit(False))
    read = F.when(hit, F.slice("_abs", F.lit(1), (F.col("_hit") - 1).cast("int"))).otherwise(F.col("_abs"))
    distances = F.transform(read, lambda n: F.abs(n - F.col("_target")))
    best = placed.withColumn("_distances", distances).withColumn("_best", F.array_min("_distances"))
    found = F.when(hit, F.try_element_at("_nums", F.col("_hit").cast("int")))
    nearest = F.try_element_at("_nums", F.array_position("_distances", F.col("_best")).cast("int"))
    kept = [c for c in df.columns if c not in ("_nums", "_abs")]
    return best.select(
        *kept,
        hit.alias("is_match"),
        found.alias("found"),
        F.coalesce(found, nearest).alias("closest"),
        F.col("_best").alias("best_diff"),
        nearest.alias("nearest"),
    )


def score_bands(df: DataFrame, expected: str = "expected", close: float = 0.10, miss: float = 0.30) -> DataFrame:
    """EXACT, CLOSE, MISS or NOT_FOUND, with the value found and the distance in percent.

    An expected value of zero can only be exact or not found.
    """
    scored = find_value(df, expected=expected)
    target = rounded_abs(F.col(expected))
    off = F.abs(rounded_abs(F.col("nearest")) - target) / F.nullif(target, F.lit(0.0))
    status = (
        F.when(F.col("is_match"), "EXACT").when(off < close, "CLOSE").when(off < miss, "MISS").otherwise("NOT_FOUND")
    )
    value = F.when(F.col("is_match"), F.col("found")).when(status.isin("CLOSE", "MISS"), F.col("nearest"))
    percent = F.round(F.col("best_diff") / F.greatest(target, F.lit(0.001)) * 100, 1)
    return scored.select(
        *[c for c in df.columns if c not in ("_nums", "_abs")],
        status.alias("status"),
        F.round(value, 2).alias("found_value"),
        F.when(F.col("nearest") != 0, percent).alias("pct_diff"),
    )


def score_coverage(df: DataFrame, expected: str = "expected", close: float = 0.05) -> DataFrame:
    scored = find_value(df, expected=expected)
    wanted = F.abs(F.col(expected))
    near = F.abs(F.abs(F.col("closest")) - wanted) / F.nullif(wanted, F.lit(0.0)) < close
    verdict = F.when(F.col("is_match"), "FOUND").when(near, "CLOSE").otherwise("NOT_FOUND")
    return scored.select(*[c for c in df.columns if c not in ("_nums", "_abs")], verdict.alias("status"), "found", "closest")


def with_expected(texts: DataFrame, expected: DataFrame, on: list[str]) -> DataFrame:
    """Every text next to the values expected of its group: ``expected`` has the key columns, id and expected."""
    return texts.join(expected.select(*on, "id", "expected"), on)


def values_match(actual: Column, expected: Column, tolerance: float = 0.01) -> Column:
    """Within one percent of the expected number, or equal as text when not numbers."""
    a, e = actual.cast("string").try_cast("double"), expected.cast("string").try_cast("double")
    near = F.abs(a - e) / F.greatest(F.abs(e), F.lit(0.001)) < tolerance
    return F.coalesce(near, actual.cast("string") == expected.cast("string"), F.lit(False))


def scorecard_summary(scored: DataFrame, keys: list[str]) -> DataFrame:
    status = F.col("status")
    exact = M.count_if(status == "EXACT")
    return scored.groupBy(*keys).agg(
        exact.alias("exact"),
        M.count_if(status == "CLOSE").alias("close"),
        M.count_if(status == "MISS").alias("miss"),
        M.count_if(status == "NOT_FOUND").alias("not_found"),
        F.count("*").alias("total"),
        F.bround(exact * 100.0 / F.count("*"), 0).cast("bigint").alias("pct_exact"),
    )


def run_consistency(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Metrics found in both runs, newly found, regressed or missing in both."""
    flag = lambda df, name: df.select(*keys, (F.col("status") == "FOUND").alias(name))
    both = flag(before, "_before").join(flag(after, "_after"), keys, "full")
    was, now = F.coalesce("_before", F.lit(False)), F.coalesce("_after", F.lit(False))
    outcome = (
        F.when(was & now, "consistent").when(now, "newly_found").when(was, "regressed").otherwise("missing")
    )
    return both.select(*keys, outcome.alias("outcome"))


def coverage_by_group(before: DataFrame, after: DataFrame, keys: list[str], id_col: str = "id") -> DataFrame:
    """Hits per id prefix before and after, and the gain.

    Both runs are stacked and counted in one aggregate instead of joined.
    """
    found = F.col("status") == "FOUND"
    side = lambda df, run: df.select(F.substring(id_col, 1, 1).alias("metric_group"), found.alias("_hit"), F.lit(run).alias("_run"))
    runs = side(before, 0).unionByName(side(after, 1))
    hits = lambda run: M.count_if((F.col("_run") == run) & F.col("_hit"))
    return runs.groupBy("metric_group").agg(
        hits(0).alias("hits_before"),
        hits(1).alias("hits_after"),
        M.count_if(F.col("_run") == 1).alias("total"),
        (hits(1) - hits(0)).alias("delta"),
    )


def stage_progression(stages: DataFrame) -> DataFrame:
    """Cumulative passes per stage and the gain over the stage before.

    Input has one row per stage (stage, passed, total), so one task ranks a handful of rows.
    """
    ordered = Window.orderBy("stage")
    so_far = F.sum("passed").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return stages.select(
        "stage",
        so_far.alias("passed_so_far"),
        F.col("passed").alias("newly_passed"),
        (F.col("passed") - F.coalesce(F.lag("passed").over(ordered), F.lit(0))).alias("gain"),
        F.floor(so_far * 100 / F.sum("total").over(Window.partitionBy())).cast("bigint").alias("pct"),
    )


def failing_subset(tests: DataFrame, results: DataFrame, keys: list[str]) -> DataFrame:
    """The tests whose result failed, to be run again."""
    failed = results.where(F.col("status") != "EXACT").select(*keys)
    return tests.join(failed, keys, "left_semi")


def verify_views(checks: DataFrame, truth: DataFrame, metrics: list[str], tolerance: float = 0.01) -> DataFrame:
    """Each check's value against the first truth metric, by name, that holds its keyword.

    ``metrics`` are the declared names of the truth. A keyword is resolved among them as an expression, so that
    the values meet by an equi-join.
    """
    keyword = F.lower(F.col("keyword"))
    named = F.coalesce(*[F.when(F.lower(F.lit(m)).contains(keyword), F.lit(m)) for m in sorted(metrics)])
    looked = checks.withColumn("metric", named).join(truth.select("metric", F.col("value").alias("expected")), "metric", "left")
    return looked.select(
        "keyword",
        "metric",
        "actual",
        "expected",
        F.when(values_match(F.col("actual"), F.col("expected"), tolerance), "EXACT").otherwise("MISS").alias("status"),
    )
