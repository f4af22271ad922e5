"""Table-in, table-out text operators over responses, documents and conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplylens.functions import textual as X
from supplylens.operators.windows import index_within_key, previous_within_key

#: Turns ranked together; the border between two such blocks shows in no result.
TURNS_PER_BLOCK = 1000


def assistant_text(messages: DataFrame, role: str = "assistant", turns_per_block: int = TURNS_PER_BLOCK) -> DataFrame:
    """Assistant messages of every conversation in turn order: conv_id, position, turn, text.

    The messages stay rows, so an endless conversation is never gathered in one task; read by
    position they are the conversation's text.
    """
    said = messages.where(F.col("role") == role)
    block = F.floor(F.col("turn") / turns_per_block).cast("bigint")
    return index_within_key(said, ["conv_id"], block, ["turn"], "position").select("conv_id", "position", "turn", "text")


def text_after_exclusion(
    messages: DataFrame,
    marker_roles: list[str],
    marker_texts: list[str],
    turns_per_block: int = TURNS_PER_BLOCK,
) -> DataFrame:
    """Assistant messages in order without the excluded ones.

    A call in ``marker_roles`` or an assistant message carrying a marker text excludes the assistant
    message that follows it directly; the carrier itself goes too. Every role but the user's is a call,
    and any call in between lifts the mark.
    """
    assistant = F.col("role") == "assistant"
    carries = F.lit(False)
    for marker in marker_texts:
        carries = carries | F.col("text").contains(marker)
    calls = F.col("role").isin(marker_roles)
    relevant = messages.where(F.col("role") != "user").withColumn("_marks", calls | (assistant & carries))
    block = F.floor(F.col("turn") / turns_per_block).cast("bigint")
    judged = previous_within_key(relevant, ["conv_id"], block, ["turn"], "_marks", "_after_mark")
    kept = judged.where(assistant & ~F.col("_marks") & ~F.coalesce("_after_mark", F.lit(False)))
    return assistant_text(kept.select("conv_id", "turn", "role", "text"), turns_per_block=turns_per_block)


def role_call_counts(messages: DataFrame) -> DataFrame:
    return messages.groupBy("conv_id", "role").agg(F.count("*").alias("calls"))


def positions(df: DataFrame, keys: list[str], array: Column, value: str, start: int = 0) -> DataFrame:
    """One row per array element with its position."""
    exploded = df.select(*keys, F.posexplode(array).alias("_pos", value))
    return exploded.select(*keys, (F.col("_pos") + start).cast("bigint").alias("pos"), value)


def extract_sql(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    return positions(df, keys, X.sql_blocks(F.col(text)), "sql_block")


def extract_numbers(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    return positions(df, keys, X.numbers(F.col(text)), "number")


def header_columns(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Columns of texts that start with a double pipe."""
    tables = df.where(F.col(text).startswith("||"))
    return positions(tables, keys, X.header_columns(F.col(text)), "column_name")


def labelled_metrics(df: DataFrame, keys: list[str], text: str, defaults: dict[str, float] | None = None) -> DataFrame:
    """Metric values found behind their labels; defaults stand in for missing ones."""
    defaults = defaults or {}
    entries = [
        F.struct(
            F.lit(name).alias("metric"),
            F.coalesce(X.labelled_value(F.col(text), name), F.lit(defaults.get(name)).cast("double")).alias("value"),
        )
        for name in X.METRIC_LABELS
    ]
    return (
        df.select(*keys, F.explode(F.array(*entries)).alias("_m"))
        .select(*keys, "_m.*")
        .where(F.col("value").isNotNull())
    )


def metric_counts(df: DataFrame, keys: list[str], text: str, defaults: dict[str, float]) -> DataFrame:
    """How many metrics a text states, and how many with a default it leaves to that."""
    stated = F.array(*[F.when(X.labelled_value(F.col(text), name).isNotNull(), F.lit(name)) for name in X.METRIC_LABELS])
    return df.select(*keys, F.array_compact(stated).alias("_stated")).select(
        *keys,
        F.size("_stated").cast("bigint").alias("found"),
        F.size(F.array_except(F.array(*[F.lit(n) for n in defaults]), "_stated")).cast("bigint").alias("defaulted"),
    )


def markdown_tables(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Cells of every pipe table: table, row and cell numbers from 0."""
    tables = F.regexp_extract_all(F.col(text), F.lit(X.PIPE_TABLE), F.lit(1))
    rows = df.select(*keys, F.posexplode(tables).alias("table_no", "_t")).select(
        *keys, "table_no", F.posexplode(X.table_rows(F.col("_t"))).alias("row_no", "_r")
    )
    return rows.select(
        *keys,
        F.col("table_no").cast("bigint").alias("table_no"),
        F.col("row_no").cast("bigint").alias("row_no"),
        F.posexplode("_r").alias("cell_no", "cell"),
    ).withColumn("cell_no", F.col("cell_no").cast("bigint"))


def sections(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Sections split at headings; a repeated title keeps its last body."""
    found = df.select(*keys, F.explode(X.last_sections(F.col(text))).alias("_s"))
    return found.select(*keys, F.col("_s.title").alias("section"), F.col("_s.body").alias("body"))


def status_word_counts(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    counts = {
        f"{name}_count": F.regexp_count(F.col(text), F.lit(word)).cast("bigint") for name, word in X.STATUS_WORDS.items()
    }
    return df.select(
        *keys,
        *[c.alias(n) for n, c in counts.items()],
        F.regexp_count(F.lower(F.col(text)), F.lit("n/a")).cast("bigint").alias("na_count"),
    )


def parse_counts(df: DataFrame, keys: list[str], narration: str, total: str) -> DataFrame:
    counts = X.narrated_counts(F.col(narration), F.col(total))
    return df.select(*keys, *[c.alias(n) for n, c in counts.items()])


def requote_sql(df: DataFrame, keys: list[str], text: str, regions: list[str], date_pattern: str) -> DataFrame:
    blocks = positions(df, keys, X.sql_blocks(F.col(text)), "sql_block")
    return blocks.withColumn("sql_block", X.requoted(F.col("sql_block"), regions, date_pattern))


def best_keyword_block(df: DataFrame, keys: list[str], text: str, metric: Column) -> DataFrame:
    best = X.best_block(X.sql_blocks(F.col(text)), metric)
    return (
        df.select(*keys, best.alias("_b"))
        .where(F.col("_b").isNotNull())
        .select(*keys, F.col("_b.hits").cast("bigint").alias("hits"), F.col("_b.block").alias("sql_block"))
    )


ACTION_LIST = (
    "array<struct<category:string, timeframe:string, domain:string, title:string, description:string, "
    "specific_steps:string, expected_impact:string, priority:int>>"
)


def parse_action_json(df: DataFrame, run: str, json: str, stamp: Column | None = None) -> DataFrame:
    """Action rows from a JSON list, an object with an "actions" list, or one object.

    ``stamp`` is the time of creation, now if none is given.
    """
    df = df.withColumn("_stamp", F.current_timestamp() if stamp is None else stamp)
    listed = F.coalesce(F.get_json_object(F.col(json), "$.actions"), F.col(json))
    parsed = F.from_json(listed, ACTION_LIST)
    rows = df.select(run, "_stamp", F.posexplode(parsed).alias("_i", "_a"))
    number = F.col("_i") + 1
    text = lambda name, missing: F.coalesce(F.col(f"_a.{name}"), F.lit(missing)).alias(name)
    return rows.select(
        F.concat(F.col(run).cast("string"), F.lit("_action_"), F.format_string("%02d", number)).alias("action_id"),
        F.col(run).alias("run_id"),
        text("category", "UNKNOWN"),
        text("timeframe", "Unknown"),
        text("domain", "general"),
        F.coalesce(F.col("_a.title"), F.concat(F.lit("Action "), number.cast("string"))).alias("title"),
        text("description", ""),
        text("specific_steps", ""),
        text("expected_impact", ""),
        F.coalesce(F.col("_a.priority"), number).cast("bigint").alias("priority"),
        F.lit("PENDING").alias("status"),
        F.col("_stamp").alias("created_at"),
        F.col("_stamp").alias("updated_at"),
    )
