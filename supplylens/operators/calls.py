"""Calls in a log of messages: who was called with what, which answer belongs to whom, whose table a header is.

A log has conv_id, turn, role, name, arguments and text. A call is a row without a role that has a name and arguments; an
answer is a row of role ``tool``. Rows stay rows: what a row owes to earlier ones is found inside blocks of turns and
carried over their borders, so an endless conversation is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from supplylens.functions import textual as X
from supplylens.operators.textops import TURNS_PER_BLOCK, positions
from supplylens.operators.windows import last_known_within_key, latest_per_key, previous_within_key

#: Callers whose answers are none of the conversation's.
NO_ANSWERS_OF = ("evaluator", "unknown")


def is_call() -> Column:
    return F.col("role").isNull() & F.col("name").isNotNull() & F.col("arguments").isNotNull()


def _block(turns_per_block: int) -> Column:
    return F.floor(F.col("turn") / turns_per_block).cast("bigint")


def call_inventory(messages: DataFrame, field: str = "query") -> DataFrame:
    """conv_id, turn, caller and query of every call: the field of its JSON arguments, or else all of them as they are."""
    query = F.coalesce(F.get_json_object("arguments", f"$.{field}"), "arguments")
    return messages.where(is_call()).select("conv_id", "turn", F.col("name").alias("caller"), query.alias("query"))


def answered_calls(
    messages: DataFrame, without: Sequence[str] = NO_ANSWERS_OF, turns_per_block: int = TURNS_PER_BLOCK
) -> DataFrame:
    """conv_id, caller, turn, content and sql_blocks (an array): the newest answer to each caller of a conversation.

    An answer belongs to the call directly before it, other messages aside; without one to the name it carries, or else
    to ``unknown``. Empty answers and those to callers in ``without`` are left out.
    """
    relevant = messages.where(is_call() | (F.col("role") == "tool")).withColumn("_caller", F.when(is_call(), F.col("name")))
    paired = previous_within_key(relevant, ["conv_id"], _block(turns_per_block), ["turn"], "_caller", "_pending")
    caller = F.coalesce("_pending", "name", F.lit("unknown"))
    answers = paired.where("role = 'tool' AND text <> ''").select("conv_id", caller.alias("caller"), "turn", "text")
    newest = latest_per_key(answers.where(~F.col("caller").isin(*without)), ["conv_id", "caller"], ["turn"])
    return newest.select("conv_id", "caller", "turn", F.col("text").alias("content"), X.sql_blocks(F.col("text")).alias("sql_blocks"))


def header_owners(messages: DataFrame, turns_per_block: int = TURNS_PER_BLOCK) -> DataFrame:
    """conv_id, caller, pos and column_name: the header columns of the newest table that follows the name of each caller.

    A name is an assistant message ``<name>…</name>`` and holds until the next one; an empty name owns nothing.
    """
    text = F.col("text")
    tagged = text.startswith("<name>") & text.endswith("</name>")
    said = messages.where("role = 'assistant'").withColumn(
        "_named", F.when(tagged, F.replace(F.replace(text, F.lit("<name>"), F.lit("")), F.lit("</name>"), F.lit("")))
    )
    owned = last_known_within_key(said, ["conv_id"], _block(turns_per_block), ["turn"], "_named", "caller")
    headers = owned.where(text.startswith("||") & (F.col("caller") != ""))
    newest = latest_per_key(headers, ["conv_id", "caller"], ["turn"])
    return positions(newest, ["conv_id", "caller"], X.header_columns(text), "column_name")
