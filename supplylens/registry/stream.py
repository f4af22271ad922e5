"""The streaming query, run to completion over the event file."""

from __future__ import annotations

from pyspark.sql import functions as F

from supplylens.operators import actions as A
from supplylens.operators import derive
from supplylens.operators.windows import latest_and_previous
from supplylens.registry.actions import CHANGES_SQL
from supplylens.registry.base import query
from supplylens.registry.ctes import with_tables
from supplylens.session import new_folder, path_kind
from supplylens.streaming.evaluations import current_state, run_available


def evaluation_stream(t):
    """Evaluations read as a file stream with the same binding as the batch table.

    A table written by Spark is a folder of files; a single file is picked out of the folder it lies in.
    """
    stream = t.spark.readStream.schema(t.table("events").schema)
    whole = f"{t.root}/events.parquet"
    if path_kind(t.spark, whole) == "folder":
        events = stream.parquet(whole)
    else:
        events = stream.option("pathGlobFilter", "events.parquet").parquet(t.root)
    return events.select(
        F.col("event_id").alias("evaluation_id"),
        F.col("user_id").alias("action_id"),
        F.col("ts").alias("evaluated_at"),
        derive.recommendation_of_event(F.col("event_type")).alias("recommendation"),
        F.least(F.col("value") / 100, F.lit(1.0)).alias("practicality_score"),
    )


@query("incremental_latest_eval", with_tables("items evals", CHANGES_SQL))
def _(t):
    root = new_folder(t.spark, "evaluations")
    run_available(evaluation_stream(t), root)
    state = current_state(t.spark, root, evaluation_stream(t).schema)
    pairs = latest_and_previous(state, ["action_id"], A.NEWEST, ["recommendation", "practicality_score"])
    return A.change_rows(pairs).join(t.action_items().select("action_id", "title"), "action_id")
