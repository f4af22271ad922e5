"""Incremental evaluations: several arrivals, duplicates and a replayed batch."""

import pytest
from pyspark.sql import functions as F

from supplylens.operators import actions as A
from supplylens.operators.windows import latest_and_previous
from supplylens.session import new_folder
from supplylens.streaming.evaluations import current_state, emitted_changes, run_available

SCHEMA = "evaluation_id long, action_id long, evaluated_at long, recommendation string, practicality_score double"
FIRST = [(1, 1, 10, "PROCEED", 0.9), (2, 1, 20, "PROCEED", 0.8), (3, 2, 10, "DEFER", 0.4)]
SECOND = [(2, 1, 20, "PROCEED", 0.8), (4, 1, 30, "REJECT", 0.1), (5, 3, 5, "DEFER", 0.4), (6, 1, 1, "DEFER", 0.4)]


def drop(spark, rows, folder):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def state_rows(spark, root):
    return sorted((r["action_id"], r["evaluation_id"]) for r in current_state(spark, root).collect())


def test_runs_pick_up_only_new_files_and_keep_two_per_action(spark):
    source, root = new_folder(spark, "src"), new_folder(spark, "run")
    drop(spark, FIRST, source)
    run_available(stream(spark, source), root)
    assert state_rows(spark, root) == [(1, 1), (1, 2), (2, 3)]
    assert emitted_changes(spark, root).count() == 0
    drop(spark, SECOND, source)
    run_available(stream(spark, source), root)
    assert state_rows(spark, root) == [(1, 2), (1, 4), (2, 3), (3, 5)]
    changes = emitted_changes(spark, root).collect()
    assert [(r["action_id"], r["prev_rec"], r["curr_rec"], r["batch_id"]) for r in changes] == [(1, "PROCEED", "REJECT", 1)]
    everything = spark.createDataFrame(FIRST + SECOND, SCHEMA).dropDuplicates(["evaluation_id"])
    values = ["recommendation", "practicality_score"]
    want = latest_and_previous(everything, ["action_id"], A.NEWEST, values)
    got = latest_and_previous(current_state(spark, root), ["action_id"], A.NEWEST, values)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_a_batch_that_fails_before_commit_is_replayed_without_effect(spark):
    source, root = new_folder(spark, "src"), new_folder(spark, "run")
    drop(spark, FIRST, source)
    run_available(stream(spark, source), root)
    drop(spark, SECOND, source)

    def lost(batch_id):
        raise RuntimeError("driver lost")

    with pytest.raises(Exception, match="driver lost"):
        run_available(stream(spark, source), root, lost)
    run_available(stream(spark, source), root)
    assert state_rows(spark, root) == [(1, 2), (1, 4), (2, 3), (3, 5)]
    assert emitted_changes(spark, root).where(F.col("status") == "CHANGED").count() == 1
