"""Incremental re-evaluation: newest evaluations per action, refreshed as files arrive.

The recurring job reads only evaluations that arrived since its last run, merges them into a state of at most two rows
per action and emits the actions whose recommendation changed. The state is a keyed table in buckets: a batch reads and
rewrites the buckets of the actions it brings, so its work follows the batch and not the history. The changes of a batch
are written under its id first, then one manifest puts the new buckets in force and notes the id. A batch that is
replayed after a failure starts from the same state and writes the same rows; one whose manifest is there is passed over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from supplylens.operators.actions import NEWEST, change_rows
from supplylens.operators.windows import latest_and_previous, ranked_latest
from supplylens.sources.buckets import BucketStore

#: Name of the table of newest evaluations.
STATE = "newest"


def merge_batch(state: DataFrame, batch: DataFrame) -> DataFrame:
    """The two newest evaluations per action after the batch; repeated ids count once."""
    rows = state.unionByName(batch).dropDuplicates(["evaluation_id"])
    return ranked_latest(rows, ["action_id"], NEWEST, 2, "_rn").drop("_rn")


def changed_rows(state: DataFrame, batch: DataFrame) -> DataFrame:
    """CHANGED rows of the actions the batch touched."""
    touched = state.join(batch.select("action_id"), "action_id", "left_semi")
    pairs = latest_and_previous(touched, ["action_id"], NEWEST, ["recommendation", "practicality_score"])
    return change_rows(pairs).where("status = 'CHANGED'")


def apply_batch(store: BucketStore, batch: DataFrame, batch_id: int, changes_root: str, before_commit=None) -> None:
    """Merge one batch into the state and write its changes; nothing happens if the batch is in force already."""
    base = store.manifest()
    if base.notes.get("batch_id", -1) >= batch_id:
        return
    staged = store.changed(base, STATE, batch, lambda rows: merge_batch(rows, batch))
    changes = changed_rows(store.rows_of(staged), batch)
    changes.write.mode("overwrite").parquet(f"{changes_root}/batch_id={batch_id}")
    if before_commit:
        before_commit(batch_id)
    store.commit(base, [staged], batch_id=batch_id)
    store.expire()


def run_available(evaluations: DataFrame, root: str, before_commit=None, buckets: int = 16) -> None:
    """Process everything that has arrived since the last run and stop.

    ``evaluations`` is a streaming DataFrame and ``root`` a folder all executors can
    reach; it holds the query's progress, the state and the changes. ``buckets`` is the number of buckets of a new state.
    ``before_commit`` is called before each batch is put in force, for tests of replays.
    """
    store = BucketStore(evaluations.sparkSession, f"{root}/state")
    if not store.versions():
        store.create(STATE, evaluations.sparkSession.createDataFrame([], evaluations.schema), "action_id", buckets)

    def process(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            apply_batch(store, batch, batch_id, f"{root}/changes", before_commit)
        finally:
            batch.unpersist()

    (
        evaluations.writeStream.foreachBatch(process)
        .option("checkpointLocation", f"{root}/progress")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def current_state(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """The newest evaluations in force. Before the first run there are no rows, of the given schema."""
    store = BucketStore(spark, f"{root}/state")
    if schema and not store.versions():
        return spark.createDataFrame([], schema)
    return store.table(STATE)


def emitted_changes(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/changes")
