"""Keyed tables in buckets: what a change rewrites, commits, lost writers, expiry."""

import pytest
from pyspark.sql import functions as F

from supplylens.session import names_in
from supplylens.sources import buckets
from supplylens.sources.buckets import BucketStore
from supplylens.streaming.evaluations import STATE, apply_batch
from tests.test_stream import SCHEMA


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, v string, at long")


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def store(spark):
    s = BucketStore.new(spark, "buckets")
    s.create("t", spark.range(2000).select(F.col("id").alias("k"), F.lit("old").alias("v"), F.lit(1).cast("long").alias("at")), "k", 64)
    return s


def folders(store, version=None):
    return store.manifest(version).tables["t"]["folders"]


def test_a_change_of_ten_keys_rewrites_ten_buckets_at_most(spark, store):
    before = folders(store)
    assert len(before) == 64
    store.upsert("t", frame(spark, [(k, "new", 2) for k in range(100, 110)]), ["at"])
    after = folders(store)
    moved = [b for b in after if after[b] != before[b]]
    assert 1 <= len(moved) <= 10 and set(after) == set(before)
    assert store.table("t").where("v = 'new'").count() == 10 and store.table("t").count() == 2000
    newest = names_in(spark, f"{store.root}/data")[-1]
    assert len([n for n in names_in(spark, f"{store.root}/data/{newest}") if n.startswith("_bucket=")]) == len(moved)


def test_keyed_changes(spark):
    s = BucketStore.new(spark, "buckets")
    s.create("t", frame(spark, [(1, "a", 1), (2, "b", 1), (None, "n", 1), (2**40, "big", 1)]), "k", 4)
    s.upsert("t", frame(spark, [(1, "first", 2), (1, "second", 3), (3, "new", 2)]), ["at"])
    assert content(s.table("t")) == content(frame(spark, [(1, "second", 3), (2, "b", 1), (3, "new", 2), (None, "n", 1), (2**40, "big", 1)]))
    s.update("t", spark.createDataFrame([(2, "x"), (9, "y")], "k int, w string"), "v", "w")  # a narrower key type
    assert [tuple(r) for r in s.lookup("t", spark.createDataFrame([(2,), (9,)], "k long")).collect()] == [(2, "x", 1)]
    s.delete("t", spark.createDataFrame([(2,), (2**40,), (None,)], "k long"))
    assert content(s.table("t")) == content(frame(spark, [(1, "second", 3), (3, "new", 2), (None, "n", 1)]))
    s.replace_slice("t", frame(spark, [(7, "new", 8)]), "v")
    assert content(s.table("t")) == content(frame(spark, [(1, "second", 3), (7, "new", 8), (None, "n", 1)]))
    s.delete("t", s.table("t").select("k"))
    assert content(s.table("t")) == [(None, "n", 1)]
    s.upsert("t", frame(spark, []), ["at"])
    assert content(s.table("t")) == [(None, "n", 1)] and s.versions() == [1, 2, 3, 4, 5, 6, 7]


def test_a_lost_writer_leaves_the_old_manifest_in_force(spark, store):
    base = store.manifest()
    store.changed(base, "t", frame(spark, [(5, "lost", 9)]), lambda rows: rows.withColumn("v", F.lit("lost")))
    assert store.versions() == [1] and store.table("t").where("v = 'lost'").isEmpty()
    with pytest.raises(Exception, match="(?i)divide|zero"):
        store.upsert("t", frame(spark, [(5, "bad", 9)]).withColumn("at", F.expr("at div (k - 5)")), ["at"])
    assert store.versions() == [1] and store.table("t").where("v <> 'old'").isEmpty()


def test_of_two_writers_on_one_version_the_second_is_refused(spark, store):
    other = BucketStore(spark, store.root)
    base = other.manifest()
    late = other.changed(base, "t", frame(spark, [(5, "late", 2)]), lambda rows: rows.withColumn("v", F.lit("late")))
    store.upsert("t", frame(spark, [(6, "early", 2)]), ["at"])
    with pytest.raises(FileExistsError):
        other.commit(base, [late])
    assert [n for n in names_in(spark, f"{store.root}/manifests") if n.startswith("_")] == []
    assert content(other.table("t").where("v <> 'old'")) == [(6, "early", 2)]


def test_old_versions_are_read_until_they_expire(spark, store):
    for at in range(2, 6):
        store.upsert("t", frame(spark, [(at, "new", at)]), ["at"])
    assert store.table("t", 3).where("v = 'new'").count() == 2
    store.expire(2)
    assert store.versions() == [4, 5]
    assert store.table("t", 4).where("v = 'new'").count() == 3 and store.table("t").where("v = 'new'").count() == 4
    live = {f for v in (4, 5) for f in folders(store, v).values()}
    there = {f"data/{d}/{b}" for d in names_in(spark, f"{store.root}/data") for b in names_in(spark, f"{store.root}/data/{d}") if b[1] == "b"}
    assert there == live


def test_decisions_and_items_change_in_one_commit(spark):
    s = BucketStore.new(spark, "buckets")
    s.create("items", spark.createDataFrame([(1, "PENDING"), (2, "PENDING")], "action_id long, status string"), "action_id")
    s.create("decisions", spark.createDataFrame([], "action_id long, decision string, decided_at long"), "action_id")
    new = spark.createDataFrame([(1, "DEFERRED", 1), (1, "APPROVED", 2)], "action_id long, decision string, decided_at long")
    buckets.decide(s, "items", "decisions", new)
    assert s.versions() == [1, 2, 3]
    assert content(s.table("items")) == [(1, "APPROVED"), (2, "PENDING")]
    assert content(s.table("decisions")) == [(1, "APPROVED", 2)]
    again = BucketStore(spark.newSession(), s.root)  # another session sees the change
    assert content(again.table("items")) == [(1, "APPROVED"), (2, "PENDING")]
    buckets.reset_decisions(s, "items", "decisions", spark.createDataFrame([(1,)], "action_id long"))
    assert content(s.table("items")) == [(1, "PENDING"), (2, "PENDING")] and s.table("decisions").isEmpty()


def test_a_stream_batch_rewrites_the_buckets_of_its_actions(spark):
    s = BucketStore.new(spark, "state")
    s.create(STATE, spark.createDataFrame([], SCHEMA), "action_id", 32)
    history = spark.range(5000).selectExpr("id AS evaluation_id", "id % 1000 AS action_id", "id AS evaluated_at", "'DEFER' AS recommendation", "0.5D AS practicality_score")
    apply_batch(s, history, 0, f"{s.root}/changes")
    before = s.manifest().tables[STATE]["folders"]
    batch = spark.createDataFrame([(9000, 7, 9000, "PROCEED", 0.9), (9001, 8, 9001, "DEFER", 0.5)], SCHEMA)
    apply_batch(s, batch, 1, f"{s.root}/changes")
    after = s.manifest().tables[STATE]["folders"]
    assert 1 <= sum(after[b] != before[b] for b in after) <= 2
    assert s.table(STATE).count() == 2000
    apply_batch(s, batch, 1, f"{s.root}/changes")  # a replay after its commit
    assert s.manifest().tables[STATE]["folders"] == after
    changes = spark.read.parquet(f"{s.root}/changes").select("action_id", "batch_id").collect()
    assert [tuple(r) for r in changes] == [(7, 1)]
