"""Table maintenance round trips."""

import pytest
from pyspark.sql import functions as F

from supplylens.sources import tables as T
from supplylens.session import new_folder


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, v string, at long")


def content(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_existing_new_and_duplicate_source_keys(spark):
    target = T.publish(frame(spark, [(1, "old", 1), (2, "keep", 1)]), "upsert_case")
    source = frame(spark, [(1, "first", 2), (1, "second", 3), (3, "new", 2)])
    T.publish(T.upserted(target, source, "k", ["at"]), "upsert_case")
    assert content(spark.table("upsert_case")) == [(1, "second", 3), (2, "keep", 1), (3, "new", 2)]
    T.publish(T.upserted(spark.table("upsert_case"), source, "k", ["at"]), "upsert_case")
    assert content(spark.table("upsert_case")) == [(1, "second", 3), (2, "keep", 1), (3, "new", 2)]


def test_update_can_set_null_and_leaves_others(spark):
    target = frame(spark, [(1, "a", 1), (2, "b", 1)])
    changes = spark.createDataFrame([(1, None)], "k long, v string")
    assert content(T.updated(target, changes, "k", "v", "v").fillna("NULL")) == [(1, "NULL", 1), (2, "b", 1)]


def test_update_takes_the_newest_of_several_changes(spark):
    target = frame(spark, [(1, "a", 1), (2, "b", 1)])
    changes = frame(spark, [(1, "old", 1), (1, "new", 2)])
    assert content(T.updated(target, changes, "k", "v", "v", ["at"])) == [(1, "new", 1), (2, "b", 1)]


def test_delete_and_replace_slice(spark):
    target = frame(spark, [(1, "a", 1), (2, "b", 1), (2, "c", 1)])
    assert content(T.deleted(target, frame(spark, [(2, "x", 0), (None, "y", 0)]), "k")) == [(1, "a", 1)]
    assert content(T.replaced_slice(target, frame(spark, [(2, "z", 9)]), "k")) == [(1, "a", 1), (2, "z", 9)]


def test_decide_then_reset(spark):
    T.publish(spark.createDataFrame([(1, "PENDING"), (2, "PENDING")], "action_id long, status string"), "case_items")
    T.publish(spark.createDataFrame([], "action_id long, decision string, decided_at long"), "case_decisions")
    new = spark.createDataFrame([(1, "DEFERRED", 1), (1, "APPROVED", 2)], "action_id long, decision string, decided_at long")
    T.decide("case_items", "case_decisions", new)
    assert content(spark.table("case_items")) == [(1, "APPROVED"), (2, "PENDING")]
    assert content(spark.table("case_decisions")) == [(1, "APPROVED", 2)]
    T.reset_decisions("case_items", "case_decisions", spark.createDataFrame([(1,)], "action_id long"))
    assert content(spark.table("case_items")) == [(1, "PENDING"), (2, "PENDING")]
    assert spark.table("case_decisions").count() == 0


def test_catalog_tables(spark):
    folder = new_folder(spark, "casedb")
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    T.ensure_namespace(spark, name, "case", folder)
    table = f"{name}.notes"
    assert not T.table_exists(spark, table)
    T.create_typed_table(spark, table, "v STRING COMMENT 'it''s a value', k BIGINT", "Notes")
    assert T.table_exists(spark, table)
    T.insert_into(spark.createDataFrame([(1, "a")], "k long, v string"), table)
    T.insert_select(spark, table, *[spark.createDataFrame([(i, "b")], "k long, v string") for i in (2, 3)])
    assert content(T.scan_table(spark, table)) == [("a", 1), ("b", 2), ("b", 3)]
    T.apply_comments(spark, table, "New comment", {"k": "The key's column"})
    notes = {r["column_name"]: r["comment"] for r in T.read_comments(spark, table).collect()}
    assert notes["k"] == "The key's column"
    T.overwrite_table(spark.createDataFrame([(True,)], "flag boolean"), table)
    assert T.scan_table(spark, table).columns == ["flag"]
    T.append_table(spark.createDataFrame([(False,)], "flag boolean"), table)
    assert T.scan_table(spark, table).count() == 2


def test_small_rows_and_stamp(spark):
    inferred = T.rows_inferred(spark, [{"z": 1, "a": "x"}, {"z": 2, "a": None}])
    assert inferred.dtypes == [("z", "bigint"), ("a", "string")]
    typed = T.rows_typed(spark, [(1, 2.5)], "k int, v float")
    assert T.stamped(typed).where(F.col("calculated_at").isNotNull()).count() == 1
    T.create_view(typed, "typed_view")
    assert spark.table("typed_view").count() == 1


def test_assets_need_every_tag(spark):
    tags = spark.createDataFrame(
        [("a", "domain", "demand"), ("a", "size", "large"), ("b", "domain", "demand")], "asset string, key string, value string"
    )
    assert [r["asset"] for r in T.assets_with_tags(tags, domain="demand", size="large").collect()] == ["a"]


def test_shared_dir_is_the_configured_one(spark):
    assert new_folder(spark, "x").startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))
