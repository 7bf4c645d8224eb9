"""One row per key, upsert, update, change sets and snapshots."""

import pytest
from pyspark.sql import functions as F

from ledgerwatch.operators import keyed

SCHEMA = "id string, t int, v double"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows(df, columns=("id", "t", "v")):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_one_per_key_keeps_the_smallest_by_order(spark):
    df = frame(spark, ("a", 2, 1.0), ("a", 1, 9.0), ("a", 1, 3.0), ("b", 5, None), (None, 1, 1.0), (None, 0, 1.0))
    assert rows(keyed.one_per_key(df, ["id"], ["t"])) == rows(frame(spark, ("a", 1, 3.0), ("b", 5, None), (None, 0, 1.0)))


def test_one_per_key_on_all_columns_is_distinct(spark):
    df = frame(spark, ("a", 1, 1.0), ("a", 1, 1.0))
    assert keyed.one_per_key(df, ["id", "t", "v"]).count() == 1


def test_upsert(spark):
    target = frame(spark, ("a", 1, 1.0), ("b", 1, 2.0), (None, 1, 3.0))
    source = frame(spark, ("a", 1, 10.0), ("c", 1, 30.0), (None, 1, 40.0))
    merged = keyed.upsert(target, source, ["id", "t"])
    # A null key matches nothing: both rows stay.
    assert rows(merged) == rows(
        frame(spark, ("a", 1, 10.0), ("b", 1, 2.0), (None, 1, 3.0), ("c", 1, 30.0), (None, 1, 40.0))
    )


def test_upsert_twice_changes_nothing(spark):
    target, source = frame(spark, ("a", 1, 1.0)), frame(spark, ("a", 1, 2.0), ("b", 1, 3.0))
    once = keyed.upsert(target, source, ["id"])
    assert rows(keyed.upsert(once, source, ["id"])) == rows(once)


def test_upsert_into_nothing_creates(spark):
    source = frame(spark, ("a", 1, 1.0))
    assert rows(keyed.upsert(None, source, ["id"])) == rows(source)


def test_upsert_refuses_two_rows_for_one_key(spark):
    with pytest.raises(ValueError, match="several rows"):
        keyed.upsert(None, frame(spark, ("a", 1, 1.0), ("a", 1, 2.0)), ["id"])


def test_upsert_with_a_new_column(spark):
    source = frame(spark, ("b", 1, 2.0)).withColumn("extra", F.lit("x"))
    merged = keyed.upsert(frame(spark, ("a", 1, 1.0)), source, ["id"])
    assert rows(merged, ("id", "extra")) == [("a", None), ("b", "x")]


def test_update_overwrites_also_with_null(spark):
    target = frame(spark, ("a", 1, 1.0), ("b", 1, 2.0), ("c", 1, 3.0))
    source = frame(spark, ("a", 1, None), ("b", 1, 20.0), ("x", 1, 5.0))
    assert rows(keyed.update_from(target, source, ["id", "t"], ["v"])) == rows(
        frame(spark, ("a", 1, None), ("b", 1, 20.0), ("c", 1, 3.0))
    )


def test_changes_lead_from_old_to_new(spark):
    old = frame(spark, ("same", 1, 1.0), ("null", 1, None), ("gone", 1, 2.0), ("moved", 1, 3.0), ("filled", 1, None))
    new = frame(spark, ("same", 1, 1.0), ("null", 1, None), ("moved", 1, 4.0), ("filled", 1, 5.0), ("added", 1, 6.0))
    found = keyed.changes(old, new, ["id"])
    kinds = sorted((r.id, r.change_type, r.v) for r in found.collect() if r.id != "filled")
    assert kinds == [
        ("added", "insert", 6.0), ("gone", "delete", 2.0), ("moved", "update_post", 4.0), ("moved", "update_pre", 3.0)
    ]
    touched = old.join(found.where("change_type <> 'insert'").select("id").distinct(), "id", "left_anti")
    written = found.where("change_type IN ('insert', 'update_post')").drop("change_type")
    assert rows(touched.unionByName(written)) == rows(new)
    assert keyed.changes(new, new, ["id"]).count() == 0


def test_changes_of_versions_with_other_columns(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, None)], "id string, v int, gone string")
    new = spark.createDataFrame([("a", 1, 0.5), ("b", 2, None), ("c", 3, 1.5)], "id string, v int, fresh double")
    found = sorted((r.id, r.change_type, r.v, r.fresh, r.gone) for r in keyed.changes(old, new, ["id"]).collect())
    assert found == [("a", "update_post", 1, 0.5, None), ("a", "update_pre", 1, None, "x"), ("c", "insert", 3, 1.5, None)]


def test_latest_snapshot(spark):
    df = frame(spark, ("a", 1, 9.0), ("a", 2, 1.0), ("a", 2, 5.0), ("b", None, 1.0))
    found = keyed.latest_snapshot(df, "id", "t", F.lit(3))
    assert rows(found, ("id", "t", "v", "snapshot_version")) == [("a", 2, 5.0, 3), ("b", None, 1.0, 3)]


def test_update_refuses_several_source_rows_for_one_key(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, v string")
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "id int, v string")
    with pytest.raises(Exception, match="several source rows"):
        keyed.update_from(target, twice, ["id"], ["v"]).collect()
    nulls = spark.createDataFrame([(2, None), (None, "x"), (None, "y")], "id int, v string")
    assert sorted((r.id or 0, r.v) for r in keyed.update_from(target, nulls, ["id"], ["v"]).collect()) == [(0, "c"), (1, "a"), (2, None)]
