import pytest
from helpers import at, frame, rows

from tillwarden.operators import merge
from tillwarden.operators.dedup import keep_first
from pyspark.sql import functions as F

LOADS = "transaction_id STRING, amount DOUBLE, ingested_at TIMESTAMP_NTZ"


def test_high_water_mark_is_exclusive_and_empty_target_takes_all(spark):
    source = frame(spark, LOADS, [("a", 1.0, at(0)), ("b", 2.0, at(1)), ("c", 3.0, at(2))])
    target = frame(spark, LOADS, [("x", 0.0, at(1)), ("y", 0.0, at(0))])
    assert rows(merge.newer_than(source, target, "ingested_at"), "transaction_id") == [("c",)]
    assert merge.newer_than(source, target.where("false"), "ingested_at").count() == 3


def test_upsert_replaces_whole_rows(spark):
    target = frame(spark, LOADS, [("a", 1.0, at(0)), ("b", 2.0, at(0))])
    source = frame(spark, LOADS, [("b", None, at(5)), ("c", 3.0, at(5))])
    assert rows(merge.upsert(target, source, ["transaction_id"])) == [
        ("a", 1.0, at(0)), ("b", None, at(5)), ("c", 3.0, at(5))
    ]


def test_upsert_twice_changes_nothing(spark):
    target = frame(spark, LOADS, [("a", 1.0, at(0)), ("b", 2.0, at(0))])
    source = frame(spark, LOADS, [("b", 9.0, at(5))])
    once = merge.upsert(target, source, ["transaction_id"])
    assert rows(merge.upsert(once, source, ["transaction_id"])) == rows(once)


def test_schema_sync_adds_and_drops(spark):
    target = frame(spark, "transaction_id STRING, gone STRING", [("a", "x")])
    source = frame(spark, "transaction_id STRING, added BIGINT", [("b", 7)])
    merged = merge.upsert(target, source, ["transaction_id"])
    assert merged.columns == ["transaction_id", "added"] and rows(merged) == [("a", None), ("b", 7)]


def test_repeated_merge_key_is_refused(spark):
    source = frame(spark, LOADS, [("a", 1.0, at(0)), ("a", 2.0, at(0))])
    with pytest.raises(ValueError, match="repeats key"):
        merge.assert_unique(source, ["transaction_id"])
    assert merge.assert_unique(source.limit(1), ["transaction_id"]).count() == 1


def test_defaults_fill_nulls_and_missing_columns(spark):
    df = frame(spark, "transaction_id STRING, currency STRING", [("a", None), ("b", "EUR")])
    filled = merge.with_defaults(df, {"currency": F.lit("USD"), "fraud_rate": F.lit(0.0)})
    assert rows(filled) == [("a", "USD", 0.0), ("b", "EUR", 0.0)]


def test_ids_are_unique_and_above_the_table(spark):
    table = frame(spark, "id BIGINT", [(41,), (7,)])
    start = merge.next_id(table, "id")
    assert start == 42 and merge.next_id(table.where("false"), "id") == 1
    ids = [r["id"] for r in merge.assign_ids(spark.range(1000).toDF("n").repartition(7), "id", start).collect()]
    assert len(set(ids)) == 1000 and min(ids) >= start


def test_keep_first_with_many_copies(spark):
    copies = [("hot", float(i % 7), at(i % 5)) for i in range(500)] + [("cold", 3.0, at(9))]
    df = frame(spark, LOADS, copies).repartition(8)
    assert rows(keep_first(df, ["transaction_id"], ["ingested_at"])) == [("cold", 3.0, at(9)), ("hot", 0.0, at(0))]
