"""Properties of physical plans that matter on large and skewed data."""

import re
from datetime import datetime

from helpers import START, frame, visits
from pyspark.sql import functions as F

from tillwarden.catalog import inputs as I
from tillwarden.operators import behaviour, merge, rules
from tillwarden.operators.dedup import keep_first
from tillwarden.plans import gold
from tillwarden.sources import messages as topics


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_copies_are_cut_before_the_shuffle(spark, sf_dir):
    text = plan(keep_first(I.purchases(spark, sf_dir), ["transaction_id"], ["event_time"]))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_scoring_is_one_scan_without_shuffle(spark, sf_dir):
    text = plan(I.scored_payments(spark, sf_dir))
    assert "Exchange hashpartitioning" not in text and "Python" not in text


def test_only_needed_columns_are_read(spark, sf_dir):
    text = plan(behaviour.velocity_alerts(I.payments(spark, sf_dir), I.PAYMENT_RULES))
    scan = re.search(r"FileScan parquet \[([^\]]*)\][^\n]*events", text).group(1)
    assert "value" not in scan and "event_type" not in scan


def test_high_water_mark_reaches_the_scan(spark, tmp_path):
    days = [("a", datetime(2024, 3, 1, 12)), ("b", datetime(2024, 3, 2, 12)), ("c", datetime(2024, 3, 3, 12))]
    rows = frame(spark, "k STRING, loaded TIMESTAMP_NTZ", days)
    rows.withColumn("day", F.to_date("loaded")).write.partitionBy("day").parquet(f"{tmp_path}/source")
    source = spark.read.parquet(f"{tmp_path}/source")
    fresh = merge.newer_than(source, rows.where("k <> 'c'"), "loaded", "day")
    assert [r["k"] for r in fresh.collect()] == ["c"]
    text = plan(fresh)
    assert re.search(r"PushedFilters: \[[^\n]*GreaterThan\(loaded,ScalarSubquery", text)
    assert re.search(r"PartitionFilters: \[[^\n]*day[^\n]*ubquery", text)


def test_messages_are_parsed_once(spark):
    df = frame(spark, "key STRING, value STRING, timestamp TIMESTAMP", [("c", "{}", START)])
    alerts = rules.only_alerts(rules.apply_fraud_detection(topics.decode(df))).select("transaction_id", "fraud_score")
    assert plan(alerts).count("from_json") == 1


def test_customers_are_never_sorted_whole(spark):
    df = visits(spark, [(1, "c", 0, "US")])
    for measured in (behaviour.with_velocity(df), behaviour.with_country_spread(df)):
        windows = [line for line in plan(measured).splitlines() if re.search(r"\bWindow \[", line)]
        assert windows and all("cell" in line.split("windowspecdefinition(")[1].split("ASC")[0] for line in windows)


def test_first_pass_over_all_rows_is_a_hash_aggregation(spark, sf_dir):
    flags = I.flagged_payments(spark, sf_dir)
    for model in (gold.customer_stats(flags), gold.merchant_risk_scores(flags, I.AS_OF)):
        kinds = re.findall(r"(HashAggregate|SortAggregate|ObjectHashAggregate)\(", plan(model))
        assert kinds[-2:] == ["HashAggregate", "HashAggregate"]


def test_the_as_of_join_sorts_cells_and_forms_no_pairs(spark):
    df = visits(spark, [(1, "c", 0, "US")])
    text = "customer_id STRING, valid_from TIMESTAMP_NTZ, risk_tier STRING, total_fraud_alerts BIGINT, last_alert_time TIMESTAMP_NTZ"
    known = plan(behaviour.with_profile_as_of(df, frame(spark, text, [])))
    assert "NestedLoop" not in known and "Cartesian" not in known
    # Only the windows over one row per cell go by customer alone.
    by_customer = [line for line in known.splitlines() if re.search(r"\bWindow \[", line) and "cell" not in line.split("windowspecdefinition(")[1].split("ASC")[0]]
    assert all("first" not in line and "at#" not in line.split("windowspecdefinition(")[1] for line in by_customer)
