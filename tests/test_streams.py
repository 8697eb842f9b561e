import json
import os

import pytest
from helpers import START, at, frame, rows

from pyspark.sql import functions as F
from tillwarden.config import RuleConfig
from tillwarden.operators import behaviour, rules
from tillwarden.plans import serving
from tillwarden.schemas import FRAUD_ALERTS, TRANSACTIONS_RAW
from tillwarden.sources import messages as topics
from tillwarden.streaming import jobs

MESSAGES = "key STRING, value STRING, timestamp TIMESTAMP"


def body(n, customer="c", second=0, **more):
    fields = dict(
        transaction_id=str(n), customer_id=customer, timestamp=at(second).isoformat(), amount=50.0, merchant_name="Shop",
        merchant_category="grocery", merchant_country="US", is_fraud=False,
    )
    return json.dumps(fields | more)


class Topic:
    """A folder of message files; each ``send`` adds one file, read as one batch."""

    def __init__(self, spark, path):
        self.spark, self.path, self.sent = spark, str(path), 0

    def send(self, *values):
        df = frame(self.spark, MESSAGES, [("c", v, START) for v in values])
        df.coalesce(1).write.mode("append").parquet(self.path)
        self.sent += 1
        newest = max((f for f in os.scandir(self.path) if f.name.endswith(".parquet")), key=lambda f: f.stat().st_mtime_ns)
        os.utime(newest.path, (1e9 + self.sent, 1e9 + self.sent))  # files are read in order of time

    def stream(self):
        return topics.read_messages(self.spark, "parquet", {"maxFilesPerTrigger": "1"}, self.path)


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


def drain(spark, df, folder):
    jobs.finish(jobs.to_files(df, f"{folder}/rows", f"{folder}/offsets", trigger=None))
    return spark.read.schema(df.schema).parquet(f"{folder}/rows")


def test_malformed_message_is_kept_aside_and_never_alerts(spark):
    df = frame(spark, MESSAGES, [("c", "{not json", START), ("c", body(1), START), ("c", body(2, timestamp="soon"), START)])
    decoded = topics.decode(df)
    good, bad = topics.split_malformed(decoded)
    assert rows(bad, topics.MALFORMED) == [("{not json",)]
    assert rows(good, "transaction_id", "event_time") == [("1", at(0)), ("2", None)]
    scored = rules.apply_fraud_detection(decoded).where("transaction_id is null")
    assert rows(scored, "fraud_score", "risk_level") == [(None, "CRITICAL")]
    assert topics.prepare_kafka_output(scored).count() == 0 and topics.routed_messages(scored).count() == 0


def test_empty_message_is_one_row_of_nulls(spark):
    row = topics.decode(frame(spark, MESSAGES, [("c", None, START)])).collect()
    assert len(row) == 1 and row[0]["transaction_id"] is None and row[0]["kafka_timestamp"] == START


def test_alert_json_leaves_out_nulls_and_is_keyed_by_customer(spark):
    df = frame(spark, MESSAGES, [("c", body(1, amount=5000.0), START)])
    alert = topics.prepare_kafka_output(rules.apply_fraud_detection(topics.decode(df))).first()
    read = json.loads(alert["value"])
    assert alert["key"] == "c" and "customer_lat" not in read
    assert (read["fraud_score"], read["risk_level"], read["amount_flag"]) == (30, "MEDIUM", True)


def test_alert_without_time_gets_its_arrival(spark):
    value = json.dumps(dict(transaction_id="1", customer_id="c", fraud_score=35))
    row = topics.alert_rows(frame(spark, MESSAGES, [("c", value, START)])).first()
    assert row["event_time"] == START and row["amount"] is None and float(row["fraud_score"]) == 35


def test_peek_marks_fraud_and_fills_gaps(spark):
    values = [body(1, is_fraud=True), json.dumps(dict(fraud_score=65, risk_level="HIGH")), body(3)]
    peeked = topics.peek_topic(frame(spark, MESSAGES, [("c", v, at(i)) for i, v in enumerate(values)]), 2).collect()
    assert [(r["fraud_flag"], r["risk_level"], r["customer_id"]) for r in peeked] == [
        ("", "N/A", "c"), ("FRAUD", "HIGH", "N/A")
    ]


def test_kafka_options():
    assert topics.kafka_options("broker:9092", batch_rows=100)["maxOffsetsPerTrigger"] == "100"
    options = topics.kafka_options("broker:9092")
    assert (options["subscribe"], options["startingOffsets"], options["failOnDataLoss"]) == ("raw-transactions", "latest", "false")


def test_stream_equals_batch_over_several_files(spark, topic, tmp_path):
    for n in range(3):
        topic.send(*(body(10 * n + i, second=60 * n + i, amount=900.0 + 30 * i) for i in range(8)))
    streamed = drain(spark, jobs.scored(topic.stream()).select("transaction_id", "fraud_score", "risk_level"), tmp_path)
    stored = spark.read.parquet(topic.path)
    batch = rules.apply_fraud_detection(topics.decode(stored)).select("transaction_id", "fraud_score", "risk_level")
    assert rows(streamed) == rows(batch) and streamed.count() == 24


def test_resumes_from_its_checkpoint(spark, topic, tmp_path):
    columns = ["transaction_id"]
    topic.send(body(1))
    assert rows(drain(spark, jobs.transactions(topic.stream()).select(*columns), tmp_path)) == [("1",)]
    topic.send(body(2))
    assert rows(drain(spark, jobs.transactions(topic.stream()).select(*columns), tmp_path)) == [("1",), ("2",)]


def test_velocity_drops_rows_of_closed_windows(spark, topic, tmp_path):
    topic.send(*(body(i, "fast", i) for i in range(6)), *(body(20 + i, "late", i) for i in range(5)))
    topic.send(body(50, "other", 600))  # moves the watermark past the first window,
    topic.send(body(51, "other", 601))  # which closes in the batch after
    topic.send(body(60, "late", 6), body(61, "other", 700))  # too late for it
    alerts = drain(spark, jobs.velocity_alerts(jobs.transactions(topic.stream())), tmp_path)
    assert rows(alerts, "customer_id", "txn_count") == [("fast", 6)]


def test_multi_country_windows(spark, topic, tmp_path):
    topic.send(body(1, "near", 0), body(2, "near", 540, merchant_country="RU"), body(3, "far", 0),
               body(4, "far", 660, merchant_country="RU"))
    topic.send(body(5, "other", 7200))
    alerts = drain(spark, jobs.multi_country_alerts(jobs.transactions(topic.stream())), tmp_path)
    assert {r[0] for r in rows(alerts, "customer_id")} == {"near"}


def test_redelivered_message_counts_once(spark, topic, tmp_path):
    topic.send(body(1), body(1), body(2))
    topic.send(body(2), body(3))
    once = jobs.without_redelivery(jobs.transactions(topic.stream())).select("transaction_id")
    assert rows(drain(spark, once, tmp_path)) == [("1",), ("2",), ("3",)]


def test_routing_writes_both_topics_from_one_query(spark, topic, tmp_path):
    topic.send(body(1), body(2, amount=5000.0), body(3, amount=None, merchant_category="crypto_exchange"))
    topic.send("{not json", None)

    def routed(name, *settings):
        jobs.finish(jobs.start_routing(topic.stream(), f"{tmp_path}/{name}", f"{tmp_path}/{name}-offsets", *settings, trigger=None))
        return rows(spark.read.parquet(f"{tmp_path}/{name}").select("topic", F.get_json_object("value", "$.transaction_id")))

    assert routed("out") == [("approved-transactions", "1"), ("fraud-alerts", "2"), ("fraud-alerts", "3")]
    assert routed("strict", RuleConfig()) == [("approved-transactions", "1"), ("fraud-alerts", "2"), ("review-transactions", "3")]


def test_loaders_read_a_topic_independently(spark, topic, tmp_path):
    topic.send(body(1), body(2, amount=5000.0))
    jobs.finish(jobs.start_alerts(topic.stream(), f"{tmp_path}/alerts", f"{tmp_path}/o1", trigger=None))
    jobs.finish(jobs.start_raw_loader(topic.stream(), f"{tmp_path}/raw", f"{tmp_path}/o2", trigger=None))
    alerts = topics.read_messages(spark, "parquet", {}, f"{tmp_path}/alerts")
    jobs.finish(jobs.start_alert_loader(alerts, f"{tmp_path}/table", f"{tmp_path}/o3", trigger=None))
    loaded = jobs.loaded_rows(spark, f"{tmp_path}/table", FRAUD_ALERTS)
    assert rows(loaded, "transaction_id", "event_time") == [("2", at(0))]
    loaded = jobs.loaded_rows(spark, f"{tmp_path}/raw", TRANSACTIONS_RAW)
    assert rows(loaded, "transaction_id", "currency", "is_fraud_label", "ingested_at") == [
        ("1", "USD", False, START), ("2", "USD", False, START)
    ]


def test_raw_loader_keeps_aside_what_is_no_row_and_numbers_the_rest(spark, topic, tmp_path):
    topic.send(body(1), body(2))
    topic.send(None, "{not json", body(3, amount="much"), body(4, timestamp="soon"), body(5, customer=None))
    topic.send(body(6), body(7))
    jobs.finish(jobs.start_raw_loader(topic.stream(), f"{tmp_path}/raw", f"{tmp_path}/offsets", trigger=None))
    loaded = jobs.loaded_rows(spark, f"{tmp_path}/raw", TRANSACTIONS_RAW)
    assert rows(loaded, "transaction_id", "load_day") == [(n, START.date()) for n in "1267"]
    ids = [r["id"] for r in loaded.orderBy("batch_id", "id").collect()]
    assert ids == sorted(set(ids)) and ids[0] >= 1
    rejects = jobs.loaded_rejects(spark, f"{tmp_path}/raw")
    assert rejects.count() == 5 and rejects.where("message IS NULL").count() == 1
    reasons = {r["reason"] for r in rejects.collect()}
    assert "malformed" in reasons and "missing event_time" in reasons and "missing customer_id" in reasons


def test_alerts_that_come_after_the_start_are_found(spark, topic, tmp_path):
    alerts = f"{tmp_path}/alerts"
    schema = "customer_id STRING, event_time TIMESTAMP"
    frame(spark, schema, [("a", at(0))]).write.parquet(alerts)
    topic.send(body(1, "a", 60), body(2, "b", 60))
    stream = jobs.transactions(topic.stream()).select("transaction_id", "customer_id", "event_time")
    read = lambda: spark.read.parquet(alerts)
    query = jobs.start_repeat_offences(stream, read, f"{tmp_path}/hits", f"{tmp_path}/offsets", trigger="1 second")
    query.processAllAvailable()
    frame(spark, schema, [("b", at(90))]).write.mode("append").parquet(alerts)
    topic.send(body(3, "b", 120), body(4, "c", 120))
    query.processAllAvailable()
    query.stop()
    assert rows(spark.read.parquet(f"{tmp_path}/hits"), "transaction_id") == [("1",), ("3",)]


def test_changes_are_read_once_and_nothing_new_gives_no_rows(spark, tmp_path):
    table, schema = f"{tmp_path}/table", frame(spark, "k STRING", []).schema

    def feed(*keys):
        if keys:
            frame(spark, "k STRING", [(k,) for k in keys]).write.mode("append").parquet(table)
        jobs.finish(jobs.start_change_feed(spark, table, schema, f"{tmp_path}/changes", f"{tmp_path}/offsets"))

    feed("a")
    seen, mark = jobs.changes_after(spark, f"{tmp_path}/changes", schema)
    assert rows(seen) == [("a",)]
    feed()
    seen, same = jobs.changes_after(spark, f"{tmp_path}/changes", schema, mark)
    assert seen.count() == 0 and same == mark
    feed("b")
    feed("c")  # two runs between two reads
    seen, _ = jobs.changes_after(spark, f"{tmp_path}/changes", schema, mark)
    assert rows(seen) == [("b",), ("c",)]


def test_one_alert_per_run_of_windows(spark, topic, tmp_path):
    topic.send(body(1, "a", 0), body(2, "a", 60, merchant_country="RU"), body(3, "a", 7200), body(4, "a", 7230, merchant_country="NG"))
    topic.send(body(5, "other", 40_000))
    topic.send(body(6, "other", 40_001))
    transactions = jobs.transactions(topic.stream())
    alerts = drain(spark, jobs.first_multi_country_alerts(transactions), tmp_path)
    stored = topics.decode(spark.read.parquet(topic.path))
    batch = behaviour.first_of_each_run(behaviour.multi_country_alerts(stored))
    assert rows(alerts) == rows(batch) and alerts.count() == 2


def test_real_time_job_writes_topics_and_stops_as_one(spark, topic, tmp_path):
    topic.send(body(1), body(2, amount=5000.0))
    queries = jobs.start_real_time(topic.stream(), str(tmp_path / "run"), trigger="1 second")
    for query in queries:
        query.processAllAvailable()
    queries[0].stop()
    jobs.run_until_stopped(spark)
    assert not any(q.isActive for q in queries)
    assert spark.read.parquet(f"{tmp_path}/run/topics").count() == 2
    spark.streams.resetTerminated()


def test_profiles_grow_with_each_batch(spark, topic, tmp_path):
    topic.send(body(1, "a", 1, amount=5000.0), body(2, "b", 2, amount=5000.0))
    topic.send(body(3, "a", 3, amount=5000.0, merchant_country="RU"), body(4, "b", 4))
    alerts = jobs.scored(topic.stream()).where("fraud_score > 0")
    jobs.finish(jobs.start_profiles(alerts, f"{tmp_path}/changes", f"{tmp_path}/offsets", trigger=None))
    names = ("customer_id", "total_fraud_alerts", "cumulative_fraud_score", "last_seen_country", "risk_tier")
    assert rows(jobs.current_profiles(spark, f"{tmp_path}/changes"), *names) == [
        ("a", 2, 95, "US", "MEDIUM"), ("b", 1, 30, "US", "MEDIUM")
    ]
    before = rows(jobs.current_profiles(spark, f"{tmp_path}/changes"))
    jobs.compact_profiles(spark, f"{tmp_path}/changes")
    folders = [p.name[:5] for p in (tmp_path / "changes").iterdir() if "=" in p.name]
    assert rows(jobs.current_profiles(spark, f"{tmp_path}/changes")) == before and folders == ["upto="]


def test_running_totals(spark, topic, tmp_path):
    topic.send(body(1), body(2, is_fraud=True))
    topic.send(body(3), body(4))
    totals = serving.running_totals(jobs.transactions(topic.stream()), label="is_fraud")
    jobs.finish(jobs.to_numbered_batches(totals, f"{tmp_path}/t", f"{tmp_path}/o", "complete", trigger=None))
    assert rows(jobs.newest_batch(spark, f"{tmp_path}/t")) == [(4, 1, 25.0)]


def test_waiting_ends_with_the_first_query_and_stops_the_others(spark, topic, tmp_path):
    topic.send(body(1))
    frames = jobs.transactions(topic.stream()).select("transaction_id")
    ended, running = (jobs.to_files(frames, f"{tmp_path}/{n}", f"{tmp_path}/{n}-offsets", "1 second") for n in ("a", "b"))
    ended.stop()
    jobs.run_until_stopped(spark)
    assert not running.isActive
    spark.streams.resetTerminated()


def test_console_output_and_stop(spark, topic, tmp_path):
    topic.send(body(1))
    query = jobs.to_console(jobs.scored(topic.stream()), f"{tmp_path}/offsets", trigger="1 second")
    query.processAllAvailable()
    query.stop()
    assert not query.isActive and query.exception() is None


def test_state_can_live_on_disk(spark, topic, tmp_path):
    default = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    jobs.large_state(spark)
    try:
        topic.send(body(1), body(1))
        once = jobs.without_redelivery(jobs.transactions(topic.stream())).select("transaction_id")
        assert rows(drain(spark, once, tmp_path)) == [("1",)]
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", default)
