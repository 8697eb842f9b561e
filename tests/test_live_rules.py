"""Streams against streams, alerts at the payment that is one too many, and the account of late rows."""

import random
from datetime import timedelta

import numpy as np
import pytest
from helpers import at, frame, rows
from test_streams import Topic, body, drain

from pyspark.sql import functions as F
from tillwarden.config import RuleConfig
from tillwarden.operators import behaviour
from tillwarden.sources import messages as topics
from tillwarden.streaming import bursts, jobs

MINUTE = timedelta(minutes=1)


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


@pytest.fixture
def other(spark, tmp_path):
    return Topic(spark, tmp_path / "other")


def payments(topic):
    return jobs.transactions(topic.stream()).select("transaction_id", "customer_id", "event_time")


def test_payments_meet_alerts_of_two_streams(spark, topic, other, tmp_path):
    """Alerts before and after their payments in arrival, at both ends of the look-back, copies,
    a hot customer, missing customers."""
    dice = random.Random(2)
    asked = [(n, "hot" if n % 3 else f"c{n % 7}", dice.randrange(0, 400)) for n in range(120)]
    raised = [(n, dice.choice(["hot", "c1", "c2", "c6"]), dice.choice([0, 60, dice.randrange(0, 400)])) for n in range(25)]
    topic.send(*(body(n, c, s) for n, c, s in asked), body("edge", "e", 100), body("out", "e", 101), body("none", None, 50))
    other.send(*(body(n, c, s) for n, c, s in raised), body(900, "e", 40), body(901, None, 50), body(902, "hot", None or 60))
    hits = jobs.repeat_offences(payments(topic), payments(other), MINUTE)
    got = {r[0] for r in rows(drain(spark, hits, tmp_path), "transaction_id")}
    alerts = [(c, s) for _, c, s in raised] + [("hot", 60)]
    assert got == {"edge"} | {str(n) for n, c, s in asked if any(a == c and s - 60 <= t <= s for a, t in alerts)}


def test_the_state_of_the_join_is_evicted(spark, topic, other, tmp_path):
    """An hour of payments and alerts, one batch a minute: the state holds minutes, not the hour."""
    for minute in range(8):
        topic.send(*(body(f"{minute}-{n}", f"c{n}", minute * 600 + n) for n in range(20)))
        other.send(*(body(f"{minute}-{n}", f"d{n}", minute * 600 + n) for n in range(20)))
    query = jobs.to_files(jobs.repeat_offences(payments(topic), payments(other), MINUTE), f"{tmp_path}/rows", f"{tmp_path}/offsets", trigger=None)
    jobs.finish(query)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert held and max(held) <= 3 * 60 and held[-1] < 8 * 20


RULES = RuleConfig(velocity_window=MINUTE, velocity_limit=3, null_policy="false")


def told(spark, topic, tmp_path):
    jobs.large_state(spark)
    try:
        return drain(spark, bursts.early_velocity_alerts(jobs.transactions(topic.stream(), "10 minutes"), RULES), tmp_path)
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_early_alerts_are_those_of_the_trailing_windows(spark, topic, tmp_path):
    """Out of order within the watermark, copies of an instant, a hot customer, four batches."""
    dice = random.Random(8)
    sent = [(n, "hot" if dice.random() < 0.4 else f"c{n % 9}", dice.choice([0, 60, dice.randrange(0, 300)])) for n in range(160)]
    for k in range(0, 160, 40):
        topic.send(*(body(*x) for x in sent[k : k + 40]), body(f"n{k}", None, 5))
    alerts = told(spark, topic, tmp_path)
    flagged = behaviour.with_velocity(topics.decode(spark.read.parquet(topic.path)), RULES).where("velocity_flag")
    expected = {(r["customer_id"], r["event_time"]) for r in flagged.select("customer_id", "event_time").collect()}
    got = [(r["customer_id"], r["event_time"]) for r in alerts.collect()]
    assert expected and len(got) == len(set(got)) and set(got) == expected


def test_the_alert_comes_with_the_payment_and_not_with_the_watermark(spark, topic, tmp_path):
    topic.send(body(1, "a", 0), body(2, "a", 10), body(3, "a", 20))
    topic.send(body(4, "a", 30))
    assert rows(told(spark, topic, tmp_path), "customer_id", "event_time", "recent_transactions") == [("a", at(30), 4)]


def test_burst_state_is_dropped_behind_the_watermark(spark, topic, tmp_path):
    for minute in range(6):
        topic.send(*(body(f"{minute}-{n}", f"c{minute}-{n}", minute * 1200) for n in range(10)))
    jobs.large_state(spark)
    try:
        query = jobs.to_files(bursts.early_velocity_alerts(jobs.transactions(topic.stream()), RULES), f"{tmp_path}/rows", f"{tmp_path}/offsets", None)
        jobs.finish(query)
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    with_state = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    values = [int(s["customMetrics"].get("numValueStateVars", 1)) and s["numRowsTotal"] for s in with_state]
    assert max(values) < 6 * 10 * 4 and values[-1] <= max(values) / 2


def test_trailing_counts_of_instants():
    instants = bursts.counted(np.zeros(0, bursts.INSTANT), np.array([5, 0, 5, 9, 20]))
    instants = bursts.counted(instants, np.array([0, 10]))
    assert instants["at"].tolist() == [0, 5, 9, 10, 20] and instants["n"].tolist() == [2, 2, 1, 1, 1]
    assert bursts.trailing(instants, 9).tolist() == [2, 4, 5, 4, 1]


def test_kept_and_late_are_all_that_was_sent(spark, topic, tmp_path):
    topic.send(body(1, "a", 100), body(2, "a", 200))
    topic.send(body(3, "a", 0), body(4, "a", 250))  # no watermark is in force for these yet
    topic.send(body(5, "a", 170), body(6, "a", 171), body(7, "a", 400))
    topic.send(body(8, "a", 220), body(9, "a", 221), body(10, "a", 260, timestamp=None))
    jobs.finish(jobs.start_accounted(jobs.transactions(topic.stream()), f"{tmp_path}/out", f"{tmp_path}/offsets", trigger=None))
    kept, late = (spark.read.parquet(f"{tmp_path}/out/{k}") for k in ("kept", "late"))
    assert rows(late, "transaction_id", "watermark") == [("5", at(170)), ("8", at(220))]
    assert rows(kept, "transaction_id") == sorted((str(n),) for n in (1, 2, 3, 4, 6, 7, 9, 10))


def test_windows_and_their_late_rows_are_all_that_was_sent(spark, topic, tmp_path):
    """Rows that the window query counted, and the late rows by its windows, over the same batches."""
    dice = random.Random(4)
    for k in range(4):
        topic.send(*(body(f"{k}-{n}", f"c{n % 3}", k * 90 + dice.randrange(-200, 90)) for n in range(40)))
    topic.send(body("end", "z", 10_000))
    topic.send(body("close", "z", 10_001))
    every = RuleConfig(velocity_window=MINUTE, velocity_limit=0)
    windows = drain(spark, jobs.velocity_alerts(jobs.transactions(topic.stream()), every), tmp_path)
    counted = windows.agg(F.sum("txn_count")).first()[0]
    job = jobs.start_accounted(jobs.transactions(topic.stream()), f"{tmp_path}/out", f"{tmp_path}/o2", jobs.window_closed(MINUTE), trigger=None)
    jobs.finish(job)
    late = spark.read.parquet(f"{tmp_path}/out/late").count()
    assert late > 0 and counted + late == 160
