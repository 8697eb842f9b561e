"""Gold models and profiles from states by day, against the models over all rows."""

import random
import re
from datetime import date, datetime, timedelta

import pytest
from helpers import rows

from pyspark.sql import functions as F
from test_plans import plan
from tillwarden.plans import alert_views, gold, layers, nightly
from tillwarden.plans.daily_states import AlertDays, GoldStates, loaded_since
from tillwarden.schemas import FRAUD_ALERTS, TRANSACTIONS_RAW
from tillwarden.sources.tables import MergeConflict, TableStore

FLAGS = (
    "transaction_id string, customer_id string, customer_name string, merchant_category string, merchant_country string, "
    "amount double, event_time timestamp_ntz, transaction_date date, is_fraud_label boolean, fraud_score int, risk_level string, "
    "amount_flag boolean, merchant_flag boolean, geo_flag boolean, is_flagged boolean, loaded timestamp_ntz"
)
START = datetime(2024, 3, 1)


def flag_rows(seed, ids, load, days=5):
    """A hot customer, missing countries, categories and names, flags of all levels."""
    dice = random.Random(seed)
    out = []
    for i in ids:
        who = "hot" if dice.random() < 0.4 else f"c{dice.randrange(6)}"
        moment = START + timedelta(days=dice.randrange(days), seconds=dice.randrange(86400))
        score = dice.choice([0, 0, 30, 65, 100])
        level = {0: "LOW", 30: "MEDIUM", 65: "HIGH", 100: "CRITICAL"}[score]
        out.append(
            (
                str(i), who, None if who == "c3" else who.upper(), dice.choice(["shop", "travel", None]), dice.choice(["US", "RU", None]),
                dice.choice([None, round(dice.uniform(1, 2000), 2)]), moment, moment.date(), dice.choice([True, False, None]), score, level,
                score >= 30, score >= 65, score == 100, score > 0, START + timedelta(days=10 + load),
            )
        )
    return out


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path))


def merge(store, spark, made):
    store.recover("flags")
    return store.merge("flags", spark.createDataFrame(made, FLAGS), ["transaction_id"], "loaded", changed="transaction_date")


MODELS = ("fraud_summary_daily", "high_risk_customers", "merchant_risk_scores")


def same_models(store, states):
    flags = store.read("flags")
    for name in MODELS:
        mine, theirs = getattr(states, name)("2024-04-01 00:00:00"), getattr(gold, name)(flags, "2024-04-01 00:00:00")
        assert mine.dtypes == theirs.dtypes and rows(mine) == rows(theirs), name


def test_models_from_states_equal_models_over_all_rows(store, spark, tmp_path):
    merge(store, spark, flag_rows(1, range(200), 0))
    states = GoldStates(store, "flags")
    assert states.refresh() is None
    same_models(store, states)
    # Later flags of old rows, corrected amounts, rows that move to another day, new rows.
    merge(store, spark, flag_rows(2, [*range(0, 40, 7), *range(200, 230)], 1, days=2))
    states = GoldStates(store, "flags")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "flags_days").rglob("*.parquet")}
    changed = states.refresh()
    assert changed and set(changed) < {str((START + timedelta(days=d)).date()) for d in range(5)} | {changed[0]}
    same_models(store, states)
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "flags_days").rglob("*.parquet")}
    kept = [p for p in before if not any(f"state_day={d}" in str(p) for d in changed)]
    assert all(after[p] == before[p] for p in kept) and len(kept) < len(before)
    assert GoldStates(store, "flags").refresh() == []


def test_a_day_that_loses_its_last_row(store, spark):
    made = flag_rows(3, range(20), 0, days=1)
    alone = list(flag_rows(4, ["alone"], 0, days=1)[0])
    alone[6], alone[7] = START + timedelta(days=3), date(2024, 3, 4)
    merge(store, spark, [*made, tuple(alone)])
    GoldStates(store, "flags").refresh()
    merge(store, spark, flag_rows(5, ["alone"], 1, days=1))
    states = GoldStates(store, "flags")
    assert states.refresh() == ["2024-03-01", "2024-03-04"]
    same_models(store, states)
    assert states.fraud_summary_daily("2024-04-01 00:00:00").count() == 1


def test_a_refresh_that_stops_is_done_again(store, spark, monkeypatch):
    merge(store, spark, flag_rows(6, range(50), 0))
    GoldStates(store, "flags").refresh()
    merge(store, spark, flag_rows(7, range(20, 60), 1))
    states = GoldStates(store, "flags")

    def stops(*_):
        raise OSError

    with monkeypatch.context() as patch:
        patch.setattr(states.states["merchants"], "refresh", stops)
        with pytest.raises(OSError):
            states.refresh()
    states.refresh()
    same_models(store, states)


def test_states_of_nothing(store, spark):
    merge(store, spark, [])
    states = GoldStates(store, "flags")
    states.refresh()
    same_models(store, states)


def test_only_changed_days_are_asked_for(store, spark):
    merge(store, spark, flag_rows(8, range(30), 0))
    state = GoldStates(store, "flags").states["customers"]
    text = plan(state._parts(state.rows.where(state.day.isin([date(2024, 3, 1), date(2024, 3, 2)]))))
    assert "PushedFilters: [In(transaction_date" in text and "Python" not in text


def test_too_many_loads_behind_means_all_days(store, spark, monkeypatch):
    merge(store, spark, flag_rows(9, range(10), 0))
    GoldStates(store, "flags").refresh()
    monkeypatch.setattr("tillwarden.sources.tables.KEPT_CHANGES", 1)
    for load in (1, 2):
        merge(store, spark, flag_rows(9 + load, range(5), load))
    states = GoldStates(store, "flags")
    assert store.changed_days("flags", 1) is None and states.refresh() is None
    same_models(store, states)


def test_two_merges_at_once_do_not_lose_a_load(store, spark, monkeypatch):
    """Both have read the table's state before the other publishes; the second gives up."""
    merge(store, spark, flag_rows(12, range(5), 0))
    old = store._pointer("flags")
    other = TableStore(spark, store.root)
    store.merge("flags", spark.createDataFrame(flag_rows(13, range(5, 8), 1), FLAGS), ["transaction_id"], "loaded")
    monkeypatch.setattr(other, "_pointer", lambda name: old)
    late = spark.createDataFrame(flag_rows(14, range(8, 10), 1), FLAGS)
    with pytest.raises(MergeConflict):
        other.merge("flags", late, ["transaction_id"], "loaded")
    with pytest.raises(MergeConflict):
        other._publish("flags", store._pointer("flags"))
    assert store.read("flags").count() == 8
    store.merge("flags", late, ["transaction_id"], "loaded")
    assert store.read("flags").count() == 10


def test_appended_loads_replace_themselves_and_keep_equal_rows(store, spark):
    df = spark.createDataFrame([("a",), ("a",)], "k string")
    for number in (1, 2, 2):
        store.append("t", df, number)
    assert store.exists("t") and rows(store.read("t")) == [("a",)] * 4


# Profiles over 30 days

def alert_rows(spark, seed, count, batch, first=datetime(2024, 1, 20, 13), days=50):
    dice = random.Random(seed)
    blank = dict.fromkeys(FRAUD_ALERTS.names)
    out = []
    for n in range(count):
        moment = first + timedelta(days=dice.randrange(days), seconds=dice.randrange(86400))
        who = dice.choice(["hot", "hot", "a", "b", None])
        row = blank | dict(alert_id=n, transaction_id=f"{batch}-{n}", customer_id=who, event_time=moment, alerted_at=moment, merchant_country=dice.choice(["US", "RU", None]))
        out.append(tuple(row[c] for c in FRAUD_ALERTS.names))
    df = spark.createDataFrame(out, FRAUD_ALERTS).withColumn("fraud_score", F.lit(35).cast("decimal(5,2)"))
    return df.withColumns({"batch_id": F.lit(batch).cast("long"), "load_day": F.to_date("alerted_at")})


@pytest.mark.parametrize("moment, country", [("2024-02-29 00:00:00", "greatest"), ("2024-03-05 13:37:11", "latest")])
def test_profiles_from_states_equal_profiles_over_all_alerts(store, spark, moment, country):
    held = None
    for batch in range(3):
        more = alert_rows(spark, batch, 150, batch, days=50 if batch != 1 else 3)
        held = more if held is None else held.unionByName(more)
        days = AlertDays(store, held)
        days.refresh("batch_id")
        assert rows(days.profile_facts(moment, country)) == rows(alert_views.profile_facts(held, moment, country))
    assert AlertDays(store, held).refresh("batch_id") == []


def test_no_alerts_no_profiles(store, spark):
    none = alert_rows(spark, 1, 3, 0).limit(0)
    days = AlertDays(store, none)
    days.refresh("batch_id")
    assert days.profile_facts("2024-02-29 00:00:00").count() == 0


def test_a_refresh_opens_30_days_only(store, spark, tmp_path):
    held = alert_rows(spark, 4, 400, 0, days=90)
    held.write.partitionBy("load_day").parquet(f"{tmp_path}/alerts")
    stored = spark.read.parquet(f"{tmp_path}/alerts")
    days = AlertDays(store, stored)
    days.refresh("batch_id")
    facts = days.profile_facts("2024-04-10 12:00:00")
    text = plan(facts)
    assert "PartitionFilters: [isnotnull(state_day" in text and "load_day" in text.split("PartitionFilters")[2]
    loaded = {p.split("load_day=")[1][:10] for p in loaded_since(stored, "2024-03-11").inputFiles()}
    assert min(loaded) >= "2024-03-11" or len(loaded) == stored.select("load_day").distinct().count()
    assert rows(facts) == rows(alert_views.profile_facts(held, "2024-04-10 12:00:00"))


# The daily run by batches

def raw_rows(spark, ids, batch):
    blank = dict.fromkeys(TRANSACTIONS_RAW.names)
    out = []
    for i in ids:
        moment = datetime(2024, 3, 1 + i % 4, 10)
        row = blank | dict(transaction_id=str(i), customer_id=f"c{i % 5}", customer_name="n", event_time=moment, ingested_at=datetime(2024, 3, 6), amount=10.0 + i, currency="USD", merchant_category="shop", merchant_country="US")
        out.append(tuple(row[c] for c in TRANSACTIONS_RAW.names))
    return spark.createDataFrame(out, TRANSACTIONS_RAW).withColumn("batch_id", F.lit(batch).cast("long"))


def alerts_of(spark, ids, batch, moment):
    blank = dict.fromkeys(FRAUD_ALERTS.names)
    made = [
        tuple((blank | dict(transaction_id=str(i), customer_id=f"c{i % 5}", event_time=datetime(2024, 3, 1 + i % 4, 10), alerted_at=moment, risk_level="HIGH", merchant_country="US", amount_flag=True, merchant_flag=False, geo_flag=False))[c] for c in FRAUD_ALERTS.names)
        for i in ids
    ]
    df = spark.createDataFrame(made, FRAUD_ALERTS).withColumn("fraud_score", F.lit(40 + batch).cast("decimal(5,2)"))
    return df.withColumns({"batch_id": F.lit(batch).cast("long"), "load_day": F.to_date("alerted_at")})


def test_runs_by_batches_equal_one_run_over_all(spark, tmp_path):
    """Late, repeated, earlier and early alerts (before their transaction is cleaned), by number."""
    by_number, at_once = (TableStore(spark, str(tmp_path / n)) for n in ("numbers", "once"))
    alerts = alerts_of(spark, [1, 2, 30], 0, datetime(2024, 3, 6, 1))
    raw = raw_rows(spark, range(20), 0)
    bounds = (0.0, 100.0)
    nightly.run(by_number, raw, alerts, "2024-03-06 01:30:00", None, bounds)
    steps = [
        (alerts_of(spark, [3, 1], 1, datetime(2024, 3, 6, 1, 30)), None),
        (alerts_of(spark, [2, 31], 2, datetime(2024, 3, 6, 0, 30)), raw_rows(spark, range(20, 32), 1)),
    ]
    for more_alerts, more_raw in steps:
        alerts = alerts.unionByName(more_alerts)
        raw = raw if more_raw is None else raw.unionByName(more_raw)
        nightly.run(by_number, raw, alerts, "2024-03-06 02:00:00", None, bounds)
    nightly.run(at_once, raw, alerts, "2024-03-06 02:00:00", None, bounds)
    hidden = ("load_date", "load_number", "dbt_loaded_at", "silver_loaded_at", "fraud_flags_loaded_at", "refreshed_at", "updated_at")
    for table in ("fraud_flags", *MODELS, "customer_risk_profiles"):
        assert rows(by_number.read(table).drop(*hidden)) == rows(at_once.read(table).drop(*hidden)), table
    number = by_number.load_number("fraud_flags")
    nightly.run(by_number, raw, alerts, "2024-03-06 02:00:00", ["silver"])
    assert by_number.load_number("fraud_flags") == number


def test_outdated_ids_say_which_days_to_read(spark, store):
    """Of the cleaned rows only the load dates of outdated ids are opened."""
    text = "transaction_id STRING, is_flagged BOOLEAN, silver_loaded_at TIMESTAMP_NTZ, alerted_at TIMESTAMP_NTZ"
    facts = [F.lit(v).alias(c) for c, v in layers.NO_ALERT.items()] + [F.lit(None).cast("string").alias("fraud_reason")]
    held = [("a", False, START, None), ("b", True, START + timedelta(days=1), START), ("c", False, START, None)]
    flags = spark.createDataFrame(held, text.replace("STRING", "string")).select("*", *facts)
    news = alerts_of(spark, [0], 0, START + timedelta(days=2)).drop("transaction_id")
    news = news.crossJoin(spark.createDataFrame([("a",), ("b",), ("z",)], "transaction_id string"))
    assert rows(layers.outdated_flags(flags, news, all_alerts=False)) == [("a", START.date())]
    assert rows(layers.outdated_flags(flags, news)) == [("a", START.date()), ("b", date(2024, 3, 2))]
    store.merge("clean", flags, ["transaction_id"], "silver_loaded_at")
    read = store.read("clean").where(F.col("load_date").isin([START.date()]))
    assert re.search(r"PartitionFilters: \[[^\]]*load_date", plan(read)) and read.count() == 2
