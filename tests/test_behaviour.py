import random
from datetime import datetime, timedelta

from helpers import at, frame, rows, visits

from tillwarden.config import RuleConfig
from tillwarden.operators import behaviour
from tillwarden.plans import alert_views
from tillwarden.schemas import CUSTOMER_RISK_PROFILES

MINUTE = timedelta(minutes=1)


def test_velocity_needs_more_than_five_in_a_minute(spark):
    six = [(i, "six", i * 9, "US") for i in range(6)]
    five = [(10 + i, "five", i * 9, "US") for i in range(5)]
    split = [(20 + i, "split", 30 + i * 9, "US") for i in range(6)]  # over two tumbling windows
    df = visits(spark, six + five + split)
    assert rows(behaviour.velocity_alerts(df), "customer_id", "txn_count", "rule", "risk_level") == [
        ("six", 6, "VELOCITY", "CRITICAL")
    ]
    trailing = behaviour.with_velocity(df).where("velocity_flag")
    assert rows(trailing, "transaction_id") == [("25",), ("5",)]


def test_trailing_window_includes_its_start(spark):
    df = visits(spark, [(1, "c", 0, "US"), (2, "c", 60, "US"), (3, "c", 121, "US")])
    counted = behaviour.with_velocity(df)
    assert rows(counted, "transaction_id", "recent_transactions") == [("1", 1), ("2", 2), ("3", 1)]


def test_two_countries_within_ten_minutes(spark):
    df = visits(spark, [(1, "near", 0, "US"), (2, "near", 540, "RU"), (3, "far", 0, "US"), (4, "far", 660, "RU")])
    assert rows(behaviour.with_country_spread(df).where("multi_country_flag"), "transaction_id") == [("2",)]
    alerts = behaviour.multi_country_alerts(df)
    assert {r[0] for r in rows(alerts, "customer_id")} == {"near"}
    assert rows(behaviour.first_of_each_run(alerts), "customer_id", "window_start") == [("near", at(0))]


def _random_visits(seed, hot_share=0.4):
    """A hot customer, many copies of an instant, times before and after 1970, NULL countries."""
    dice = random.Random(seed)
    out = []
    for i in range(400):
        customer = "hot" if dice.random() < hot_share else f"c{dice.randrange(12)}"
        second = dice.choice([0, 0, 37, dice.randrange(0, 4000), -1709294400 + dice.randrange(-900, 900)])
        out.append((i, customer, second, dice.choice(["US", "RU", "GB", "NG", None])))
    return out


def test_trailing_measures_equal_brute_force(spark):
    for seed, look_back in ((1, 60), (2, 600), (3, 1)):
        data = _random_visits(seed)
        config = RuleConfig(velocity_window=timedelta(seconds=look_back), geo_window=timedelta(seconds=look_back))
        df = visits(spark, data)
        counts = dict(rows(behaviour.with_velocity(df, config), "transaction_id", "recent_transactions"))
        spread = dict(rows(behaviour.with_country_spread(df, config), "transaction_id", "recent_countries"))
        for i, customer, second, _ in data:
            near = [v for v in data if v[1] == customer and second - look_back <= v[2] <= second]
            assert counts[str(i)] == len(near)
            assert spread[str(i)] == len({v[3] for v in near} - {None})


def test_repeat_offences_equal_brute_force(spark):
    for seed, look_back in ((4, 600), (5, 60)):
        data, alerts = _random_visits(seed), _random_visits(seed + 50)[:60]
        found = behaviour.repeat_offences(visits(spark, data), visits(spark, alerts), timedelta(seconds=look_back))
        wanted = sorted(
            (str(i),)
            for i, customer, second, _ in data
            if any(a[1] == customer and second - look_back <= a[2] <= second for a in alerts)
        )
        assert sorted(rows(found, "transaction_id")) == wanted
        assert found.columns == visits(spark, data[:1]).columns


def test_profile_lookup_defaults_to_unknown(spark):
    known = spark.createDataFrame([("known", 9, 3, 0.0, 90, at(0), "US", "HIGH", at(0))], CUSTOMER_RISK_PROFILES)
    df = frame(spark, "transaction_id STRING, customer_id STRING", [("1", "known"), ("2", "new")])
    got = rows(behaviour.with_profile(df, known), "transaction_id", "risk_tier", "total_fraud_alerts", "repeat_offender")
    assert got == [("1", "HIGH", 3, True), ("2", "UNKNOWN", 0, False)]


def test_times_do_not_depend_on_the_session_zone(spark):
    """Two events an hour apart around a change of clocks are not within a minute."""
    df = frame(
        spark,
        "customer_id STRING, event_time TIMESTAMP_NTZ, merchant_country STRING",
        [("c", datetime(2024, 3, 10, 1, 59, 59), "US"), ("c", datetime(2024, 3, 10, 2, 30), "US"), ("c", datetime(2024, 3, 10, 3, 0, 1), "RU")],
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        counts = behaviour.trailing_count(df, timedelta(minutes=1)).collect()
        assert sorted((r["event_time"], r["recent_transactions"]) for r in counts) == [(r["event_time"], 1) for r in df.orderBy("event_time").collect()]
        assert behaviour.repeat_offences(df, df.where("merchant_country = 'RU'"), timedelta(minutes=10)).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def _versions(spark, data, extra=()):
    text = "customer_id STRING, valid_from TIMESTAMP_NTZ, risk_tier STRING, total_fraud_alerts BIGINT, last_alert_time TIMESTAMP_NTZ"
    made = [(c, at(s), "HIGH", n, at(s)) for c, s, n in data]
    return frame(spark, text, made + list(extra))


def test_profiles_as_of_equal_brute_force(spark):
    """A hot customer with many versions at one instant, rows before the first version and before
    1970, customers without any, missing customers and times, cells of very different sizes."""
    data = _random_visits(11)
    dice = random.Random(5)
    states = [(f"c{dice.randrange(9)}" if dice.random() < 0.6 else "hot", dice.choice([0, 37, dice.randrange(-9000, 9000), -1709294400]), n) for n in range(200)]
    df = visits(spark, data).unionByName(
        frame(
            spark,
            "transaction_id STRING, customer_id STRING, event_time TIMESTAMP_NTZ, merchant_country STRING",
            [("x", None, at(0), "US"), ("y", "hot", None, "US"), ("z", None, None, None)],
        )
    )
    versions = _versions(spark, states, [(None, at(0), "HIGH", 7, at(0)), ("hot", None, "HIGH", 8, None)])
    for width in (timedelta(seconds=40), timedelta(days=1), timedelta(days=40_000)):
        known = behaviour.as_of(df, versions, "customer_id", "event_time", "valid_from", ["total_fraud_alerts"], width)
        got = dict(rows(known, "transaction_id", "total_fraud_alerts"))
        assert len(got) == len(data) + 3 and got["x"] is got["y"] is got["z"] is None
        for i, customer, second, _ in data:
            before = [(s, n) for c, s, n in states if c == customer and s <= second]
            assert got[str(i)] == (max(before)[1] if before else None)
    told = behaviour.with_profile_as_of(df, versions)
    assert rows(told.where("transaction_id = 'x'"), "risk_tier", "total_fraud_alerts", "repeat_offender") == [("UNKNOWN", 0, False)]


def test_profile_versions_equal_brute_force(spark):
    data = [(i, c, s, k) for i, c, s, k in _random_visits(21)]
    alerts = visits(spark, data).selectExpr("customer_id", "event_time", "merchant_country", "CAST(transaction_id AS INT) % 90 AS fraud_score")
    alerts = alerts.unionByName(alerts.limit(2).selectExpr("NULL AS customer_id", "event_time", "merchant_country", "fraud_score"))
    alerts = alerts.unionByName(alerts.limit(2).selectExpr("customer_id", "NULL AS event_time", "merchant_country", "fraud_score"))
    for width in (timedelta(seconds=50), timedelta(days=1)):
        got = {(r["customer_id"], r["valid_from"]): r for r in alert_views.profile_versions(alerts, width).collect()}
        assert set(got) == {(c, at(s)) for _, c, s, _ in data}
        for (customer, moment), r in got.items():
            upto = [v for v in data if v[1] == customer and at(v[2]) <= moment]
            later = [at(v[2]) for v in data if v[1] == customer and at(v[2]) > moment]
            countries = [v[3] for v in upto if v[3] is not None]
            assert (r["total_fraud_alerts"], r["cumulative_fraud_score"]) == (len(upto), sum(v[0] % 90 for v in upto))
            assert r["valid_to"] == min(later, default=None) and r["last_alert_time"] == moment
            assert r["last_seen_country"] == max(countries, default=None)


def test_no_versions_and_no_rows(spark):
    df = visits(spark, [(1, "c", 0, "US")])
    assert rows(behaviour.with_profile_as_of(df, _versions(spark, [])), "transaction_id", "risk_tier") == [("1", "UNKNOWN")]
    assert behaviour.with_profile_as_of(df.limit(0), _versions(spark, [("c", 0, 1)])).count() == 0
