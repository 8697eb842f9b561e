import random
from collections import Counter
from datetime import date, datetime

from helpers import at, frame, rows

from pyspark.sql import functions as F
from tillwarden.operators import ranking
from tillwarden.plans import alert_views, gold, layers
from tillwarden.schemas import CUSTOMER_RISK_PROFILES, TRANSACTIONS_RAW

AS_OF = "2024-03-02 00:00:00"
RAW = dict.fromkeys(TRANSACTIONS_RAW.names) | dict(
    id=1, transaction_id="t", customer_id="c", event_time=at(0), ingested_at=at(0), amount=9.999, currency=" usd ",
    merchant_name=" Shop ", merchant_category=" Grocery ", merchant_country=" us", customer_lat=91.0, customer_lon=-180.0,
    card_type="visa",
)


def raw(spark, *changes):
    made = [RAW | c for c in changes]
    return spark.createDataFrame([tuple(r[n] for n in TRANSACTIONS_RAW.names) for r in made], TRANSACTIONS_RAW)


def test_cleaning(spark):
    bronze = layers.bronze_raw_transactions(raw(spark, {}), AS_OF)
    row = layers.silver_clean_transactions(bronze, AS_OF).first()
    assert row["amount"] == 10.0 and row["amount_bucket"] == "micro"  # bucket of the amount before rounding
    assert (row["currency"], row["merchant_name"], row["merchant_category"]) == ("USD", "Shop", "grocery")
    assert (row["merchant_country"], row["card_type"]) == ("US", "VISA")
    assert (row["customer_lat"], row["customer_lon"]) == (None, -180.0)
    assert (row["transaction_date"], row["transaction_hour"], row["day_of_week"]) == (date(2024, 3, 1), 12, 6)
    assert row["is_weekend"] is False


def test_weekend_is_saturday_and_sunday(spark):
    days = [{"transaction_id": str(d), "event_time": datetime(2024, 3, d)} for d in range(1, 8)]
    clean = layers.silver_clean_transactions(layers.bronze_raw_transactions(raw(spark, *days), AS_OF), AS_OF)
    assert [r[0] for r in rows(clean.where("is_weekend"), "transaction_id")] == ["2", "3"]


def test_first_copy_wins_within_a_load_and_last_load_across(spark):
    first = layers.bronze_raw_transactions(raw(spark, {"amount": 1.0}, {"amount": 2.0, "event_time": at(-5)}), "2024-03-02")
    silver = layers.silver_clean_transactions(first, "2024-03-02")
    assert rows(silver, "amount") == [(2.0,)]
    second = layers.bronze_raw_transactions(raw(spark, {"amount": 7.0, "ingested_at": at(60)}), "2024-03-03", first)
    both = first.unionByName(second)
    assert rows(layers.silver_clean_transactions(both, "2024-03-03", silver), "amount") == [(7.0,)]


def test_bronze_takes_only_newer_rows(spark):
    data = raw(spark, {"transaction_id": "a"}, {"transaction_id": "b", "ingested_at": at(1)})
    table = layers.bronze_raw_transactions(data.where("transaction_id = 'a'"), "2024-03-02")
    assert rows(layers.bronze_raw_transactions(data, "2024-03-03", table), "transaction_id") == [("b",)]
    assert layers.bronze_raw_transactions(data, "2024-03-03", table.where("false")).count() == 2


def test_split_incomplete_keeps_every_row(spark):
    data = raw(spark, {}, {"amount": None}, {"customer_id": None}, {"event_time": None})
    good, bad = layers.split_incomplete(data)
    assert (good.count(), bad.count()) == (1, 3)


ALERTS = (
    "transaction_id STRING, customer_id STRING, event_time TIMESTAMP_NTZ, amount DOUBLE, merchant_category STRING, "
    "merchant_country STRING, fraud_score INT, risk_level STRING, fraud_reason STRING, amount_flag BOOLEAN, "
    "merchant_flag BOOLEAN, geo_flag BOOLEAN, alerted_at TIMESTAMP_NTZ"
)


def alert(t, customer="c", second=0, score=35, country="RU", alerted=0, amount=10.0):
    return (t, customer, at(second), amount, "unknown", country, score, "HIGH", "why", False, True, False, at(alerted))


def test_flags_default_and_duplicate_alerts(spark):
    data = raw(spark, {"transaction_id": "a"}, {"transaction_id": "b"})
    clean = layers.silver_clean_transactions(layers.bronze_raw_transactions(data, AS_OF), AS_OF)
    alerts = frame(spark, ALERTS, [alert("a", alerted=5, score=65), alert("a", alerted=1, score=35)])
    names = ("transaction_id", "fraud_score", "risk_level", "is_flagged", "merchant_flag", "fraud_reason")
    assert rows(layers.silver_fraud_flags(clean, alerts, AS_OF), *names) == [
        ("a", 35, "HIGH", True, True, "why"), ("b", 0, "LOW", False, False, None)
    ]
    assert layers.silver_fraud_flags(clean, alerts, AS_OF, dedup_alerts=False).count() == 3


def test_late_alerts_are_an_option(spark):
    data = raw(spark, {"transaction_id": "a"}, {"transaction_id": "b"})
    clean = layers.silver_clean_transactions(layers.bronze_raw_transactions(data, AS_OF), AS_OF)
    table = layers.silver_fraud_flags(clean, frame(spark, ALERTS, [alert("b")]), AS_OF)
    alerts = frame(spark, ALERTS, [alert("a"), alert("b")])
    later = layers.silver_fraud_flags(clean, alerts, "2024-03-03", table)
    assert rows(later, "transaction_id", "is_flagged") == [("a", True)]
    assert layers.silver_fraud_flags(clean, alerts, "2024-03-03", table, late_alerts=False).count() == 0


def _flags(spark, seed=3):
    dice = random.Random(seed)
    out = []
    for i in range(600):
        customer = "hot" if dice.random() < 0.4 else f"c{dice.randrange(25)}"
        score = dice.choice([0, 0, 0, 30, 35, 65, 100])
        level = {0: "LOW", 30: "MEDIUM", 35: "HIGH", 65: "HIGH", 100: "CRITICAL"}[score]
        out.append((str(i), customer, customer.upper(), at(i), round(dice.uniform(0, 90), 2), dice.choice(["x", "y", None]),
                    dice.choice(["US", "RU", "GB", None]), score, level, score > 0))
    text = ("transaction_id STRING, customer_id STRING, customer_name STRING, event_time TIMESTAMP_NTZ, amount DOUBLE, "
            "merchant_category STRING, merchant_country STRING, fraud_score INT, risk_level STRING, is_flagged BOOLEAN")
    return out, frame(spark, text, out)


def test_customer_ranking_equals_brute_force(spark):
    data, flags = _flags(spark)
    result = {r["customer_id"]: r for r in gold.high_risk_customers(flags, AS_OF).collect()}
    groups = {}
    for row in data:
        groups.setdefault(row[1], []).append(row)
    keys = {}
    for customer, mine in groups.items():
        hits = [r for r in mine if r[9]]
        if not hits:
            assert customer not in result
            continue
        got = result[customer]
        keys[customer] = (len(hits), sum(r[7] for r in hits) / len(hits))
        places = Counter(r[6] for r in mine if r[6])
        assert got["most_common_country"] == min(places, key=lambda k: (-places[k], k))
        assert (got["countries_used"], got["total_transactions"], got["total_flags"]) == (len(places), len(mine), len(hits))
        assert abs(got["total_spend_usd"] - sum(r[4] for r in mine)) < 1e-6
        assert got["last_flagged"] == max(r[3] for r in hits)
    for customer, key in keys.items():
        assert result[customer]["fraud_rank"] == 1 + sum(other > key for other in keys.values())


def test_models_of_empty_tables_are_empty(spark):
    _, flags = _flags(spark)
    assert gold.high_risk_customers(flags.where("not is_flagged"), AS_OF).count() == 0
    assert gold.merchant_risk_scores(flags.where("false"), AS_OF).count() == 0
    assert alert_views.customer_alert_view(frame(spark, ALERTS, [])).count() == 0


def test_merchant_scores_count_each_customer_once(spark):
    data, flags = _flags(spark, 8)
    for got in gold.merchant_risk_scores(flags, AS_OF).collect():
        mine = [r for r in data if r[5] == got["merchant_category"]]
        assert got["unique_customers"] == len({r[1] for r in mine})
        assert got["countries_seen"] == len({r[6] for r in mine} - {None})
        assert got["total_flags"] == sum(r[9] for r in mine)


def test_global_positions_with_ties(spark):
    values = [(i, 5 if i % 3 else i % 11) for i in range(300)]
    df = frame(spark, "n BIGINT, score BIGINT", values)
    numbered = ranking.global_row_number(df, [F.desc("score"), F.asc("n")], "place")
    wanted = {n: i + 1 for i, (n, _) in enumerate(sorted(values, key=lambda v: (-v[1], v[0])))}
    assert dict(rows(numbered, "n", "place")) == wanted
    ranked = ranking.global_rank(df, {"score": F.desc("score")}, "place")
    assert all(r["place"] == 1 + sum(s > r["score"] for _, s in values) for r in ranked.collect())
    assert ranked.count() == len(values)


def test_customer_view_lists_countries_and_tiers(spark):
    alerts = frame(spark, ALERTS, [alert("1", "a", score=30, country="US"), alert("2", "a", score=65, country="RU"),
                                   alert("3", "a", score=35, country="RU"), alert("4", "b", score=30, country=None)])
    names = ("customer_id", "fraud_rank", "countries_used", "risk_tier", "fraud_rate_pct", "total_flags")
    assert rows(alert_views.customer_alert_view(alerts), *names) == [
        ("a", 1, "RU, US", "CRITICAL", 43.3, 3), ("b", 2, "", "MEDIUM", 30.0, 1)
    ]


def test_alert_views_for_sql_users(spark):
    alert_views.create_views(frame(spark, ALERTS, [alert("1", "a"), alert("2", "b", score=65)]))
    assert spark.sql("SELECT total_transactions, fraud_flag_rate_pct FROM fraud_summary_daily").first()[:] == (2, 100.0)
    assert spark.sql("SELECT merchant_risk_tier FROM merchant_risk_scores").first()[0] == "HIGH"
    assert [r[0] for r in spark.sql("SELECT customer_id FROM high_risk_customers ORDER BY fraud_rank").collect()] == ["b", "a"]


def test_profile_refresh_updates_inserts_and_keeps(spark):
    profiles = spark.createDataFrame(
        [("old", 40, 9, 0.5, 300, at(-9), "GB", "CRITICAL", at(-9)), ("seen", 12, 1, 0.1, 30, at(-9), "GB", "MEDIUM", at(-9))],
        CUSTOMER_RISK_PROFILES,
    )
    alerts = frame(
        spark, ALERTS,
        [alert("1", "seen", 10, country="US"), alert("2", "seen", 20, country="RU"), alert("3", "seen", 30, country="KP")]
        + [alert("4", "new", 5)] + [alert("5", "old", -40 * 86400)],
    )
    done = alert_views.refresh_customer_risk_profiles(profiles, alerts, AS_OF)
    names = ("customer_id", "total_transactions", "total_fraud_alerts", "cumulative_fraud_score", "last_seen_country", "risk_tier")
    assert rows(done, *names) == [
        ("new", 0, 1, 35, "RU", "MEDIUM"), ("old", 40, 9, 300, "GB", "CRITICAL"), ("seen", 12, 3, 105, "US", "HIGH")
    ]
    again = alert_views.refresh_customer_risk_profiles(done, alerts, AS_OF)
    assert rows(again, *names) == rows(done, *names)
    latest = alert_views.profile_facts(alerts, AS_OF, last_country="latest")
    assert rows(latest, "customer_id", "last_seen_country") == [("new", "RU"), ("seen", "KP")]
