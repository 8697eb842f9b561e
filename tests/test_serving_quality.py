import pytest
from helpers import at, frame, rows

from tillwarden.operators import quality
from tillwarden.plans import serving

FEED = (
    "transaction_id STRING, customer_id STRING, event_time TIMESTAMP_NTZ, amount DOUBLE, merchant_name STRING, "
    "merchant_category STRING, merchant_country STRING, customer_lat DOUBLE, customer_lon DOUBLE, fraud_score INT, "
    "risk_level STRING, fraud_reason STRING"
)


def alert(n, level="HIGH", score=35, lat=1.0, lon=1.0, customer="CUST_00001", amount=10.0):
    return (f"{n:04d}", customer, at(n), amount, "m", "c", "RU", lat, lon, score, level, f"r{n}")


def test_feed_reads_the_last_200_oldest_first(spark):
    df = frame(spark, FEED, [alert(n, "HIGH" if n % 2 else "LOW") for n in range(300)])
    oldest = [r["fraud_reason"] for r in serving.alert_feed(df).collect()]
    assert oldest == [f"r{n}" for n in range(101, 141, 2)]
    newest = [r["fraud_reason"] for r in serving.alert_feed(df, newest_first=True).collect()]
    assert newest[0] == "r299" and len(newest) == 20
    assert serving.alert_feed(df, levels=()).first()["fraud_reason"] == "r100"
    assert serving.alert_feed(df.drop("merchant_category"), levels=("LOW",)).columns[1:3] == ["amount", "merchant_country"]


def test_kpis_of_an_empty_buffer_are_zero(spark):
    empty = frame(spark, FEED, [])
    assert rows(serving.kpi_buffer(empty)) == [(0, 0, 0.0, 0.0, 0.0)]


def test_hotspots_need_a_real_place(spark):
    places = [(1.0, 2.0), (0.0, 2.0), (1.0, 0.0), (None, 2.0), (1.0, None)]
    df = frame(spark, FEED, [alert(n, lat=a, lon=b) for n, (a, b) in enumerate(places)] + [alert(9, score=0)])
    assert rows(serving.geo_hotspots(df), "fraud_reason") == [("r0",)]


def test_lookup_takes_text_as_a_value(spark):
    df = frame(spark, FEED, [alert(1), alert(2, customer="CUST_00002")])
    assert rows(serving.recent_alerts(df, "cust_00001"), "transaction_id") == [("0001",)]
    assert serving.recent_alerts(df, "x' OR '1'='1").count() == 0


def test_time_windows(spark):
    df = frame(spark, FEED, [alert(0), alert(3600), alert(3601)])
    assert rows(serving.within_window(df, "Last 1 hour", at(7200)), "transaction_id") == [("3600",), ("3601",)]
    assert serving.within_window(df, "All time", at(7200)).count() == 3


def test_rate_bands(spark):
    df = frame(spark, "transaction_date STRING, fraud_flag_rate_pct DOUBLE", [("a", 1.99), ("b", 2.0), ("c", 5.0), ("d", 40.0)])
    assert rows(serving.fraud_rate_bands(df), "band", "alarm") == sorted(
        [("0-2", False), ("2-5", False), ("5-10", True), ("5-10", True)], key=repr
    )


FLAGS = "transaction_id STRING, customer_id STRING, risk_level STRING, is_flagged BOOLEAN"


def test_model_checks_count_violations(spark):
    good = [(str(n), "c", "LOW", n < 3) for n in range(100)]
    assert rows(quality.model_checks(frame(spark, FLAGS, good)).where("not passed")) == []
    bad = frame(spark, FLAGS, good + [("1", None, "ODD", True), (None, "c", None, True), (None, "c", "LOW", True)])
    found = dict(rows(quality.model_checks(bad), "check_name", "violations"))
    assert found == {
        "not_null_transaction_id": 2, "not_null_customer_id": 1, "accepted_values_risk_level": 1, "rate_is_flagged": 1,
        "unique_transaction_id": 1,
    }
    with pytest.raises(quality.CheckFailed, match="unique_transaction_id failed on fraud_flags: 1"):
        quality.require(quality.model_checks(bad))


def test_freshness(spark):
    df = frame(spark, "ingested_at TIMESTAMP_NTZ", [(at(0),)])
    assert rows(quality.freshness(df, at(7200)), "passed") == [(True,)]
    with pytest.raises(quality.CheckFailed):
        quality.require(quality.freshness(df, at(7201)))


def test_rows_after_as_of_are_not_fresh(spark):
    df = frame(spark, "ingested_at TIMESTAMP_NTZ", [(at(10 * 86400),)])
    assert quality.freshness(df, at(0)).first()["passed"] is False
    assert quality.freshness(df, at(10 * 86400 + 60)).first()["passed"] is True
