import pytest
from helpers import transaction

from tillwarden.config import RuleConfig
from tillwarden.operators import rules

LENIENT = RuleConfig(null_policy="false")


def scored(spark, config=rules.DEFAULT_RULES, **changes):
    return rules.apply_fraud_detection(transaction(spark, **changes), config).first()


@pytest.mark.parametrize("amount, flagged", [(99.99, False), (1000.0, False), (1000.01, True), (1500.0, True), (9999.0, True)])
def test_amount_limit_is_exclusive(spark, amount, flagged):
    row = rules.apply_amount_rule(transaction(spark, amount=amount)).first()
    assert row["amount_flag"] is flagged
    assert row["amount_reason"] == (f"HIGH_AMOUNT: ${amount}" if flagged else None)


@pytest.mark.parametrize(
    "name, category, flagged, reason",
    [
        ("Whole Foods", "grocery", False, None),
        ("Unknown Co", "unknown", True, "HIGH_RISK_CATEGORY: unknown"),
        ("Corner Grocery", "crypto_exchange", True, "HIGH_RISK_CATEGORY: crypto_exchange"),
        ("Corner Grocery", "wire_transfer", True, "HIGH_RISK_CATEGORY: wire_transfer"),
        ("Dark Web Store", "grocery", True, "FRAUD_MERCHANT: Dark Web Store"),
        ("QuickWire Transfer", "unknown", True, "FRAUD_MERCHANT: QuickWire Transfer"),
    ],
)
def test_merchant_name_wins_over_category(spark, name, category, flagged, reason):
    row = rules.apply_merchant_rule(transaction(spark, merchant_name=name, merchant_category=category)).first()
    assert (row["merchant_flag"], row["merchant_reason"]) == (flagged, reason)


@pytest.mark.parametrize("country, flagged", [("US", False), ("GB", False), ("RU", True), ("NG", True), ("KP", True)])
def test_country(spark, country, flagged):
    row = rules.apply_geo_country_rule(transaction(spark, merchant_country=country)).first()
    assert row["geo_flag"] is flagged
    assert row["geo_reason"] == (f"HIGH_RISK_COUNTRY: {country}" if flagged else None)


@pytest.mark.parametrize(
    "changes, score, level",
    [
        ({}, 0, "LOW"),
        ({"amount": 1500.0}, 30, "MEDIUM"),
        ({"merchant_category": "unknown", "merchant_name": "Unknown Co"}, 35, "HIGH"),
        ({"amount": 1500.0, "merchant_category": "crypto_exchange"}, 65, "HIGH"),
        ({"merchant_category": "unknown", "merchant_country": "NG"}, 70, "CRITICAL"),
        ({"amount": 4750.0, "merchant_category": "crypto_exchange", "merchant_country": "RU"}, 100, "CRITICAL"),
    ],
)
def test_score_and_level(spark, changes, score, level):
    row = scored(spark, **changes)
    assert (row["fraud_score"], row["risk_level"]) == (score, level)


def test_clean_transaction_has_no_reason(spark):
    assert scored(spark)["fraud_reason"] is None


def test_all_reasons_in_rule_order(spark):
    row = scored(spark, amount=9999.0, merchant_name="Dark Web Store", merchant_category="unknown", merchant_country="RU")
    assert row["fraud_reason"] == "HIGH_AMOUNT: $9999.0 | FRAUD_MERCHANT: Dark Web Store | HIGH_RISK_COUNTRY: RU"


@pytest.mark.parametrize("missing", ["amount", "merchant_country", "merchant_category"])
def test_missing_value_is_critical_but_no_alert(spark, missing):
    df = rules.apply_fraud_detection(transaction(spark, **{missing: None}))
    row = df.first()
    assert (row["fraud_score"], row["risk_level"]) == (None, "CRITICAL")
    assert rules.only_alerts(df).count() == 0 and rules.only_approved(df).count() == 0


def test_listed_name_decides_without_category(spark):
    assert scored(spark, merchant_category=None, merchant_name="Dark Web Store")["merchant_flag"] is True


@pytest.mark.parametrize("missing", ["amount", "merchant_country", "merchant_category"])
def test_missing_value_as_not_fired(spark, missing):
    row = scored(spark, LENIENT, **{missing: None})
    assert (row["fraud_score"], row["risk_level"]) == (0, "LOW")


def test_lenient_policy_still_scores_other_rules(spark):
    assert scored(spark, LENIENT, amount=5000.0, merchant_country=None)["fraud_score"] == 30


def test_unknown_policy_is_refused():
    with pytest.raises(ValueError):
        RuleConfig(null_policy="maybe")


def test_actions(spark):
    wanted = {0: "APPROVE", 30: "MONITOR", 65: "REVIEW", 100: "BLOCK_AND_ALERT"}
    changes = [{}, {"amount": 1500.0}, {"amount": 1500.0, "merchant_country": "RU"},
               {"amount": 1500.0, "merchant_country": "RU", "merchant_category": "unknown"}]
    for change in changes:
        row = rules.with_action(rules.apply_fraud_detection(transaction(spark, **change))).first()
        assert row["action"] == wanted[row["fraud_score"]]


def test_rule_quality_counts(spark):
    df = transaction(spark, amount=5000.0, is_fraud=True)
    for change in ({"amount": 5000.0, "is_fraud": False}, {"is_fraud": True}, {"is_fraud": False}, {"is_fraud": False}):
        df = df.unionByName(transaction(spark, **change))
    row = rules.rule_quality(rules.apply_fraud_detection(df), label="is_fraud").first()
    assert (row["true_positives"], row["false_positives"], row["false_negatives"], row["true_negatives"]) == (1, 1, 1, 2)
    assert (row["detection_rate_pct"], row["precision_pct"], row["false_positive_rate_pct"]) == (50.0, 50.0, 33.33)
