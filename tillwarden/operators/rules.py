"""Row-level scoring. No shuffle and no state: the same code serves tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwarden.config import DEFAULT_RULES, RuleConfig
from tillwarden.functions import signals
from tillwarden.functions.scalars import how_many, percent


def apply_amount_rule(df: DataFrame, rules: RuleConfig = DEFAULT_RULES) -> DataFrame:
    return df.withColumns(signals.amount_signal(rules))


def apply_merchant_rule(df: DataFrame, rules: RuleConfig = DEFAULT_RULES) -> DataFrame:
    return df.withColumns(signals.merchant_signal(rules))


def apply_geo_country_rule(df: DataFrame, rules: RuleConfig = DEFAULT_RULES) -> DataFrame:
    return df.withColumns(signals.country_signal(rules))


def compute_fraud_score(df: DataFrame, rules: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """Adds ``fraud_score``, ``risk_level`` and ``fraud_reason`` to flagged rows."""
    scored = df.withColumn("fraud_score", signals.score(rules))
    return scored.withColumns(
        {"risk_level": signals.level(F.col("fraud_score"), rules), "fraud_reason": signals.reasons()}
    )


def apply_fraud_detection(df: DataFrame, rules: RuleConfig = DEFAULT_RULES) -> DataFrame:
    """All three signals in one projection, then the score."""
    signal_columns = signals.amount_signal(rules) | signals.merchant_signal(rules) | signals.country_signal(rules)
    return compute_fraud_score(df.withColumns(signal_columns), rules)


def with_action(df: DataFrame) -> DataFrame:
    return df.withColumn("action", signals.action(F.col("risk_level")))


def only_alerts(scored: DataFrame) -> DataFrame:
    """Rows with a positive score; a NULL score is no alert."""
    return scored.where(F.col("fraud_score") > 0)


def only_approved(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("fraud_score") == 0)


def rule_quality(scored: DataFrame, *by: str, label: str = "is_fraud_label") -> DataFrame:
    """Confusion counts and rates of ``score > 0`` against the label, per ``by`` columns. A row
    without a score has not fired; one without a label is in no count."""
    fired, fraud = F.coalesce(F.col("fraud_score") > 0, F.lit(False)), F.col(label)
    counts = scored.groupBy(*by).agg(
        how_many(fired & fraud).alias("true_positives"),
        how_many(fired & ~fraud).alias("false_positives"),
        how_many(~fired & fraud).alias("false_negatives"),
        how_many(~fired & ~fraud).alias("true_negatives"),
    )
    tp, fp, fn, tn = (
        F.col(c) for c in ("true_positives", "false_positives", "false_negatives", "true_negatives")
    )
    return counts.withColumns(
        {
            "detection_rate_pct": percent(tp, tp + fn, 2),
            "precision_pct": percent(tp, tp + fp, 2),
            "false_positive_rate_pct": percent(fp, fp + tn, 2),
        }
    )
