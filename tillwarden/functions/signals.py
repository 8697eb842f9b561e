"""The three scoring signals, the score, its level and the action, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwarden.config import RISK_LEVELS, RuleConfig
from tillwarden.functions.scalars import ladder

# Texts of the reasons and actions.
AMOUNT_TEXT = "HIGH_AMOUNT: $"
MERCHANT_TEXT = "FRAUD_MERCHANT: "
CATEGORY_TEXT = "HIGH_RISK_CATEGORY: "
COUNTRY_TEXT = "HIGH_RISK_COUNTRY: "
REASON_SEPARATOR = " | "
ACTIONS = {"LOW": "APPROVE", "MEDIUM": "MONITOR", "HIGH": "REVIEW", "CRITICAL": "BLOCK_AND_ALERT"}


def _flag(hit: Column, rules: RuleConfig) -> Column:
    return F.coalesce(hit, F.lit(False)) if rules.null_policy == "false" else hit


def _labelled(text: str, value: str) -> Column:
    return F.concat(F.lit(text), F.col(value).cast("string"))


def amount_signal(rules: RuleConfig) -> dict[str, Column]:
    hit = F.col("amount") > rules.amount_limit
    return {"amount_flag": _flag(hit, rules), "amount_reason": F.when(hit, _labelled(AMOUNT_TEXT, "amount"))}


def merchant_signal(rules: RuleConfig) -> dict[str, Column]:
    by_name = F.col("merchant_name").isin(*rules.merchants)
    by_category = F.col("merchant_category").isin(*rules.categories)
    return {
        "merchant_flag": _flag(by_name | by_category, rules),
        "merchant_reason": F.coalesce(
            F.when(by_name, _labelled(MERCHANT_TEXT, "merchant_name")),
            F.when(by_category, _labelled(CATEGORY_TEXT, "merchant_category")),
        ),
    }


def country_signal(rules: RuleConfig) -> dict[str, Column]:
    hit = F.col("merchant_country").isin(*rules.countries)
    return {"geo_flag": _flag(hit, rules), "geo_reason": F.when(hit, _labelled(COUNTRY_TEXT, "merchant_country"))}


def score(rules: RuleConfig) -> Column:
    """Points of the fired signals; NULL as soon as one flag is NULL."""
    points = {
        "amount_flag": rules.amount_points,
        "merchant_flag": rules.merchant_points,
        "geo_flag": rules.country_points,
    }
    parts = [F.col(flag).cast("int") * weight for flag, weight in points.items()]
    return parts[0] + parts[1] + parts[2]


def level(score_column: Column, rules: RuleConfig) -> Column:
    """Tier of a score. A NULL score fails every test and ends as CRITICAL."""
    *below, top = RISK_LEVELS
    bounds = (0, rules.medium_max, rules.high_max)
    return ladder([(score_column <= bound, name) for bound, name in zip(bounds, below)], top)


def reasons() -> Column:
    """The fired reasons joined in rule order; NULL when there is none."""
    return F.nullif(F.concat_ws(REASON_SEPARATOR, "amount_reason", "merchant_reason", "geo_reason"), F.lit(""))


def action(level_column: Column) -> Column:
    return ladder([(level_column == name, step) for name, step in ACTIONS.items()])
