"""Rule settings. Every threshold and list a rule reads comes from ``RuleConfig``."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

# Results depend on these lists, limits, weights and texts.
HIGH_RISK_CATEGORIES = ("unknown", "crypto_exchange", "wire_transfer")
HIGH_RISK_COUNTRIES = ("RU", "NG", "KP")
FRAUD_MERCHANTS = ("Dark Web Store", "CryptoFast Exchange", "QuickWire Transfer")
HIGH_AMOUNT = 1000.0
VELOCITY_WINDOW = timedelta(seconds=60)
VELOCITY_LIMIT = 5
GEO_WINDOW = timedelta(minutes=10)
GEO_SLIDE = timedelta(minutes=1)
GEO_MIN_COUNTRIES = 2
AMOUNT_POINTS, MERCHANT_POINTS, COUNTRY_POINTS = 30, 35, 35
MEDIUM_MAX, HIGH_MAX = 30, 65
RISK_LEVELS = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
RAW_TOPIC, ALERT_TOPIC, APPROVED_TOPIC = "raw-transactions", "fraud-alerts", "approved-transactions"
# Our own addition: transactions that could not be scored.
REVIEW_TOPIC = "review-transactions"
WATERMARK = "30 seconds"
SCORING_TRIGGER = "5 seconds"
LOADER_TRIGGER = "10 seconds"
LOADER_BATCH_ROWS = 100
FEED_BUFFER_ROWS = 200
FEED_ROWS = 20


@dataclass(frozen=True)
class RuleConfig:
    """Settings of the scoring and behaviour rules.

    ``null_policy`` decides what a missing amount, category or country means:
    ``"propagate"`` leaves the flag NULL (score NULL, level CRITICAL, never an
    alert), ``"false"`` treats the rule as not fired.
    """

    amount_limit: float = HIGH_AMOUNT
    categories: tuple[str, ...] = HIGH_RISK_CATEGORIES
    merchants: tuple[str, ...] = FRAUD_MERCHANTS
    countries: tuple[str, ...] = HIGH_RISK_COUNTRIES
    velocity_window: timedelta = VELOCITY_WINDOW
    velocity_limit: int = VELOCITY_LIMIT
    geo_window: timedelta = GEO_WINDOW
    geo_slide: timedelta = GEO_SLIDE
    geo_min_countries: int = GEO_MIN_COUNTRIES
    amount_points: int = AMOUNT_POINTS
    merchant_points: int = MERCHANT_POINTS
    country_points: int = COUNTRY_POINTS
    medium_max: int = MEDIUM_MAX
    high_max: int = HIGH_MAX
    null_policy: str = "propagate"

    def __post_init__(self) -> None:
        if self.null_policy not in ("propagate", "false"):
            raise ValueError(f"unknown null_policy {self.null_policy!r}")


DEFAULT_RULES = RuleConfig()
#: What the jobs use: a missing value must neither hide an alert nor lose a transaction.
PIPELINE_RULES = RuleConfig(null_policy="false")
