"""What an analyst looks at: key figures, alert feed, top lists, customer lookup."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwarden.config import FEED_BUFFER_ROWS, FEED_ROWS
from tillwarden.functions.scalars import (
    RATE_ALARM_PCT,
    RATE_REFERENCE_PCT,
    dollars,
    how_many,
    instant,
    interval,
    money_total,
    rate_band,
    ratio,
)

# Column sets, names of the time windows, list lengths.
KPI_COLUMNS = (
    "total_transactions", "flagged_transactions", "fraud_flag_rate_pct", "total_volume_usd", "flagged_volume_usd",
)
FEED_COLUMNS = (
    "customer_id", "amount", "merchant_category", "merchant_country", "risk_level", "fraud_score", "fraud_reason",
)
HOTSPOT_COLUMNS = (
    "customer_lat", "customer_lon", "risk_level", "fraud_score", "customer_id", "amount", "merchant_country",
    "fraud_reason",
)
TOP_CUSTOMER_COLUMNS = (
    "customer_id", "customer_name", "total_flags", "fraud_rate_pct", "max_fraud_score", "risk_tier", "last_flagged",
    "countries_used",
)
RECENT_ALERT_COLUMNS = (
    "transaction_id", "event_time", "amount", "merchant_name", "merchant_country", "risk_level", "fraud_reason",
)
TIME_WINDOWS = {
    "Last 1 hour": timedelta(hours=1),
    "Last 24 hours": timedelta(hours=24),
    "Last 7 days": timedelta(days=7),
    "All time": None,
}
DEFAULT_LEVELS = ("CRITICAL", "HIGH")
TOP_ROWS, RECENT_ROWS = 10, 20


def latest_alerts(alerts: DataFrame, rows: int = FEED_BUFFER_ROWS) -> DataFrame:
    """The newest alerts; each task keeps only its own newest ``rows``."""
    return alerts.orderBy(F.desc("event_time"), F.desc("transaction_id")).limit(rows)


def kpi_day(summary: DataFrame, day: date | str) -> DataFrame:
    return summary.where(F.col("transaction_date") == F.lit(str(day)).cast("date")).select(*KPI_COLUMNS)


def kpi_buffer(buffer: DataFrame) -> DataFrame:
    """Key figures of a set of alerts; an empty set gives rate 0."""
    positive = F.col("fraud_score") > 0
    zero = F.lit(0.0)
    return buffer.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        how_many(positive).alias("flagged_transactions"),
        F.coalesce(ratio(how_many(positive), F.count(F.lit(1))) * 100, zero).alias("fraud_flag_rate_pct"),
        F.coalesce(dollars(money_total(F.col("amount"))), zero).alias("total_volume_usd"),
        F.coalesce(dollars(money_total(F.col("amount"), positive)), zero).alias("flagged_volume_usd"),
    )


def kpis(summary: DataFrame, alerts: DataFrame, day: date | str) -> DataFrame:
    """The day's figures, or those of the newest alerts when the day has no row yet (one small
    look at the summary decides, and only one of the two is computed)."""
    of_day = kpi_day(summary, day)
    return kpi_buffer(latest_alerts(alerts)) if of_day.isEmpty() else of_day


def alert_feed(
    alerts: DataFrame, levels: Sequence[str] = DEFAULT_LEVELS, rows: int = FEED_ROWS, newest_first: bool = False
) -> DataFrame:
    """``rows`` of the newest alerts at the chosen levels (none chosen: all levels)."""
    feed = latest_alerts(alerts)
    if levels:
        feed = feed.where(F.col("risk_level").isin(*levels))
    time, tie = F.col("event_time"), F.col("transaction_id")
    order = [time.desc(), tie.desc()] if newest_first else [time.asc(), tie.asc()]
    return feed.orderBy(*order).limit(rows).select(*(c for c in FEED_COLUMNS if c in alerts.columns))


def merchant_top(scores: DataFrame, rows: int = TOP_ROWS) -> DataFrame:
    return (
        scores.select("merchant_category", "fraud_rate_pct", "total_flags", "merchant_risk_tier")
        .orderBy(F.desc_nulls_last("fraud_rate_pct"), "merchant_category")
        .limit(rows)
    )


def customers_top(customers: DataFrame, rows: int = TOP_ROWS) -> DataFrame:
    return customers.orderBy("fraud_rank", "customer_id").limit(rows).select(*TOP_CUSTOMER_COLUMNS)


def geo_hotspots(alerts: DataFrame) -> DataFrame:
    """Alerts with a usable place; latitude or longitude 0 counts as missing."""
    placed = (F.col("customer_lat") != 0) & (F.col("customer_lon") != 0)
    return alerts.where((F.col("fraud_score") > 0) & placed).select(*HOTSPOT_COLUMNS)


def customer_lookup(customers: DataFrame, customer_id: str) -> DataFrame:
    """The customer's row. The id is a literal, never part of a SQL text."""
    return customers.where(F.col("customer_id") == F.upper(F.lit(customer_id)))


def recent_alerts(alerts: DataFrame, customer_id: str, rows: int = RECENT_ROWS) -> DataFrame:
    return (
        customer_lookup(alerts, customer_id)
        .orderBy(F.desc("event_time"), F.desc("transaction_id"))
        .limit(rows)
        .select(*RECENT_ALERT_COLUMNS)
    )


def within_window(df: DataFrame, window: str, as_of: datetime | str) -> DataFrame:
    span = TIME_WINDOWS[window]
    return df if span is None else df.where(F.col("event_time") >= instant(as_of) - interval(span))


def window_counts(df: DataFrame, as_of: datetime | str) -> DataFrame:
    """Rows within each of TIME_WINDOWS before ``as_of``, in one pass."""
    kept = {
        name: F.lit(True) if span is None else F.col("event_time") >= instant(as_of) - interval(span)
        for name, span in TIME_WINDOWS.items()
    }
    counts = df.agg(*(how_many(test).alias(name) for name, test in kept.items()))
    rows = (F.struct(F.lit(name).alias("time_window"), F.col(f"`{name}`").alias("alerts")) for name in kept)
    return counts.select(F.inline(F.array(*rows)))


def fraud_rate_bands(summary: DataFrame) -> DataFrame:
    """Per day: band of the flag rate, distance to the expected rate, alarm."""
    rate = F.col("fraud_flag_rate_pct")
    return summary.select(
        "transaction_date",
        rate,
        rate_band(rate).alias("band"),
        F.round(rate - RATE_REFERENCE_PCT, 2).alias("above_expected_pct"),
        (rate >= RATE_ALARM_PCT).alias("alarm"),
    )


def running_totals(transactions: DataFrame, label: str = "is_fraud_label") -> DataFrame:
    """Transactions, frauds and fraud percent so far (a table, or a stream in complete mode)."""
    counts = transactions.agg(F.count(F.lit(1)).alias("total_sent"), how_many(F.col(label)).alias("total_fraud"))
    return counts.withColumn("fraud_pct", F.round(ratio(F.col("total_fraud"), F.col("total_sent")) * 100, 1))
