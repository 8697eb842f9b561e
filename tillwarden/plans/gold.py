"""Daily, customer and merchant summaries over the flagged transactions.

Text columns that an aggregate needs (countries, customers) are grouped on first: the
first pass is a hash aggregation with map-side combine over numbers only, and distinct
counts, modes and text maxima then work on its much smaller result.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwarden.functions.scalars import dollars, how_many, instant, ladder, money_total, percent, ratio
from tillwarden.operators.ranking import global_rank

# Flag-rate bounds (percent, exceeded) of the tiers, highest first.
RATE_TIERS = ((50, "CRITICAL"), (20, "HIGH"), (5, "MEDIUM"))
HIGH_MIN_FLAGS, MEDIUM_MIN_FLAGS = 3, 1
# The tables' columns in order.
DAILY_COLUMNS = (
    "transaction_date", "total_transactions", "flagged_transactions", "confirmed_fraud", "fraud_flag_rate_pct",
    "confirmed_fraud_rate_pct", "total_volume_usd", "flagged_volume_usd", "avg_transaction_amount",
    "max_transaction_amount", "critical_count", "high_count", "medium_count", "low_count", "amount_rule_hits",
    "merchant_rule_hits", "geo_rule_hits", "refreshed_at",
)
CUSTOMER_COLUMNS = (
    "customer_id", "customer_name", "total_transactions", "total_flags", "critical_flags", "fraud_rate_pct",
    "total_spend_usd", "flagged_spend_usd", "avg_fraud_score", "max_fraud_score", "countries_used",
    "most_common_country", "last_seen", "last_flagged", "risk_tier", "fraud_rank", "refreshed_at",
)
MERCHANT_COLUMNS = (
    "merchant_category", "total_transactions", "total_flags", "fraud_rate_pct", "avg_fraud_score", "total_volume_usd",
    "flagged_volume_usd", "unique_customers", "countries_seen", "merchant_risk_tier", "refreshed_at",
)


def rate_tier(rate_pct: Column, also: dict[str, Column] | None = None) -> Column:
    """Tier by flag rate; ``also`` names further conditions that reach a tier."""
    more = also or {}
    by_rate = [(rate_pct > bound, tier) for bound, tier in RATE_TIERS]
    return ladder([(more[tier] | test if tier in more else test, tier) for test, tier in by_rate], "LOW")


def day_totals(flags: DataFrame, *more: Column) -> DataFrame:
    """One row of counts and sums per day: all that a day's summary is made of (and ``more``)."""
    flagged, level = F.col("is_flagged"), F.col("risk_level")
    amount = F.col("amount")
    return flags.groupBy("transaction_date").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        how_many(flagged).alias("flagged_transactions"),
        how_many(F.col("is_fraud_label")).alias("confirmed_fraud"),
        money_total(amount).alias("volume"),
        money_total(amount, flagged).alias("flagged_volume"),
        F.count("amount").alias("priced"),
        F.max("amount").alias("max_transaction_amount"),
        *(how_many(level == name.upper()).alias(f"{name}_count") for name in ("critical", "high", "medium", "low")),
        how_many(F.col("amount_flag")).alias("amount_rule_hits"),
        how_many(F.col("merchant_flag")).alias("merchant_rule_hits"),
        how_many(F.col("geo_flag")).alias("geo_rule_hits"),
        *more,
    )


def fraud_summary_daily(flags: DataFrame, as_of: datetime | str) -> DataFrame:
    return shown_days(day_totals(flags), as_of)


def shown_days(days: DataFrame, as_of: datetime | str) -> DataFrame:
    """The daily summary from ``day_totals``."""
    total = F.col("total_transactions")
    shown = days.withColumns(
        {
            "fraud_flag_rate_pct": percent(F.col("flagged_transactions"), total, 2),
            "confirmed_fraud_rate_pct": percent(F.col("confirmed_fraud"), total, 2),
            "total_volume_usd": dollars(F.col("volume")),
            "flagged_volume_usd": dollars(F.col("flagged_volume")),
            "avg_transaction_amount": ratio(F.col("volume"), F.col("priced")),
            "refreshed_at": instant(as_of),
        }
    )
    return shown.select(*DAILY_COLUMNS).orderBy(F.desc("transaction_date"))


WHO = ("customer_id", "customer_name")
CUSTOMER_SUMS = ("n", "flags", "criticals", "spend", "flagged_spend", "score_sum")
CUSTOMER_MAXIMA = ("top_score", "seen", "flagged_at")


def customer_stats(flags: DataFrame) -> DataFrame:
    """One row per customer, in two passes: per country, then per customer."""
    return customer_totals(customer_parts(flags))


def customer_parts(flags: DataFrame, *by: str) -> DataFrame:
    """Counts, sums and maxima per customer and country (and ``by``)."""
    flagged, amount = F.col("is_flagged"), F.col("amount")
    return flags.groupBy(*by, *WHO, "merchant_country").agg(
        F.count(F.lit(1)).alias("n"),
        how_many(flagged).alias("flags"),
        how_many(F.col("risk_level") == "CRITICAL").alias("criticals"),
        money_total(amount).alias("spend"),
        money_total(amount, flagged).alias("flagged_spend"),
        F.sum(F.when(flagged, F.col("fraud_score"))).alias("score_sum"),
        F.max("fraud_score").alias("top_score"),
        F.max("event_time").alias("seen"),
        F.max(F.when(flagged, F.col("event_time"))).alias("flagged_at"),
    )


def merged_customer_parts(parts: DataFrame) -> DataFrame:
    """Parts of several days as one per customer and country."""
    sums = [F.sum(c).alias(c) for c in CUSTOMER_SUMS]
    return parts.groupBy(*WHO, "merchant_country").agg(*sums, *(F.max(c).alias(c) for c in CUSTOMER_MAXIMA))


def customer_totals(per_country: DataFrame) -> DataFrame:
    """One row per customer, from one part per customer and country."""
    country = F.col("merchant_country")
    commonest = F.when(country.isNotNull(), F.struct(-F.col("n"), country))
    return per_country.groupBy(*WHO).agg(
        F.sum("n").alias("total_transactions"),
        F.sum("flags").alias("total_flags"),
        F.sum("criticals").alias("critical_flags"),
        F.sum("spend").alias("spend"),
        F.sum("flagged_spend").alias("flagged_spend"),
        F.sum("score_sum").alias("flag_score_sum"),
        F.max("top_score").alias("max_fraud_score"),
        F.max("seen").alias("last_seen"),
        F.max("flagged_at").alias("last_flagged"),
        F.count("merchant_country").alias("countries_used"),
        F.min_by("merchant_country", commonest).alias("most_common_country"),
    )


def high_risk_customers(flags: DataFrame, as_of: datetime | str) -> DataFrame:
    """Customers with at least one flag, ranked by flags, then by average flag score.

    The average goes unrounded into the rank; among equal flag counts it orders as the
    score sum does, so the rank compares whole numbers.
    """
    return ranked_customers(customer_stats(flags), as_of)


def ranked_customers(stats: DataFrame, as_of: datetime | str) -> DataFrame:
    """The customer table from ``customer_totals``."""
    flags_count, rate = F.col("total_flags"), F.col("fraud_rate_pct")
    ranked = global_rank(
        stats.where(flags_count > 0),
        {"total_flags": F.desc("total_flags"), "flag_score_sum": F.desc("flag_score_sum")},
        "fraud_rank",
    )
    tier = rate_tier(
        rate,
        {
            "CRITICAL": F.col("critical_flags") > 0,
            "HIGH": flags_count >= HIGH_MIN_FLAGS,
            "MEDIUM": flags_count >= MEDIUM_MIN_FLAGS,
        },
    )
    shown = ranked.withColumns(
        {
            "fraud_rate_pct": percent(flags_count, F.col("total_transactions"), 1),
            "total_spend_usd": F.round(dollars(F.col("spend")), 2),
            "flagged_spend_usd": F.round(dollars(F.col("flagged_spend")), 2),
            "avg_fraud_score": F.round(ratio(F.col("flag_score_sum"), flags_count), 1),
            "refreshed_at": instant(as_of),
        }
    ).withColumn("risk_tier", tier)
    return shown.select(*CUSTOMER_COLUMNS).orderBy("fraud_rank", "customer_id")


def merchant_risk_scores(flags: DataFrame, as_of: datetime | str) -> DataFrame:
    """Counts, rates and volumes per merchant category."""
    per_pair = merchant_parts(flags, "customer_id", "merchant_country")
    totals = per_pair.groupBy("merchant_category").agg(
        F.sum("n").alias("total_transactions"),
        F.sum("flags").alias("total_flags"),
        F.sum("score_sum").alias("score_sum"),
        F.sum("volume").alias("volume"),
        F.sum("flagged_volume").alias("flagged_volume"),
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("merchant_country").alias("countries_seen"),
    )
    return rated_merchants(totals, as_of)


MERCHANT_SUMS = ("n", "flags", "score_sum", "volume", "flagged_volume")


def merchant_parts(flags: DataFrame, *by: str) -> DataFrame:
    """Counts and sums per merchant category and ``by``."""
    flagged, amount = F.col("is_flagged"), F.col("amount")
    return flags.groupBy("merchant_category", *by).agg(
        F.count(F.lit(1)).alias("n"),
        how_many(flagged).alias("flags"),
        F.sum(F.when(flagged, F.col("fraud_score"))).alias("score_sum"),
        money_total(amount).alias("volume"),
        money_total(amount, flagged).alias("flagged_volume"),
    )


def rated_merchants(totals: DataFrame, as_of: datetime | str) -> DataFrame:
    """The merchant table from one row of totals per category."""
    shown = totals.withColumns(
        {
            "fraud_rate_pct": percent(F.col("total_flags"), F.col("total_transactions"), 2),
            "avg_fraud_score": F.round(ratio(F.col("score_sum"), F.col("total_flags")), 1),
            "total_volume_usd": F.round(dollars(F.col("volume")), 2),
            "flagged_volume_usd": F.round(dollars(F.col("flagged_volume")), 2),
            "refreshed_at": instant(as_of),
        }
    ).withColumn("merchant_risk_tier", rate_tier(F.col("fraud_rate_pct")))
    return shown.select(*MERCHANT_COLUMNS).orderBy(F.desc_nulls_last("fraud_rate_pct"), "merchant_category")
