"""The same three summaries seen from the alerts alone, and customer risk profiles."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwarden.functions.scalars import at_micros, cell_of, dollars, how_many, instant, interval, ladder, micros, money_total, ratio
from tillwarden.operators.asof import DAY, totals_before
from tillwarden.operators.ranking import global_row_number

# Score bounds (reached) and alert-count bounds (up to) of the tiers; window of the profiles.
SCORE_TIERS = ((65, "CRITICAL"), (35, "HIGH"), (10, "MEDIUM"))
COUNT_TIERS = ((0, "LOW"), (2, "MEDIUM"), (5, "HIGH"))
ALERTS_ARE_ALL_FLAGGED_PCT = 100.0
COUNTRY_SEPARATOR = ", "
PROFILE_WINDOW = timedelta(days=30)


def score_tier(score: Column) -> Column:
    return ladder([(score >= bound, tier) for bound, tier in SCORE_TIERS], "LOW")


def count_tier(alerts: Column) -> Column:
    return ladder([(alerts <= bound, tier) for bound, tier in COUNT_TIERS], "CRITICAL")


def daily_alert_view(alerts: DataFrame) -> DataFrame:
    level = F.col("risk_level")
    days = alerts.groupBy(F.to_date("event_time").alias("transaction_date")).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        money_total(F.col("amount")).alias("volume"),
        F.sum("fraud_score").alias("score_sum"),
        F.count("fraud_score").alias("scored"),
        *(how_many(level == name.upper()).alias(f"{name}_count") for name in ("critical", "high", "medium")),
        how_many(F.col("amount_flag")).alias("amount_rule_hits"),
        how_many(F.col("merchant_flag")).alias("merchant_rule_hits"),
        how_many(F.col("geo_flag")).alias("geo_rule_hits"),
    )
    volume = F.round(dollars(F.col("volume")), 2)
    return days.withColumns(
        {
            "flagged_transactions": F.col("total_transactions"),
            "fraud_flag_rate_pct": F.lit(ALERTS_ARE_ALL_FLAGGED_PCT),
            "flagged_volume_usd": volume,
            "total_volume_usd": volume,
            "avg_fraud_score": ratio(F.col("score_sum"), F.col("scored")),
        }
    ).drop("volume", "score_sum", "scored")


def merchant_alert_view(alerts: DataFrame) -> DataFrame:
    totals = alerts.groupBy("merchant_category").agg(
        F.count(F.lit(1)).alias("total_flags"),
        F.sum("fraud_score").alias("score_sum"),
        F.count("fraud_score").alias("scored"),
        money_total(F.col("amount")).alias("volume"),
    )
    average = ratio(F.col("score_sum"), F.col("scored"))
    return (
        totals.withColumns(
            {
                "avg_fraud_score": F.round(average, 1),
                "flagged_volume_usd": F.round(dollars(F.col("volume")), 2),
                "merchant_risk_tier": score_tier(average),
                "fraud_rate_pct": F.lit(ALERTS_ARE_ALL_FLAGGED_PCT),
            }
        )
        .drop("score_sum", "scored", "volume")
        .orderBy(F.desc("avg_fraud_score"), "merchant_category")
    )


def customer_alert_view(alerts: DataFrame) -> DataFrame:
    """Customers numbered by their score total; ``fraud_rate_pct`` holds the average score."""
    per_country = alerts.groupBy("customer_id", "merchant_country").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("fraud_score").alias("score_sum"),
        F.count("fraud_score").alias("scored"),
        F.max("fraud_score").alias("top_score"),
        F.max("event_time").alias("latest"),
    )
    totals = per_country.groupBy("customer_id").agg(
        F.sum("n").alias("total_flags"),
        F.sum("score_sum").alias("score_sum"),
        F.sum("scored").alias("scored"),
        F.max("top_score").alias("max_fraud_score"),
        F.max("latest").alias("last_flagged"),
        F.array_join(F.sort_array(F.collect_list("merchant_country")), COUNTRY_SEPARATOR).alias("countries_used"),
    )
    numbered = global_row_number(totals, [F.desc("score_sum"), F.asc("customer_id")], "fraud_rank")
    return numbered.withColumns(
        {
            "customer_name": F.col("customer_id"),
            "fraud_rate_pct": F.round(ratio(F.col("score_sum"), F.col("scored")), 1),
            "risk_tier": score_tier(F.col("max_fraud_score")),
        }
    ).drop("score_sum", "scored")


def create_views(alerts: DataFrame) -> None:
    """The three summaries as views for SQL users who have only the alerts."""
    daily_alert_view(alerts).createOrReplaceTempView("fraud_summary_daily")
    merchant_alert_view(alerts).createOrReplaceTempView("merchant_risk_scores")
    customer_alert_view(alerts).createOrReplaceTempView("high_risk_customers")


def profile_facts(alerts: DataFrame, as_of: datetime | str | None, last_country: str = "greatest") -> DataFrame:
    """Per customer with alerts in the 30 days before ``as_of`` (None: in all alerts).

    ``last_country="greatest"`` takes the alphabetically greatest country, ``"latest"``
    the one of the latest alert.
    """
    recent = alerts
    if as_of is not None:
        recent = alerts.where(in_window(as_of))
    return profile_totals(alert_parts(recent), last_country)


def in_window(as_of: datetime | str) -> Column:
    """Event times that a refresh at ``as_of`` looks at."""
    return F.col("event_time").between(instant(as_of) - interval(PROFILE_WINDOW), instant(as_of))


def alert_parts(alerts: DataFrame, *by: Column) -> DataFrame:
    """Counts, score sums and the latest time per customer and country (and ``by``). Parts of
    different alerts can be put together by ``profile_totals``."""
    return alerts.groupBy(*by, "customer_id", "merchant_country").agg(
        F.count(F.lit(1)).alias("n"), F.sum("fraud_score").alias("score"), F.max("event_time").alias("latest")
    )


def profile_totals(per_country: DataFrame, last_country: str = "greatest") -> DataFrame:
    """Facts per customer, from any number of parts."""
    country = F.col("merchant_country")
    pick = F.max(country) if last_country == "greatest" else F.max_by(country, F.struct("latest", country))
    totals = per_country.groupBy("customer_id").agg(
        F.sum("n").alias("total_fraud_alerts"),
        F.sum("score").cast("long").alias("cumulative_fraud_score"),
        F.max("latest").alias("last_alert_time"),
        pick.alias("last_seen_country"),
    )
    return totals.withColumn("risk_tier", count_tier(F.col("total_fraud_alerts")))


PROFILE_FACTS = (
    "total_fraud_alerts", "cumulative_fraud_score", "last_alert_time", "last_seen_country", "risk_tier",
)


def refresh_customer_risk_profiles(
    profiles: DataFrame, alerts: DataFrame, as_of: datetime | str, last_country: str = "greatest"
) -> DataFrame:
    """Profiles after the refresh: customers with recent alerts get the new facts, new
    customers are added with the table's defaults, all others stay as they are."""
    return refreshed_profiles(profiles, profile_facts(alerts, as_of, last_country), as_of)


def refreshed_profiles(profiles: DataFrame, facts: DataFrame, as_of: datetime | str) -> DataFrame:
    facts = facts.withColumn("updated_at", instant(as_of))
    fresh = facts.select("customer_id", F.struct(*PROFILE_FACTS, "updated_at").alias("new"))
    both = profiles.join(fresh, "customer_id", "full_outer")
    touched = F.col("new").isNotNull()
    return both.select(
        "customer_id",
        F.coalesce("total_transactions", F.lit(0).cast("long")).alias("total_transactions"),
        F.coalesce("fraud_rate", F.lit(0.0)).alias("fraud_rate"),
        *(
            F.when(touched, F.col(f"new.{c}")).otherwise(F.col(c)).alias(c)
            for c in (*PROFILE_FACTS, "updated_at")
        ),
    )


def profile_versions(alerts: DataFrame, width: timedelta = DAY) -> DataFrame:
    """Every version of every customer's profile: the facts of all alerts up to ``valid_from``
    (an instant with alerts), in force until ``valid_to`` (the next one; NULL: still in force).

    Totals are summed within (customer, cell) and start from those of the cells before, so a
    customer with very many alerts is spread over tasks. Alerts without customer or time give
    no version.
    """
    span, key = micros(width), "customer_id"
    timed = alerts.where(F.col(key).isNotNull() & F.col("event_time").isNotNull())
    moments = timed.select(key, at_micros(alerts, "event_time").alias("at"), "event_time", "fraud_score", "merchant_country")
    moments = moments.groupBy(key, "at").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("fraud_score").alias("score"),
        F.max("merchant_country").alias("country"),
        F.max("event_time").alias("valid_from"),
    )
    moments = moments.withColumn("cell", cell_of(F.col("at"), span))
    cells = moments.groupBy(key, "cell").agg(
        F.sum("n").alias("n"), F.sum("score").alias("score"), F.max("country").alias("country"), F.min("valid_from").alias("first")
    )
    totals = {"n_before": F.sum("n"), "score_before": F.sum("score"), "country_before": F.max("country")}
    opening = totals_before(cells, key, totals).withColumn(
        "next_cell", F.lead("first").over(Window.partitionBy(key).orderBy("cell"))
    )
    opening = opening.select(key, "cell", *totals, "next_cell")
    inside = Window.partitionBy(key, "cell").orderBy("at")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    running = moments.join(opening, [key, "cell"]).withColumns(
        {
            "total_fraud_alerts": F.sum("n").over(upto) + F.coalesce("n_before", F.lit(0)),
            "cumulative_fraud_score": (
                F.coalesce(F.sum("score").over(upto), F.lit(0)) + F.coalesce("score_before", F.lit(0))
            ).cast("long"),
            "last_alert_time": F.col("valid_from"),
            "last_seen_country": F.greatest(F.max("country").over(upto), "country_before"),
            "valid_to": F.coalesce(F.lead("valid_from").over(inside), "next_cell"),
        }
    )
    rated = running.withColumn("risk_tier", count_tier(F.col("total_fraud_alerts")))
    return rated.select(key, "valid_from", "valid_to", *PROFILE_FACTS)
