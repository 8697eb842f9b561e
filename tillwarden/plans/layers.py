"""Raw, cleaned and flagged transactions (bronze and silver), full or incremental.

Each model takes the table built so far as ``existing`` and then returns only the rows
of this load; ``upsert`` or ``TableStore.merge`` puts them into the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwarden.functions.scalars import amount_bucket, in_range, instant, is_weekend, utc_time
from tillwarden.operators.dedup import keep_first
from tillwarden.operators.merge import newer_than, with_defaults
from tillwarden.schemas import REQUIRED_RAW_COLUMNS, TRANSACTIONS_RAW

# Allowed coordinate ranges, and what a transaction without an alert gets.
LATITUDE, LONGITUDE = (-90, 90), (-180, 180)
NO_ALERT = {"fraud_score": 0, "risk_level": "LOW", "amount_flag": False, "merchant_flag": False, "geo_flag": False}
ALERT_FACTS = (
    "fraud_score", "risk_level", "fraud_reason", "amount_flag", "merchant_flag", "geo_flag", "alerted_at",
)


def raw_rows(transactions: DataFrame, as_of: datetime | str | None = None, more: Sequence[str] = ()) -> DataFrame:
    """Decoded messages in the raw table's columns (and ``more``): renames, default currency,
    and ``as_of`` as the ingest time of rows without one."""
    renames = {"is_fraud": "is_fraud_label"}
    shaped = transactions.withColumnsRenamed({k: v for k, v in renames.items() if k in transactions.columns})
    defaults = {"currency": F.lit("USD")} | ({} if as_of is None else {"ingested_at": instant(as_of)})
    if shaped.schema["event_time"].dataType.typeName() == "timestamp":
        shaped = shaped.withColumn("event_time", utc_time(F.col("event_time")))
    filled = with_defaults(shaped, defaults)
    return filled.select(*(c for c in TRANSACTIONS_RAW.names if c in filled.columns), *more)


def split_incomplete(df: DataFrame, required: tuple[str, ...] = REQUIRED_RAW_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """(complete rows, rows missing a required value); together all rows."""
    missing = reduce(or_, (F.col(c).isNull() for c in required))
    return df.where(~missing), df.where(missing)


def bronze_raw_transactions(raw: DataFrame, as_of: datetime | str, existing: DataFrame | None = None) -> DataFrame:
    """Raw rows as they are, plus the load time; last load wins per transaction_id.

    A load may hold several copies of a transaction. They all stay in bronze when they
    arrive together and the table is new; a later load replaces by key, so it brings
    one row per key.
    """
    fresh = raw if existing is None else keep_first(
        newer_than(raw, existing, "ingested_at"), ["transaction_id"], ["ingested_at"]
    )
    return fresh.withColumnRenamed("id", "raw_id").withColumn("dbt_loaded_at", instant(as_of))


def silver_clean_transactions(
    bronze: DataFrame, as_of: datetime | str, existing: DataFrame | None = None, load_partition: str | None = None
) -> DataFrame:
    """One cleaned row per transaction_id (the first loaded), with time features and bucket.

    ``load_partition`` names bronze's load-date partition column, if it has one.
    """
    fresh = bronze if existing is None else newer_than(bronze, existing, "dbt_loaded_at", load_partition)
    fresh = fresh if load_partition is None else fresh.drop(load_partition)
    first = keep_first(fresh, ["transaction_id"], ["dbt_loaded_at", "event_time"])
    return first.select(*cleaned_columns(), "dbt_loaded_at", instant(as_of).alias("silver_loaded_at"))


def cleaned_columns() -> list:
    """The cleaned columns in the table's order (a fixed value); the bucket looks at the amount
    before it is rounded."""
    c, event_time = F.col, F.col("event_time")
    named = {
        "transaction_id": c("transaction_id"),
        "customer_id": c("customer_id"),
        "customer_name": c("customer_name"),
        "event_time": event_time,
        "amount": F.round("amount", 2),
        "currency": F.upper(F.trim("currency")),
        "merchant_name": F.trim("merchant_name"),
        "merchant_category": F.lower(F.trim("merchant_category")),
        "merchant_country": F.upper(F.trim("merchant_country")),
        "customer_lat": in_range(c("customer_lat"), *LATITUDE),
        "customer_lon": in_range(c("customer_lon"), *LONGITUDE),
        "card_last4": c("card_last4"),
        "card_type": F.upper("card_type"),
        "transaction_date": F.to_date(event_time),
        "transaction_hour": F.hour(event_time).cast("long"),
        "day_of_week": F.dayofweek(event_time).cast("long"),
        "is_weekend": is_weekend(event_time),
        "amount_bucket": amount_bucket(c("amount")),
        "is_fraud_label": c("is_fraud_label"),
        "fraud_type": c("fraud_type"),
    }
    return [value.alias(name) for name, value in named.items()]


#: The day on which the row behind an outdated flag was cleaned.
CLEANED_ON = "cleaned_on"


def outdated_flags(flags: DataFrame, alerts: DataFrame, all_alerts: bool = True) -> DataFrame:
    """transaction_id and the day of cleaning of the rows of ``flags`` that do not hold what the
    earliest alert of their transaction gives them. If ``alerts`` are new ones only, what a row
    holds stands as long as it is earlier."""
    first = keep_first(alerts.select("transaction_id", *ALERT_FACTS), ["transaction_id"], ["alerted_at"])
    filled = with_defaults(first, {name: F.lit(value) for name, value in NO_ALERT.items()})
    facts = filled.select("transaction_id", *(F.col(c).alias(f"alert_{c}") for c in ALERT_FACTS))
    differs = reduce(or_, (~F.col(c).eqNullSafe(F.col(f"alert_{c}")) for c in ALERT_FACTS))
    if not all_alerts:
        differs &= ~F.coalesce(F.col("alert_alerted_at") > F.col("alerted_at"), F.lit(False))
    held = flags.select("transaction_id", "is_flagged", "silver_loaded_at", *ALERT_FACTS)
    outdated = held.join(facts, "transaction_id").where(~F.col("is_flagged") | differs)
    return outdated.select("transaction_id", F.to_date("silver_loaded_at").alias(CLEANED_ON))


def silver_fraud_flags(
    clean: DataFrame,
    alerts: DataFrame,
    as_of: datetime | str,
    existing: DataFrame | None = None,
    dedup_alerts: bool = True,
    late_alerts: bool = True,
) -> DataFrame:
    """Every cleaned transaction with its alert, or score 0 / LOW / FALSE.

    ``dedup_alerts``: several alerts of a transaction count once (the earliest);
    otherwise each gives a row. ``late_alerts``: an incremental run also takes
    transactions flagged since the last run, not only newly cleaned ones.
    """
    facts = alerts.select("transaction_id", *ALERT_FACTS)
    if dedup_alerts:
        facts = keep_first(facts, ["transaction_id"], ["alerted_at"])
    fresh = clean
    if existing is not None:
        fresh = newer_than(clean, existing, "silver_loaded_at")
        if late_alerts:
            unseen = facts.join(existing.where("is_flagged").select("transaction_id"), "transaction_id", "left_anti")
            older = clean.where(F.col("silver_loaded_at") <= existing.agg(F.max("silver_loaded_at")).scalar())
            fresh = fresh.unionByName(older.join(unseen.select("transaction_id"), "transaction_id", "left_semi"))
    joined = fresh.join(facts.withColumn("is_flagged", F.lit(True)), "transaction_id", "left")
    defaults = {name: F.lit(value) for name, value in NO_ALERT.items()} | {"is_flagged": F.lit(False)}
    return with_defaults(joined, defaults).withColumn("fraud_flags_loaded_at", instant(as_of))
