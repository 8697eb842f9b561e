"""Payment-shaped views of the test tables.

``payments`` come from ``events`` (unique ids, one month); ``purchases`` from the sales
tables (ids occur more than once, categories in upper case, coordinates partly invalid).
Both have the raw table's columns.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwarden.config import RuleConfig
from tillwarden.functions.scalars import padded_id
from tillwarden.operators.rules import apply_fraud_detection, only_alerts
from tillwarden.plans.layers import silver_clean_transactions, silver_fraud_flags
from tillwarden.schemas import TRANSACTIONS_RAW
from tillwarden.session import utc

AS_OF = "2024-01-31 00:00:00"
PURCHASES_AS_OF = "2003-01-01 00:00:00"

PAYMENT_RULES = RuleConfig(
    amount_limit=100.0,
    categories=("error",),
    merchants=("Merchant 13", "Merchant 42"),
    countries=("NATION_3", "NATION_7", "NATION_11"),
    velocity_window=timedelta(days=1),
    geo_window=timedelta(days=1),
    geo_slide=timedelta(hours=6),
)
PURCHASE_RULES = RuleConfig(
    amount_limit=100000.0,
    categories=("promo",),
    merchants=("Supplier#000000007",),
    countries=("NATION_3", "NATION_7", "NATION_11"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _in_raw_columns(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Select the raw table's columns; those without a value are NULL."""
    return df.select(
        *(
            (values[f.name] if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TRANSACTIONS_RAW.fields
        )
    )


def as_payments(events: DataFrame, nation: DataFrame) -> DataFrame:
    """Works on the events table and on a stream of it."""
    k = F.get_json_object("props", "$.k").cast("int")
    home = nation.select("n_nationkey", "n_name")
    keyed = events.withColumn("k", k).join(home, F.pmod("k", F.lit(25)) == F.col("n_nationkey"), "left")
    customer = padded_id("CUST_", F.col("user_id"))
    return _in_raw_columns(
        keyed,
        {
            "id": F.col("event_id"),
            "transaction_id": F.col("event_id"),
            "customer_id": customer,
            "customer_name": customer,
            "event_time": F.col("ts"),
            "ingested_at": F.col("ts"),
            "amount": F.col("value"),
            "currency": F.lit("USD"),
            "merchant_name": F.concat(F.lit("Merchant "), F.col("k").cast("string")),
            "merchant_category": F.col("event_type"),
            "merchant_country": F.col("n_name"),
            "is_fraud_label": F.col("event_type") == "error",
        },
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_payments(table(spark, sf_dir, "events"), table(spark, sf_dir, "nation"))


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders, customers, suppliers, parts, nations = (
        table(spark, sf_dir, name) for name in ("lineitem", "orders", "customer", "supplier", "part", "nation")
    )
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return _in_raw_columns(
        joined,
        {
            "transaction_id": F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")),
            "customer_id": padded_id("CUST_", F.col("o_custkey")),
            "customer_name": F.col("c_name"),
            "event_time": F.col("l_shipdate"),
            "ingested_at": F.col("l_shipdate"),
            "amount": F.col("l_extendedprice"),
            "currency": F.lit(" usd "),
            "merchant_name": F.col("s_name"),
            "merchant_category": F.col("p_type"),
            "merchant_country": F.col("n_name"),
            "customer_lat": F.col("c_acctbal") / 50,
            "customer_lon": F.col("c_acctbal") / 25,
            "card_type": F.col("o_orderpriority"),
            "is_fraud_label": F.col("l_returnflag") == "R",
        },
    )


def scored_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_fraud_detection(payments(spark, sf_dir), PAYMENT_RULES)


def alerts_of(scored: DataFrame) -> DataFrame:
    return only_alerts(scored).withColumn("alerted_at", F.col("event_time"))


def payment_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alerts_of(scored_payments(spark, sf_dir))


def cleaned_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = payments(spark, sf_dir).withColumnRenamed("id", "raw_id").withColumn(
        "dbt_loaded_at", F.lit(AS_OF).cast("timestamp_ntz")
    )
    return silver_clean_transactions(bronze, AS_OF)


def flagged_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_fraud_flags(cleaned_payments(spark, sf_dir), payment_alerts(spark, sf_dir), AS_OF)


def purchases_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return purchases(spark, sf_dir).withColumnRenamed("id", "raw_id").withColumn(
        "dbt_loaded_at", F.lit(PURCHASES_AS_OF).cast("timestamp_ntz")
    )


def purchase_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of the cleaned purchases: rules see lower-case categories and valid places."""
    clean = silver_clean_transactions(purchases_bronze(spark, sf_dir), PURCHASES_AS_OF)
    return alerts_of(apply_fraud_detection(clean, PURCHASE_RULES))
