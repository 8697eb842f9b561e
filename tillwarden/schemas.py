"""Explicit schemas of messages and tables; nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

STRING, DOUBLE, BOOLEAN, INT, LONG = StringType(), DoubleType(), BooleanType(), IntegerType(), LongType()
SCORE, TIME, INSTANT = DecimalType(5, 2), TimestampNTZType(), TimestampType()

# Column names, order and types of messages and tables.
TRANSACTION_MESSAGE = StructType(
    [
        StructField("transaction_id", STRING, nullable=False),
        StructField("customer_id", STRING, nullable=False),
        StructField("customer_name", STRING),
        StructField("timestamp", STRING, nullable=False),
        StructField("amount", DOUBLE, nullable=False),
        StructField("currency", STRING),
        StructField("merchant_name", STRING),
        StructField("merchant_category", STRING),
        StructField("merchant_country", STRING),
        StructField("customer_lat", DOUBLE),
        StructField("customer_lon", DOUBLE),
        StructField("card_last4", STRING),
        StructField("card_type", STRING),
        StructField("is_fraud", BOOLEAN),
        StructField("fraud_type", STRING),
    ]
)
ALERT_MESSAGE = StructType(
    [
        StructField("transaction_id", STRING),
        StructField("customer_id", STRING),
        StructField("timestamp", STRING),
        StructField("amount", DOUBLE),
        StructField("merchant_name", STRING),
        StructField("merchant_category", STRING),
        StructField("merchant_country", STRING),
        StructField("customer_lat", DOUBLE),
        StructField("customer_lon", DOUBLE),
        StructField("card_type", STRING),
        StructField("fraud_score", INT),
        StructField("risk_level", STRING),
        StructField("fraud_reason", STRING),
        StructField("amount_flag", BOOLEAN),
        StructField("merchant_flag", BOOLEAN),
        StructField("geo_flag", BOOLEAN),
    ]
)
TRANSACTIONS_RAW = StructType(
    [
        StructField("id", LONG),
        StructField("transaction_id", STRING),
        StructField("customer_id", STRING),
        StructField("customer_name", STRING),
        StructField("event_time", TIME),
        StructField("ingested_at", TIME),
        StructField("amount", DOUBLE),
        StructField("currency", STRING),
        StructField("merchant_name", STRING),
        StructField("merchant_category", STRING),
        StructField("merchant_country", STRING),
        StructField("customer_lat", DOUBLE),
        StructField("customer_lon", DOUBLE),
        StructField("card_last4", STRING),
        StructField("card_type", STRING),
        StructField("is_fraud_label", BOOLEAN),
        StructField("fraud_type", STRING),
    ]
)
FRAUD_ALERTS = StructType(
    [
        StructField("alert_id", LONG),
        StructField("transaction_id", STRING),
        StructField("customer_id", STRING),
        StructField("event_time", TIME),
        StructField("alerted_at", TIME),
        StructField("amount", DOUBLE),
        StructField("merchant_name", STRING),
        StructField("merchant_category", STRING),
        StructField("merchant_country", STRING),
        StructField("customer_lat", DOUBLE),
        StructField("customer_lon", DOUBLE),
        StructField("card_type", STRING),
        StructField("fraud_score", SCORE),
        StructField("risk_level", STRING),
        StructField("fraud_reason", STRING),
        StructField("amount_flag", BOOLEAN),
        StructField("merchant_flag", BOOLEAN),
        StructField("geo_flag", BOOLEAN),
    ]
)
CUSTOMER_RISK_PROFILES = StructType(
    [
        StructField("customer_id", STRING),
        StructField("total_transactions", LONG),
        StructField("total_fraud_alerts", LONG),
        StructField("fraud_rate", DOUBLE),
        StructField("cumulative_fraud_score", LONG),
        StructField("last_alert_time", TIME),
        StructField("last_seen_country", STRING),
        StructField("risk_tier", STRING),
        StructField("updated_at", TIME),
    ]
)
FILE_MESSAGES = StructType([StructField("key", STRING), StructField("value", STRING), StructField("timestamp", INSTANT)])
REQUIRED_RAW_COLUMNS = ("transaction_id", "customer_id", "event_time", "amount")
