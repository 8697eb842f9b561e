"""Small frames for the tests."""

from datetime import datetime, timedelta

from pyspark.sql import types as T

_TYPES = {
    "STRING": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DECIMAL(5,2)": T.DecimalType(5, 2),
    "TIMESTAMP": T.TimestampType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def columns(text: str) -> T.StructType:
    """``"name TYPE [NOT NULL], ..."`` as a schema, without needing a session."""
    fields = []
    for column in text.split(", "):
        name, kind, *rest = column.split(" ")
        fields.append(T.StructField(name, _TYPES[kind], nullable=not rest))
    return T.StructType(fields)

START = datetime(2024, 3, 1, 12, 0, 0)
TRANSACTION = columns(
    "transaction_id STRING, customer_id STRING, amount DOUBLE, merchant_name STRING, merchant_category STRING, "
    "merchant_country STRING, customer_lat DOUBLE, customer_lon DOUBLE, is_fraud BOOLEAN, fraud_type STRING"
)
PLAIN = dict(
    transaction_id="txn-001", customer_id="CUST_00001", amount=50.0, merchant_name="Corner Grocery",
    merchant_category="grocery", merchant_country="US", customer_lat=42.36, customer_lon=-71.06, is_fraud=False,
    fraud_type=None,
)


def transaction(spark, **changes):
    row = PLAIN | changes
    return spark.createDataFrame([tuple(row[c] for c in TRANSACTION.names)], TRANSACTION)


def at(seconds):
    return START + timedelta(seconds=seconds)


def frame(spark, text, rows):
    return spark.createDataFrame(rows, columns(text))


def visits(spark, rows):
    """(transaction_id, customer_id, seconds, country)"""
    return frame(
        spark,
        "transaction_id STRING, customer_id STRING, event_time TIMESTAMP_NTZ, merchant_country STRING",
        [(str(t), c, at(s), k) for t, c, s, k in rows],
    )


def rows(df, *names):
    picked = df.select(*names) if names else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
