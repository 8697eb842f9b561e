"""Topics: messages with ``key``, ``value`` and broker ``timestamp``.

A topic is a broker topic, or a folder of files with the same three columns (plus
``topic`` where one folder holds several). Nothing downstream sees the difference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from tillwarden.config import ALERT_TOPIC, APPROVED_TOPIC, RAW_TOPIC, REVIEW_TOPIC
from tillwarden.functions.scalars import utc_time
from tillwarden.schemas import ALERT_MESSAGE, FILE_MESSAGES, TRANSACTION_MESSAGE

MALFORMED = "_malformed"
#: Messages with unknown fields, whole.
EXTRA = "extra"


def kafka_options(
    servers: str, topic: str = RAW_TOPIC, starting: str = "latest", batch_rows: int | None = None
) -> dict[str, str]:
    """``batch_rows`` bounds a micro-batch; without it a batch takes all that has arrived."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": "false",
    }
    return options if batch_rows is None else options | {"maxOffsetsPerTrigger": str(batch_rows)}


def read_messages(spark: SparkSession, format: str, options: dict[str, str], path: str | None = None) -> DataFrame:
    """A stream of messages. ``kafka`` needs Spark's connector package on the class path;
    file formats read a folder in the ``FILE_MESSAGES`` columns."""
    reader = spark.readStream.format(format).options(**options)
    return reader.load() if format == "kafka" else reader.schema(FILE_MESSAGES).load(path)


def decode(
    messages: DataFrame,
    schema: StructType = TRANSACTION_MESSAGE,
    watermark: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """JSON value -> typed columns + ``kafka_timestamp`` + ``event_time``.

    Unreadable JSON gives a row of NULLs whose text stays in ``_malformed``; an
    unreadable time gives a NULL ``event_time``. ``keep`` names columns of the message to keep.
    """
    arrived = messages.select("value", F.col("timestamp").alias("kafka_timestamp"), *(c for c in keep if c != "value"))
    timed = arrived.select(parse(schema), "kafka_timestamp", *keep).withColumn("event_time", F.try_to_timestamp("timestamp"))
    return timed if watermark is None else timed.withWatermark("event_time", watermark)


def parse(schema: StructType) -> Column:
    """The fields of the JSON ``value`` as columns.

    As a generator (one row per message), so that a filter on the fields stays above it:
    filters pushed below a plain ``from_json`` would parse the text once per field they use.
    """
    with_text = StructType([*schema.fields, StructField(MALFORMED, StringType())])
    options = {"columnNameOfCorruptRecord": MALFORMED}
    return F.inline(F.array(F.from_json(F.col("value").cast("string"), with_text, options)))


def unknown_fields(schema: StructType = TRANSACTION_MESSAGE) -> Column:
    """The whole message as VARIANT if it has fields that ``schema`` does not know, else NULL.
    Kept beside the typed columns it loses nothing, whatever producers add."""
    text = F.col("value").cast("string")
    more = F.exists(F.json_object_keys(text), lambda k: ~k.isin(*schema.names))
    return F.when(more, F.try_parse_json(text)).alias(EXTRA)


def drift(rows: DataFrame, schema: StructType = TRANSACTION_MESSAGE) -> DataFrame:
    """field, kind, messages: what the fields that ``schema`` does not know hold, and how many
    messages have them. ``rows`` have the column EXTRA. ``kind`` is the schema that all values of
    the field share."""
    held = rows.select(EXTRA).where(F.col(EXTRA).isNotNull())
    fields = held.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col(EXTRA).outer()).alias("f")).select("f.key", "f.value")
    unknown = fields.where(~F.col("key").isin(*schema.names))
    return unknown.groupBy(F.col("key").alias("field")).agg(
        F.schema_of_variant_agg("value").alias("kind"), F.count(F.lit(1)).alias("messages")
    )


def backfilled(rows: DataFrame, name: str, kind: str) -> DataFrame:
    """``rows`` with a column that the schema has gained since some of them were loaded: where it
    is missing or NULL, its value comes out of EXTRA (NULL if that can't be cast)."""
    kept = F.try_variant_get(F.col(EXTRA), f"$['{name}']", kind)
    return rows.withColumn(name, F.coalesce(F.col(name), kept) if name in rows.columns else kept)


def split_malformed(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable rows, texts that were no valid message)."""
    bad = F.col(MALFORMED).isNotNull()
    return decoded.where(~bad).drop(MALFORMED), decoded.where(bad).select(MALFORMED, "kafka_timestamp")


def encode(rows: DataFrame, fields: list[str], key: str = "customer_id") -> DataFrame:
    """Message per row, keyed so that one customer stays in one topic partition.
    NULL fields are left out of the JSON."""
    return rows.select(F.col(key).alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def transaction_messages(rows: DataFrame) -> DataFrame:
    """Raw-table rows as the messages they came from."""
    iso = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    shaped = rows.withColumns({"timestamp": iso, "is_fraud": F.col("is_fraud_label")})
    body = F.to_json(F.struct(*TRANSACTION_MESSAGE.names))
    return shaped.select(
        F.col("customer_id").alias("key"), body.alias("value"), F.to_timestamp(iso).alias("timestamp")
    )


def prepare_kafka_output(scored: DataFrame) -> DataFrame:
    """Alert messages: positive scores only."""
    return encode(scored.where(F.col("fraud_score") > 0), ALERT_MESSAGE.names)


def routed_messages(scored: DataFrame) -> DataFrame:
    """Alerts, approved transactions and those without a score (to be reviewed) in one stream;
    ``topic`` says where a message goes, so one query with one pass over the source feeds all
    topics and every transaction reaches one. Messages without a transaction id are no
    transactions: the raw loader keeps them aside."""
    score = F.col("fraud_score")
    named = F.when(score > 0, ALERT_TOPIC).when(score == 0, APPROVED_TOPIC).otherwise(REVIEW_TOPIC)
    topic = F.when(F.col("transaction_id").isNotNull(), named)
    return scored.select(
        F.col("customer_id").alias("key"),
        F.to_json(F.struct(*ALERT_MESSAGE.names)).alias("value"),
        topic.alias("topic"),
    ).where(F.col("topic").isNotNull())


def alert_rows(messages: DataFrame) -> DataFrame:
    """Alert messages as rows of the alert table; a missing event time is the arrival time."""
    alerts = decode(messages, ALERT_MESSAGE)
    when = utc_time(F.coalesce("event_time", "kafka_timestamp"))
    facts = [c for c in ALERT_MESSAGE.names if c not in ("transaction_id", "customer_id", "timestamp")]
    return alerts.where(F.col(MALFORMED).isNull()).select(
        "transaction_id",
        "customer_id",
        when.alias("event_time"),
        utc_time(F.col("kafka_timestamp")).alias("alerted_at"),
        *(F.col(c).cast("decimal(5,2)").alias(c) if c == "fraud_score" else c for c in facts),
    )


def peek_topic(messages: DataFrame, rows: int = 10) -> DataFrame:
    """The latest ``rows`` messages of a stored topic, in short form."""
    both = StructType([*TRANSACTION_MESSAGE.fields, *(f for f in ALERT_MESSAGE if f.name in ("fraud_score", "risk_level"))])
    latest = messages.orderBy(F.desc("timestamp"), F.desc("value")).limit(rows)
    seen = latest.select(F.from_json(F.col("value").cast("string"), both).alias("m")).select("m.*")
    fraud = F.coalesce("is_fraud", F.lit(False)) | (F.coalesce("fraud_score", F.lit(0)) > 0)
    named = {name: F.coalesce(name, F.lit("N/A")) for name in ("customer_id", "merchant_category", "merchant_country", "risk_level")}
    return seen.select(
        F.when(fraud, "FRAUD").otherwise("").alias("fraud_flag"),
        F.round(F.coalesce("amount", F.lit(0.0)), 2).alias("amount"),
        *(value.alias(name) for name, value in named.items()),
    )
