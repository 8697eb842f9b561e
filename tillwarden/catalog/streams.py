"""Streaming queries: the jobs over a stream of the test tables, run until all of it is read."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, VariantType

from tillwarden.catalog import check_sql as C
from tillwarden.catalog import inputs as I
from tillwarden.catalog.batch import _FACTS, _before, _from, SLIDING
from tillwarden.catalog.registry import query
from tillwarden.functions.scalars import utc_time
from tillwarden.operators import merge, quality
from tillwarden.plans import alert_views, nightly, serving
from tillwarden.schemas import ALERT_MESSAGE, FRAUD_ALERTS, TRANSACTIONS_RAW
from tillwarden.session import materialise, new_run_dir
from tillwarden.sources import messages as topics
from tillwarden.sources.keyed import KeyedTable
from tillwarden.sources.tables import TableStore
from tillwarden.streaming import jobs


def _payment_stream(spark, sf_dir):
    """The events table as a stream of payments. A stream takes a folder or a pattern;
    the pattern matches the table whether it is one file or a folder of files."""
    schema = I.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    return I.as_payments(events, I.table(spark, sf_dir, "nation"))


def _message_stream(spark, sf_dir):
    return topics.transaction_messages(_payment_stream(spark, sf_dir))


def _run_to_table(spark, stream, label):
    """Write a stream to files until its source is exhausted, and read them."""
    folder = new_run_dir(spark, label)
    jobs.finish(jobs.to_files(stream, f"{folder}/rows", f"{folder}/offsets", trigger=None))
    return spark.read.parquet(f"{folder}/rows")


_WITH_ZONE = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _plain_times(df):
    """Stream times as the zone-less times of the tables."""
    return df.select(
        *(F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType.typeName() == "timestamp" else f.name for f in df.schema)
    )


@query(C.sql(C.SCORED, "SELECT transaction_id, customer_id, amount, fraud_score, risk_level, fraud_reason FROM scored"))
def stream_scoring(spark, sf_dir):
    scored = jobs.scored(_message_stream(spark, sf_dir), I.PAYMENT_RULES)
    columns = ("transaction_id", "customer_id", "amount", "fraud_score", "risk_level", "fraud_reason")
    return _run_to_table(spark, scored.select(*columns), "scoring")


@query(
    C.sql(
        C.SCORED,
        """SELECT CASE WHEN fraud_score > 0 THEN 'fraud-alerts' ELSE 'approved-transactions' END AS topic,
           customer_id, transaction_id, fraud_score FROM scored""",
    )
)
def stream_routing(spark, sf_dir):
    folder = new_run_dir(spark, "routing")
    job = jobs.start_routing(
        _message_stream(spark, sf_dir), f"{folder}/topics", f"{folder}/offsets", I.PAYMENT_RULES, trigger=None
    )
    jobs.finish(job)
    stored = spark.read.parquet(f"{folder}/topics")
    body = F.from_json("value", ALERT_MESSAGE).alias("m")
    return stored.select("topic", F.col("key").alias("customer_id"), body).select(
        "topic", "customer_id", "m.transaction_id", "m.fraud_score"
    )


@query(
    C.sql(
        C.ALERTS,
        """SELECT transaction_id, customer_id, event_time, amount, merchant_name, merchant_category, merchant_country,
           CAST(fraud_score AS DOUBLE) AS fraud_score, risk_level, fraud_reason, amount_flag, merchant_flag, geo_flag
           FROM alerts""",
    )
)
def stream_alert_loader(spark, sf_dir):
    """One job writes the alert topic, a second one loads that topic into the alert table."""
    folder = new_run_dir(spark, "alerts")
    scoring = jobs.start_alerts(
        _message_stream(spark, sf_dir), f"{folder}/topic", f"{folder}/offsets", I.PAYMENT_RULES, trigger=None
    )
    jobs.finish(scoring)
    topic = topics.read_messages(spark, "parquet", {}, f"{folder}/topic")
    jobs.finish(jobs.start_alert_loader(topic, f"{folder}/table", f"{folder}/loaded", trigger=None))
    loaded = jobs.loaded_rows(spark, f"{folder}/table", FRAUD_ALERTS)
    loaded = loaded.withColumn("fraud_score", F.col("fraud_score").cast("double"))
    return loaded.drop("alert_id", "batch_id", "load_day", "alerted_at", "customer_lat", "customer_lon", "card_type")


@query(
    C.sql(
        C.PAYMENTS,
        """SELECT transaction_id, customer_id, event_time, ingested_at, amount, currency, merchant_name, merchant_category,
           merchant_country, is_fraud_label FROM payments""",
    )
)
def stream_raw_loader(spark, sf_dir):
    folder = new_run_dir(spark, "raw")
    job = jobs.start_raw_loader(_message_stream(spark, sf_dir), f"{folder}/table", f"{folder}/offsets", trigger=None)
    jobs.finish(job)
    return jobs.loaded_rows(spark, f"{folder}/table", TRANSACTIONS_RAW).select(
        "transaction_id", "customer_id", "event_time", "ingested_at", "amount", "currency", "merchant_name",
        "merchant_category", "merchant_country", "is_fraud_label",
    )


@query(
    C.sql(
        C.PAYMENTS,
        """SELECT transaction_id, customer_id, amount, CAST(CASE WHEN event_time < TIMESTAMP '2024-01-11' THEN 0
             WHEN event_time < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS BIGINT) AS batch_id FROM payments""",
    )
)
def stream_compacted_loader(spark, sf_dir):
    """The raw loader's batches, compacted while it goes on: nothing is lost, and rows keep the
    number of their batch."""
    folder = new_run_dir(spark, "compacted")
    rows = I.payments(spark, sf_dir)
    middle = _before(_from(rows, "2024-01-11"), "2024-01-21")
    for part in (_before(rows, "2024-01-11"), middle, _from(rows, "2024-01-21")):
        part.write.mode("append").parquet(f"{folder}/payments")
        messages = topics.transaction_messages(spark.readStream.schema(rows.schema).parquet(f"{folder}/payments"))
        jobs.finish(jobs.start_raw_loader(messages, f"{folder}/table", f"{folder}/offsets", trigger=None))
        jobs.compact_loaded(spark, f"{folder}/table", TRANSACTIONS_RAW)
    return jobs.loaded_rows(spark, f"{folder}/table", TRANSACTIONS_RAW).select("transaction_id", "customer_id", "amount", "batch_id")


def _loaded_with_more(spark, sf_dir):
    """The raw loader over messages of which some have fields that the schema doesn't know."""
    folder = new_run_dir(spark, "more")
    messages = _message_stream(spark, sf_dir)
    n = F.get_json_object("value", "$.transaction_id").cast("long")
    text = F.col("value")
    channel = F.when(n % 2 == 0, F.regexp_replace(text, r"\}$", ',"channel":"app"}'))
    points = F.when(n % 3 == 0, F.regexp_replace(text, r"\}$", F.concat(F.lit(',"points":'), (n % 7).cast("string"), F.lit("}"))))
    jobs.finish(
        jobs.start_raw_loader(
            messages.withColumn("value", F.coalesce(channel, points, text)),
            f"{folder}/table", f"{folder}/offsets", trigger=None, keep_unknown=True,
        )
    )
    return jobs.loaded_rows(spark, f"{folder}/table", StructType([*TRANSACTIONS_RAW.fields, StructField(topics.EXTRA, VariantType())]))


@query(
    C.sql(
        C.PAYMENTS,
        """SELECT 'channel' AS field, 'STRING' AS kind, count(*) AS messages FROM payments WHERE id % 2 = 0
           UNION ALL SELECT 'points', 'BIGINT', count(*) FROM payments WHERE id % 2 = 1 AND id % 3 = 0""",
    )
)
def schema_drift(spark, sf_dir):
    """Fields that messages have beyond the schema, and what they hold."""
    return topics.drift(_loaded_with_more(spark, sf_dir))


@query(
    C.sql(
        C.PAYMENTS,
        """SELECT transaction_id, amount, CASE WHEN id % 2 = 0 THEN 'app' END AS channel,
           CAST(CASE WHEN id % 2 = 1 AND id % 3 = 0 THEN id % 7 ELSE -1 END AS INTEGER) AS points FROM payments""",
    )
)
def added_columns(spark, sf_dir):
    """Columns that the schema gained after the rows were loaded, filled from what was kept."""
    rows = topics.backfilled(topics.backfilled(_loaded_with_more(spark, sf_dir), "channel", "string"), "points", "int")
    return rows.select("transaction_id", "amount", "channel", F.coalesce("points", F.lit(-1)).alias("points"))


# The watermark ends 30 seconds before the latest event; only windows before it are final.
_CLOSED = "(SELECT max(event_time) - INTERVAL 30 SECOND FROM payments)"


@query(
    C.sql(
        C.PAYMENTS,
        f"""SELECT customer_id, date_trunc('day', event_time)::TIMESTAMP AS window_start,
           date_trunc('day', event_time)::TIMESTAMP + INTERVAL 1 DAY AS window_end, count(*) AS txn_count,
           'VELOCITY' AS rule, 'CRITICAL' AS risk_level FROM payments
           WHERE date_trunc('day', event_time)::TIMESTAMP + INTERVAL 1 DAY <= {_CLOSED}
           GROUP BY 1, 2, 3 HAVING count(*) > 5""",
    )
)
def stream_velocity(spark, sf_dir):
    transactions = jobs.transactions(_message_stream(spark, sf_dir))
    return _plain_times(_run_to_table(spark, jobs.velocity_alerts(transactions, I.PAYMENT_RULES), "velocity"))


@query(
    C.sql(
        C.PAYMENTS + SLIDING,
        f"""SELECT customer_id, window_start, window_end, countries, 'MULTI_COUNTRY' AS rule, 'CRITICAL' AS risk_level
            FROM countries_in WHERE window_end <= {_CLOSED}""",
    )
)
def stream_multi_country(spark, sf_dir):
    transactions = jobs.transactions(_message_stream(spark, sf_dir))
    return _plain_times(_run_to_table(spark, jobs.multi_country_alerts(transactions, I.PAYMENT_RULES), "spread"))


@query(
    C.sql(
        C.PAYMENTS + SLIDING,
        f"""SELECT customer_id, window_start, window_end, countries, 'MULTI_COUNTRY' AS rule, 'CRITICAL' AS risk_level
            FROM (
              SELECT *, max(window_end) OVER (PARTITION BY customer_id, run) AS run_end,
                     row_number() OVER (PARTITION BY customer_id, run ORDER BY window_start) AS place
              FROM (
                SELECT *, sum(fresh) OVER (PARTITION BY customer_id ORDER BY window_start) AS run
                FROM (
                  SELECT *, CASE WHEN lag(window_start) OVER (PARTITION BY customer_id ORDER BY window_start)
                                 >= window_start - INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh
                  FROM countries_in)))
            WHERE place = 1 AND run_end + INTERVAL 9 HOUR <= {_CLOSED}""",
    )
)
def stream_multi_country_first(spark, sf_dir):
    """One alert per run of windows, for runs that the watermark has closed."""
    transactions = jobs.transactions(_message_stream(spark, sf_dir))
    return _plain_times(_run_to_table(spark, jobs.first_multi_country_alerts(transactions, I.PAYMENT_RULES), "first"))


@query(C.sql(C.PAYMENTS, "SELECT transaction_id, customer_id, amount FROM payments"))
def stream_dedup(spark, sf_dir):
    """Every message delivered twice."""
    delivered = _message_stream(spark, sf_dir).union(_message_stream(spark, sf_dir))
    once = jobs.without_redelivery(jobs.transactions(delivered))
    return _run_to_table(spark, once.select("transaction_id", "customer_id", "amount"), "once")


@query(
    C.sql(
        C.ALERTS,
        """SELECT transaction_id, customer_id FROM payments p WHERE EXISTS (SELECT 1 FROM alerts a
           WHERE a.customer_id = p.customer_id AND a.event_time BETWEEN p.event_time - INTERVAL 1 DAY AND p.event_time)""",
    )
)
def stream_repeat_offences(spark, sf_dir):
    """The stream against the alert table, which every batch opens anew, from the days on that
    matter to it; the alerts of each half of the month are loaded just before its payments come."""
    folder = new_run_dir(spark, "repeat")
    schema = I.payments(spark, sf_dir).schema
    for part in _halves(I.payments(spark, sf_dir)):
        part.write.mode("append").parquet(f"{folder}/payments")
        messages = topics.transaction_messages(spark.readStream.schema(schema).parquet(f"{folder}/payments"))
        scoring = jobs.start_alerts(messages, f"{folder}/topic", f"{folder}/scored", I.PAYMENT_RULES, trigger=None)
        jobs.finish(scoring)
        topic = topics.read_messages(spark, "parquet", {}, f"{folder}/topic")
        jobs.finish(jobs.start_alert_loader(topic, f"{folder}/alerts", f"{folder}/loaded", trigger=None))
        stream = jobs.transactions(messages).select("transaction_id", "customer_id", "event_time")
        look_up = jobs.start_loaded_offences(
            stream, f"{folder}/alerts", f"{folder}/hits", f"{folder}/offsets", timedelta(days=1), trigger=None
        )
        jobs.finish(look_up)
    return spark.read.parquet(f"{folder}/hits").select("transaction_id", "customer_id")


def _halves(rows):
    return _before(rows, "2024-01-16"), _from(rows, "2024-01-16")


@query(
    C.sql(
        C.ALERTS,
        """SELECT transaction_id, customer_id FROM payments p WHERE EXISTS (SELECT 1 FROM alerts a
           WHERE a.customer_id = p.customer_id AND a.event_time BETWEEN p.event_time - INTERVAL 1 DAY AND p.event_time)""",
    )
)
def stream_repeat_join(spark, sf_dir):
    """The same question by two streams: payments against alerts, no table."""
    payments = jobs.transactions(_message_stream(spark, sf_dir)).select("transaction_id", "customer_id", "event_time")
    alerts = jobs.scored(_message_stream(spark, sf_dir), I.PAYMENT_RULES).where(F.col("fraud_score") > 0)
    hits = jobs.repeat_offences(payments, alerts, timedelta(days=1))
    return _run_to_table(spark, hits.select("transaction_id", "customer_id"), "repeat-join")


@query(
    C.sql(
        C.PAYMENTS,
        """SELECT DISTINCT customer_id, event_time, 'VELOCITY' AS rule, 'CRITICAL' AS risk_level FROM (
             SELECT *, count(*) OVER (PARTITION BY customer_id ORDER BY event_time
                       RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS recent FROM payments)
           WHERE recent > 5""",
    )
)
def stream_early_velocity(spark, sf_dir):
    """Every payment that is one too many, told in the batch that brings it."""
    folder = new_run_dir(spark, "bursts")
    stream = jobs.transactions(_message_stream(spark, sf_dir))
    jobs.finish(jobs.start_early_velocity(stream, f"{folder}/alerts", f"{folder}/offsets", I.PAYMENT_RULES, trigger=None))
    return _plain_times(spark.read.parquet(f"{folder}/alerts").drop("recent_transactions"))


@query(
    C.sql(
        C.PAYMENTS,
        """SELECT transaction_id, event_time, CASE WHEN event_time < TIMESTAMP '2024-01-16'
             AND event_time <= (SELECT max(event_time) - INTERVAL 30 SECOND FROM payments WHERE event_time >= TIMESTAMP '2024-01-16')
             THEN 'late' ELSE 'kept' END AS place FROM payments""",
    )
)
def stream_late_account(spark, sf_dir):
    """The second half of the month comes first, in two batches, so that the first half is behind
    the watermark: every row is found again, among the kept or among the late ones."""
    folder = new_run_dir(spark, "account")
    schema = I.payments(spark, sf_dir).schema
    early, later = _halves(I.payments(spark, sf_dir))
    for part in (_from(later, "2024-01-21"), _before(later, "2024-01-21"), early):
        part.write.mode("append").parquet(f"{folder}/payments")
        messages = topics.transaction_messages(spark.readStream.schema(schema).parquet(f"{folder}/payments"))
        jobs.finish(jobs.start_accounted(jobs.transactions(messages), folder, f"{folder}/offsets", trigger=None))
    kept, late = (spark.read.parquet(f"{folder}/{p}").select("transaction_id", "event_time", F.lit(p).alias("place")) for p in ("kept", "late"))
    return _plain_times(kept.unionByName(late))


@query(
    C.sql(
        C.ALERTS,
        f"""SELECT p.transaction_id, p.customer_id, coalesce(f.total_fraud_alerts, 0) AS total_fraud_alerts,
            coalesce(f.risk_tier, 'UNKNOWN') AS risk_tier
            FROM payments p LEFT JOIN (SELECT customer_id, {_FACTS} FROM alerts GROUP BY customer_id) f
            ON p.customer_id = f.customer_id""",
    )
)
def stream_profile_lookup(spark, sf_dir):
    """The stream with its customers' profiles."""
    folder = new_run_dir(spark, "known")
    profiles = materialise(alert_views.profile_facts(I.payment_alerts(spark, sf_dir), None))
    stream = jobs.transactions(_message_stream(spark, sf_dir)).select("transaction_id", "customer_id")
    jobs.finish(jobs.start_profile_lookup(stream, lambda: profiles, f"{folder}/rows", f"{folder}/offsets", trigger=None))
    return spark.read.parquet(f"{folder}/rows").select("transaction_id", "customer_id", "total_fraud_alerts", "risk_tier")


@query(
    C.sql(
        C.ALERTS,
        f"""SELECT p.transaction_id, p.customer_id, coalesce(f.total_fraud_alerts, 0) AS total_fraud_alerts,
            coalesce(f.risk_tier, 'UNKNOWN') AS risk_tier
            FROM payments p LEFT JOIN (SELECT customer_id, {_FACTS} FROM alerts GROUP BY customer_id) f
            ON p.customer_id = f.customer_id""",
    )
)
def stream_keyed_lookup(spark, sf_dir):
    """The stream with its customers' profiles out of a table laid out by customer."""
    folder = new_run_dir(spark, "keyed-lookup")
    profiles = KeyedTable(TableStore(spark, f"{folder}/store"), "profiles", "customer_id", buckets=8)
    profiles.upsert(alert_views.profile_facts(I.payment_alerts(spark, sf_dir), None))
    stream = jobs.transactions(_message_stream(spark, sf_dir)).select("transaction_id", "customer_id")
    jobs.finish(jobs.start_keyed_lookup(stream, profiles, f"{folder}/rows", f"{folder}/offsets", trigger=None))
    return spark.read.parquet(f"{folder}/rows").select("transaction_id", "customer_id", "total_fraud_alerts", "risk_tier")


@query(C.sql(C.ALERTS, f"SELECT customer_id, {_FACTS} FROM alerts GROUP BY customer_id"))
def stream_profiles(spark, sf_dir):
    folder = new_run_dir(spark, "profiles")
    alerts = jobs.scored(_message_stream(spark, sf_dir), I.PAYMENT_RULES).where(F.col("fraud_score") > 0)
    jobs.finish(jobs.start_profiles(alerts, f"{folder}/changes", f"{folder}/offsets", trigger=None))
    return _plain_times(jobs.current_profiles(spark, f"{folder}/changes"))


@query(C.sql(C.ALERTS, f"SELECT customer_id, {_FACTS} FROM alerts GROUP BY customer_id"))
def stream_profile_state(spark, sf_dir):
    """The same profiles out of the query's state."""
    folder = new_run_dir(spark, "state")
    alerts = jobs.scored(_message_stream(spark, sf_dir), I.PAYMENT_RULES).where(F.col("fraud_score") > 0)
    jobs.finish(jobs.start_profiles(alerts, f"{folder}/changes", f"{folder}/offsets", trigger=None))
    return _plain_times(jobs.profiles_in_state(spark, f"{folder}/offsets"))


@query(
    C.sql(
        C.SCORED,
        """SELECT check_name, 'scored' AS table_name, CAST(violations AS BIGINT) AS violations, violations = 0 AS passed FROM (
             SELECT 'not_null_transaction_id' AS check_name, count(*) FILTER (transaction_id IS NULL) AS violations FROM scored
             UNION ALL SELECT 'not_null_merchant_country', count(*) FILTER (merchant_country IS NULL) FROM scored
             UNION ALL SELECT 'accepted_values_risk_level', count(*) FILTER (risk_level NOT IN ('LOW', 'MEDIUM')) FROM scored)""",
    )
)
def stream_quality(spark, sf_dir):
    """Checks counted while the scored stream is written; HIGH and CRITICAL are not accepted here,
    so that there is something to find."""
    folder = new_run_dir(spark, "checked")
    scored = jobs.scored(_message_stream(spark, sf_dir), I.PAYMENT_RULES)
    wanted = lambda: [
        quality.not_null("transaction_id"), quality.not_null("merchant_country"), quality.accepted_values("risk_level", ("LOW", "MEDIUM")),
    ]
    jobs.finish(jobs.to_checked_batches(scored, folder, f"{folder}/offsets", wanted, trigger=None))
    return jobs.checked_report(spark, folder, "scored")


@query(
    C.sql(
        C.PAYMENTS,
        """SELECT count(*) AS total_sent, count(*) FILTER (is_fraud_label) AS total_fraud,
           round(count(*) FILTER (is_fraud_label) / count(*) * 100, 1) AS fraud_pct FROM payments""",
    )
)
def stream_running_totals(spark, sf_dir):
    folder = new_run_dir(spark, "totals")
    totals = serving.running_totals(_payment_stream(spark, sf_dir))
    jobs.finish(jobs.to_numbered_batches(totals, f"{folder}/totals", f"{folder}/offsets", "complete", trigger=None))
    return jobs.newest_batch(spark, f"{folder}/totals")


@query(C.sql(C.PAYMENTS, "SELECT transaction_id, amount, event_time FROM payments WHERE event_time >= TIMESTAMP '2024-01-16'"))
def change_feed(spark, sf_dir):
    """Two runs of the feed over a growing table; the second sees only the rows added since."""
    folder = new_run_dir(spark, "feed")
    rows = I.payments(spark, sf_dir).select("transaction_id", "amount", "event_time")
    mark, seen = -1, None
    for part in (_before(rows, "2024-01-16"), _from(rows, "2024-01-16")):
        part.write.mode("append").parquet(f"{folder}/table")
        feed = jobs.start_change_feed(spark, f"{folder}/table", rows.schema, f"{folder}/changes", f"{folder}/offsets")
        jobs.finish(feed)
        seen, mark = jobs.changes_after(spark, f"{folder}/changes", rows.schema, mark)
    return seen


@query(
    C.sql(
        C.FLAGS,
        """SELECT transaction_id, customer_id, event_time, amount, CAST(fraud_score AS DOUBLE) AS fraud_score, risk_level, is_flagged,
           'flags' AS place FROM flags
           UNION ALL SELECT transaction_id, customer_id, event_time, -1.0, -1.0, '', FALSE, 'rejects' FROM payments
           WHERE CAST(transaction_id AS BIGINT) % 10 = 3""",
    )
)
def stream_to_gold(spark, sf_dir):
    """Messages, some twice and some without their amount besides, through the loaders and the
    daily run: the flags of all payments, and the messages that were put aside."""
    folder = new_run_dir(spark, "gold")
    good = _message_stream(spark, sf_dir)
    amount_gone = F.to_json(F.struct(*(F.get_json_object("value", f"$.{c}").alias(c) for c in ("transaction_id", "customer_id", "timestamp"))))
    third = F.get_json_object("value", "$.transaction_id").cast("long") % 10 == 3
    bad = good.where(third).withColumn("value", amount_gone)
    everything = good.unionByName(good.where(third)).unionByName(bad)
    jobs.finish(jobs.start_alerts(good, f"{folder}/topic", f"{folder}/o1", I.PAYMENT_RULES, trigger=None))
    topic = topics.read_messages(spark, "parquet", {}, f"{folder}/topic")
    jobs.finish(jobs.start_alert_loader(topic, f"{folder}/alerts", f"{folder}/o2", trigger=None))
    jobs.finish(jobs.start_raw_loader(everything, f"{folder}/raw", f"{folder}/o3", trigger=None))
    raw = jobs.loaded_rows(spark, f"{folder}/raw", TRANSACTIONS_RAW)
    alerts = jobs.loaded_rows(spark, f"{folder}/alerts", FRAUD_ALERTS).drop("batch_id", "load_day")
    store = TableStore(spark, f"{folder}/store")
    nightly.run(store, raw, alerts, I.AS_OF, ("bronze", "silver"), ingest_date="load_day")
    flags = store.read("fraud_flags").select(
        "transaction_id", "customer_id", "event_time", "amount", F.col("fraud_score").cast("double").alias("fraud_score"),
        "risk_level", "is_flagged", F.lit("flags").alias("place"),
    )
    message = F.col("message")
    rejects = jobs.loaded_rejects(spark, f"{folder}/raw").select(
        F.get_json_object(message, "$.transaction_id").alias("transaction_id"),
        F.get_json_object(message, "$.customer_id").alias("customer_id"),
        utc_time(F.to_timestamp(F.get_json_object(message, "$.timestamp"))).alias("event_time"),
        F.lit("rejects").alias("place"),
    )
    missing = {"amount": F.lit(-1.0), "fraud_score": F.lit(-1.0), "risk_level": F.lit(""), "is_flagged": F.lit(False)}
    return merge.with_defaults(flags.unionByName(rejects, allowMissingColumns=True), missing)
