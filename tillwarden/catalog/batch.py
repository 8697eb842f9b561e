"""Batch queries: each operator and model over whole test tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from tillwarden.catalog import check_sql as C
from tillwarden.catalog import inputs as I
from tillwarden.catalog.registry import query
from tillwarden.operators import behaviour, merge, quality, rules
from tillwarden.operators.dedup import keep_first
from tillwarden.plans import alert_views, gold, layers, nightly, serving
from tillwarden.plans.daily_states import AlertDays, GoldStates
from tillwarden.schemas import ALERT_MESSAGE, CUSTOMER_RISK_PROFILES
from tillwarden.session import materialise, new_run_dir
from tillwarden.sources import messages as topics
from tillwarden.sources.keyed import KeyedTable
from tillwarden.sources.tables import TableStore

DAY = timedelta(days=1)


def _before(df, moment, column="event_time"):
    return df.where(F.col(column) < F.lit(moment).cast("timestamp_ntz"))


def _from(df, moment, column="event_time"):
    return df.where(F.col(column) >= F.lit(moment).cast("timestamp_ntz"))


# Scoring rules

@query(C.sql(C.SCORED, "SELECT transaction_id, amount, amount_flag, amount_reason FROM signals"))
def amount_rule(spark, sf_dir):
    flagged = rules.apply_amount_rule(I.payments(spark, sf_dir), I.PAYMENT_RULES)
    return flagged.select("transaction_id", "amount", "amount_flag", "amount_reason")


@query(C.sql(C.SCORED, "SELECT transaction_id, merchant_name, merchant_category, merchant_flag, merchant_reason FROM signals"))
def merchant_rule(spark, sf_dir):
    flagged = rules.apply_merchant_rule(I.payments(spark, sf_dir), I.PAYMENT_RULES)
    return flagged.select("transaction_id", "merchant_name", "merchant_category", "merchant_flag", "merchant_reason")


@query(C.sql(C.SCORED, "SELECT transaction_id, merchant_country, geo_flag, geo_reason FROM signals"))
def geo_country_rule(spark, sf_dir):
    flagged = rules.apply_geo_country_rule(I.payments(spark, sf_dir), I.PAYMENT_RULES)
    return flagged.select("transaction_id", "merchant_country", "geo_flag", "geo_reason")


@query(C.sql(C.SCORED, "SELECT transaction_id, fraud_score, risk_level, fraud_reason FROM scored"))
def fraud_score(spark, sf_dir):
    return I.scored_payments(spark, sf_dir).select("transaction_id", "fraud_score", "risk_level", "fraud_reason")


@query(
    C.sql(
        C.SCORED,
        """SELECT transaction_id, risk_level, CASE risk_level WHEN 'LOW' THEN 'APPROVE' WHEN 'MEDIUM' THEN 'MONITOR'
           WHEN 'HIGH' THEN 'REVIEW' ELSE 'BLOCK_AND_ALERT' END AS action FROM scored""",
    )
)
def action_for_level(spark, sf_dir):
    return rules.with_action(I.scored_payments(spark, sf_dir)).select("transaction_id", "risk_level", "action")


@query(
    C.sql(
        C.SCORED + """,
counted AS (
  SELECT CAST(event_time AS DATE) AS transaction_date,
         count(*) FILTER (fraud_score > 0 AND is_fraud_label) AS true_positives,
         count(*) FILTER (fraud_score > 0 AND NOT is_fraud_label) AS false_positives,
         count(*) FILTER (fraud_score = 0 AND is_fraud_label) AS false_negatives,
         count(*) FILTER (fraud_score = 0 AND NOT is_fraud_label) AS true_negatives
  FROM scored GROUP BY 1
)""",
        """SELECT *, round(true_positives / nullif(true_positives + false_negatives, 0) * 100, 2) AS detection_rate_pct,
           round(true_positives / nullif(true_positives + false_positives, 0) * 100, 2) AS precision_pct,
           round(false_positives / nullif(false_positives + true_negatives, 0) * 100, 2) AS false_positive_rate_pct
           FROM counted""",
    )
)
def rule_quality(spark, sf_dir):
    dated = I.scored_payments(spark, sf_dir).withColumn("transaction_date", F.to_date("event_time"))
    return rules.rule_quality(dated, "transaction_date")


# Messages

@query(
    C.sql(
        C.ALERTS,
        """SELECT transaction_id, customer_id, event_time, amount, merchant_name, merchant_category, merchant_country,
           fraud_score, risk_level, fraud_reason, amount_flag, merchant_flag, geo_flag FROM alerts""",
    )
)
def fraud_alerts(spark, sf_dir):
    """Transactions as messages, scored, and the alert messages read back."""
    transactions = topics.decode(topics.transaction_messages(I.payments(spark, sf_dir)))
    alerts = topics.prepare_kafka_output(rules.apply_fraud_detection(transactions, I.PAYMENT_RULES))
    read = alerts.select(F.from_json("value", ALERT_MESSAGE).alias("m")).select("m.*")
    timed = read.withColumn("event_time", F.try_to_timestamp("timestamp").cast("timestamp_ntz"))
    return timed.drop("timestamp", "customer_lat", "customer_lon", "card_type")


@query(
    C.sql(
        C.SCORED,
        """SELECT CASE WHEN fraud_score > 0 THEN 'fraud-alerts' ELSE 'approved-transactions' END AS topic,
           customer_id, transaction_id, fraud_score FROM scored""",
    )
)
def approved_split(spark, sf_dir):
    transactions = topics.decode(topics.transaction_messages(I.payments(spark, sf_dir)))
    routed = topics.routed_messages(rules.apply_fraud_detection(transactions, I.PAYMENT_RULES))
    body = F.from_json("value", ALERT_MESSAGE).alias("m")
    return routed.select("topic", F.col("key").alias("customer_id"), body).select(
        "topic", "customer_id", "m.transaction_id", "m.fraud_score"
    )


@query(
    C.sql(
        C.PAYMENTS,
        """SELECT transaction_id, customer_id, event_time, amount, currency, merchant_name, merchant_category,
           merchant_country, is_fraud_label AS is_fraud FROM payments""",
    )
)
def json_roundtrip(spark, sf_dir):
    decoded = topics.decode(topics.transaction_messages(I.payments(spark, sf_dir)))
    readable, _ = topics.split_malformed(decoded)
    return readable.select(
        "transaction_id",
        "customer_id",
        F.col("event_time").cast("timestamp_ntz").alias("event_time"),
        "amount",
        "currency",
        "merchant_name",
        "merchant_category",
        "merchant_country",
        "is_fraud",
    )


@query(
    C.sql(
        C.PAYMENTS,
        """SELECT CASE WHEN is_fraud_label THEN 'FRAUD' ELSE '' END AS fraud_flag, round(amount, 2) AS amount,
           customer_id, merchant_category, merchant_country, 'N/A' AS risk_level
           FROM payments ORDER BY event_time DESC, id DESC LIMIT 10""",
    )
)
def topic_sample(spark, sf_dir):
    return topics.peek_topic(topics.transaction_messages(I.payments(spark, sf_dir)), 10)


# Layers and merges

@query(
    C.sql(
        C.PURCHASES + f""",
old_load AS (SELECT * FROM purchases WHERE ingested_at < TIMESTAMP '2000-01-01 00:00:00'),
new_load AS (
  SELECT * FROM purchases WHERE ingested_at > (SELECT max(ingested_at) FROM old_load)
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY {C.COPY_ORDER}) = 1
),
both_loads AS (
  SELECT *, TIMESTAMP '2000-01-02 00:00:00' AS dbt_loaded_at FROM old_load
  WHERE transaction_id NOT IN (SELECT transaction_id FROM new_load)
  UNION ALL SELECT *, TIMESTAMP '2003-01-01 00:00:00' FROM new_load
)""",
        """SELECT transaction_id, customer_id, event_time, ingested_at, amount, merchant_name, merchant_category,
           merchant_country, customer_lat, customer_lon, is_fraud_label, dbt_loaded_at FROM both_loads""",
    )
)
def bronze_incremental(spark, sf_dir):
    """A first load, then a second one above its high-water mark, merged by id. Loads
    read the raw table several times, so it is written first, as it would be."""
    raw = materialise(I.purchases(spark, sf_dir))
    table = layers.bronze_raw_transactions(_before(raw, "2000-01-01"), "2000-01-02 00:00:00")
    load = layers.bronze_raw_transactions(raw, I.PURCHASES_AS_OF, table)
    return merge.upsert(table, load, ["transaction_id"]).drop(
        "raw_id", "customer_name", "currency", "card_last4", "card_type", "fraud_type"
    )


@query(
    C.sql(
        C.PAYMENTS + """,
old_rows AS (SELECT transaction_id, event_time, 30 * (amount > 100)::INT AS points FROM payments
             WHERE event_time < TIMESTAMP '2024-01-21'),
new_rows AS (SELECT transaction_id, event_time, 30 * (amount > 200)::INT AS points FROM payments
             WHERE event_time >= TIMESTAMP '2024-01-11')""",
        """SELECT * FROM old_rows WHERE transaction_id NOT IN (SELECT transaction_id FROM new_rows)
           UNION ALL SELECT * FROM new_rows""",
    )
)
def upsert_by_key(spark, sf_dir):
    """Scores of the first twenty days, then ten of those and the rest scored anew."""
    rows = I.payments(spark, sf_dir)

    def scored(df, limit):
        return df.select("transaction_id", "event_time", ((F.col("amount") > limit).cast("int") * 30).alias("points"))

    target = scored(_before(rows, "2024-01-21"), 100)
    return merge.upsert(target, scored(_from(rows, "2024-01-11"), 200), ["transaction_id"])


@query(
    C.sql(
        C.CLEAN,
        """SELECT transaction_id, customer_id, event_time, amount, merchant_name, merchant_category, merchant_country,
           is_fraud_label FROM first_copies""",
    )
)
def dedup_first(spark, sf_dir):
    first = keep_first(I.purchases(spark, sf_dir), ["transaction_id"], ["event_time"])
    return first.select(
        "transaction_id", "customer_id", "event_time", "amount", "merchant_name", "merchant_category",
        "merchant_country", "is_fraud_label",
    )


@query(C.sql(C.CLEAN, "SELECT * FROM clean"))
def clean_transactions(spark, sf_dir):
    clean = layers.silver_clean_transactions(I.purchases_bronze(spark, sf_dir), I.PURCHASES_AS_OF)
    return clean.drop("dbt_loaded_at", "card_last4", "fraud_type")


@query(
    C.sql(
        C.PURCHASES + f""",
old_load AS (SELECT * FROM purchases WHERE ingested_at < TIMESTAMP '2000-01-01 00:00:00'
             QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY {C.COPY_ORDER}) = 1),
new_load AS (SELECT * FROM purchases WHERE ingested_at >= TIMESTAMP '2000-01-01 00:00:00'
             QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY {C.COPY_ORDER}) = 1),
both_loads AS (
  SELECT *, TIMESTAMP '2000-01-02 00:00:00' AS silver_loaded_at FROM old_load
  WHERE transaction_id NOT IN (SELECT transaction_id FROM new_load)
  UNION ALL SELECT *, TIMESTAMP '2003-01-01 00:00:00' FROM new_load
)""",
        """SELECT transaction_id, event_time, round(amount, 2) AS amount, lower(merchant_category) AS merchant_category,
           silver_loaded_at FROM both_loads""",
    )
)
def clean_incremental(spark, sf_dir):
    """Within a load the first copy of an id wins, across loads the last load."""
    raw = materialise(I.purchases(spark, sf_dir))
    early = layers.bronze_raw_transactions(_before(raw, "2000-01-01"), "2000-01-02 00:00:00")
    late = layers.bronze_raw_transactions(_from(raw, "2000-01-01"), I.PURCHASES_AS_OF)
    table = layers.silver_clean_transactions(early, "2000-01-02 00:00:00")
    load = layers.silver_clean_transactions(early.unionByName(late), I.PURCHASES_AS_OF, table)
    merged = merge.upsert(table, load, ["transaction_id"])
    return merged.select("transaction_id", "event_time", "amount", "merchant_category", "silver_loaded_at")


@query(
    C.sql(
        C.PURCHASES,
        """SELECT transaction_id, event_time, amount, CAST(event_time AS DATE) AS transaction_date,
           CAST(hour(event_time) AS BIGINT) AS transaction_hour, CAST(dayofweek(event_time) + 1 AS BIGINT) AS day_of_week,
           dayofweek(event_time) IN (0, 6) AS is_weekend,
           CASE WHEN amount < 10 THEN 'micro' WHEN amount < 100 THEN 'small' WHEN amount < 500 THEN 'medium'
                WHEN amount < 1000 THEN 'large' ELSE 'very_large' END AS amount_bucket FROM purchases""",
    )
)
def amount_bucket_time_features(spark, sf_dir):
    featured = I.purchases(spark, sf_dir).select(*layers.cleaned_columns())
    return featured.select(
        "transaction_id", "event_time", "amount", "transaction_date", "transaction_hour", "day_of_week", "is_weekend",
        "amount_bucket",
    )


@query(
    C.sql(
        C.CLEAN,
        """SELECT transaction_id, customer_lat, customer_lon,
           customer_lat IS NOT NULL AND customer_lon IS NOT NULL AS complete FROM clean""",
    )
)
def quality_filter(spark, sf_dir):
    """Cleaned purchases split by the required values, here also the coordinates."""
    clean = layers.silver_clean_transactions(I.purchases_bronze(spark, sf_dir), I.PURCHASES_AS_OF)
    required = ("transaction_id", "customer_id", "event_time", "amount", "customer_lat", "customer_lon")
    complete, rejected = layers.split_incomplete(clean, required)
    columns = ("transaction_id", "customer_lat", "customer_lon")
    return complete.select(*columns, F.lit(True).alias("complete")).unionByName(
        rejected.select(*columns, F.lit(False).alias("complete"))
    )


@query(
    C.sql(
        C.FLAGS,
        """SELECT transaction_id, customer_id, event_time, amount, merchant_category, merchant_country, fraud_score,
           risk_level, fraud_reason, amount_flag, merchant_flag, geo_flag, alerted_at, is_flagged FROM flags""",
    )
)
def fraud_flags(spark, sf_dir):
    return I.flagged_payments(spark, sf_dir).select(
        "transaction_id", "customer_id", "event_time", "amount", "merchant_category", "merchant_country", "fraud_score",
        "risk_level", "fraud_reason", "amount_flag", "merchant_flag", "geo_flag", "alerted_at", "is_flagged",
    )


@query(
    C.sql(
        C.ALERTS + """,
doubled AS (
  SELECT transaction_id, fraud_score, alerted_at FROM alerts
  UNION ALL SELECT transaction_id, fraud_score, alerted_at + INTERVAL 1 HOUR FROM alerts
)""",
        """SELECT p.transaction_id, coalesce(d.fraud_score, 0) AS fraud_score, d.alerted_at,
           d.transaction_id IS NOT NULL AS is_flagged
           FROM payments p LEFT JOIN doubled d ON p.transaction_id = d.transaction_id""",
    )
)
def fraud_flags_all_alerts(spark, sf_dir):
    """Alerts delivered twice, each joined: a flagged transaction has two rows."""
    alerts = I.payment_alerts(spark, sf_dir)
    again = alerts.withColumn("alerted_at", F.col("alerted_at") + F.expr("INTERVAL 1 HOUR"))
    flags = layers.silver_fraud_flags(
        I.cleaned_payments(spark, sf_dir), alerts.unionByName(again), I.AS_OF, dedup_alerts=False
    )
    return flags.select("transaction_id", "fraud_score", "alerted_at", "is_flagged")


@query(
    C.sql(
        C.FLAGS,
        """SELECT transaction_id, fraud_score, is_flagged, CASE WHEN event_time >= TIMESTAMP '2024-01-16' OR (is_flagged
           AND event_time >= TIMESTAMP '2024-01-11') THEN TIMESTAMP '2024-01-31' ELSE TIMESTAMP '2024-01-16' END
           AS fraud_flags_loaded_at FROM flags""",
    )
)
def flags_incremental(spark, sf_dir):
    """Second run: new transactions, and older ones whose alert came late."""
    first_day, late_from = "2024-01-16", "2024-01-11"
    clean, alerts = materialise(I.cleaned_payments(spark, sf_dir)), materialise(I.payment_alerts(spark, sf_dir))
    loaded = F.when(_is_before(first_day), F.lit(first_day)).otherwise(F.lit("2024-01-31")).cast("timestamp_ntz")
    staged = clean.withColumn("silver_loaded_at", loaded)
    table = layers.silver_fraud_flags(_before(staged, first_day), _before(alerts, late_from), first_day)
    load = layers.silver_fraud_flags(staged, alerts, "2024-01-31", table)
    merged = merge.upsert(table, load, ["transaction_id"])
    return merged.select("transaction_id", "fraud_score", "is_flagged", "fraud_flags_loaded_at")


def _is_before(moment):
    return F.col("event_time") < F.lit(moment).cast("timestamp_ntz")


@query(
    C.sql(
        C.PAYMENTS,
        """SELECT transaction_id, amount, CASE WHEN event_time >= TIMESTAMP '2024-01-16' THEN merchant_category END
           AS merchant_category FROM payments""",
    )
)
def schema_sync(spark, sf_dir):
    """The table still has a column the source dropped, and lacks one the source added."""
    rows = I.payments(spark, sf_dir)
    table = _before(rows, "2024-01-20").select("transaction_id", "amount", F.lit("web").alias("channel"))
    source = _from(rows, "2024-01-16").select("transaction_id", "amount", "merchant_category")
    return merge.upsert(table, source, ["transaction_id"])


@query(
    C.sql(
        C.PAYMENTS,
        """SELECT CAST(event_time AS DATE) AS transaction_date, count(*) AS rows_loaded, count(*) AS distinct_ids,
           TRUE AS above_start, count(*) AS usd_rows FROM payments GROUP BY 1""",
    )
)
def surrogate_keys(spark, sf_dir):
    """Ids and defaults for new rows. The ids themselves are arbitrary; shown is that
    every row has its own one, above those given out before."""
    rows = I.payments(spark, sf_dir).drop("id").withColumn("currency", F.lit(None).cast("string"))
    start = merge.next_id(I.payments(spark, sf_dir), "id")
    keyed = merge.assign_ids(merge.with_defaults(rows, {"currency": F.lit("USD")}), "id", start)
    once = keyed.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.to_date("event_time")).alias("transaction_date"),
        F.count_if(F.col("currency") == "USD").alias("usd"),
    )
    return once.groupBy("transaction_date").agg(
        F.sum("n").alias("rows_loaded"),
        F.count(F.lit(1)).alias("distinct_ids"),
        (F.min("id") >= start).alias("above_start"),
        F.sum("usd").alias("usd_rows"),
    )


# Gold

@query(
    C.sql(
        C.FLAGS,
        """SELECT transaction_date, count(*) AS total_transactions, count(*) FILTER (is_flagged) AS flagged_transactions,
           count(*) FILTER (is_fraud_label) AS confirmed_fraud,
           round(count(*) FILTER (is_flagged) / count(*) * 100, 2) AS fraud_flag_rate_pct,
           round(count(*) FILTER (is_fraud_label) / count(*) * 100, 2) AS confirmed_fraud_rate_pct,
           CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_volume_usd,
           CAST(coalesce(sum(CAST(amount AS DECIMAL(18,2))) FILTER (is_flagged), 0) AS DOUBLE) AS flagged_volume_usd,
           CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) / count(amount) AS avg_transaction_amount,
           max(amount) AS max_transaction_amount,
           count(*) FILTER (risk_level = 'CRITICAL') AS critical_count, count(*) FILTER (risk_level = 'HIGH') AS high_count,
           count(*) FILTER (risk_level = 'MEDIUM') AS medium_count, count(*) FILTER (risk_level = 'LOW') AS low_count,
           count(*) FILTER (amount_flag) AS amount_rule_hits, count(*) FILTER (merchant_flag) AS merchant_rule_hits,
           count(*) FILTER (geo_flag) AS geo_rule_hits, TIMESTAMP '2024-01-31 00:00:00' AS refreshed_at
           FROM flags GROUP BY transaction_date""",
    )
)
def fraud_summary_daily(spark, sf_dir):
    return gold.fraud_summary_daily(I.flagged_payments(spark, sf_dir), I.AS_OF)


@query(C.sql(C.CUSTOMERS, "SELECT * FROM customers"))
def high_risk_customers(spark, sf_dir):
    return gold.high_risk_customers(I.flagged_payments(spark, sf_dir), I.AS_OF)


@query(C.sql(C.MERCHANTS, "SELECT * FROM merchant_scores"))
def merchant_risk_scores(spark, sf_dir):
    return gold.merchant_risk_scores(I.flagged_payments(spark, sf_dir), I.AS_OF)


# Views over the alerts, profiles

@query(
    C.sql(
        C.ALERTS,
        """SELECT CAST(event_time AS DATE) AS transaction_date, count(*) AS total_transactions,
           count(*) AS flagged_transactions, CAST(100.0 AS DOUBLE) AS fraud_flag_rate_pct,
           CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS flagged_volume_usd,
           CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_volume_usd,
           CAST(sum(fraud_score) AS DOUBLE) / count(fraud_score) AS avg_fraud_score,
           count(*) FILTER (risk_level = 'CRITICAL') AS critical_count, count(*) FILTER (risk_level = 'HIGH') AS high_count,
           count(*) FILTER (risk_level = 'MEDIUM') AS medium_count, count(*) FILTER (amount_flag) AS amount_rule_hits,
           count(*) FILTER (merchant_flag) AS merchant_rule_hits, count(*) FILTER (geo_flag) AS geo_rule_hits
           FROM alerts GROUP BY 1""",
    )
)
def daily_alert_view(spark, sf_dir):
    return alert_views.daily_alert_view(I.payment_alerts(spark, sf_dir))


_SCORE_TIER = "CASE WHEN {0} >= 65 THEN 'CRITICAL' WHEN {0} >= 35 THEN 'HIGH' WHEN {0} >= 10 THEN 'MEDIUM' ELSE 'LOW' END"


@query(
    C.sql(
        C.ALERTS,
        f"""SELECT merchant_category, count(*) AS total_flags,
           round(CAST(sum(fraud_score) AS DOUBLE) / count(fraud_score), 1) AS avg_fraud_score,
           CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS flagged_volume_usd,
           {_SCORE_TIER.format('(CAST(sum(fraud_score) AS DOUBLE) / count(fraud_score))')} AS merchant_risk_tier,
           CAST(100.0 AS DOUBLE) AS fraud_rate_pct FROM alerts GROUP BY merchant_category""",
    )
)
def merchant_alert_view(spark, sf_dir):
    return alert_views.merchant_alert_view(I.payment_alerts(spark, sf_dir))


@query(
    C.sql(
        C.ALERTS,
        f"""SELECT customer_id, customer_id AS customer_name, count(*) AS total_flags,
           round(CAST(sum(fraud_score) AS DOUBLE) / count(fraud_score), 1) AS fraud_rate_pct,
           max(fraud_score) AS max_fraud_score, {_SCORE_TIER.format('max(fraud_score)')} AS risk_tier,
           max(event_time) AS last_flagged,
           string_agg(DISTINCT merchant_country, ', ' ORDER BY merchant_country) AS countries_used,
           row_number() OVER (ORDER BY sum(fraud_score) DESC, customer_id) AS fraud_rank
           FROM alerts GROUP BY customer_id""",
    )
)
def customer_alert_view(spark, sf_dir):
    return alert_views.customer_alert_view(I.payment_alerts(spark, sf_dir))


_COUNT_TIER = "CASE WHEN count(*) <= 2 THEN 'MEDIUM' WHEN count(*) <= 5 THEN 'HIGH' ELSE 'CRITICAL' END"
_FACTS = f"""count(*) AS total_fraud_alerts, CAST(sum(fraud_score) AS BIGINT) AS cumulative_fraud_score,
  max(event_time) AS last_alert_time, max(merchant_country) AS last_seen_country, {_COUNT_TIER} AS risk_tier"""
_FACT_NAMES = "total_fraud_alerts, cumulative_fraud_score, last_alert_time, last_seen_country, risk_tier"


@query(
    C.sql(
        C.ALERTS,
        f"SELECT customer_id, {_FACTS} FROM alerts WHERE event_time >= TIMESTAMP '2024-01-11' GROUP BY customer_id",
    )
)
def profile_risk_source(spark, sf_dir):
    return alert_views.profile_facts(I.payment_alerts(spark, sf_dir), "2024-02-10 00:00:00")


@query(
    C.sql(
        C.ALERTS + f""",
old_profiles AS (SELECT customer_id, {_FACTS}, TIMESTAMP '2024-01-16' AS updated_at FROM alerts
                 WHERE event_time < TIMESTAMP '2024-01-16' GROUP BY customer_id),
new_facts AS (SELECT customer_id, {_FACTS}, TIMESTAMP '2024-02-25' AS updated_at FROM alerts
              WHERE event_time >= TIMESTAMP '2024-01-26' GROUP BY customer_id),
profiles AS (
  SELECT * FROM new_facts
  UNION ALL SELECT * FROM old_profiles WHERE customer_id NOT IN (SELECT customer_id FROM new_facts)
)""",
        f"""SELECT customer_id, CAST(0 AS BIGINT) AS total_transactions, CAST(0 AS DOUBLE) AS fraud_rate,
            {_FACT_NAMES}, updated_at FROM profiles""",
    )
)
def profile_refresh(spark, sf_dir):
    """Two refreshes; customers quiet in the second one's 30 days keep the first's facts."""
    alerts = I.payment_alerts(spark, sf_dir)
    empty = spark.createDataFrame([], CUSTOMER_RISK_PROFILES)
    first = alert_views.refresh_customer_risk_profiles(empty, _before(alerts, "2024-01-16"), "2024-01-16 00:00:00")
    return alert_views.refresh_customer_risk_profiles(first, alerts, "2024-02-25 00:00:00")


@query(
    C.sql(
        C.ALERTS + f""",
profiles AS (SELECT customer_id, {_FACTS} FROM alerts WHERE event_time >= TIMESTAMP '2024-01-25' GROUP BY customer_id)""",
        """SELECT p.transaction_id, p.customer_id, coalesce(f.risk_tier, 'UNKNOWN') AS risk_tier,
           coalesce(f.total_fraud_alerts, 0) AS total_fraud_alerts, f.last_alert_time,
           coalesce(f.total_fraud_alerts, 0) > 0 AS repeat_offender
           FROM payments p LEFT JOIN profiles f ON p.customer_id = f.customer_id""",
    )
)
def profile_lookup(spark, sf_dir):
    profiles = alert_views.profile_facts(I.payment_alerts(spark, sf_dir), "2024-02-24 00:00:00")
    return behaviour.with_profile(I.payments(spark, sf_dir).select("transaction_id", "customer_id"), profiles)


@query(
    C.sql(
        C.ALERTS,
        f"""SELECT customer_id, {_FACTS} FROM alerts WHERE event_time < TIMESTAMP '2024-01-21' GROUP BY customer_id
            HAVING customer_id NOT IN (SELECT customer_id FROM alerts WHERE event_time >= TIMESTAMP '2024-01-11')
            UNION ALL SELECT customer_id, {_FACTS} FROM alerts WHERE event_time >= TIMESTAMP '2024-01-11' GROUP BY customer_id""",
    )
)
def upsert_by_bucket(spark, sf_dir):
    """Profiles in a table laid out by customer, of which a second load replaces some and adds others."""
    store = TableStore(spark, new_run_dir(spark, "keyed"))
    alerts = I.payment_alerts(spark, sf_dir)
    for part in (_before(alerts, "2024-01-21"), _from(alerts, "2024-01-11")):
        KeyedTable(store, "profiles", "customer_id", buckets=8).upsert(alert_views.profile_facts(part, None))
    return KeyedTable(store, "profiles", "customer_id").read()


#: All versions of all profiles: running totals at every instant at which a customer had alerts.
VERSIONS = f""",
versions AS (
  SELECT *, {_COUNT_TIER.replace("count(*)", "total_fraud_alerts")} AS risk_tier FROM (
    SELECT customer_id, event_time AS valid_from, lead(event_time) OVER w AS valid_to,
           CAST(sum(count(*)) OVER w AS BIGINT) AS total_fraud_alerts,
           CAST(sum(sum(fraud_score)) OVER w AS BIGINT) AS cumulative_fraud_score, event_time AS last_alert_time,
           max(max(merchant_country)) OVER w AS last_seen_country
    FROM alerts GROUP BY customer_id, event_time WINDOW w AS (PARTITION BY customer_id ORDER BY event_time)))"""


@query(C.sql(C.ALERTS + VERSIONS, f"SELECT customer_id, valid_from, valid_to, {_FACT_NAMES} FROM versions"))
def profile_versions(spark, sf_dir):
    """Every profile as it was, and from when to when."""
    return alert_views.profile_versions(I.payment_alerts(spark, sf_dir))


@query(
    C.sql(
        C.ALERTS + VERSIONS,
        """SELECT p.transaction_id, p.customer_id, p.event_time, coalesce(v.risk_tier, 'UNKNOWN') AS risk_tier,
           coalesce(v.total_fraud_alerts, 0) AS total_fraud_alerts, v.last_alert_time,
           coalesce(v.total_fraud_alerts, 0) > 0 AS repeat_offender
           FROM payments p ASOF LEFT JOIN versions v ON p.customer_id = v.customer_id AND p.event_time >= v.valid_from""",
    )
)
def profile_as_of(spark, sf_dir):
    """Every payment with its customer's profile as it was at that time."""
    versions = alert_views.profile_versions(I.payment_alerts(spark, sf_dir))
    return behaviour.with_profile_as_of(I.payments(spark, sf_dir).select("transaction_id", "customer_id", "event_time"), versions)


# Behaviour rules

@query(
    C.sql(
        C.PAYMENTS,
        """SELECT customer_id, date_trunc('day', event_time)::TIMESTAMP AS window_start,
           date_trunc('day', event_time)::TIMESTAMP + INTERVAL 1 DAY AS window_end, count(*) AS txn_count,
           'VELOCITY' AS rule, 'CRITICAL' AS risk_level FROM payments GROUP BY 1, 2, 3 HAVING count(*) > 5""",
    )
)
def velocity_tumbling(spark, sf_dir):
    return behaviour.velocity_alerts(I.payments(spark, sf_dir), I.PAYMENT_RULES)


@query(
    C.sql(
        C.PAYMENTS + """,
counted AS (
  SELECT transaction_id, customer_id, event_time, count(*) OVER (PARTITION BY customer_id ORDER BY event_time
         RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS recent_transactions FROM payments
)""",
        "SELECT *, recent_transactions > 5 AS velocity_flag FROM counted",
    )
)
def velocity_trailing(spark, sf_dir):
    rows = I.payments(spark, sf_dir).select("transaction_id", "customer_id", "event_time")
    return behaviour.with_velocity(rows, I.PAYMENT_RULES)


@query(
    C.sql(
        C.PAYMENTS + """,
counted AS (
  SELECT transaction_id, customer_id, event_time, merchant_country,
         count(DISTINCT merchant_country) OVER (PARTITION BY customer_id ORDER BY event_time
         RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS recent_countries FROM payments
)""",
        "SELECT *, recent_countries >= 2 AS multi_country_flag FROM counted",
    )
)
def multi_country_window(spark, sf_dir):
    rows = I.payments(spark, sf_dir).select("transaction_id", "customer_id", "event_time", "merchant_country")
    return behaviour.with_country_spread(rows, I.PAYMENT_RULES)


SLIDING = """,
sliding AS (
  SELECT customer_id, merchant_country, event_time,
         unnest([time_bucket(INTERVAL 6 HOUR, event_time, TIMESTAMP '1970-01-01') - o * INTERVAL 6 HOUR FOR o IN [0, 1, 2, 3]])
         AS window_start FROM payments
),
countries_in AS (
  SELECT customer_id, window_start, window_start + INTERVAL 1 DAY AS window_end,
         count(DISTINCT merchant_country) AS countries FROM sliding GROUP BY 1, 2, 3
  HAVING count(DISTINCT merchant_country) >= 2
)"""
_SPREAD_COLUMNS = "customer_id, window_start, window_end, countries, 'MULTI_COUNTRY' AS rule, 'CRITICAL' AS risk_level"


@query(C.sql(C.PAYMENTS + SLIDING, f"SELECT {_SPREAD_COLUMNS} FROM countries_in"))
def multi_country_sliding(spark, sf_dir):
    return behaviour.multi_country_alerts(I.payments(spark, sf_dir), I.PAYMENT_RULES)


@query(
    C.sql(
        C.PAYMENTS + SLIDING,
        f"""SELECT {_SPREAD_COLUMNS} FROM countries_in c WHERE NOT EXISTS (SELECT 1 FROM countries_in b
            WHERE b.customer_id = c.customer_id AND b.window_start = c.window_start - INTERVAL 6 HOUR)""",
    )
)
def multi_country_first_windows(spark, sf_dir):
    alerts = behaviour.multi_country_alerts(I.payments(spark, sf_dir), I.PAYMENT_RULES)
    return behaviour.first_of_each_run(alerts, I.PAYMENT_RULES)


@query(
    C.sql(
        C.ALERTS,
        """SELECT transaction_id, customer_id, event_time FROM payments p WHERE EXISTS (SELECT 1 FROM alerts a
           WHERE a.customer_id = p.customer_id AND a.event_time BETWEEN p.event_time - INTERVAL 1 DAY AND p.event_time)""",
    )
)
def repeat_offender_semi(spark, sf_dir):
    rows = I.payments(spark, sf_dir).select("transaction_id", "customer_id", "event_time")
    return behaviour.repeat_offences(rows, I.payment_alerts(spark, sf_dir), DAY)


# Serving

@query(
    C.sql(
        C.DAILY,
        """SELECT total_transactions, flagged_transactions, fraud_flag_rate_pct, total_volume_usd, flagged_volume_usd
           FROM daily WHERE transaction_date = DATE '2024-01-15'""",
    )
)
def kpi_day(spark, sf_dir):
    summary = gold.fraud_summary_daily(I.flagged_payments(spark, sf_dir), I.AS_OF)
    return serving.kpis(summary, I.payment_alerts(spark, sf_dir), "2024-01-15")


_BUFFER = """,
buffer AS (SELECT * FROM alerts ORDER BY event_time DESC, transaction_id DESC LIMIT 200)"""


@query(
    C.sql(
        C.ALERTS + _BUFFER,
        """SELECT count(*) AS total_transactions, count(*) FILTER (fraud_score > 0) AS flagged_transactions,
           CAST(count(*) FILTER (fraud_score > 0) AS DOUBLE) / count(*) * 100 AS fraud_flag_rate_pct,
           CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_volume_usd,
           CAST(sum(CAST(amount AS DECIMAL(18,2))) FILTER (fraud_score > 0) AS DOUBLE) AS flagged_volume_usd FROM buffer""",
    )
)
def kpi_buffer(spark, sf_dir):
    """A day without a summary row: the figures come from the newest alerts."""
    summary = gold.fraud_summary_daily(I.flagged_payments(spark, sf_dir), I.AS_OF)
    return serving.kpis(summary, I.payment_alerts(spark, sf_dir), "2031-01-01")


@query(
    C.sql(
        C.ALERTS + _BUFFER,
        """SELECT customer_id, amount, merchant_category, merchant_country, risk_level, fraud_score, fraud_reason
           FROM buffer WHERE risk_level IN ('CRITICAL', 'HIGH') ORDER BY event_time, transaction_id LIMIT 20""",
    )
)
def alert_feed(spark, sf_dir):
    return serving.alert_feed(I.payment_alerts(spark, sf_dir))


@query(
    C.sql(
        C.MERCHANTS,
        """SELECT merchant_category, fraud_rate_pct, total_flags, merchant_risk_tier FROM merchant_scores
           ORDER BY fraud_rate_pct DESC, merchant_category LIMIT 10""",
    )
)
def merchant_top10(spark, sf_dir):
    return serving.merchant_top(gold.merchant_risk_scores(I.flagged_payments(spark, sf_dir), I.AS_OF))


@query(
    C.sql(
        C.CLEAN + """,
flagged AS (
  SELECT *, amount > 100000 AS a, merchant_category = 'promo' OR merchant_name = 'Supplier#000000007' AS m,
         merchant_country IN ('NATION_3', 'NATION_7', 'NATION_11') AS g FROM clean
),
pointed AS (SELECT *, CAST(30 * a::INT + 35 * m::INT + 35 * g::INT AS INTEGER) AS fraud_score FROM flagged)""",
        """SELECT customer_lat, customer_lon, fraud_score, customer_id, amount, merchant_country,
           CASE WHEN fraud_score <= 30 THEN 'MEDIUM' WHEN fraud_score <= 65 THEN 'HIGH' ELSE 'CRITICAL' END AS risk_level,
           concat_ws(' | ', CASE WHEN a THEN 'HIGH_AMOUNT: $' || CAST(amount AS VARCHAR) END,
             CASE WHEN merchant_name = 'Supplier#000000007' THEN 'FRAUD_MERCHANT: ' || merchant_name
                  WHEN merchant_category = 'promo' THEN 'HIGH_RISK_CATEGORY: ' || merchant_category END,
             CASE WHEN g THEN 'HIGH_RISK_COUNTRY: ' || merchant_country END) AS fraud_reason
           FROM pointed WHERE fraud_score > 0 AND customer_lat <> 0 AND customer_lon <> 0""",
    )
)
def geo_hotspots(spark, sf_dir):
    return serving.geo_hotspots(I.purchase_alerts(spark, sf_dir))


@query(
    C.sql(
        C.CUSTOMERS,
        """SELECT customer_id, customer_name, total_flags, fraud_rate_pct, max_fraud_score, risk_tier, last_flagged,
           countries_used FROM customers ORDER BY fraud_rank, customer_id LIMIT 10""",
    )
)
def customers_top10(spark, sf_dir):
    return serving.customers_top(gold.high_risk_customers(I.flagged_payments(spark, sf_dir), I.AS_OF))


@query(C.sql(C.CUSTOMERS, "SELECT * FROM customers WHERE customer_id = upper('cust_00007')"))
def customer_lookup(spark, sf_dir):
    return serving.customer_lookup(gold.high_risk_customers(I.flagged_payments(spark, sf_dir), I.AS_OF), "cust_00007")


_RECENT = """SELECT transaction_id, event_time, amount, merchant_name, merchant_country, risk_level, fraud_reason
           FROM alerts WHERE customer_id = upper('cust_00007') ORDER BY event_time DESC, transaction_id DESC LIMIT 20"""


@query(C.sql(C.ALERTS, _RECENT))
def alerts_by_filter(spark, sf_dir):
    """The same out of a merged table whose row groups have filters on the ids that are looked up."""
    store = TableStore(spark, new_run_dir(spark, "found"))
    alerts = I.payment_alerts(spark, sf_dir)
    store.merge("alerts", alerts, ["transaction_id"], "alerted_at", find=("transaction_id", "customer_id"))
    return serving.recent_alerts(store.read("alerts"), "cust_00007")


@query(C.sql(C.ALERTS, _RECENT))
def recent_alerts(spark, sf_dir):
    return serving.recent_alerts(I.payment_alerts(spark, sf_dir), "cust_00007")


@query(
    C.sql(
        C.ALERTS,
        """SELECT 'Last 1 hour' AS time_window, count(*) AS alerts FROM alerts WHERE event_time >= TIMESTAMP '2024-01-30 11:00:00'
           UNION ALL SELECT 'Last 24 hours', count(*) FROM alerts WHERE event_time >= TIMESTAMP '2024-01-29 12:00:00'
           UNION ALL SELECT 'Last 7 days', count(*) FROM alerts WHERE event_time >= TIMESTAMP '2024-01-23 12:00:00'
           UNION ALL SELECT 'All time', count(*) FROM alerts""",
    )
)
def time_window_filter(spark, sf_dir):
    return serving.window_counts(I.payment_alerts(spark, sf_dir), "2024-01-30 12:00:00")


@query(
    C.sql(
        C.DAILY,
        """SELECT transaction_date, fraud_flag_rate_pct, CASE WHEN fraud_flag_rate_pct < 2 THEN '0-2'
           WHEN fraud_flag_rate_pct < 5 THEN '2-5' ELSE '5-10' END AS band,
           round(fraud_flag_rate_pct - 2.0, 2) AS above_expected_pct, fraud_flag_rate_pct >= 5 AS alarm FROM daily""",
    )
)
def fraud_rate_band(spark, sf_dir):
    return serving.fraud_rate_bands(gold.fraud_summary_daily(I.flagged_payments(spark, sf_dir), I.AS_OF))


@query(
    C.sql(
        C.PAYMENTS,
        """SELECT count(*) AS total_sent, count(*) FILTER (is_fraud_label) AS total_fraud,
           round(count(*) FILTER (is_fraud_label) / count(*) * 100, 1) AS fraud_pct FROM payments""",
    )
)
def running_totals(spark, sf_dir):
    return serving.running_totals(I.payments(spark, sf_dir))


# Checks and the daily run

@query(
    C.sql(
        C.PAYMENTS + """,
recent AS (SELECT count(*) AS n FROM payments WHERE ingested_at >= TIMESTAMP '2024-01-30 22:00:00')""",
        """SELECT 'freshness' AS check_name, 'transactions_raw' AS table_name,
           CAST(CASE WHEN n = 0 THEN 1 ELSE 0 END AS BIGINT) AS violations, n > 0 AS passed FROM recent""",
    )
)
def freshness(spark, sf_dir):
    return quality.freshness(I.payments(spark, sf_dir), I.AS_OF)


_CHECKS = """,
counted AS (
  SELECT 'not_null_transaction_id' AS check_name, count(*) FILTER (transaction_id IS NULL) AS violations FROM flags
  UNION ALL SELECT 'not_null_customer_id', count(*) FILTER (customer_id IS NULL) FROM flags
  UNION ALL SELECT 'accepted_values_risk_level',
                   count(*) FILTER (risk_level NOT IN ('LOW', 'MEDIUM', 'HIGH', 'CRITICAL')) FROM flags
  UNION ALL SELECT 'rate_is_flagged', CASE WHEN avg(is_flagged::INT) BETWEEN 0.01 AND 0.05 THEN 0 ELSE 1 END FROM flags
  UNION ALL SELECT 'unique_transaction_id', count(*) FROM (SELECT transaction_id FROM flags GROUP BY 1 HAVING count(*) > 1)
)"""


@query(
    C.sql(
        C.FLAGS + _CHECKS,
        """SELECT check_name, 'fraud_flags' AS table_name, CAST(violations AS BIGINT) AS violations, violations = 0 AS passed
           FROM counted""",
    )
)
def quality_checks(spark, sf_dir):
    return quality.model_checks(I.flagged_payments(spark, sf_dir))


@query(
    C.sql(
        C.FLAGS + _CHECKS,
        """SELECT check_name, 'fraud_flags' AS table_name,
           'Check ' || check_name || ' failed on fraud_flags: ' || CAST(violations AS VARCHAR) || ' violations' AS message
           FROM counted WHERE violations > 0""",
    )
)
def quality_failures(spark, sf_dir):
    return quality.failures(quality.model_checks(I.flagged_payments(spark, sf_dir)))


@query(
    C.sql(
        C.FLAGS + _CHECKS,
        """SELECT check_name, 'fraud_flags' AS table_name, CAST(violations AS BIGINT) AS violations, violations = 0 AS passed
           FROM counted""",
    )
)
def quality_by_day(spark, sf_dir):
    """The checks by counts per day, after two loads of which the second brings late alerts: the
    table itself is not looked at."""
    return _states_of_two_loads(spark, sf_dir).checks(quality.RATE_BOUNDS_PCT)


def _states_of_two_loads(spark, sf_dir):
    """Flags by half of the alerts, then by all of them and of all payments; states take both loads."""
    store = TableStore(spark, new_run_dir(spark, "states"))
    clean, alerts = materialise(I.cleaned_payments(spark, sf_dir)), I.payment_alerts(spark, sf_dir)
    first = layers.silver_fraud_flags(_before(clean, "2024-01-21"), _before(alerts, "2024-01-11"), I.AS_OF)
    store.merge("fraud_flags", first, ["transaction_id"], "fraud_flags_loaded_at", changed="transaction_date", unique=True)
    gold_states = GoldStates(store, "fraud_flags")
    gold_states.refresh()
    second = layers.silver_fraud_flags(_from(clean, "2024-01-11"), alerts, I.AS_OF)
    store.merge("fraud_flags", second, ["transaction_id"], "fraud_flags_loaded_at", changed="transaction_date", unique=True)
    gold_states = GoldStates(store, "fraud_flags")
    gold_states.refresh()
    return gold_states


@query(C.sql(C.MERCHANTS, "SELECT * FROM merchant_scores"))
def merchants_by_day_states(spark, sf_dir):
    return _states_of_two_loads(spark, sf_dir).merchant_risk_scores(I.AS_OF)


@query(C.sql(C.CUSTOMERS, "SELECT * FROM customers"))
def customers_by_day_states(spark, sf_dir):
    return _states_of_two_loads(spark, sf_dir).high_risk_customers(I.AS_OF)


@query(C.sql(C.ALERTS, f"SELECT customer_id, {_FACTS} FROM alerts WHERE event_time >= TIMESTAMP '2024-01-11 06:00:00' GROUP BY customer_id"))
def profiles_by_day_states(spark, sf_dir):
    """Profiles over 30 days from alert counts by day, the alerts having come in two batches."""
    store = TableStore(spark, new_run_dir(spark, "alert-days"))
    alerts = I.payment_alerts(spark, sf_dir).withColumn("batch_id", (F.col("transaction_id").cast("long") % 2))
    alerts = materialise(alerts.withColumn("load_day", F.to_date("alerted_at")))
    for rows in (alerts.where("batch_id = 0"), alerts):
        days = AlertDays(store, rows)
        days.refresh("batch_id")
    return days.profile_facts("2024-02-10 06:00:00")


@query(C.sql(C.MERCHANTS, "SELECT * FROM merchant_scores"))
def nightly_by_batches(spark, sf_dir):
    """The daily run twice over rows and alerts that carry their loader's batch number: of the
    alerts of the first half a third comes with the second batch only."""
    store = TableStore(spark, new_run_dir(spark, "batches"))
    later, n = (F.col("event_time") >= F.lit("2024-01-16").cast("timestamp_ntz")), F.col("transaction_id").cast("long")
    raw = materialise(I.payments(spark, sf_dir).withColumn("batch_id", later.cast("long")))
    alerts = I.payment_alerts(spark, sf_dir).withColumn("batch_id", (later | (n % 3 == 0)).cast("long"))
    alerts = materialise(alerts.withColumn("load_day", F.to_date("alerted_at")))
    for batch, as_of in ((0, "2024-01-16 00:00:00"), (1, I.AS_OF)):
        some = (rows.where(F.col("batch_id") <= batch) for rows in (raw, alerts))
        nightly.run(store, *some, as_of, None, (0.0, 100.0))
    return store.read("merchant_risk_scores")


@query(C.sql(C.MERCHANTS, "SELECT * FROM merchant_scores"))
def nightly_two_loads(spark, sf_dir):
    """The daily run at mid-month and at its end; the second takes only what is new, and
    the tables equal those of one load."""
    store = TableStore(spark, new_run_dir(spark, "nightly"))
    raw, alerts = materialise(I.payments(spark, sf_dir)), materialise(I.payment_alerts(spark, sf_dir))
    bounds = (0.0, 100.0)
    nightly.run(store, _before(raw, "2024-01-16"), _before(alerts, "2024-01-16"), "2024-01-16 00:00:00", None, bounds)
    nightly.run(store, raw, alerts, I.AS_OF, None, bounds)
    return store.read("merchant_risk_scores")


@query(
    C.sql(
        C.PAYMENTS,
        """SELECT transaction_id, amount, CASE WHEN event_time >= TIMESTAMP '2024-01-11' THEN 'second' ELSE 'first' END AS load
           FROM payments""",
    )
)
def merge_after_failure(spark, sf_dir):
    """A load that is merged again, as after a run that failed once the table was published:
    nothing is lost and nothing doubled."""
    store = TableStore(spark, new_run_dir(spark, "repeated"))
    rows = materialise(I.payments(spark, sf_dir)).select("transaction_id", "amount", "event_time")
    store.merge("t", _before(rows, "2024-01-21").withColumn("load", F.lit("first")), ["transaction_id"], "event_time")
    second = _from(rows, "2024-01-11").withColumn("load", F.lit("second"))
    for _ in range(2):
        store.merge("t", second, ["transaction_id"], "event_time")
        store.recover("t")
    return store.read("t").select("transaction_id", "amount", "load")
