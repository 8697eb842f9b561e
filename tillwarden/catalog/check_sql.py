"""Common table expressions of the checking SQL, over the test tables."""

from __future__ import annotations

PAYMENTS = """
keyed AS (
  SELECT e.*, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(user_id AS VARCHAR) AS u FROM events e
),
payments AS (
  SELECT event_id AS id, CAST(event_id AS VARCHAR) AS transaction_id,
         'CUST_' || CASE WHEN length(u) < 5 THEN lpad(u, 5, '0') ELSE u END AS customer_id,
         ts AS event_time, ts AS ingested_at, value AS amount, 'USD' AS currency,
         'Merchant ' || CAST(k AS VARCHAR) AS merchant_name, event_type AS merchant_category,
         n_name AS merchant_country, event_type = 'error' AS is_fraud_label
  FROM keyed LEFT JOIN nation ON n_nationkey = k % 25
)"""

SCORED = (
    PAYMENTS
    + """,
signals AS (
  SELECT *, amount > 100 AS amount_flag,
         merchant_category = 'error' OR merchant_name IN ('Merchant 13', 'Merchant 42') AS merchant_flag,
         merchant_country IN ('NATION_3', 'NATION_7', 'NATION_11') AS geo_flag,
         CASE WHEN amount > 100 THEN 'HIGH_AMOUNT: $' || CAST(amount AS VARCHAR) END AS amount_reason,
         CASE WHEN merchant_name IN ('Merchant 13', 'Merchant 42') THEN 'FRAUD_MERCHANT: ' || merchant_name
              WHEN merchant_category = 'error' THEN 'HIGH_RISK_CATEGORY: ' || merchant_category END AS merchant_reason,
         CASE WHEN merchant_country IN ('NATION_3', 'NATION_7', 'NATION_11')
              THEN 'HIGH_RISK_COUNTRY: ' || merchant_country END AS geo_reason
  FROM payments
),
pointed AS (
  SELECT *, CAST(30 * amount_flag::INT + 35 * merchant_flag::INT + 35 * geo_flag::INT AS INTEGER) AS fraud_score
  FROM signals
),
scored AS (
  SELECT *, CASE WHEN fraud_score = 0 THEN 'LOW' WHEN fraud_score <= 30 THEN 'MEDIUM'
                 WHEN fraud_score <= 65 THEN 'HIGH' ELSE 'CRITICAL' END AS risk_level,
         nullif(concat_ws(' | ', amount_reason, merchant_reason, geo_reason), '') AS fraud_reason
  FROM pointed
)"""
)

ALERTS = SCORED + ",\nalerts AS (SELECT *, event_time AS alerted_at FROM scored WHERE fraud_score > 0)"

# Payment ids are unique and clean already, so the flagged table keeps payments' own values.
FLAGS = (
    ALERTS
    + """,
flags AS (
  SELECT p.*, p.customer_id AS customer_name, CAST(p.event_time AS DATE) AS transaction_date,
         coalesce(a.fraud_score, 0) AS fraud_score, coalesce(a.risk_level, 'LOW') AS risk_level, a.fraud_reason,
         coalesce(a.amount_flag, FALSE) AS amount_flag, coalesce(a.merchant_flag, FALSE) AS merchant_flag,
         coalesce(a.geo_flag, FALSE) AS geo_flag, a.alerted_at, a.transaction_id IS NOT NULL AS is_flagged
  FROM payments p LEFT JOIN alerts a ON p.transaction_id = a.transaction_id
)"""
)

DAILY = (
    FLAGS
    + """,
daily AS (
  SELECT transaction_date, count(*) AS total_transactions, count(*) FILTER (is_flagged) AS flagged_transactions,
         round(count(*) FILTER (is_flagged) / count(*) * 100, 2) AS fraud_flag_rate_pct,
         CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_volume_usd,
         CAST(coalesce(sum(CAST(amount AS DECIMAL(18,2))) FILTER (is_flagged), 0) AS DOUBLE) AS flagged_volume_usd
  FROM flags GROUP BY transaction_date
)"""
)

MERCHANTS = (
    FLAGS
    + """,
merchants AS (
  SELECT merchant_category, count(*) AS total_transactions, count(*) FILTER (is_flagged) AS total_flags,
         round(count(*) FILTER (is_flagged) / count(*) * 100, 2) AS fraud_rate_pct,
         round(CAST(sum(fraud_score) FILTER (is_flagged) AS DOUBLE) / count(*) FILTER (is_flagged), 1) AS avg_fraud_score,
         CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_volume_usd,
         CAST(coalesce(sum(CAST(amount AS DECIMAL(18,2))) FILTER (is_flagged), 0) AS DOUBLE) AS flagged_volume_usd,
         count(DISTINCT customer_id) AS unique_customers, count(DISTINCT merchant_country) AS countries_seen
  FROM flags GROUP BY merchant_category
),
merchant_scores AS (
  SELECT *, CASE WHEN fraud_rate_pct > 50 THEN 'CRITICAL' WHEN fraud_rate_pct > 20 THEN 'HIGH'
                 WHEN fraud_rate_pct > 5 THEN 'MEDIUM' ELSE 'LOW' END AS merchant_risk_tier,
         TIMESTAMP '2024-01-31 00:00:00' AS refreshed_at
  FROM merchants
)"""
)

CUSTOMERS = (
    FLAGS
    + """,
country_counts AS (
  SELECT customer_id, merchant_country,
         row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, merchant_country) AS place
  FROM flags WHERE merchant_country IS NOT NULL GROUP BY customer_id, merchant_country
),
customer_totals AS (
  SELECT customer_id, customer_name, count(*) AS total_transactions, count(*) FILTER (is_flagged) AS total_flags,
         count(*) FILTER (risk_level = 'CRITICAL') AS critical_flags,
         CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total_spend_usd,
         CAST(sum(CAST(amount AS DECIMAL(18,2))) FILTER (is_flagged) AS DOUBLE) AS flagged_spend_usd,
         CAST(sum(fraud_score) FILTER (is_flagged) AS DOUBLE) / count(*) FILTER (is_flagged) AS average_score,
         max(fraud_score) AS max_fraud_score, max(event_time) AS last_seen,
         max(event_time) FILTER (is_flagged) AS last_flagged,
         count(DISTINCT merchant_country) AS countries_used
  FROM flags GROUP BY customer_id, customer_name HAVING count(*) FILTER (is_flagged) > 0
),
rated AS (SELECT *, round(total_flags / total_transactions * 100, 1) AS fraud_rate_pct FROM customer_totals),
customers AS (
  SELECT r.customer_id, customer_name, total_transactions, total_flags, critical_flags, fraud_rate_pct,
         total_spend_usd, flagged_spend_usd, round(average_score, 1) AS avg_fraud_score, max_fraud_score,
         countries_used, c.merchant_country AS most_common_country, last_seen, last_flagged,
         CASE WHEN critical_flags > 0 OR fraud_rate_pct > 50 THEN 'CRITICAL'
              WHEN total_flags >= 3 OR fraud_rate_pct > 20 THEN 'HIGH'
              WHEN total_flags >= 1 OR fraud_rate_pct > 5 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
         rank() OVER (ORDER BY total_flags DESC, average_score DESC) AS fraud_rank,
         TIMESTAMP '2024-01-31 00:00:00' AS refreshed_at
  FROM rated r LEFT JOIN country_counts c ON c.customer_id = r.customer_id AND c.place = 1
)"""
)

PURCHASES = """
purchases AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS transaction_id,
         'CUST_' || CASE WHEN o_custkey < 10000 THEN lpad(CAST(o_custkey AS VARCHAR), 5, '0')
                         ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
         c_name AS customer_name, l_shipdate AS event_time, l_shipdate AS ingested_at, l_extendedprice AS amount,
         ' usd ' AS currency, s_name AS merchant_name, p_type AS merchant_category, n_name AS merchant_country,
         c_acctbal / 50 AS customer_lat, c_acctbal / 25 AS customer_lon, o_orderpriority AS card_type,
         l_returnflag = 'R' AS is_fraud_label
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey
)"""

# A total order of the copies of one id, as far as they differ.
COPY_ORDER = (
    "event_time, amount, card_type, customer_id, customer_lat, customer_lon, customer_name, is_fraud_label, "
    "merchant_category, merchant_country, merchant_name"
)

CLEAN = (
    PURCHASES
    + f""",
first_copies AS (
  SELECT * FROM purchases
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY {COPY_ORDER}) = 1
),
clean AS (
  SELECT transaction_id, customer_id, customer_name, event_time, round(amount, 2) AS amount, 'USD' AS currency,
         trim(merchant_name) AS merchant_name, lower(trim(merchant_category)) AS merchant_category,
         upper(trim(merchant_country)) AS merchant_country,
         CASE WHEN customer_lat BETWEEN -90 AND 90 THEN customer_lat END AS customer_lat,
         CASE WHEN customer_lon BETWEEN -180 AND 180 THEN customer_lon END AS customer_lon,
         upper(card_type) AS card_type, CAST(event_time AS DATE) AS transaction_date,
         CAST(hour(event_time) AS BIGINT) AS transaction_hour, CAST(dayofweek(event_time) + 1 AS BIGINT) AS day_of_week,
         dayofweek(event_time) IN (0, 6) AS is_weekend,
         CASE WHEN amount < 10 THEN 'micro' WHEN amount < 100 THEN 'small' WHEN amount < 500 THEN 'medium'
              WHEN amount < 1000 THEN 'large' ELSE 'very_large' END AS amount_bucket,
         is_fraud_label, TIMESTAMP '2003-01-01 00:00:00' AS silver_loaded_at
  FROM first_copies
)"""
)


def sql(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"
