"""Bronze inputs derived from the given star-schema tables.

Every statement is plain SQL that Spark and DuckDB both run, so the same text feeds the Spark queries
and the SQL they are checked against. ``{table}`` marks an input table. Only modular arithmetic is used:
no random values, no hashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2024-01-31 00:00:00"

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")

RAW_TRANSACTIONS = """
SELECT concat('TXN', l_orderkey, '-', l_linenumber) AS txn_id,
  concat('mbr', 100000 + o_custkey, ' ') AS member_id,
  concat('fi', 10000 + o_custkey % 25) AS institution_id,
  l_shipdate + INTERVAL '8122' DAY + (l_partkey * 7 % 86400) * INTERVAL '1' SECOND AS txn_timestamp,
  CAST(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS DECIMAL(15,2)) AS amount,
  'usd' AS currency_code,
  CASE l_returnflag WHEN 'A' THEN 'debit' WHEN 'N' THEN 'credit' ELSE 'atm' END AS txn_type,
  CASE l_suppkey % 5 WHEN 0 THEN 'online' WHEN 1 THEN 'pos' WHEN 2 THEN 'atm' WHEN 3 THEN 'mobile' ELSE 'branch' END AS channel,
  concat(' cat', l_partkey % 10, ' ') AS merchant_category,
  concat(' shop', l_partkey % 50) AS merchant_name,
  CASE l_partkey % 3 WHEN 0 THEN 'us' WHEN 1 THEN 'ca' ELSE 'mx' END AS merchant_country,
  CASE l_linestatus WHEN 'O' THEN 'pending' ELSE 'completed' END AS status,
  concat('A', l_partkey % 100000) AS auth_code,
  lpad(concat('', l_partkey % 10000), 4, '0') AS card_last_four,
  concat('10.1.', l_suppkey % 256, '.', l_partkey % 256) AS ip_address,
  concat('FP', l_partkey % 997) AS device_fingerprint,
  CASE WHEN l_tax = 0 THEN NULL ELSE CAST(l_discount * 10 AS DECIMAL(5,2)) END AS risk_score,
  l_shipdate + INTERVAL '8122' DAY + (l_partkey * 7 % 86400 + 60 + (l_suppkey * 7919 + l_partkey * 31) % 1000000) * INTERVAL '1' SECOND AS _loaded_at,
  concat('txn_', l_suppkey % 8, '.psv') AS _source_file
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
"""

FIRST_MEMBERS = """
SELECT concat('MBR', 100000 + c_custkey) AS member_id,
  concat('FI', 10000 + c_custkey % 25) AS institution_id,
  concat(' ann', c_custkey % 11) AS first_name,
  concat('LEE', c_custkey % 13, ' ') AS last_name,
  DATE '1950-01-01' + CAST(c_custkey * 37 % 18000 AS INT) AS date_of_birth,
  lpad(concat('', c_custkey * 7919 % 1000003), 64, '0') AS ssn_hash,
  concat('User', c_custkey, '@X.com ') AS email,
  concat('(212) 555-', 1000 + c_custkey % 9000) AS phone,
  concat(1 + c_custkey % 900, ' main st ') AS address_line1,
  CASE WHEN c_custkey % 4 = 0 THEN concat(' apt ', c_custkey % 90) END AS address_line2,
  CASE c_custkey % 3 WHEN 0 THEN 'springfield' WHEN 1 THEN 'RIVERTON ' ELSE ' Dover' END AS city,
  CASE c_custkey % 3 WHEN 0 THEN 'il' WHEN 1 THEN 'wy' ELSE 'de' END AS state_code,
  concat(10000 + c_custkey % 89999, ' ') AS zip_code,
  CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE 'us' END AS country_code,
  DATE '2015-01-01' + CAST(c_custkey % 3000 AS INT) AS member_since,
  CASE WHEN c_custkey % 17 = 0 THEN 'suspended' ELSE 'active' END AS status,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'critical' WHEN 'MACHINERY' THEN 'high' WHEN 'HOUSEHOLD' THEN 'medium' ELSE 'low' END AS risk_tier,
  CASE c_custkey % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS kyc_verified,
  DATE '2024-01-31' - CAST(c_custkey % 365 AS INT) AS last_activity_date,
  TIMESTAMP_NTZ '2024-01-01 00:00:00' AS _loaded_at,
  concat('mbr_', c_custkey % 4, '.dat') AS _source_file
FROM {customer}
"""

# Some members come again later with a higher risk tier.
RAW_MEMBERS = f"""
{FIRST_MEMBERS.strip()}
UNION ALL
SELECT member_id, institution_id, first_name, last_name, date_of_birth, ssn_hash, email, phone, address_line1, address_line2, city,
  state_code, zip_code, country_code, member_since, status, 'critical' AS risk_tier, kyc_verified, last_activity_date,
  TIMESTAMP_NTZ '2024-01-20 00:00:00' AS _loaded_at, 'mbr_again.dat' AS _source_file
FROM ({FIRST_MEMBERS.strip()}) m WHERE CAST(substr(member_id, 4) AS BIGINT) % 9 = 4
"""

RAW_INSTITUTIONS = """
SELECT concat('FI', 10000 + n_nationkey) AS institution_id, n_name AS institution_name,
  CASE n_nationkey % 4 WHEN 0 THEN 'BANK' WHEN 1 THEN 'CREDIT_UNION' WHEN 2 THEN 'FINTECH' ELSE 'PROCESSOR' END AS institution_type,
  r_name AS region,
  CASE n_nationkey % 4 WHEN 0 THEN 'SMALL' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'LARGE' ELSE 'MEGA' END AS asset_size_tier
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""

_EVENT_COLUMNS = """event_id, event_time, event_type, member_id, institution_id, payload, amount, channel, device_id,
  ip_address, geo_lat, geo_lon, risk_score"""

STREAMING_EVENTS = f"""
WITH b AS (
  SELECT concat('EVT', event_id) AS event_id, ts AS event_time,
    CASE event_type WHEN 'purchase' THEN 'txn' WHEN 'error' THEN 'alert' WHEN 'click' THEN 'card_swipe' ELSE 'login' END AS event_type,
    concat('mbr', 100000 + user_id) AS member_id, concat('fi', 10000 + user_id % 25) AS institution_id,
    props AS payload, CAST(value AS DECIMAL(15,2)) AS amount,
    CASE event_id % 4 WHEN 0 THEN 'online' WHEN 1 THEN 'pos' WHEN 2 THEN 'atm' ELSE 'mobile' END AS channel,
    concat('DEV-', event_id * 31 % 997) AS device_id,
    concat('10.0.', event_id % 256, '.', event_id * 7 % 256) AS ip_address,
    CAST((event_id * 13 % 18000) / 100.0 - 90 AS DECIMAL(10,7)) AS geo_lat,
    CAST((event_id * 29 % 36000) / 100.0 - 180 AS DECIMAL(10,7)) AS geo_lon,
    CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST((event_id * 37 % 101) / 100.0 AS DECIMAL(5,2)) END AS risk_score,
    ts + (CASE WHEN event_id % 97 = 0 THEN 259200 ELSE event_id % 360 END) * INTERVAL '1' SECOND AS _ingest_time,
    event_id AS n
  FROM {{events}})
SELECT {_EVENT_COLUMNS}, _ingest_time, 'file_delivery' AS _channel_name, concat('a', n) AS _offset_token FROM b
UNION ALL
SELECT {_EVENT_COLUMNS}, _ingest_time + INTERVAL '1' HOUR, 'file_delivery', concat('b', n) FROM b WHERE n % 40 = 0
"""

RAW_ALERTS = """
SELECT concat('ALR', event_id) AS alert_id, concat('MBR', 100000 + user_id) AS member_id,
  concat('FI', 10000 + user_id % 25) AS institution_id, ts AS alert_timestamp,
  CASE event_id % 4 WHEN 0 THEN 'fraud_suspected' WHEN 1 THEN 'aml_sar' WHEN 2 THEN 'velocity' ELSE 'identity' END AS alert_type,
  CASE event_id % 7 WHEN 0 THEN 'critical' WHEN 1 THEN 'high' WHEN 2 THEN 'high' WHEN 3 THEN 'medium' ELSE 'low' END AS severity,
  CASE event_id % 3 WHEN 0 THEN 'RULE_ENGINE' WHEN 1 THEN 'ML_MODEL' ELSE 'MANUAL' END AS alert_source,
  concat('value ', CAST(value AS DECIMAL(15,2)), ' raised by rule ', event_id % 30) AS description,
  CASE WHEN event_id % 3 = 0 THEN concat('EVT', event_id) END AS related_txn_id,
  concat('R', event_id % 30) AS rule_id,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST((event_id * 13 % 10001) / 10000.0 AS DECIMAL(5,4)) END AS confidence_score,
  CASE event_id % 5 WHEN 0 THEN 'open' WHEN 1 THEN 'investigating' WHEN 2 THEN 'resolved' ELSE 'false_positive' END AS status,
  concat('analyst', event_id % 6) AS assigned_to,
  CASE WHEN event_id % 5 = 2 THEN 'closed after review' END AS resolution_notes,
  CASE WHEN event_id % 5 = 2 THEN ts + INTERVAL '2' HOUR END AS resolved_at,
  ts AS _loaded_at
FROM {events} WHERE event_type = 'error'
"""

# Alert notes long enough for text search: one alert per document, whole text.
ALERT_NOTES = """
SELECT concat('ALR', doc_id) AS alert_id, concat('MBR', 100000 + doc_id % 1500) AS member_id,
  concat('FI', 10000 + doc_id % 25) AS institution_id,
  CASE doc_id % 4 WHEN 0 THEN 'FRAUD_SUSPECTED' WHEN 1 THEN 'AML_SAR' WHEN 2 THEN 'VELOCITY' ELSE 'IDENTITY' END AS alert_type,
  CASE doc_id % 7 WHEN 0 THEN 'CRITICAL' WHEN 1 THEN 'HIGH' WHEN 2 THEN 'HIGH' WHEN 3 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
  text AS description, TIMESTAMP_NTZ '2024-01-01 00:00:00' + (doc_id % 2592000) * INTERVAL '1' SECOND AS alert_timestamp
FROM {documents}
"""

# Log-shaped tables the operational reports read.
REFRESH_LOG = """
SELECT concat('NODE_', o_orderkey % 10) AS name,
  CASE WHEN o_orderkey % 10 < 4 THEN 'SILVER' WHEN o_orderkey % 10 < 8 THEN 'GOLD' ELSE 'FEATURE_STORE' END AS schema_name,
  CASE WHEN o_orderkey % 10 < 4 THEN 'DOWNSTREAM' ELSE '10 minutes' END AS target_lag,
  CASE WHEN o_orderkey % 2 = 0 THEN 'INCREMENTAL' ELSE 'FULL' END AS refresh_mode,
  CASE WHEN o_orderkey % 41 = 0 THEN 'SUSPENDED' ELSE 'ACTIVE' END AS scheduling_state,
  CASE WHEN o_orderkey % 13 = 0 THEN 'FAILED' ELSE 'SUCCEEDED' END AS state,
  CASE WHEN o_orderkey % 13 = 0 THEN 'source not readable' END AS state_message,
  CASE WHEN o_orderkey % 5 = 0 THEN 'MANUAL' ELSE 'SCHEDULED' END AS refresh_trigger,
  CASE WHEN o_orderkey % 3 = 0 THEN 'FULL' ELSE 'INCREMENTAL' END AS refresh_action,
  TIMESTAMP_NTZ '2024-01-31 00:00:00' - (o_orderkey * 61 % 1209600) * INTERVAL '1' SECOND AS refresh_start_time,
  TIMESTAMP_NTZ '2024-01-31 00:00:00' - (o_orderkey * 61 % 1209600 - o_orderkey * 7 % 180) * INTERVAL '1' SECOND AS refresh_end_time,
  TIMESTAMP_NTZ '2024-01-31 00:00:00' - (o_orderkey * 61 % 1209600 + 30) * INTERVAL '1' SECOND AS data_timestamp,
  concat('rows=', o_orderkey % 1000) AS statistics,
  o_orderkey AS run_id
FROM {orders}
"""

QUERY_LOG = """
SELECT concat('Q', event_id) AS query_id, concat('SELECT ', event_id % 100) AS query_text,
  CASE event_id % 4 WHEN 0 THEN 'INGEST' WHEN 1 THEN 'TRANSFORM' WHEN 2 THEN 'ANALYTICS' ELSE 'AI' END AS warehouse_name,
  CASE WHEN event_id % 19 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS execution_status,
  event_id * 37 % 90000 AS total_elapsed_time, event_id * 7919 % 99999989 * 4096 AS bytes_scanned,
  event_id % 5000 AS rows_produced, event_id % 50 AS partitions_scanned,
  CASE WHEN event_id % 23 = 0 THEN 0 ELSE 50 END AS partitions_total,
  TIMESTAMP_NTZ '2024-01-31 00:00:00' - (event_id * 11 % 7200) * INTERVAL '1' SECOND AS start_time
FROM {events}
"""

USAGE_LOG = """
SELECT CASE event_id % 6 WHEN 0 THEN 'RISK_INGEST' WHEN 1 THEN 'RISK_TRANSFORM' WHEN 2 THEN 'RISK_ANALYTICS' WHEN 3 THEN 'RISK_AI' WHEN 4 THEN 'RISK_NEW' ELSE 'OTHER' END AS warehouse_name,
  ts AS start_time, CAST(value / 10 AS DECIMAL(12,4)) AS credits_used
FROM {events}
"""

TASKS = """
SELECT o_orderkey AS id, concat('Phase ', o_orderkey % 9) AS phase, concat('task ', o_orderkey) AS task,
  concat('owner', o_custkey % 12) AS owner,
  CASE o_orderkey % 7 WHEN 0 THEN 'Blocked' WHEN 1 THEN 'In Progress' WHEN 2 THEN 'Not Started' ELSE 'Complete' END AS status,
  CAST(o_orderdate AS DATE) AS start_date, CAST(1 + o_orderkey % 30 AS INT) AS days
FROM {orders}
"""

TEST_RESULTS = """
SELECT concat('UC', l_suppkey % 10) AS use_case, concat('test ', l_orderkey, '-', l_linenumber) AS test,
  CASE WHEN l_partkey % 19 = 0 THEN 'PARTIAL' WHEN l_partkey % 23 = 0 THEN 'FAIL' WHEN l_partkey % 29 = 0 THEN 'NOT TESTED' ELSE 'PASS' END AS status
FROM {lineitem}
"""

# Object dependencies: each order number depends on its quarter, a forest of logarithmic depth.
OBJECT_DEPENDENCIES = """
SELECT DISTINCT concat('OBJ', lpad(concat('', o_orderkey), 12, '0')) AS downstream,
  concat('OBJ', lpad(concat('', CAST(floor(o_orderkey / 4) AS BIGINT)), 12, '0')) AS upstream,
  CASE WHEN o_orderkey % 2 = 0 THEN 'TABLE' ELSE 'VIEW' END AS type
FROM {orders} WHERE o_orderkey > 0
"""

# --- landing records: the same rows as text, with faults that every loader must survive ----------

# ``k`` decides the fault of a row; several may meet in one row.
LANDING_TRANSACTIONS = f"""
SELECT *, CASE
    WHEN k % 73 = 0 THEN concat(head, '|', tail12)
    WHEN k % 79 = 0 THEN concat(head, '|', tail12, '|', tail17, '|surplus')
    ELSE concat(head, '|', tail12, '|', tail17) END AS line
FROM (SELECT r.*, CAST(card_last_four AS INT) AS k,
    concat(CASE WHEN CAST(card_last_four AS INT) % 61 = 0 THEN CASE CAST(card_last_four AS INT) % 4 WHEN 0 THEN '' WHEN 1 THEN 'NULL' WHEN 2 THEN 'null' ELSE concat(chr(92), 'N') END ELSE txn_id END,
      '|', member_id, '|', institution_id, '|',
      CASE WHEN CAST(card_last_four AS INT) % 59 = 0 THEN 'yesterday' ELSE concat('', txn_timestamp, '.000 +0000') END, '|',
      CASE WHEN CAST(card_last_four AS INT) % 53 = 0 THEN 'abc' ELSE concat('', amount) END) AS head,
    concat(currency_code, '|', txn_type, '|', channel, '|', merchant_category, '|',
      CASE WHEN CAST(card_last_four AS INT) % 71 = 0 THEN '"a|b"' ELSE merchant_name END, '|', merchant_country, '|', status) AS tail12,
    concat(auth_code, '|', card_last_four, '|', ip_address, '|', device_fingerprint, '|',
      CASE WHEN CAST(card_last_four AS INT) % 67 = 0 THEN 'n/a' ELSE coalesce(concat('', risk_score), '') END) AS tail17
  FROM ({RAW_TRANSACTIONS.strip()}) r) x
"""

LANDING_MEMBERS = f"""
SELECT r.*, CAST(substr(member_id, 4) AS BIGINT) - 100000 AS k,
  concat(rpad(CASE WHEN (CAST(substr(member_id, 4) AS BIGINT)) % 37 = 0 THEN ' ' ELSE member_id END, 20, ' '),
    rpad(institution_id, 20, ' '), rpad(first_name, 50, ' '), rpad(last_name, 50, ' '),
    rpad(CASE WHEN (CAST(substr(member_id, 4) AS BIGINT)) % 31 = 0 THEN '31/12/1980' ELSE concat('', date_of_birth) END, 10, ' '),
    ssn_hash, rpad(email, 100, ' '), rpad(phone, 20, ' '), rpad(address_line1, 100, ' '), rpad(city, 50, ' '),
    rpad(state_code, 2, ' '), rpad(zip_code, 10, ' '), rpad(coalesce(country_code, ' '), 3, ' '),
    rpad(concat('', member_since), 10, ' '), rpad(status, 20, ' '), rpad(risk_tier, 10, ' ')) AS line
FROM ({FIRST_MEMBERS.strip()}) r
"""

LANDING_ALERTS = f"""
SELECT r.*, CAST(substr(alert_id, 4) AS BIGINT) AS k,
  concat(alert_id, ',', CASE WHEN CAST(substr(alert_id, 4) AS BIGINT) % 29 = 0 THEN 'SPACES' ELSE member_id END, ',', institution_id, ',',
    CASE WHEN CAST(substr(alert_id, 4) AS BIGINT) % 31 = 0 THEN '2024-99-99' ELSE concat('', date_trunc('second', alert_timestamp)) END, ',',
    alert_type, ',', severity, ',', alert_source, ',"', description, ', noted",', coalesce(related_txn_id, '0000000000'), ',', rule_id, ',',
    CASE WHEN CAST(substr(alert_id, 4) AS BIGINT) % 37 = 0 THEN 'high' ELSE coalesce(concat('', confidence_score), '') END, ',', status, ',', assigned_to) AS line
FROM ({RAW_ALERTS.strip()}) r
"""

LANDING_EVENTS = f"""
SELECT r.*, CAST(substr(event_id, 4) AS BIGINT) AS k,
  CASE WHEN CAST(substr(event_id, 4) AS BIGINT) % 43 = 0 THEN concat('[', obj, ']') ELSE obj END AS line
FROM (SELECT q.*,
    concat('{{{{', CASE WHEN CAST(substr(event_id, 4) AS BIGINT) % 53 = 0 AND CAST(substr(event_id, 4) AS BIGINT) % 41 <> 0 THEN ''
        ELSE concat('"event_id":"', event_id, '",') END,
      CASE WHEN CAST(substr(event_id, 4) AS BIGINT) % 41 = 0 THEN '"event_id":"again",' ELSE '' END,
      '"event_time":"', concat('', event_time), '","event_type":"', event_type, '","member_id":"', member_id,
      '","institution_id":"', institution_id, '","amount":', CASE WHEN CAST(substr(event_id, 4) AS BIGINT) % 37 = 0 THEN '"abc"' ELSE concat('', amount) END, ',"channel":"', channel, '",',
      CASE WHEN CAST(substr(event_id, 4) AS BIGINT) % 47 = 0 THEN ''
        ELSE concat('"device_id":"', device_id, '","ip_address":"', ip_address, '","geo_lat":', concat('', geo_lat), ',"geo_lon":', concat('', geo_lon), ',') END,
      '"risk_score":', CASE WHEN risk_score IS NULL THEN 'null' ELSE concat('', risk_score) END, '}}}}') AS obj
  FROM ({STREAMING_EVENTS.strip()}) q) r
"""

BRONZE = {
    "landing_transactions": LANDING_TRANSACTIONS,
    "landing_members": LANDING_MEMBERS,
    "landing_alerts": LANDING_ALERTS,
    "landing_events": LANDING_EVENTS,
    "raw_transactions": RAW_TRANSACTIONS,
    "raw_members": RAW_MEMBERS,
    "raw_institutions": RAW_INSTITUTIONS,
    "streaming_events": STREAMING_EVENTS,
    "raw_alerts": RAW_ALERTS,
    "alert_notes": ALERT_NOTES,
    "refresh_log": REFRESH_LOG,
    "query_log": QUERY_LOG,
    "usage_log": USAGE_LOG,
    "tasks": TASKS,
    "test_results": TEST_RESULTS,
    "object_dependencies": OBJECT_DEPENDENCIES,
}


def given_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Bronze input as a DataFrame over the given tables."""
    text = BRONZE[name]
    used = {t: given_table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


def oracle_text(name: str) -> str:
    """The same statement for the checking engine, where the tables are views of their own name."""
    return BRONZE[name].format(**{t: t for t in TABLES}).replace("TIMESTAMP_NTZ '", "TIMESTAMP '")
