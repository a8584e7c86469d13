"""Silver, Gold and dashboard queries."""

from __future__ import annotations

from riskloom.catalog.registry import query
from riskloom.catalog.views import default, key, proper, score, tidy
from riskloom.functions.expressions import risk_band
from riskloom.plans import bi, gold, silver
from riskloom.plans.lake import Lake

AT = "TIMESTAMP '2024-01-31 00:00:00'"


@query("silver_transactions", "SELECT * FROM s_txn")
def silver_transactions(lake: Lake):
    return lake.transactions


@query("silver_members", "SELECT * FROM s_members")
def silver_members(lake: Lake):
    return lake.members


@query("silver_events", "SELECT * FROM s_events")
def silver_events(lake: Lake):
    return lake.events


@query("silver_alerts", "SELECT * FROM s_alerts")
def silver_alerts(lake: Lake):
    return lake.enriched_alerts


@query("silver_transactions_nodedup", tidy(
    "raw_transactions", "txn_id txn_timestamp amount merchant_category merchant_name _loaded_at _source_file", "txn_type channel status",
    "txn_id member_id amount", member_id=key("member_id"), institution_id=key("institution_id"),
    currency_code=default("currency_code", "'USD'"), risk_score=score("risk_score", 5, 2)))
def silver_transactions_nodedup(lake: Lake):
    return silver.cleanse_transactions_nodedup(lake.raw("raw_transactions"))


@query("silver_members_nodedup", tidy(
    "raw_members", "member_id date_of_birth phone zip_code member_since _loaded_at", "institution_id state_code status risk_tier",
    "member_id institution_id", email="lower(email)", country_code=f"upper({default('country_code', repr('US'))})",
    kyc_verified=default("kyc_verified", "FALSE"), **{c: proper(c) for c in ("first_name", "last_name", "city")}))
def silver_members_nodedup(lake: Lake):
    return silver.cleanse_members_nodedup(lake.raw("raw_members"))


@query("silver_events_nodedup", tidy(
    "streaming_events", "event_id event_time payload amount device_id ip_address geo_lat geo_lon _ingest_time",
    "event_type member_id institution_id channel", "event_id member_id", risk_score=score("risk_score", 5, 2)))
def silver_events_nodedup(lake: Lake):
    return silver.cleanse_events_nodedup(lake.raw("streaming_events"))


@query("silver_risk_category", """
SELECT *, CASE WHEN risk_score <= 0.5 THEN 'LOW' WHEN risk_score <= 0.75 THEN 'MEDIUM' WHEN risk_score <= 0.9 THEN 'HIGH'
  ELSE 'CRITICAL' END AS risk_category FROM s_txn""")
def silver_risk_category(lake: Lake):
    return lake.transactions.withColumn("risk_category", risk_band("risk_score"))


# --- gold ---------------------------------------------------------------------------------------

@query("gold_daily_member", "SELECT * FROM g_daily")
def gold_daily_member(lake: Lake):
    return lake.daily


@query("gold_daily_member_slim", """
SELECT member_id, institution_id, txn_date, txn_count, total_amount, avg_amount, max_amount, unique_channels,
  max_risk_score, avg_risk_score FROM g_daily""")
def gold_daily_member_slim(lake: Lake):
    return gold.daily_member_summary(lake.transactions, slim=True)


@query("gold_fraud_signals", "SELECT * FROM g_signals")
def gold_fraud_signals(lake: Lake):
    return lake.signals


def _signal(ident: str, time: str, kind: str) -> str:
    return f"{ident} AS signal_id, {time} AS signal_time, '{kind}' AS signal_source, member_id, institution_id"


@query("gold_fraud_signals_union", f"""
WITH levels(severity) AS (VALUES ('HIGH'), ('CRITICAL'))
FROM s_alerts SEMI JOIN levels USING (severity)
SELECT {_signal('alert_id', 'alert_timestamp', 'ALERT')}, alert_type, severity, status AS alert_status, confidence_score AS alert_confidence
UNION ALL BY NAME
FROM s_events SELECT {_signal('event_id', 'event_time', 'HIGH_RISK_EVENT')}, event_type AS alert_type, amount AS event_amount,
  risk_score AS event_risk_score, ['HIGH', 'CRITICAL'][1 + CAST(risk_score > 0.9 AS INT)] AS severity WHERE risk_score > 0.75""")
def gold_fraud_signals_union(lake: Lake):
    return gold.fraud_signals_union(lake.alerts, lake.events)


@query("gold_member_activity", "SELECT * FROM g_activity")
def gold_member_activity(lake: Lake):
    return lake.activity()


@query("gold_member_activity_corrected", "SELECT * FROM g_activity_once")
def gold_member_activity_corrected(lake: Lake):
    return lake.activity("corrected")


@query("gold_institution_summary", "SELECT * FROM g_inst")
def gold_institution_summary(lake: Lake):
    return lake.institutions()


@query("gold_institution_summary_corrected", "SELECT * FROM g_inst_once")
def gold_institution_summary_corrected(lake: Lake):
    return lake.institutions("corrected")


# --- dashboards ---------------------------------------------------------------------------------

@query("bi_signals_daily", f"""
SELECT institution_id, CAST(signal_time AS DATE) AS signal_date, signal_source, count(*) AS signal_count,
  CAST(sum(coalesce(CAST(event_risk_score AS DECIMAL(10,4)), CAST(alert_confidence AS DECIMAL(10,4)))) AS DOUBLE)
    / count(coalesce(event_risk_score, alert_confidence)) AS avg_risk
FROM g_signals WHERE signal_time >= {AT} - INTERVAL 30 DAY GROUP BY 1, 2, 3""")
def bi_signals_daily(lake: Lake):
    return bi.signals_daily(lake.signals, lake.as_of)


@query("bi_top_members", """
SELECT member_id, first_name || ' ' || last_name AS member_name, institution_id, risk_tier, txn_count_30d,
  total_spend_30d, open_alerts
FROM g_activity WHERE txn_count_30d > 0 ORDER BY total_spend_30d DESC NULLS LAST, member_id LIMIT 100""")
def bi_top_members(lake: Lake):
    return bi.top_members(lake.activity())


@query("bi_institution_health", """
SELECT institution_name, institution_type, region, active_members_30d, total_txns_30d, total_volume_30d, alerts_30d,
  critical_alerts_30d,
  round(CAST(alerts_30d AS DOUBLE) / nullif(CAST(total_txns_30d AS DOUBLE), 0) * 10000, 2) AS alerts_per_10k_txns
FROM g_inst""")
def bi_institution_health(lake: Lake):
    return bi.institution_health(lake.institutions())


@query("bi_signal_counts_7d", f"""
SELECT institution_id, count(*) AS signal_count, CAST(sum(event_risk_score) AS DOUBLE) / nullif(count(event_risk_score), 0) AS avg_risk
FROM g_signals WHERE signal_time >= {AT} - INTERVAL 7 DAY GROUP BY 1 ORDER BY signal_count DESC, institution_id LIMIT 20""")
def bi_signal_counts_7d(lake: Lake):
    return bi.signal_counts(lake.signals, lake.as_of)


@query("bi_high_risk_members", """
SELECT member_id, txn_count_30d, total_spend_30d, open_alerts FROM g_activity WHERE risk_tier = 'HIGH'
ORDER BY total_spend_30d DESC NULLS LAST, member_id LIMIT 50""")
def bi_high_risk_members(lake: Lake):
    return bi.high_risk_members(lake.activity())


@query("bi_daily_volume", """
SELECT txn_date, CAST(sum(txn_count) AS BIGINT) AS daily_txns, CAST(sum(total_amount) AS DECIMAL(20,2)) AS daily_volume
FROM g_daily WHERE txn_date >= DATE '2024-01-31' - 30 GROUP BY 1""")
def bi_daily_volume(lake: Lake):
    return bi.daily_volume(lake.daily, lake.as_of)


@query("bi_rolling_avg", """
SELECT member_id, txn_date, txn_count, total_amount, max_risk_score,
  CAST(sum(total_amount) OVER w AS DOUBLE) / count(total_amount) OVER w AS rolling_7d_avg
FROM g_daily WHERE txn_date >= DATE '2024-01-31' - 90
WINDOW w AS (PARTITION BY member_id ORDER BY txn_date, institution_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def bi_rolling_avg(lake: Lake):
    return bi.rolling_average(lake.daily, lake.as_of)


@query("bi_alert_rate", """
SELECT institution_id, active_members_30d, total_txns_30d, alerts_30d,
  round(CAST(alerts_30d AS DOUBLE) / nullif(CAST(active_members_30d AS DOUBLE), 0), 4) AS alert_rate FROM g_inst""")
def bi_alert_rate(lake: Lake):
    return bi.alert_rate(lake.institutions())


@query("bi_top_institutions_30d", """
SELECT institution_name, total_volume_30d, total_txns_30d FROM g_inst
ORDER BY total_volume_30d DESC NULLS LAST, institution_name LIMIT 10""")
def bi_top_institutions_30d(lake: Lake):
    return bi.top_institutions(lake.institutions())
