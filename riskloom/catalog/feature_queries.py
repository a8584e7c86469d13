"""Feature store queries."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.catalog.registry import query
from riskloom.functions.expressions import ago, at
from riskloom.plans import features, gold, silver
from riskloom.plans.lake import Lake
from riskloom.session import new_path
from riskloom.sources.tables import read_as_of, snapshot, snapshot_each

SNAPS = ("2024-01-01 00:00:00", "2024-01-24 00:00:00", "2024-01-31 00:00:00")
SHOWN = ", ".join(features.FEATURE_COLUMNS)


@query("fs_online", "SELECT * FROM f_online")
def fs_online(lake: Lake):
    return lake.online


@query("fs_online_slim", """
SELECT member_id, event_count_24h, unique_channels_24h, unique_ips_24h, total_spend_24h, avg_amount_24h,
  max_risk_score_24h, last_activity_time, feature_computed_at FROM f_online""")
def fs_online_slim(lake: Lake):
    return features.online_features(lake.events, lake.as_of, slim=True)


@query("fs_offline", "SELECT * FROM f_offline")
def fs_offline(lake: Lake):
    return lake.offline


def snapshot_table(lake: Lake, moments=SNAPS) -> str:
    """Offline features as they would have been computed at each moment, kept as snapshots."""
    path = new_path(lake.spark, "offline-features")
    rows = features.backfill_features(*[lake.raw(n) for n in ("raw_members", "raw_transactions", "raw_alerts")], moments)
    snapshot_each(rows, path, "system_time")
    return path


def versions(lake: Lake) -> DataFrame:
    """Snapshots and late corrections of older business dates, as one bi-temporal table."""
    path = snapshot_table(lake)
    rows = lake.spark.read.parquet(path).select(*features.FEATURE_COLUMNS)
    late = (read_as_of(lake.spark, path, SNAPS[0]).where("CAST(substr(member_id, 4) AS BIGINT) % 7 = 0")
            .withColumn("txn_count_30d", F.col("txn_count_30d") + 1)
            .withColumn("system_time", F.col("system_time") + F.expr("INTERVAL 25 DAYS")))
    return rows.unionByName(late)


@query("fs_time_travel", f"SELECT {SHOWN} FROM f_snaps WHERE snap = TIMESTAMP '2024-01-24 00:00:00'")
def fs_time_travel(lake: Lake):
    """State of the offline features seven days ago (newest snapshot not after that time)."""
    path = snapshot_table(lake)
    return read_as_of(lake.spark, path, "2024-01-25 12:00:00")


@query("fs_drift", """
SELECT c.member_id, c.txn_count_30d AS current_txn_count, h.txn_count_30d AS historical_txn_count,
  c.txn_count_30d - h.txn_count_30d AS txn_count_change, c.total_spend_30d AS current_spend,
  h.total_spend_30d AS historical_spend,
  round(CAST(c.total_spend_30d - h.total_spend_30d AS DOUBLE) / nullif(CAST(h.total_spend_30d AS DOUBLE), 0) * 100, 1) AS spend_change_pct
FROM f_snaps c JOIN f_snaps h ON c.member_id = h.member_id
WHERE c.snap = TIMESTAMP '2024-01-31 00:00:00' AND h.snap = TIMESTAMP '2024-01-01 00:00:00'
  AND abs(c.total_spend_30d - h.total_spend_30d) > 1000
ORDER BY abs(spend_change_pct) DESC NULLS LAST, c.member_id LIMIT 20""")
def fs_drift(lake: Lake):
    path = snapshot_table(lake, (SNAPS[0], SNAPS[2]))
    return features.feature_drift(read_as_of(lake.spark, path, SNAPS[2]), read_as_of(lake.spark, path, SNAPS[0]))


def _daily_snapshot(lake: Lake, ts: str) -> DataFrame:
    path = new_path(lake.spark, "daily-member")
    known = lake.raw("raw_transactions").where(F.col("_loaded_at") <= at(ts))
    snapshot(gold.daily_member_summary(silver.cleanse_transactions(known)), path, ts)
    return read_as_of(lake.spark, path, ts)


@query("fs_gold_state", "SELECT * FROM g_daily_nov")
def fs_gold_state(lake: Lake):
    """The daily table as it stood at a decision date."""
    return _daily_snapshot(lake, "2023-11-02 00:00:00")


@query("fs_lookback_90d", """
SELECT member_id, CAST(sum(txn_count) AS BIGINT) AS total_txns_at_90d,
  CAST(sum(total_amount) AS DECIMAL(20,2)) AS total_volume_at_90d, count(DISTINCT txn_date) AS active_days_at_90d
FROM g_daily_nov GROUP BY member_id HAVING sum(total_amount) > 10000
ORDER BY total_volume_at_90d DESC, member_id LIMIT 50""")
def fs_lookback_90d(lake: Lake):
    """Ninety days of states in one pass; the earliest is the one asked for."""
    newest = date(2024, 1, 31)
    moments = [f"{newest - timedelta(days=n)} 00:00:00" for n in range(91)]
    states = features.past_totals(lake.raw("raw_transactions"), moments)
    return features.lookback_totals(features.totals_at(states, moments[-1]))


@query("fs_pit_latest", f"""
SELECT {SHOWN} FROM f_versions
WHERE business_date <= DATE '2024-01-25' AND system_time <= TIMESTAMP '2024-01-28 00:00:00'
QUALIFY row_number() OVER (PARTITION BY member_id ORDER BY business_date DESC, system_time DESC) = 1""")
def fs_pit_latest(lake: Lake):
    return features.pit_features(versions(lake), "2024-01-25", "2024-01-28 00:00:00", "latest")


@query("fs_pit_literal", f"""
WITH known AS (SELECT * FROM f_versions
  WHERE business_date <= DATE '2024-01-25' AND system_time <= TIMESTAMP '2024-01-28 00:00:00')
SELECT {SHOWN} FROM known
WHERE business_date = (SELECT max(k.business_date) FROM known k WHERE k.member_id = known.member_id)
  AND system_time = (SELECT max(k.system_time) FROM known k WHERE k.member_id = known.member_id)""")
def fs_pit_literal(lake: Lake):
    return features.pit_features(versions(lake), "2024-01-25", "2024-01-28 00:00:00", "literal")


@query("fs_pit_spine", """
SELECT s.alert_id, s.member_id, s.decision_ts, f.business_date, f.system_time, f.txn_count_30d, f.total_spend_30d, f.open_alerts
FROM (SELECT alert_id, member_id, alert_timestamp AS decision_ts FROM s_alerts) s
LEFT JOIN f_versions f ON f.member_id = s.member_id AND f.business_date <= CAST(s.decision_ts AS DATE)
  AND f.system_time <= s.decision_ts
QUALIFY row_number() OVER (PARTITION BY s.alert_id ORDER BY f.business_date DESC NULLS LAST, f.system_time DESC NULLS LAST) = 1""")
def fs_pit_spine(lake: Lake):
    """Features known at the time of every alert."""
    spine = lake.alerts.select("alert_id", "member_id", F.col("alert_timestamp").alias("decision_ts"))
    return features.pit_spine(spine, versions(lake), values=("txn_count_30d", "total_spend_30d", "open_alerts"))


def _slo(view: str, start: str, end: str, metric: str) -> str:
    ms = f"date_sub('millisecond', {start}, {end})"
    return f"""
SELECT '{metric}' AS metric, count(*) AS sample_size, round(CAST(sum({ms}) AS DOUBLE) / count(*), 0) AS avg_latency_ms,
  round(quantile_cont(CAST({ms} AS DOUBLE), 0.5), 0) AS p50_latency_ms,
  round(quantile_cont(CAST({ms} AS DOUBLE), 0.95), 0) AS p95_latency_ms,
  round(quantile_cont(CAST({ms} AS DOUBLE), 0.99), 0) AS p99_latency_ms,
  CASE WHEN quantile_cont(CAST({ms} AS DOUBLE), 0.99) <= 1500 THEN 'PASS: p99 <= 1.5s' ELSE 'FAIL: p99 > 1.5s' END AS slo_status
FROM {view}"""


@query("fs_slo", _slo("f_online", "last_activity_time", "feature_computed_at", "FEATURE FRESHNESS SLO"))
def fs_slo(lake: Lake):
    rows = lake.online.where(F.col("feature_computed_at") >= ago(lake.as_of, 1, "hour"))
    return features.latency_slo(rows, "last_activity_time", "feature_computed_at")


@query("fs_slo_ingest", _slo("s_events", "event_time", "_ingest_time", "INGEST LATENCY SLO"))
def fs_slo_ingest(lake: Lake):
    return features.latency_slo(lake.events, "event_time", "_ingest_time", metric="INGEST LATENCY SLO")
