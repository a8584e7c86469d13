"""Data quality and governance queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.registry import query
from riskloom.functions import masking
from riskloom.functions import metrics as m
from riskloom.functions.expressions import at
from riskloom.plans import quality
from riskloom.plans.lake import Lake
from riskloom.session import new_path


def _rate(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(5,4))"


NULLS = "CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / count(*)"
DUPS = "1.0::DOUBLE - CAST(count(DISTINCT {c}) AS DOUBLE) / count(*)"
FRESH = "CAST(CAST(date_sub('minute', max({c}), TIMESTAMP '2024-01-31 00:00:00') AS DOUBLE) / 60.0 AS DECIMAL(10,2))"
POSITIVE = "CAST(count(*) FILTER (WHERE {c} >= 0) AS DOUBLE) / count(*)"


@query("dq_null_rate", f"SELECT {_rate(NULLS.format(c='risk_score'))} AS risk_score_nulls, "
                       f"{_rate(NULLS.format(c='txn_id'))} AS txn_id_nulls FROM raw_transactions")
def dq_null_rate(lake: Lake):
    return lake.raw("raw_transactions").agg(m.null_rate("risk_score").alias("risk_score_nulls"),
                                            m.null_rate("txn_id").alias("txn_id_nulls"))


@query("dq_duplicate_rate", f"SELECT {_rate(DUPS.format(c='txn_id'))} AS duplicate_rate FROM raw_transactions")
def dq_duplicate_rate(lake: Lake):
    return lake.raw("raw_transactions").agg(m.duplicate_rate("txn_id").alias("duplicate_rate"))


@query("dq_freshness", f"SELECT {FRESH.format(c='alert_timestamp')} AS freshness_hours FROM raw_alerts")
def dq_freshness(lake: Lake):
    return lake.raw("raw_alerts").agg(m.freshness_hours("alert_timestamp", lake.as_of).alias("freshness_hours"))


@query("dq_positive_rate", f"SELECT {_rate(POSITIVE.format(c='amount'))} AS positive_rate FROM raw_transactions")
def dq_positive_rate(lake: Lake):
    return lake.raw("raw_transactions").agg(m.positive_rate("amount").alias("positive_rate"))


@query("dq_row_count", "SELECT count(*) AS row_count FROM raw_transactions")
def dq_row_count(lake: Lake):
    return lake.raw("raw_transactions").agg(m.row_count().alias("row_count"))


def _one(table: str, view: str, column: str, metric: str) -> str:
    expr = {"NULL_RATE": _rate(NULLS.format(c=column)), "DUPLICATE_RATE": _rate(DUPS.format(c=column)),
            "FRESHNESS_HOURS": FRESH.format(c=column), "POSITIVE_RATE": _rate(POSITIVE.format(c=column)),
            "ROW_COUNT": "count(*)"}[metric]
    return (f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{metric}' AS metric, "
            f"CAST({expr} AS DOUBLE) AS value, TIMESTAMP '2024-01-31 00:00:00' AS measured_at FROM {view}")


BRONZE_SQL = " UNION ALL ".join(_one(a.table, a.table.lower(), a.column, a.metric) for a in quality.BRONZE_CHECKS)
DAILY_SQL = " UNION ALL ".join(_one(a.table, "g_daily", a.column, a.metric) for a in quality.DAILY_CHECKS)


def _bronze_metrics(lake: Lake):
    tables = {t: lake.raw(t.lower()) for t in ("RAW_TRANSACTIONS", "RAW_MEMBERS", "RAW_ALERTS")}
    return quality.run_metrics(tables, quality.BRONZE_CHECKS, lake.as_of)


@query("dq_attached_all", BRONZE_SQL)
def dq_attached_all(lake: Lake):
    return _bronze_metrics(lake)


@query("dq_gold_daily", DAILY_SQL)
def dq_gold_daily(lake: Lake):
    return quality.run_metrics({"DAILY_MEMBER_SUMMARY": lake.daily}, quality.DAILY_CHECKS, lake.as_of)


@query("dq_gate", f"""
SELECT *, CASE WHEN value > high THEN 'BLOCK' ELSE 'PASS' END AS status FROM (
  SELECT *, CAST(CASE WHEN metric = 'NULL_RATE' AND table_name = 'RAW_TRANSACTIONS' THEN 0.0
    WHEN metric = 'DUPLICATE_RATE' AND table_name = 'RAW_TRANSACTIONS' THEN 0.05 END AS DOUBLE) AS high,
    CAST(CASE WHEN metric = 'NULL_RATE' AND table_name = 'RAW_TRANSACTIONS' THEN 0.0 END AS DOUBLE) AS low
  FROM ({BRONZE_SQL}) r) g""")
def dq_gate(lake: Lake):
    return quality.gate(_bronze_metrics(lake), {("RAW_TRANSACTIONS", "NULL_RATE"): (0.0, 0.0),
                                                ("RAW_TRANSACTIONS", "DUPLICATE_RATE"): (None, 0.05)})


@query("dq_publish", """
WITH tries AS (
  SELECT 1 AS attempt, alert_id, alert_timestamp FROM raw_alerts WHERE _loaded_at < TIMESTAMP '2024-01-15 00:00:00' UNION ALL
  SELECT 2, CASE WHEN upper(severity) <> 'LOW' THEN alert_id END, alert_timestamp FROM raw_alerts UNION ALL
  SELECT 3, alert_id, alert_timestamp FROM raw_alerts),
rates AS (SELECT attempt, count(*) AS n, CAST(count(*) FILTER (WHERE alert_id IS NULL) AS DOUBLE) / count(*) AS value FROM tries GROUP BY attempt)
SELECT CAST(attempt AS BIGINT) AS attempt, CASE WHEN value > 0 THEN 'BLOCK' ELSE 'PASS' END AS status,
  CAST(CASE WHEN attempt = 2 THEN (SELECT n FROM rates WHERE attempt = 1) ELSE n END AS BIGINT) AS rows_seen FROM rates""")
def dq_publish(lake: Lake):
    """Three states of a table are offered. The second lacks ids of some rows, so its readers still get the first."""
    alerts, path, out = lake.raw("raw_alerts"), new_path(lake.spark, "published"), None
    lost = F.when(F.upper("severity") != "LOW", F.col("alert_id"))
    tries = (alerts.where(F.col("_loaded_at") < at("2024-01-15 00:00:00")), alerts.withColumn("alert_id", lost), alerts)
    for number, df in enumerate(tries, 1):
        verdicts = quality.publish(df, path, "RAW_ALERTS", quality.BRONZE_CHECKS, {("RAW_ALERTS", "NULL_RATE"): (None, 0.0)}, lake.as_of)
        seen = lake.spark.read.parquet(path).count()
        row = verdicts.where("metric = 'NULL_RATE'").select(F.lit(number).cast("bigint").alias("attempt"), "status", F.lit(seen).cast("bigint").alias("rows_seen"))
        out = row if out is None else out.unionByName(row)
    return out


@query("dq_quarantine", """
SELECT txn_id, amount, risk_score, array_to_string(list_filter([CASE WHEN coalesce(amount >= 0, FALSE) THEN NULL ELSE 'amount_positive' END,
    CASE WHEN risk_score IS NOT NULL THEN NULL ELSE 'risk_known' END], lambda x: x IS NOT NULL), ',') AS broken_rules
FROM raw_transactions WHERE NOT (coalesce(amount >= 0, FALSE) AND risk_score IS NOT NULL)""")
def dq_quarantine(lake: Lake):
    rules = {"amount_positive": F.col("amount") >= 0, "risk_known": F.col("risk_score").isNotNull()}
    _, held = quality.quarantine(lake.raw("raw_transactions"), rules)
    return held.select("txn_id", "amount", "risk_score", F.array_join("broken_rules", ",").alias("broken_rules"))


# --- governance ---------------------------------------------------------------------------------

ANALYST = masking.Access("ANALYST", "AMERICA,ASIA")


@query("gov_mask_pii", "SELECT member_id, '***MASKED***' AS email, email AS email_for_admin FROM s_members")
def gov_mask_pii(lake: Lake):
    admin = masking.Access("ADMIN")
    return lake.members.select("member_id", masking.mask_pii("email", ANALYST).alias("email"),
                               masking.mask_pii("email", admin).alias("email_for_admin"))


@query("gov_mask_email", r"SELECT member_id, regexp_replace(email, '(.)[^@]*(@.*)', '\1***\2') AS email FROM s_members")
def gov_mask_email(lake: Lake):
    return lake.members.select("member_id", masking.mask_email("email", ANALYST).alias("email"))


@query("gov_row_filter", "SELECT * FROM g_inst WHERE region IN ('AMERICA', 'ASIA')")
def gov_row_filter(lake: Lake):
    return masking.row_policy(lake.institutions(), "region", ANALYST)


@query("gov_tagged_mask", """
SELECT * REPLACE ('***MASKED***' AS ssn_hash, '***MASKED***' AS email, '***MASKED***' AS phone_normalized,
  '***MASKED***' AS date_of_birth) FROM s_members""")
def gov_tagged_mask(lake: Lake):
    pii = {c: {"sensitivity": "PII", "data_domain": "MEMBER"} for c in masking.MEMBER_PII}
    return masking.apply_masks(masking.tag_columns(lake.members, pii), ANALYST)
