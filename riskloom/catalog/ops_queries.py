"""Operational reports and table maintenance."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.registry import query
from riskloom.functions.expressions import at
from riskloom.operators.merge import feature_delta, merge_features, update_by_key
from riskloom.plans import contributions, gold, ingest, medallion, ops
from riskloom.plans.gold import daily_member_summary
from riskloom.plans.lake import Lake
from riskloom.plans.nodes import BRONZE_INPUTS, standard_nodes
from riskloom.plans.silver import cleanse_transactions
from riskloom.session import new_path
from riskloom.sources.files import align_by_name
from riskloom.sources.tables import export_product

AT = "TIMESTAMP '2024-01-31 00:00:00'"
SEC = "date_sub('second', refresh_start_time, refresh_end_time)"


@query("ops_refresh_status", """
SELECT name, schema_name, target_lag, refresh_mode, scheduling_state, refresh_end_time AS last_refresh_time, data_timestamp
FROM refresh_log QUALIFY row_number() OVER (PARTITION BY schema_name, name ORDER BY refresh_end_time DESC, run_id DESC) = 1""")
def ops_refresh_status(lake: Lake):
    return ops.refresh_status(lake.raw("refresh_log"))


@query("ops_refresh_history", f"""
SELECT name, schema_name, state, refresh_trigger, refresh_action, {SEC} AS refresh_duration_sec, refresh_start_time,
  refresh_end_time, statistics, run_id
FROM refresh_log WHERE refresh_start_time >= {AT} - INTERVAL 24 HOUR ORDER BY refresh_start_time DESC, run_id LIMIT 50""")
def ops_refresh_history(lake: Lake):
    return ops.refresh_history(lake.raw("refresh_log"), lake.as_of)


@query("ops_slow", f"""
SELECT name, schema_name, refresh_action, {SEC} AS duration_sec, refresh_start_time FROM refresh_log
WHERE {SEC} > 60 AND state = 'SUCCEEDED'""")
def ops_slow(lake: Lake):
    return ops.slow_refreshes(lake.raw("refresh_log"))


@query("ops_failed", f"""
SELECT name, schema_name, state, state_message, refresh_start_time, statistics FROM refresh_log
WHERE state = 'FAILED' AND refresh_start_time >= {AT} - INTERVAL 7 DAY""")
def ops_failed(lake: Lake):
    return ops.failed_refreshes(lake.raw("refresh_log"), lake.as_of)


@query("ops_rebuild_runs", f"""
SELECT name, state, refresh_action, refresh_start_time, refresh_end_time, {SEC} AS rebuild_seconds, run_id
FROM refresh_log WHERE name = 'NODE_8' ORDER BY refresh_start_time DESC, run_id LIMIT 5""")
def ops_rebuild_runs(lake: Lake):
    return ops.rebuild_runs(lake.raw("refresh_log"), "NODE_8")


@query("ops_query_profile", f"""
SELECT query_id, query_text, warehouse_name, execution_status, CAST(total_elapsed_time AS DOUBLE) / 1000 AS elapsed_seconds,
  CAST(bytes_scanned AS DOUBLE) / 1073741824 AS gb_scanned, rows_produced, partitions_scanned,
  CAST(partitions_total AS INTEGER) AS partitions_total,
  round(CAST(partitions_scanned AS DOUBLE) / nullif(CAST(partitions_total AS DOUBLE), 0) * 100, 1) AS prune_pct
FROM query_log WHERE warehouse_name = 'ANALYTICS' AND start_time >= {AT} - INTERVAL 1 HOUR AND execution_status = 'SUCCESS'
ORDER BY total_elapsed_time DESC, query_id LIMIT 20""")
def ops_query_profile(lake: Lake):
    return ops.query_profile(lake.raw("query_log"), lake.as_of)


@query("ops_latency_summary", """
WITH ok AS (SELECT total_elapsed_time AS x, row_number() OVER (ORDER BY total_elapsed_time) - 1 AS r, count(*) OVER () AS n
  FROM query_log WHERE execution_status = 'SUCCESS')
SELECT (SELECT count(*) FROM query_log) AS total, count(*) AS successful,
  (SELECT count(*) FROM query_log WHERE execution_status <> 'SUCCESS') AS failed,
  CAST(sum(x) AS DOUBLE) / count(*) AS avg_latency, max(x) FILTER (WHERE r = n // 2) AS p50_latency,
  max(x) FILTER (WHERE r = CAST(floor(n * 0.95::DOUBLE) AS BIGINT)) AS p95_latency, max(x) AS max_latency FROM ok""")
def ops_latency_summary(lake: Lake):
    return ops.latency_summary(lake.raw("query_log"), "total_elapsed_time", F.col("execution_status") == "SUCCESS")


COST = f"""
SELECT warehouse_name, CAST(start_time AS DATE) AS usage_date, CAST(sum(credits_used) AS DECIMAL(20,4)) AS credits_used
FROM usage_log WHERE warehouse_name LIKE 'RISK!_%' ESCAPE '!' AND start_time >= {AT} - INTERVAL 30 DAY GROUP BY 1, 2"""


@query("ops_cost_daily", COST)
def ops_cost_daily(lake: Lake):
    return ops.credits_daily(lake.raw("usage_log"), lake.as_of)


@query("ops_cost_total", f"SELECT warehouse_name, CAST(sum(credits_used) AS DECIMAL(20,4)) AS credits_used FROM ({COST}) c GROUP BY 1")
def ops_cost_total(lake: Lake):
    return ops.credits_total(lake.raw("usage_log"), lake.as_of)


# Values that the input holds; the Spark side finds them itself.
WAREHOUSES = ("RISK_INGEST", "RISK_TRANSFORM", "RISK_ANALYTICS", "RISK_AI", "RISK_NEW")


@query("ops_cost_pivot", "SELECT usage_date, " + ", ".join(
    f"CAST(coalesce(sum(credits_used) FILTER (WHERE warehouse_name = '{w}'), 0) AS DECIMAL(30,4)) AS {w}" for w in WAREHOUSES)
    + f" FROM ({COST}) c GROUP BY 1")
def ops_cost_pivot(lake: Lake):
    wide = ops.pivot_fill(ops.credits_daily(lake.raw("usage_log"), lake.as_of), "usage_date", "warehouse_name", "credits_used")
    return wide.select("usage_date", *[F.col(w).cast("decimal(30,4)").alias(w) for w in wide.columns[1:]])


@query("ops_status_totals", "SELECT status, count(*) AS n FROM tasks GROUP BY 1")
def ops_status_totals(lake: Lake):
    return ops.status_totals(lake.raw("tasks"))


@query("ops_progress", """
SELECT phase, count(status) AS total, count(*) FILTER (WHERE status = 'Complete') AS done,
  CAST(floor(CAST(count(*) FILTER (WHERE status = 'Complete') AS DOUBLE) / count(status) * 100) AS BIGINT) AS pct
FROM tasks GROUP BY 1""")
def ops_progress(lake: Lake):
    return ops.progress(lake.raw("tasks"), "phase")


@query("ops_progress_rounded", """
SELECT owner, count(status) AS total, count(*) FILTER (WHERE status = 'Complete') AS done,
  CAST(round_even(CAST(count(*) FILTER (WHERE status = 'Complete') AS DOUBLE) / count(status) * 100, 0) AS BIGINT) AS pct
FROM tasks GROUP BY 1""")
def ops_progress_rounded(lake: Lake):
    return ops.progress(lake.raw("tasks"), "owner", rounding="bround")


STATES = ("Complete", "In Progress", "Blocked", "Not Started")


@query("ops_owner_pivot", "SELECT owner, " + ", ".join(
    f"count(*) FILTER (WHERE status = '{s}') AS \"{s}\"" for s in STATES) + " FROM tasks GROUP BY 1")
def ops_owner_pivot(lake: Lake):
    return ops.pivot_fill(lake.raw("tasks"), "owner", "status", "id", F.count)


@query("ops_gantt", """
SELECT CAST(id AS VARCHAR) || ' ' || task AS label, phase, owner, status, start_date AS start, start_date + days AS end
FROM tasks""")
def ops_gantt(lake: Lake):
    return ops.gantt(lake.raw("tasks"))


@query("ops_test_results", "SELECT use_case, status, count(*) AS n FROM test_results GROUP BY 1, 2")
def ops_test_results(lake: Lake):
    return lake.raw("test_results").groupBy("use_case", "status").agg(F.count(F.lit(1)).alias("n"))


@query("ops_case_filter", "SELECT * FROM test_results WHERE use_case = 'UC3'")
def ops_case_filter(lake: Lake):
    return ops.case_filter(lake.raw("test_results"), "UC3")


@query("ops_distinct_cases", "SELECT DISTINCT use_case FROM test_results")
def ops_distinct_cases(lake: Lake):
    return ops.distinct_values(lake.raw("test_results"), "use_case")


@query("ops_lineage", "SELECT downstream, upstream, type FROM object_dependencies ORDER BY upstream, downstream, type LIMIT 50")
def ops_lineage(lake: Lake):
    return ops.first_dependencies(lake.raw("object_dependencies"))


@query("ops_lineage_closure", """
WITH edges AS (SELECT DISTINCT upstream, downstream FROM object_dependencies),
reach(upstream, downstream, distance) AS (
  SELECT upstream, downstream, CAST(1 AS BIGINT) FROM edges
  UNION ALL
  SELECT r.upstream, e.downstream, r.distance + 1 FROM reach r JOIN edges e ON r.downstream = e.upstream)
SELECT upstream, downstream, min(distance) AS distance FROM reach GROUP BY 1, 2""")
def ops_lineage_closure(lake: Lake):
    return ops.lineage_closure(lake.raw("object_dependencies"))


@query("ops_impact", """
WITH reach(object, distance) AS (
  SELECT DISTINCT upstream, CAST(0 AS BIGINT) FROM object_dependencies WHERE upstream LIKE 'OBJ%5'
  UNION
  SELECT d.downstream, r.distance + 1 FROM reach r JOIN object_dependencies d ON d.upstream = r.object)
SELECT object, min(distance) AS distance FROM reach GROUP BY object HAVING min(distance) > 0""")
def ops_impact(lake: Lake):
    """What depends, directly or not, on the objects whose number ends in five."""
    edges = lake.raw("object_dependencies")
    return ops.impact(edges, edges.where("upstream LIKE 'OBJ%5'").select("upstream"))


@query("ops_recent_count", f"""
SELECT _channel_name, count(*) AS events_last_minutes FROM streaming_events
WHERE _ingest_time >= TIMESTAMP '2024-01-29 00:00:00' - INTERVAL 5 MINUTE GROUP BY 1""")
def ops_recent_count(lake: Lake):
    return ops.recent_count(lake.raw("streaming_events"), "2024-01-29 00:00:00")


# --- maintenance --------------------------------------------------------------------------------

DELTA = """SELECT member_id, count(*) AS n, count(DISTINCT channel) AS ch,
    CAST(sum(CASE WHEN amount > 0 THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS sp, max(risk_score) AS mr, max(event_time) AS mt
  FROM s_events WHERE event_time {op} TIMESTAMP '2024-01-15 00:00:00' GROUP BY member_id"""


@query("merge_upsert", f"""
WITH a AS ({DELTA.format(op='<')}), b AS ({DELTA.format(op='>=')})
SELECT coalesce(a.member_id, b.member_id) AS member_id, coalesce(a.n, 0) + coalesce(b.n, 0) AS event_count_24h,
  greatest(a.ch, b.ch) AS unique_channels_24h,
  CAST(coalesce(a.sp, 0) + coalesce(b.sp, 0) AS DECIMAL(18,2)) AS total_spend_24h, greatest(a.mr, b.mr) AS max_risk_score_24h,
  greatest(a.mt, b.mt) AS last_activity_time,
  CASE WHEN b.member_id IS NULL THEN TIMESTAMP '2024-01-15 00:00:00' ELSE {AT} END AS feature_computed_at
FROM a FULL OUTER JOIN b ON a.member_id = b.member_id""")
def merge_upsert(lake: Lake):
    """Features of the first half of the month with the second half merged in."""
    half = at("2024-01-15 00:00:00")
    target = feature_delta(lake.events.where(F.col("event_time") < half)).withColumn("feature_computed_at", half)
    delta = feature_delta(lake.events.where(F.col("event_time") >= half))
    return merge_features(target, delta, at(lake.as_of))


@query("update_by_key", f"""
SELECT t.* REPLACE (CASE WHEN t.status = 'Blocked' THEN 'In Progress' ELSE t.status END AS status),
  CASE WHEN t.status = 'Blocked' THEN {AT} END AS updated_at FROM tasks t""")
def update_tasks(lake: Lake):
    tasks = lake.raw("tasks")
    freed = tasks.where("status = 'Blocked'").select("id", F.lit("In Progress").alias("status"))
    return update_by_key(tasks, freed, "id", stamp="updated_at", now=at(lake.as_of))


@query("incremental_equals_full", "SELECT * FROM g_daily")
def incremental_equals_full(lake: Lake):
    """The daily table after a first load and an incremental refresh with the rows that came later."""
    raw = lake.raw("raw_transactions")
    late = F.col("_loaded_at") >= at("2022-01-01 00:00:00")
    silver, gold = new_path(lake.spark, "silver-txn"), new_path(lake.spark, "gold-daily")
    medallion.write_parts(cleanse_transactions(raw.where(~late)), silver, "txn_timestamp", "month")
    medallion.write_parts(daily_member_summary(lake.spark.read.parquet(silver)), gold, "txn_date", "month")
    medallion.refresh_daily(lake.spark, silver, gold, raw.where(late), "month")
    out = lake.spark.read.parquet(gold)
    return out.select(*daily_member_summary(cleanse_transactions(raw)).columns)


def _refreshed(lake: Lake) -> contributions.Zone:
    """Totals after a first load, a second one that replaces rows of other months, a repetition of it, and a day's advance."""
    raw = lake.raw("raw_transactions")
    zone = contributions.Zone(lake.spark, new_path(lake.spark, "totals"), "2024-01-30 00:00:00")
    late = F.col("_loaded_at") >= at("2024-01-10 00:00:00")
    zone.load(raw.where(~late), 1)
    zone.load(raw.where(late), 2)
    zone.load(raw.where(late), 2)
    zone.advance(lake.as_of, 3)
    return zone


@query("incremental_activity", "SELECT * FROM g_activity")
def incremental_activity(lake: Lake):
    """Member activity whose transaction side was kept by additions and removals."""
    recent = contributions.recent_by_member(_refreshed(lake).held(contributions.MEMBER_TOTALS))
    return gold.member_activity(lake.members, lake.transactions, lake.alerts, lake.as_of, recent=recent)


@query("incremental_institutions", "SELECT * FROM g_inst")
def incremental_institutions(lake: Lake):
    """Institution summary whose transaction side was kept by additions and removals."""
    recent = contributions.recent_by_institution(_refreshed(lake).held(contributions.INSTITUTION_TOTALS))
    return gold.institution_summary(lake.raw("raw_institutions"), lake.transactions, lake.alerts, lake.as_of, recent=recent)


@query("zones_stored", """
SELECT 'CLEANSED_TRANSACTIONS' AS name, count(*) AS n FROM s_txn UNION ALL SELECT 'ENRICHED_MEMBERS', count(*) FROM s_members
UNION ALL SELECT 'DEDUP_EVENTS', count(*) FROM s_events UNION ALL SELECT 'ENRICHED_ALERTS', count(*) FROM s_alerts
UNION ALL SELECT 'DAILY_MEMBER_SUMMARY', count(*) FROM g_daily UNION ALL SELECT 'FRAUD_SIGNALS', count(*) FROM g_signals
UNION ALL SELECT 'MEMBER_ACTIVITY', count(*) FROM s_members UNION ALL SELECT 'INSTITUTION_SUMMARY', count(*) FROM raw_institutions
UNION ALL SELECT 'ONLINE_MEMBER_FEATURES', count(*) FROM f_online UNION ALL SELECT 'OFFLINE_MEMBER_FEATURES', count(*) FROM s_members
UNION ALL SELECT 'SPENDING_ANOMALIES', count(DISTINCT txn_date) FROM g_daily WHERE txn_date >= DATE '2024-01-24'
UNION ALL SELECT 'ALERTS_FOR_SEARCH', count(*) FROM s_alerts""")
def zones_stored(lake: Lake):
    """Rows of every stored table after a full refresh of all zones."""
    store = medallion.ZoneStore(lake.spark, new_path(lake.spark, "zones"))
    done = [n for n in standard_nodes(lake.as_of) if not n.view]
    medallion.refresh_all(store, {n: lake.raw(n.lower()) for n in BRONZE_INPUTS}, standard_nodes(lake.as_of))
    out = None
    for node in done:
        one = store.read(node.zone, node.name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(node.name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("data_product", """
SELECT 'institution_summary' AS path, count(*) AS rows FROM raw_institutions UNION ALL SELECT 'fraud_signals', count(*) FROM g_signals""")
def data_product(lake: Lake):
    """What the manifest of an exported product says."""
    path = new_path(lake.spark, "product")
    export_product({"institution_summary": lake.institutions(), "fraud_signals": lake.signals}, path, lake.as_of)
    tables = lake.spark.read.option("multiLine", "true").json(f"{path}/manifest.json").select("tables.*")
    return tables.select(F.inline(F.array(*[F.struct(F.col(f"{t}.path").alias("path"), F.col(f"{t}.rows").alias("rows")) for t in tables.columns])))


@query("align_by_name", """
SELECT event_id, event_time, event_type, member_id, institution_id, amount, channel, CAST(NULL AS VARCHAR) AS note
FROM streaming_events""")
def align_names(lake: Lake):
    """Columns that arrive in another order and case, with one missing."""
    rows = lake.raw("streaming_events")
    names = ["amount", "channel", "event_id", "event_type", "event_time", "institution_id", "member_id"]
    arrived = rows.select(*[F.col(n).alias(n.upper()) for n in names])
    target = rows.select("event_id", "event_time", "event_type", "member_id", "institution_id", "amount", "channel",
                         F.lit(None).cast("string").alias("note")).schema
    return align_by_name(arrived, target)


def _flagged(view: str, table: str, key: str, cond: str, text: str, column: str, kind: str) -> str:
    return (f"SELECT '{table}' AS source_table, {key} AS rejected_record, '{text}' AS error_message, "
            f"'{column}' AS error_column_name, '{kind}' AS error_category FROM {view} WHERE {cond}")


@query("union_dead_letter", " UNION ALL ".join((
    _flagged("raw_transactions", "BRONZE.RAW_TRANSACTIONS", "txn_id", "risk_score IS NULL", "NULL result in a non-nullable column risk_score", "risk_score", "CONSTRAINT"),
    _flagged("raw_members", "BRONZE.RAW_MEMBERS", "member_id", "country_code IS NULL", "NULL result in a non-nullable column country_code", "country_code", "CONSTRAINT"),
    _flagged("raw_alerts", "BRONZE.RAW_ALERTS", "alert_id", "confidence_score IS NULL", "Conversion of confidence_score to decimal failed", "confidence_score", "TYPE_MISMATCH"))))
def union_dead_letter(lake: Lake):
    """Rejects of three tables in one dead-letter table."""
    def part(view: str, table: str, key: str, column: str, text: str):
        bad = lake.raw(view).where(F.col(column).isNull())
        error = F.struct(F.lit(column).alias("column_name"), F.lit(text).alias("error"))
        rejects = bad.select(F.lit(view).alias("_source_file"), F.col(key).alias("_record"), F.array(error).alias("errors"))
        return ingest.dead_letter(rejects, table, at(lake.as_of))
    return ingest.union_dead_letters(
        part("raw_transactions", "BRONZE.RAW_TRANSACTIONS", "txn_id", "risk_score", "NULL result in a non-nullable column risk_score"),
        part("raw_members", "BRONZE.RAW_MEMBERS", "member_id", "country_code", "NULL result in a non-nullable column country_code"),
        part("raw_alerts", "BRONZE.RAW_ALERTS", "alert_id", "confidence_score", "Conversion of confidence_score to decimal failed"),
    ).select("source_table", "rejected_record", "error_message", "error_column_name", "error_category")
