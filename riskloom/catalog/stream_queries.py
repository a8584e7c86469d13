"""Streaming queries and delivery checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskloom.catalog.ingest_queries import EVENT_REJECTS, EVENT_ROWS, write_lines
from riskloom.catalog.registry import query
from riskloom.functions.expressions import ago, at
from riskloom.operators.merge import feature_delta
from riskloom.plans.lake import Lake
from riskloom.session import new_path
from riskloom.sources.tables import append
from riskloom.streaming import bronze, checks, features
from riskloom.streaming.keyed import kept_states

NOW = "TIMESTAMP '2024-01-31 00:00:00'"


def _bronze_run(lake: Lake) -> str:
    src = write_lines(lake, lake.raw("landing_events"))
    base = new_path(lake.spark, "bronze-stream")
    bronze.bronze_stream(lake.spark, src, f"{base}/bronze", f"{base}/errors", f"{base}/checkpoint", ingest_time=lake.as_of).awaitTermination()
    return base


@query("st_bronze_ingest", f"""
SELECT e.*, {NOW} AS _ingest_time, 'file_delivery' AS _channel_name, TRUE AS payload_has_id, TRUE AS token_names_file
FROM ({EVENT_ROWS}) e""")
def st_bronze_ingest(lake: Lake):
    """Event files through the stream into Bronze, with the payload as it came and a token that names batch and file."""
    rows = lake.spark.read.parquet(f"{_bronze_run(lake)}/bronze")
    file = F.element_at(F.split("_source_file", "/"), -1)
    return rows.withColumns({
        "payload_has_id": F.try_variant_get("payload", "$.event_id", "string") == F.col("event_id"),
        "token_names_file": F.col("_offset_token") == F.concat_ws(":", bronze.BATCH, file)}).drop(
        "payload", "_source_file", "_offset_token", bronze.BATCH)


@query("st_bronze_errors", EVENT_REJECTS)
def st_bronze_errors(lake: Lake):
    """What the stream sets aside, with the reason."""
    rows = lake.spark.read.parquet(f"{_bronze_run(lake)}/errors")
    return rows.select(F.col("_record").alias("record"), F.col("error_column_name").alias("column_name"), F.col("error_message").alias("error"))


@query("st_bronze_dups", """
SELECT 'BRONZE RAW CHECK' AS test_name, count(*) AS total_rows, count(DISTINCT event_id) AS unique_events,
  count(*) - count(DISTINCT event_id) AS duplicate_rows,
  CASE WHEN count(*) > count(DISTINCT event_id) THEN 'EXPECTED: Bronze has duplicates (at-least-once delivery)'
    ELSE 'No duplicates in Bronze (clean delivery)' END AS result
FROM streaming_events""")
def st_bronze_dups(lake: Lake):
    return checks.dup_report(lake.raw("streaming_events"))


@query("st_silver_dedup", """
SELECT 'SILVER DEDUP CHECK' AS test_name, count(*) AS total_rows, count(DISTINCT event_id) AS unique_events,
  CASE WHEN count(*) = count(DISTINCT event_id) THEN 'PASS: Silver has each event once' ELSE 'FAIL' END AS result
FROM s_events""")
def st_silver_dedup(lake: Lake):
    return checks.dedup_report(lake.events)


@query("st_late", """
SELECT 'LATE ARRIVAL CHECK' AS test_name, event_id, event_time, _ingest_time,
  date_sub('hour', event_time, _ingest_time) AS hours_late,
  CASE WHEN _ingest_time > event_time THEN 'CONFIRMED LATE' ELSE 'ON TIME' END AS arrival_status
FROM streaming_events""")
def st_late(lake: Lake):
    return checks.late_report(lake.raw("streaming_events"))


@query("st_event_order", """
WITH o AS (SELECT event_id, event_time, lag(event_time) OVER (ORDER BY event_time, event_id, _offset_token) AS prev_event_time
  FROM streaming_events)
SELECT *, CASE WHEN prev_event_time IS NULL THEN 'FIRST' WHEN event_time >= prev_event_time THEN 'ORDERED' ELSE 'OUT OF ORDER' END AS order_check
FROM o""")
def st_event_order(lake: Lake):
    return checks.order_report(lake.raw("streaming_events"))


@query("st_burst", """
SELECT 'BURST CHECK' AS test_name, count(*) AS burst_events_received, CAST(1000 AS BIGINT) AS burst_events_sent,
  CASE WHEN count(*) >= 1000 THEN 'PASS: All burst events landed'
    ELSE 'PENDING: ' || CAST(1000 - count(*) AS VARCHAR) || ' events not yet loaded' END AS result,
  min(event_time) AS first_event, max(event_time) AS last_event
FROM streaming_events""")
def st_burst(lake: Lake):
    return checks.burst_report(lake.raw("streaming_events"), 1000)


@query("st_latency", """
WITH s AS (SELECT date_sub('second', event_time, _ingest_time) AS s FROM streaming_events)
SELECT 'E2E LATENCY' AS test_name, count(*) AS sample_size, round(CAST(sum(s) AS DOUBLE) / count(*), 0) AS avg_latency_sec,
  min(s) AS min_latency_sec, max(s) AS max_latency_sec,
  CASE WHEN CAST(sum(s) AS DOUBLE) / count(*) < 360 THEN 'GOOD: Under 6 minutes' ELSE 'CHECK: Latency exceeds 6 minutes' END AS assessment
FROM s""")
def st_latency(lake: Lake):
    return checks.e2e_latency(lake.raw("streaming_events"))


@query("st_event_summary", """
SELECT event_type, count(*) AS event_count, min(event_time) AS earliest_event, max(event_time) AS latest_event,
  count(DISTINCT member_id) AS unique_members FROM streaming_events GROUP BY 1""")
def st_event_summary(lake: Lake):
    return checks.event_summary(lake.raw("streaming_events"))


@query("st_dedup_stream", "SELECT * FROM s_events")
def st_dedup_stream(lake: Lake):
    """Newest copy of every event from three deliveries, the newest first, so that copies come behind the watermark."""
    base = new_path(lake.spark, "dedup")
    src, kept = f"{base}/bronze", f"{base}/events"
    rows, t = lake.raw("streaming_events"), F.col("_ingest_time")
    first, second = at("2024-01-11 00:00:00"), at("2024-01-21 00:00:00")
    for part in (rows.where(t >= second), rows.where(t < first), rows.where((t >= first) & (t < second))):
        append(part, src)
        bronze.latest_events(bronze.stream_table(lake.spark, src, rows.schema), kept, f"{base}/checkpoint").awaitTermination()
    return bronze.current_events(lake.spark, kept)


@query("st_feature_upsert", """
WITH d AS (SELECT member_id, CASE WHEN _ingest_time < TIMESTAMP '2024-01-11 00:00:00' THEN 0 WHEN _ingest_time < TIMESTAMP '2024-01-21 00:00:00' THEN 1 ELSE 2 END AS b,
    count(*) AS n, count(DISTINCT channel) AS ch, sum(CASE WHEN amount > 0 THEN amount ELSE 0 END) AS sp,
    max(risk_score) AS mr, max(event_time) AS mt
  FROM streaming_events GROUP BY 1, 2)
SELECT member_id, CAST(sum(n) AS BIGINT) AS event_count_24h, max(ch) AS unique_channels_24h,
  CAST(sum(sp) AS DECIMAL(18,2)) AS total_spend_24h, max(mr) AS max_risk_score_24h, max(mt) AS last_activity_time,
  TIMESTAMP '2024-01-31 00:00:00' AS feature_computed_at
FROM d GROUP BY 1""")
def st_feature_upsert(lake: Lake):
    """Three deliveries, each folded into the features by its own micro-batch."""
    base = new_path(lake.spark, "features")
    src, kept = f"{base}/bronze", f"{base}/features"
    rows, t = lake.raw("streaming_events"), F.col("_ingest_time")
    first, second = at("2024-01-11 00:00:00"), at("2024-01-21 00:00:00")
    for part in (rows.where(t < first), rows.where((t >= first) & (t < second)), rows.where(t >= second)):
        append(part, src)
        stream = bronze.stream_table(lake.spark, src, rows.schema)
        features.keep_features(stream, kept, f"{base}/checkpoint", computed_at=lake.as_of).awaitTermination()
    return features.current_features(lake.spark, kept)


@query("st_sliding_24h", """
WITH w AS (SELECT date_trunc('hour', event_time) - to_hours(CAST(i AS INTEGER)) AS window_start, e.*
  FROM s_events e CROSS JOIN range(24) r(i))
SELECT window_start, window_start + INTERVAL 24 HOUR AS window_end, member_id, count(*) AS event_count,
  CAST(sum(CASE WHEN amount > 0 THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS total_spend, max(risk_score) AS max_risk_score,
  max(event_time) AS last_activity_time
FROM w GROUP BY window_start, member_id""")
def st_sliding_24h(lake: Lake):
    """24-hour windows every hour over the Silver event feed, open ones included, from hourly panes kept by the stream. Half
    of the events come after the others, most of those behind the watermark."""
    base = new_path(lake.spark, "sliding")
    src, kept = f"{base}/silver", f"{base}/panes"
    second = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 1
    for part in (lake.events.where(~second), lake.events.where(second)):
        append(part, src)
        features.keep_panes(bronze.stream_table(lake.spark, src), kept, f"{base}/checkpoint").awaitTermination()
    features.fold_late(lake.spark, kept, lake.spark.read.parquet(src))
    return features.sliding_windows(kept_states(lake.spark, kept))


SHARED = """SELECT member_id, count(*) AS n, CAST(sum(CASE WHEN amount > 0 THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS sp,
  max({risk}) AS mr, max(event_time) AS mt FROM {view} WHERE event_time >= TIMESTAMP '2024-01-30 00:00:00' GROUP BY 1"""


@query("st_rebuild_diff", f"""
WITH rt AS ({SHARED.format(risk='risk_score', view='(SELECT * REPLACE (upper(trim(member_id)) AS member_id) FROM streaming_events) q')}),
rb AS ({SHARED.format(risk='risk_score', view='s_events')})
SELECT coalesce(rt.member_id, rb.member_id) AS member_id, CASE WHEN rb.member_id IS NULL THEN 'ONLY_FIRST' WHEN rt.member_id IS NULL THEN 'ONLY_SECOND' ELSE 'DIFFERENT' END AS state
FROM rt FULL OUTER JOIN rb ON rt.member_id = rb.member_id
WHERE (rt.n, rt.sp, rt.mr, rt.mt) IS DISTINCT FROM (rb.n, rb.sp, rb.mr, rb.mt)""")
def st_rebuild_diff(lake: Lake):
    """Members whose real-time features (copies counted twice) the rebuild corrects."""
    recent = lake.raw("streaming_events").where(F.col("event_time") >= ago(lake.as_of, 24, "hour"))
    live = feature_delta(recent.withColumn("member_id", F.upper(F.trim("member_id"))))
    return features.reconcile(live, lake.events, lake.as_of)
