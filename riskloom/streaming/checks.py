"""Delivery checks over the Bronze and Silver event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.expressions import ago, elapsed, verdict
from riskloom.operators.ranking import previous_values
from riskloom.operators.skew import lookup_join


def dup_report(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Bronze: rows, distinct keys, surplus rows. Surplus is expected there, delivery is at least once."""
    n = df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct(key).alias("unique_events"))
    extra = F.col("total_rows") - F.col("unique_events")
    return n.select(F.lit("BRONZE RAW CHECK").alias("test_name"), "total_rows", "unique_events",
                    extra.alias("duplicate_rows"),
                    verdict(extra > 0, "EXPECTED: Bronze has duplicates (at-least-once delivery)",
                            "No duplicates in Bronze (clean delivery)").alias("result"))


def dedup_report(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Silver: every key once."""
    n = df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct(key).alias("unique_events"))
    extra = F.col("total_rows") - F.col("unique_events")
    bad = F.concat(F.lit("FAIL: Silver has duplicates ("), extra.cast("string"), F.lit(" extra rows)"))
    return n.select(F.lit("SILVER DEDUP CHECK").alias("test_name"), "total_rows", "unique_events",
                    verdict(extra == 0, "PASS: Silver has each event once", bad).alias("result"))


def late_report(df: DataFrame) -> DataFrame:
    return df.select(F.lit("LATE ARRIVAL CHECK").alias("test_name"), "event_id", "event_time", "_ingest_time",
                     elapsed("HOUR", "event_time", "_ingest_time").alias("hours_late"),
                     verdict(F.col("_ingest_time") > F.col("event_time"), "CONFIRMED LATE", "ON TIME").alias("arrival_status"))


def order_report(df: DataFrame, tiebreak: tuple[str, ...] = ("event_id", "_offset_token")) -> DataFrame:
    """Every row with the event time before it in the whole table.

    Rows that share an event time have that same time before them, except the first; so only distinct times need an
    order. ``tiebreak`` must tell rows of one event time apart.
    """
    first = df.groupBy("event_time").agg(F.min(F.struct(*tiebreak)).alias("_first"))
    before = previous_values(df, "event_time")
    j = lookup_join(df, first.join(before, "event_time"), "event_time")
    is_first = F.struct(*tiebreak) == F.col("_first")
    prev = F.when(is_first, F.col("previous")).otherwise(F.col("event_time"))
    out = j.select("event_id", "event_time", prev.alias("prev_event_time"))
    check = (F.when(F.col("event_time") >= F.col("prev_event_time"), "ORDERED")
             .when(F.col("prev_event_time").isNull(), "FIRST").otherwise("OUT OF ORDER"))
    return out.withColumn("order_check", check)


def burst_report(df: DataFrame, expected: int) -> DataFrame:
    n = df.agg(F.count(F.lit(1)).alias("burst_events_received"), F.min("event_time").alias("first_event"),
               F.max("event_time").alias("last_event"))
    missing = (F.lit(expected) - F.col("burst_events_received")).cast("string")
    return n.select(F.lit("BURST CHECK").alias("test_name"), "burst_events_received",
                    F.lit(expected).cast("bigint").alias("burst_events_sent"),
                    verdict(F.col("burst_events_received") >= expected, "PASS: All burst events landed",
                            F.concat(F.lit("PENDING: "), missing, F.lit(" events not yet loaded"))).alias("result"),
                    "first_event", "last_event")


def e2e_latency(df: DataFrame, as_of: str | None = None, hours: int = 1, limit_s: int = 360) -> DataFrame:
    rows = df.where(F.col("_ingest_time") >= ago(as_of, hours, "hour")) if as_of else df
    s = rows.select(elapsed("SECOND", "event_time", "_ingest_time").alias("_s"))
    a = s.agg(F.count("_s").alias("sample_size"), F.sum("_s").alias("_sum"), F.min("_s").alias("min_latency_sec"),
              F.max("_s").alias("max_latency_sec"))
    avg = F.col("_sum").cast("double") / F.nullif(F.col("sample_size"), F.lit(0)).cast("double")
    return a.select(F.lit("E2E LATENCY").alias("test_name"), "sample_size", F.round(avg, 0).alias("avg_latency_sec"),
                    "min_latency_sec", "max_latency_sec",
                    verdict(avg < limit_s, f"GOOD: Under {limit_s // 60} minutes",
                            f"CHECK: Latency exceeds {limit_s // 60} minutes").alias("assessment"))


def event_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("event_count"), F.min("event_time").alias("earliest_event"),
        F.max("event_time").alias("latest_event"), F.count_distinct("member_id").alias("unique_members")).orderBy(
        F.desc("event_count"))
