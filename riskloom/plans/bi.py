"""Dashboard queries over the Gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.expressions import days_since, full_name, mean, safe_ratio, since, total
from riskloom.operators.latest import top_k


def signals_daily(signals: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    risk = F.coalesce(F.col("event_risk_score").cast("decimal(10,4)"), F.col("alert_confidence").cast("decimal(10,4)"))
    return signals.where(since("signal_time", as_of, days)).groupBy(
        "institution_id", F.to_date("signal_time").alias("signal_date"), "signal_source").agg(
        F.count(F.lit(1)).alias("signal_count"), mean(risk).alias("avg_risk")).orderBy(
        F.desc("signal_date"), F.desc("signal_count"), "institution_id", "signal_source")


def top_members(activity: DataFrame, k: int = 100) -> DataFrame:
    rows = activity.where("txn_count_30d > 0").select(
        "member_id", full_name("first_name", "last_name").alias("member_name"), "institution_id", "risk_tier",
        "txn_count_30d", "total_spend_30d", "open_alerts")
    return top_k(rows, [F.col("total_spend_30d").desc_nulls_last()], k, ["member_id"])


def institution_health(institutions: DataFrame) -> DataFrame:
    return institutions.select(
        "institution_name", "institution_type", "region", "active_members_30d", "total_txns_30d", "total_volume_30d",
        "alerts_30d", "critical_alerts_30d",
        safe_ratio("alerts_30d", "total_txns_30d", 10000, 2).alias("alerts_per_10k_txns")).orderBy(
        F.col("total_volume_30d").desc_nulls_last(), "institution_name")


def signal_counts(signals: DataFrame, as_of: str, days: int = 7, k: int = 20) -> DataFrame:
    counts = signals.where(since("signal_time", as_of, days)).groupBy("institution_id").agg(
        F.count(F.lit(1)).alias("signal_count"), mean("event_risk_score").alias("avg_risk"))
    return top_k(counts, [F.desc("signal_count")], k, ["institution_id"])


def high_risk_members(activity: DataFrame, tier: str = "HIGH", k: int = 50) -> DataFrame:
    rows = activity.where(F.col("risk_tier") == tier).select("member_id", "txn_count_30d", "total_spend_30d", "open_alerts")
    return top_k(rows, [F.col("total_spend_30d").desc_nulls_last()], k, ["member_id"])


def daily_volume(daily: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    return daily.where(days_since("txn_date", as_of, days)).groupBy("txn_date").agg(
        F.sum("txn_count").alias("daily_txns"), total("total_amount", 20).alias("daily_volume")).orderBy("txn_date")


def rolling_average(daily: DataFrame, as_of: str, days: int = 90, rows: int = 7) -> DataFrame:
    """Trailing average of daily totals per member. A member has at most one row per day and institution here."""
    w = (Window.partitionBy("member_id").orderBy("txn_date", "institution_id").rowsBetween(-(rows - 1), 0))
    avg = F.sum("total_amount").over(w).cast("double") / F.count("total_amount").over(w).cast("double")
    return daily.where(days_since("txn_date", as_of, days)).select(
        "member_id", "txn_date", "txn_count", "total_amount", "max_risk_score", avg.alias("rolling_7d_avg"))


def alert_rate(institutions: DataFrame) -> DataFrame:
    return institutions.select(
        "institution_id", "active_members_30d", "total_txns_30d", "alerts_30d",
        safe_ratio("alerts_30d", "active_members_30d", 1, 4).alias("alert_rate")).orderBy(
        F.col("alert_rate").desc_nulls_last(), "institution_id")


def top_institutions(institutions: DataFrame, k: int = 10) -> DataFrame:
    rows = institutions.select("institution_name", "total_volume_30d", "total_txns_30d")
    return top_k(rows, [F.col("total_volume_30d").desc_nulls_last()], k, ["institution_name"])
