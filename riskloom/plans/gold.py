"""Gold zone: aggregates and combined signals over Silver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.expressions import count_when, mean, risk_band, since, total, verdict
from riskloom.operators.skew import outer_join_unique_right

SEVERE = ("HIGH", "CRITICAL")
OPEN_STATES = ("OPEN", "INVESTIGATING")
MIN_RISK = 0.75


def daily_member_summary(txns: DataFrame, slim: bool = False) -> DataFrame:
    """Daily activity per member and institution; ``slim`` is the seven-measure form.

    A member's day holds few rows, so partial results would be wider than the rows that they stand for. The narrow rows are
    sent once, sorted once and folded group by group; no table of groups with sets of values is kept or spilled.
    """
    amount, risk = F.col("amount"), F.col("risk_score")
    keys = ["member_id", "institution_id", "txn_date"]
    found = {"txn_count": F.count(F.lit(1)), "_sum": F.sum(amount), "_n": F.count(amount), "max_amount": F.max(amount),
             "_channels": F.collect_set("channel"), "max_risk_score": F.max(risk), "_risk": F.sum(risk), "_risk_n": F.count(risk)}
    if not slim:
        zero = F.lit(0)
        found |= {"debit_count": F.count_if(F.col("txn_type") == "DEBIT"), "credit_count": F.count_if(F.col("txn_type") == "CREDIT"),
                  "_credits": F.sum(F.when(amount > 0, amount).otherwise(zero)), "_debits": F.sum(F.when(amount < 0, F.abs(amount)).otherwise(zero)),
                  "min_amount": F.min(amount), "_categories": F.collect_set("merchant_category")}
    first = Window.partitionBy(*keys).orderBy("txn_date")
    group = first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = txns.withColumn("txn_date", F.to_date("txn_timestamp")).select(
        *keys, *[c.over(group).alias(name) for name, c in found.items()], F.row_number().over(first).alias("_rank")).where("_rank = 1")

    def money(c: str, name: str) -> Column:
        return F.col(c).cast("decimal(18,2)").alias(name)

    def average(part: str, whole: str, name: str) -> Column:
        return (F.col(part).cast("double") / F.nullif(F.col(whole), F.lit(0)).cast("double")).alias(name)

    def distinct(c: str, name: str) -> Column:
        return F.size(c).cast("bigint").alias(name)

    volume = money("_sum", "total_amount")
    common = [average("_sum", "_n", "avg_amount"), "max_amount", distinct("_channels", "unique_channels"),
              "max_risk_score", average("_risk", "_risk_n", "avg_risk_score")]
    if slim:
        return rows.select(*keys, "txn_count", volume, *common)
    return rows.select(*keys, "txn_count", "debit_count", "credit_count", volume, money("_credits", "total_credits"),
                       money("_debits", "total_debits"), "min_amount", distinct("_categories", "unique_merchant_categories"), *common)


def fraud_signals(alerts: DataFrame, events: DataFrame, min_risk: float = MIN_RISK, hot: list | None = None) -> DataFrame:
    """Severe alerts and risky events side by side: a full outer join on the alert's related id.

    Events are unique per id and already partitioned by it after de-duplication, so only the alerts move.
    """
    a = alerts.select("alert_id", "member_id", "institution_id", "alert_timestamp", "alert_type", "severity",
                      "confidence_score", "status", "related_txn_id")
    e = events.select("event_id", F.col("member_id").alias("e_member_id"),
                      F.col("institution_id").alias("e_institution_id"), "event_time", "risk_score", "amount",
                      "channel", "ip_address", "geo_lat", "geo_lon")
    severe = F.col("severity").isin(*SEVERE)
    joined = outer_join_unique_right(a, e, "related_txn_id", "event_id", severe | (F.col("risk_score") > min_risk),
                                     severe, hot=hot)
    return joined.select(
        F.coalesce("alert_id", "event_id").alias("signal_id"),
        F.coalesce("member_id", "e_member_id").alias("member_id"),
        F.coalesce("institution_id", "e_institution_id").alias("institution_id"),
        F.coalesce("alert_timestamp", "event_time").alias("signal_time"),
        verdict(F.col("alert_id").isNotNull(), "ALERT", "HIGH_RISK_EVENT").alias("signal_source"),
        "alert_type", "severity", F.col("confidence_score").alias("alert_confidence"),
        F.col("risk_score").alias("event_risk_score"), F.col("amount").alias("event_amount"),
        F.col("channel").alias("event_channel"), "ip_address", "geo_lat", "geo_lon",
        F.col("status").alias("alert_status"))


def fraud_signals_union(alerts: DataFrame, events: DataFrame, min_risk: float = MIN_RISK,
                        critical: float = 0.9) -> DataFrame:
    """Severe alerts and risky events stacked, each event graded by its score."""
    a = alerts.where(F.col("severity").isin(*SEVERE)).select(
        F.col("alert_id").alias("signal_id"), "member_id", "institution_id",
        F.col("alert_timestamp").alias("signal_time"), F.lit("ALERT").alias("signal_source"), "alert_type", "severity",
        F.col("confidence_score").alias("alert_confidence"), F.col("status").alias("alert_status"))
    e = events.where(F.col("risk_score") > min_risk).select(
        F.col("event_id").alias("signal_id"), "member_id", "institution_id", F.col("event_time").alias("signal_time"),
        F.lit("HIGH_RISK_EVENT").alias("signal_source"), F.col("event_type").alias("alert_type"),
        risk_band("risk_score", cuts=((critical, "CRITICAL"),), low="HIGH").alias("severity"),
        F.col("risk_score").alias("event_risk_score"), F.col("amount").alias("event_amount"))
    return a.unionByName(e, allowMissingColumns=True)


def _repeat(c, times: Column) -> Column:
    return c * F.greatest(F.coalesce(times, F.lit(0)), F.lit(1))


def member_activity(members: DataFrame, txns: DataFrame, alerts: DataFrame, as_of: str, days: int = 30,
                    mode: str = "literal", recent: DataFrame | None = None) -> DataFrame:
    """Member profile with recent activity.

    Joining both transactions and alerts to a member repeats every transaction once per open alert; ``literal`` keeps
    the totals that gives, ``corrected`` does not repeat. Either way both sides are aggregated before they are joined,
    so no pairs are built. ``recent`` takes the place of the transactions' aggregate, where one is kept.
    """
    t = recent if recent is not None else txns.where(since("txn_timestamp", as_of, days)).groupBy("member_id").agg(
        F.count("txn_id").alias("_n"), total("amount").alias("_sum"), mean("amount").alias("avg_txn_30d"),
        F.max("txn_timestamp").alias("last_txn_time"), F.count_distinct("channel").alias("_channels"))
    a = alerts.where(F.col("status").isin(*OPEN_STATES)).groupBy("member_id").agg(
        F.count("alert_id").alias("_alerts"), F.max("alert_timestamp").alias("last_alert_time"))
    base = members.select("member_id", "institution_id", "first_name", "last_name", "risk_tier", "kyc_verified",
                          "member_since", F.col("status").alias("member_status"))
    j = base.join(t, "member_id", "left").join(a, "member_id", "left")
    times = F.col("_alerts") if mode == "literal" else F.lit(1)
    return j.select(
        *base.columns, _repeat(F.coalesce("_n", F.lit(0)), times).alias("txn_count_30d"),
        _repeat(F.col("_sum"), times).cast("decimal(18,2)").alias("total_spend_30d"), "avg_txn_30d", "last_txn_time",
        F.coalesce("_channels", F.lit(0)).alias("channels_used_30d"),
        F.coalesce("_alerts", F.lit(0)).alias("open_alerts"), "last_alert_time")


def institution_summary(institutions: DataFrame, txns: DataFrame, alerts: DataFrame, as_of: str, days: int = 30,
                        mode: str = "literal", recent: DataFrame | None = None) -> DataFrame:
    """Recent activity per institution; ``literal``, ``corrected`` and ``recent`` as in ``member_activity``."""
    t = recent if recent is not None else txns.where(since("txn_timestamp", as_of, days)).groupBy("institution_id").agg(
        F.count_distinct("member_id").alias("_members"), F.count("txn_id").alias("_n"), total("amount").alias("_sum"),
        mean("risk_score").alias("avg_risk_score"))
    a = alerts.where(since("alert_timestamp", as_of, days)).groupBy("institution_id").agg(
        F.count("alert_id").alias("_alerts"), count_when(F.col("severity") == "CRITICAL").alias("_critical"))
    base = institutions.select("institution_id", "institution_name", "institution_type", "region", "asset_size_tier")
    j = base.join(t, "institution_id", "left").join(a, "institution_id", "left")
    per_alert, per_txn = (F.col("_alerts"), F.col("_n")) if mode == "literal" else (F.lit(1), F.lit(1))
    zero = F.lit(0)
    return j.select(
        *base.columns, F.coalesce("_members", zero).alias("active_members_30d"),
        _repeat(F.coalesce("_n", zero), per_alert).alias("total_txns_30d"),
        _repeat(F.col("_sum"), per_alert).cast("decimal(20,2)").alias("total_volume_30d"), "avg_risk_score",
        F.coalesce("_alerts", zero).alias("alerts_30d"),
        _repeat(F.coalesce("_critical", zero), per_txn).alias("critical_alerts_30d"))
