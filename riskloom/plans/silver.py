"""Silver zone: cleansed, de-duplicated and enriched tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.expressions import digits, required, squash, title
from riskloom.operators.latest import keep_latest
from riskloom.operators.skew import lookup_join

# Second-level order when two versions of a row carry the same load time.
TXN_TIES = ("txn_timestamp", "amount", "txn_type", "status", "risk_score", "_source_file")
EVENT_TIES = ("event_time", "amount", "_offset_token")
MEMBER_TIES = ("member_since", "email")
ALERT_TIES = ("alert_timestamp", "severity", "status")


def _no_risk(c: str, kind: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0)).cast(kind).alias(c)


def cleanse_transactions(raw: DataFrame) -> DataFrame:
    """Normalised transactions, newest version of each ``txn_id``."""
    rows = raw.where(required("txn_id", "member_id", "amount", "txn_timestamp"))
    latest = keep_latest(rows, ["txn_id"], ["_loaded_at"], TXN_TIES)
    return latest.select(
        "txn_id", squash("member_id").alias("member_id"), squash("institution_id").alias("institution_id"),
        "txn_timestamp", "amount",
        *[F.upper(c).alias(c) for c in ("currency_code", "txn_type", "channel")],
        F.trim("merchant_category").alias("merchant_category"), F.trim("merchant_name").alias("merchant_name"),
        F.upper("merchant_country").alias("merchant_country"), F.upper("status").alias("status"),
        "auth_code", "card_last_four", "ip_address", "device_fingerprint",
        _no_risk("risk_score", "decimal(5,2)"), "_loaded_at", "_source_file")


def cleanse_members(raw: DataFrame, normalise_key: bool = False) -> DataFrame:
    """Standardised members, newest version of each ``member_id``."""
    rows = raw.where(required("member_id", "institution_id"))
    if normalise_key:
        rows = rows.withColumn("member_id", squash("member_id"))
    latest = keep_latest(rows, ["member_id"], ["_loaded_at"], MEMBER_TIES)
    return latest.select(
        "member_id", squash("institution_id").alias("institution_id"),
        title("first_name").alias("first_name"), title("last_name").alias("last_name"), "date_of_birth", "ssn_hash",
        F.lower(F.trim("email")).alias("email"), digits("phone").alias("phone_normalized"),
        F.trim("address_line1").alias("address_line1"), F.trim("address_line2").alias("address_line2"),
        title("city").alias("city"), F.upper("state_code").alias("state_code"), F.trim("zip_code").alias("zip_code"),
        F.upper(F.coalesce("country_code", F.lit("US"))).alias("country_code"), "member_since",
        F.upper("status").alias("status"), F.upper("risk_tier").alias("risk_tier"),
        F.coalesce("kyc_verified", F.lit(False)).alias("kyc_verified"), "last_activity_date", "_loaded_at")


def dedup_events(raw: DataFrame) -> DataFrame:
    """Normalised events, last delivered copy of each ``event_id``."""
    rows = raw.where(required("event_id", "member_id"))
    latest = keep_latest(rows, ["event_id"], ["_ingest_time"], [c for c in EVENT_TIES if c in raw.columns])
    return latest.select(
        "event_id", "event_time", F.upper("event_type").alias("event_type"), squash("member_id").alias("member_id"),
        squash("institution_id").alias("institution_id"), "payload", "amount", F.upper("channel").alias("channel"),
        "device_id", "ip_address", "geo_lat", "geo_lon", _no_risk("risk_score", "decimal(5,2)"), "_ingest_time")


def cleanse_alerts(raw: DataFrame, normalise_key: bool = False) -> DataFrame:
    """Alerts before enrichment, newest version of each ``alert_id``."""
    rows = raw.where(required("alert_id"))
    if normalise_key:
        rows = rows.withColumn("member_id", squash("member_id"))
    latest = keep_latest(rows, ["alert_id"], ["_loaded_at"], ALERT_TIES)
    return latest.select(
        "alert_id", "member_id", "institution_id", "alert_timestamp", F.upper("alert_type").alias("alert_type"),
        F.upper("severity").alias("severity"), "alert_source", "description", "related_txn_id", "rule_id",
        _no_risk("confidence_score", "decimal(5,4)"), F.upper("status").alias("status"), "assigned_to",
        "resolution_notes", "resolved_at")


def enrich_alerts(raw: DataFrame, members: DataFrame) -> DataFrame:
    """Alerts with member context. Members are unique, so de-duplicating first gives the same rows over a smaller join."""
    context = members.select("member_id", F.col("risk_tier").alias("member_risk_tier"),
                             F.col("kyc_verified").alias("member_kyc_verified"), "member_since")
    return lookup_join(cleanse_alerts(raw), context, "member_id")


# --- variants without de-duplication ------------------------------------------------------------

def cleanse_transactions_nodedup(raw: DataFrame) -> DataFrame:
    return raw.where(required("txn_id", "member_id", "amount")).select(
        "txn_id", squash("member_id").alias("member_id"), squash("institution_id").alias("institution_id"),
        "txn_timestamp", "amount", F.coalesce("currency_code", F.lit("USD")).alias("currency_code"),
        F.upper("txn_type").alias("txn_type"), F.upper("channel").alias("channel"), "merchant_category",
        "merchant_name", F.upper("status").alias("status"), _no_risk("risk_score", "decimal(5,2)"),
        "_loaded_at", "_source_file")


def cleanse_members_nodedup(raw: DataFrame) -> DataFrame:
    return raw.where(required("member_id", "institution_id")).select(
        "member_id", F.upper("institution_id").alias("institution_id"), F.initcap("first_name").alias("first_name"),
        F.initcap("last_name").alias("last_name"), "date_of_birth", F.lower("email").alias("email"), "phone",
        F.initcap("city").alias("city"), F.upper("state_code").alias("state_code"), "zip_code",
        F.upper(F.coalesce("country_code", F.lit("US"))).alias("country_code"), "member_since",
        F.upper("status").alias("status"), F.upper("risk_tier").alias("risk_tier"),
        F.coalesce("kyc_verified", F.lit(False)).alias("kyc_verified"), "_loaded_at")


def cleanse_events_nodedup(raw: DataFrame) -> DataFrame:
    return raw.where(required("event_id", "member_id")).select(
        "event_id", "event_time", F.upper("event_type").alias("event_type"), F.upper("member_id").alias("member_id"),
        F.upper("institution_id").alias("institution_id"), "payload", "amount", F.upper("channel").alias("channel"),
        "device_id", "ip_address", "geo_lat", "geo_lon", _no_risk("risk_score", "decimal(5,2)"), "_ingest_time")
