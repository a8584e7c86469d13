"""The derived tables of all zones, in dependency order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.plans import anomaly, features, gold, search, silver
from riskloom.plans.medallion import Node, ZoneStore

BRONZE_INPUTS = ("RAW_TRANSACTIONS", "RAW_MEMBERS", "RAW_ALERTS", "RAW_INSTITUTIONS", "STREAMING_EVENTS")


def standard_nodes(as_of: str) -> list[Node]:
    """Silver, Gold, features and analytics tables as of one moment."""
    return [
        Node("CLEANSED_TRANSACTIONS", "SILVER", ("RAW_TRANSACTIONS",), silver.cleanse_transactions, part=("txn_timestamp", "month")),
        Node("ENRICHED_MEMBERS", "SILVER", ("RAW_MEMBERS",), silver.cleanse_members),
        Node("DEDUP_EVENTS", "SILVER", ("STREAMING_EVENTS",), silver.dedup_events, part=("event_time", "month")),
        Node("ENRICHED_ALERTS", "SILVER", ("RAW_ALERTS", "ENRICHED_MEMBERS"), silver.enrich_alerts),
        Node("DAILY_MEMBER_SUMMARY", "GOLD", ("CLEANSED_TRANSACTIONS",), gold.daily_member_summary, part=("txn_date", "month")),
        Node("FRAUD_SIGNALS", "GOLD", ("ENRICHED_ALERTS", "DEDUP_EVENTS"), gold.fraud_signals, part=("signal_time", "month")),
        Node("MEMBER_ACTIVITY", "GOLD", ("ENRICHED_MEMBERS", "CLEANSED_TRANSACTIONS", "ENRICHED_ALERTS"),
             lambda m, t, a: gold.member_activity(m, t, a, as_of)),
        Node("INSTITUTION_SUMMARY", "GOLD", ("RAW_INSTITUTIONS", "CLEANSED_TRANSACTIONS", "ENRICHED_ALERTS"),
             lambda i, t, a: gold.institution_summary(i, t, a, as_of)),
        Node("ONLINE_MEMBER_FEATURES", "FEATURE_STORE", ("DEDUP_EVENTS",), lambda e: features.online_features(e, as_of)),
        Node("OFFLINE_MEMBER_FEATURES", "FEATURE_STORE", ("ENRICHED_MEMBERS", "MEMBER_ACTIVITY"),
             lambda m, a: features.offline_features(m, a, as_of)),
        Node("AD_TRAINING_DATA", "ANALYTICS", ("DAILY_MEMBER_SUMMARY",), lambda d: anomaly.split_series(d, as_of)[0], view=True),
        Node("AD_DETECT_DATA", "ANALYTICS", ("DAILY_MEMBER_SUMMARY",), lambda d: anomaly.split_series(d, as_of)[1], view=True),
        Node("SPENDING_ANOMALIES", "GOLD", ("DAILY_MEMBER_SUMMARY",), lambda d: anomaly.detect(d, as_of)),
        Node("ALERTS_FOR_SEARCH", "ANALYTICS", ("ENRICHED_ALERTS",), search.alerts_for_search),
    ]


def lineage(nodes: list[Node], store: ZoneStore) -> DataFrame:
    """Edges between the nodes and what they read."""
    zone = {n.name: n.zone for n in nodes}
    rows = [(f"{zone.get(i, 'BRONZE')}.{i}", f"{n.zone}.{n.name}") for n in nodes for i in n.inputs]
    return store.spark.createDataFrame(rows, "upstream string, downstream string").orderBy(F.col("upstream"), F.col("downstream"))
