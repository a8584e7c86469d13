"""Time the headline queries and print one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and BENCH_QUERIES (comma list or ``all``).
Every query is run to its last row with a sink that keeps nothing, so no column is pruned away. Each one starts from the
given files. ``zones_refresh`` builds all Silver, Gold and feature tables as files once, and the ``served_*`` queries then
read those, as a dashboard does. The JVM is warmed on the smallest tables first.
"""

from __future__ import annotations

import json
import os
import sys
import time
from datetime import date, timedelta

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskloom.catalog import QUERIES  # noqa: E402
from riskloom.plans import bi  # noqa: E402
from riskloom.plans.lake import Lake  # noqa: E402
from riskloom.plans.medallion import ZoneStore, refresh_all  # noqa: E402
from riskloom.plans.nodes import BRONZE_INPUTS, standard_nodes  # noqa: E402
from riskloom.session import build_session, new_path  # noqa: E402

HEADLINE = (
    "silver_transactions", "silver_members", "silver_events", "silver_alerts",
    "gold_daily_member", "gold_fraud_signals", "gold_fraud_signals_union", "gold_member_activity",
    "gold_institution_summary",
    "bi_signals_daily", "bi_top_members", "bi_institution_health", "bi_signal_counts_7d", "bi_high_risk_members",
    "bi_daily_volume", "bi_rolling_avg", "bi_alert_rate", "bi_top_institutions_30d",
    "fs_online", "fs_offline", "fs_drift", "fs_lookback_90d", "fs_pit_latest", "fs_pit_spine", "fs_slo",
    "dq_attached_all", "dq_quarantine", "gov_tagged_mask",
    "sem_signals_by_severity_region", "sem_volume_and_signals_by_tier", "anomaly_flags_by_institution", "text_topk",
    "ingest_delimited", "ingest_json", "st_event_order", "st_feature_upsert", "merge_upsert", "ops_latency_summary",
)


def timed(seconds: dict[str, float], name: str, work) -> None:
    start = time.time()
    work()
    seconds[name] = round(time.time() - start, 3)
    print(name, seconds[name], file=sys.stderr, flush=True)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def served(store: ZoneStore, as_of: str) -> dict:
    month_ago = str(date.fromisoformat(as_of[:10]) - timedelta(days=31))
    signals, activity, daily, inst = (lambda n=n: store.read("GOLD", n, since=month_ago) for n in (
        "FRAUD_SIGNALS", "MEMBER_ACTIVITY", "DAILY_MEMBER_SUMMARY", "INSTITUTION_SUMMARY"))
    return {
        "served_signals_daily": lambda: bi.signals_daily(signals(), as_of),
        "served_top_members": lambda: bi.top_members(activity()),
        "served_institution_health": lambda: bi.institution_health(inst()),
        "served_top_institutions_30d": lambda: bi.top_institutions(inst()),
        "served_signal_counts_7d": lambda: bi.signal_counts(signals(), as_of),
        "served_high_risk_members": lambda: bi.high_risk_members(activity()),
        "served_daily_volume": lambda: bi.daily_volume(daily(), as_of),
        "served_rolling_avg": lambda: bi.rolling_average(daily(), as_of),
        "served_alert_rate": lambda: bi.alert_rate(inst()),
    }


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else [n for n in asked.split(",") if n] or list(HEADLINE)
    spark = build_session("bench", f"local[{cpus}]", int(cpus), {
        "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    smallest = os.path.join(os.path.dirname(sf.rstrip("/")), "sf0.001")
    if os.path.isdir(smallest):
        for name in ("gold_daily_member", "gold_fraud_signals"):
            drain(QUERIES[name](spark, smallest))
    seconds: dict[str, float] = {}
    for name in names:
        timed(seconds, name, lambda: drain(QUERIES[name](spark, sf)))
    if not asked or asked == "all":
        lake = Lake(spark, sf)
        store = ZoneStore(spark, new_path(spark, "bench-zones"))
        inputs = {n: lake.raw(n.lower()) for n in BRONZE_INPUTS}
        timed(seconds, "zones_refresh", lambda: refresh_all(store, inputs, standard_nodes(lake.as_of)))
        for name, build in served(store, lake.as_of).items():
            timed(seconds, name, lambda: drain(build()))
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": sf.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
