"""Streams fed with duplicates, late events and a burst."""

import json
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from riskloom.plans import silver
from riskloom.sources.files import hour_path
from riskloom.sources.tables import append
from riskloom.streaming import bronze, checks, features, keyed
from tests.conftest import AS_OF, rows

NOW = datetime(2024, 1, 31)


def _event(i, when, **over):
    e = {"event_id": i, "event_time": when.isoformat(), "event_type": "TXN", "member_id": "MBR1", "institution_id": "FI1",
         "amount": 10.0, "channel": "POS", "risk_score": 0.1}
    e.update(over)
    return e


DUPLICATES = [_event(f"DUP-{i}", NOW - timedelta(minutes=i), member_id=f"MBR{i}") for i in range(10)] * 3
LATE = [_event(f"LATE-{h}", NOW - timedelta(hours=h), event_type="ALERT", risk_score=0.85) for h in (1, 6, 12, 24, 48, 72)]
BURST = [_event(f"BURST-{i}", NOW - timedelta(seconds=i % 60), member_id=f"MBR{300 + i % 50}", amount=5.0 + i % 100) for i in range(1000)]


def _write(folder, name, events, extra=""):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(e) + "\n" for e in events) + extra)


def _run(spark, src, base):
    q = bronze.bronze_stream(spark, str(src), f"{base}/bronze", f"{base}/errors", f"{base}/ck", ingest_time=AS_OF)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/bronze")


def test_bronze_takes_each_file_once_and_keeps_late_rows(spark, tmp_path):
    src, base = tmp_path / "in", tmp_path / "out"
    hour = Path(hour_path(str(src), NOW))
    assert hour == src / "year=2024" / "month=01" / "day=31" / "hour=00"
    no_id, bad_amount = _event("X", NOW), _event("Y", NOW, amount="abc")
    del no_id["event_id"]
    _write(hour, "a.json", [*DUPLICATES, no_id, bad_amount], "{broken\n")
    assert _run(spark, src, base).count() == 30
    assert _run(spark, src, base).count() == 30
    _write(hour, "b.json", LATE + BURST)
    df = _run(spark, src, base)
    assert df.count() == 1036
    errors = spark.read.parquet(f"{base}/errors").collect()
    assert sorted(r["error_column_name"] for r in errors) == ["amount", "event_id", "payload"]
    dup = checks.dup_report(df.where("event_id LIKE 'DUP-%'")).head()
    assert (dup["total_rows"], dup["unique_events"], dup["duplicate_rows"]) == (30, 10, 20)
    late = {r["event_id"]: r["hours_late"] for r in checks.late_report(df.where("event_id LIKE 'LATE-%'")).collect()}
    assert late == {f"LATE-{h}": h for h in (1, 6, 12, 24, 48, 72)}
    assert checks.burst_report(df.where("event_id LIKE 'BURST-%'"), 1000).head()["result"].startswith("PASS")
    order = checks.order_report(df.where("event_id LIKE 'LATE-%'"))
    assert sorted(r["order_check"] for r in order.collect()) == ["FIRST"] + ["ORDERED"] * 5
    clean = silver.dedup_events(df)
    assert clean.count() == 1016 and checks.dedup_report(clean).head()["result"].startswith("PASS")


def _table(spark, events):
    df = spark.createDataFrame([(e["event_id"], datetime.fromisoformat(e["event_time"]), e["member_id"], e["amount"], e["channel"],
                                 e["risk_score"], n) for n, e in enumerate(events)],
                               "event_id string, event_time timestamp_ntz, member_id string, amount double, channel string, risk double, n int")
    null = F.lit(None).cast("string")
    return df.select("event_id", "event_time", F.lit("TXN").alias("event_type"), "member_id", F.lit("FI1").alias("institution_id"),
                     null.alias("payload"), F.col("amount").cast("decimal(15,2)").alias("amount"), "channel", null.alias("device_id"),
                     null.alias("ip_address"), F.lit(None).cast("decimal(10,7)").alias("geo_lat"),
                     F.lit(None).cast("decimal(10,7)").alias("geo_lon"), F.col("risk").cast("decimal(5,2)").alias("risk_score"),
                     (F.col("event_time") + F.expr("make_dt_interval(0, 0, 0, n)")).alias("_ingest_time"),
                     F.concat(F.lit("t"), F.col("n")).alias("_offset_token"))


def test_features_follow_restarts_and_the_rebuild_corrects_them(spark, tmp_path):
    src, kept = str(tmp_path / "bronze"), str(tmp_path / "kept")
    day = DUPLICATES + LATE[:3] + BURST
    history = _table(spark, day)
    for part in (_table(spark, day[:500]), _table(spark, day[500:])):  # each run starts again from the checkpoint
        append(part, src)
        features.keep_features(bronze.stream_table(spark, src, part.schema), kept, str(tmp_path / "ck"), computed_at=AS_OF).awaitTermination()
    live = features.current_features(spark, kept)
    assert live.agg(F.sum("event_count_24h")).head()[0] == len(day)
    # Copies were counted three times, which the rebuild from de-duplicated history shows.
    wrong = features.reconcile(live, silver.dedup_events(history), AS_OF)
    assert {r["member_id"] for r in wrong.collect()} == {f"MBR{i}" for i in range(10)}
    # Fed with Silver events, which have each event once, the two paths agree.
    clean, kept2 = silver.dedup_events(history), str(tmp_path / "kept2")
    append(clean, str(tmp_path / "silver"))
    features.keep_features(bronze.stream_table(spark, str(tmp_path / "silver")), kept2, str(tmp_path / "ck2"), computed_at=AS_OF).awaitTermination()
    assert features.reconcile(features.current_features(spark, kept2), clean, AS_OF).count() == 0
    # A defect in the live table disappears with the rebuild.
    broken = live.withColumn("total_spend_24h", F.lit(0).cast("decimal(18,2)"))
    rebuilt = features.rematerialize(silver.dedup_events(history), AS_OF)
    assert features.reconcile(broken, silver.dedup_events(history), AS_OF).count() > 0
    assert features.reconcile(rebuilt, silver.dedup_events(history), AS_OF).count() == 0


def test_the_widest_batch_counts_for_channels(spark, tmp_path):
    src, kept = str(tmp_path / "b"), str(tmp_path / "k")
    for channels in ("ABC", "AD", ""):
        events = [_event(f"{channels}{c}", NOW, channel=c) for c in channels] or [_event("last", NOW, member_id="other")]
        append(_table(spark, events), src)
        features.keep_features(bronze.stream_table(spark, src, _table(spark, events).schema), kept, str(tmp_path / "c"), AS_OF).awaitTermination()
    got = {r["member_id"]: (r["event_count_24h"], r["unique_channels_24h"]) for r in features.current_features(spark, kept).collect()}
    assert got == {"MBR1": (5, 3), "other": (1, 1)}


def test_a_batch_that_is_written_twice_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1, 1), ("b", 2, 1), ("c", 3, 2), (None, 4, 2)], "k string, v int, part int")
    second = spark.createDataFrame([("a", 5, 1), (None, 6, 2), ("d", 7, 3)], "k string, v int, part int")
    for rows_ in (first, second, second):
        keyed.upsert(rows_, path, "part", ["k"])
    got = {(r["k"], r["v"], r["part"]) for r in spark.read.parquet(path).collect()}
    assert got == {("a", 5, 1), ("b", 2, 1), ("c", 3, 2), (None, 6, 2), ("d", 7, 3)}
    keyed.upsert(second.limit(0), path, "part", ["k"])
    assert spark.read.parquet(path).count() == 5


def test_latest_copy_wins_however_late(spark, tmp_path):
    """Older copies that come in a later batch do not win; a newer one that comes a year late does, as do copies of other
    days and events behind the watermark."""
    history = _table(spark, DUPLICATES + LATE)
    late = history.limit(1).withColumns({"_ingest_time": F.col("_ingest_time") + F.expr("INTERVAL 365 DAYS"), "channel": F.lit("WEB")})
    moved = late.withColumns({"event_time": F.col("event_time") - F.expr("INTERVAL 40 DAYS"), "event_id": F.lit("DUP-5")})
    untimed = late.withColumns({"event_time": F.lit(None).cast("timestamp_ntz"), "event_id": F.lit("NO-TIME")})
    old = late.withColumns({"event_time": F.lit(datetime(2020, 1, 1)).cast("timestamp_ntz"), "event_id": F.lit("OLD")})
    src, kept = str(tmp_path / "b"), str(tmp_path / "kept")
    parts = (history.where("_offset_token > 't2'"), history.where("_offset_token <= 't2'"), late, moved.unionByName(untimed).unionByName(old))
    for part in parts:
        append(part, src)
        bronze.latest_events(bronze.stream_table(spark, src, history.schema), kept, str(tmp_path / "c"), "1 day").awaitTermination()
    whole = history.unionByName(late).unionByName(parts[3])
    assert rows(bronze.current_events(spark, kept)) == rows(silver.dedup_events(whole))
    aside = {r["event_id"] for r in keyed.late_rows(spark, kept).collect()}
    assert {"OLD", "NO-TIME", "DUP-5"} <= aside


def test_late_events_change_their_windows(spark, tmp_path):
    history = _table(spark, BURST[:50] + LATE)
    src, kept = str(tmp_path / "b"), str(tmp_path / "kept")
    for part in (history.where("event_id LIKE 'BURST%'"), history.where("event_id LIKE 'LATE%'")):
        append(part, src)
        features.keep_panes(bronze.stream_table(spark, src, history.schema), kept, str(tmp_path / "c"), "3 hours").awaitTermination()
    aside = {r["event_id"] for r in keyed.late_rows(spark, kept).collect()}
    assert "LATE-72" in aside and "LATE-1" not in aside
    before = features.sliding_windows(keyed.kept_states(spark, kept)).agg(F.sum("event_count")).head()[0]
    assert before == 24 * (history.count() - len(aside))
    for _ in range(2):
        features.fold_late(spark, kept, spark.read.parquet(src))
        got = features.sliding_windows(keyed.kept_states(spark, kept))
        assert got.agg(F.sum("event_count")).head()[0] == 24 * history.count()
    assert got.where("window_end > TIMESTAMP_NTZ '2024-01-31 00:00:00'").count() > 0


def test_latency_report(spark):
    r = checks.e2e_latency(_table(spark, BURST[:100])).head()
    assert r["sample_size"] == 100 and r["assessment"].startswith("GOOD")


def test_windows_are_not_shuffled(spark):
    panes = spark.createDataFrame([("m", NOW, 1, 5), ("m", NOW + timedelta(hours=1), 2, 7)], "member_id string, pane timestamp_ntz, event_count bigint, v int")
    panes = panes.withColumns({"total_spend": F.lit(1).cast("decimal(18,2)"), "max_risk_score": F.lit(0).cast("decimal(5,2)"), "last_activity_time": F.col("pane")})
    got = features.sliding_windows(panes)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hash") == 1 and "Exchange hashpartitioning(member_id" in plan
    assert got.count() == 25 and got.agg(F.sum("event_count")).head()[0] == 72
