"""Zone tables, refresh, snapshots, governance, metric model."""

import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskloom.functions import masking
from riskloom.functions.expressions import percent_text, risk_band
from riskloom.plans import contributions, features, gold, medallion, quality, silver
from riskloom.plans.nodes import BRONZE_INPUTS, lineage, standard_nodes
from riskloom.plans.semantic import FRAUD_MODEL
from riskloom.session import RELEASE, held, stored
from riskloom.sources import tables
from tests.conftest import AS_OF, rows
from tests.disk import scratch_folders, shuffle_ids, soon


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "t")
    for day, v in (("2024-01-01", 1), ("2024-01-08", 2)):
        tables.snapshot(spark.createDataFrame([(v,)], "v int"), path, f"{day} 00:00:00")
    tables.snapshot(spark.createDataFrame([(3,)], "v int"), path, "2024-01-08 00:00:00")
    assert tables.read_as_of(spark, path, "2024-01-07 23:59:59").head()[0] == 1
    assert [r[0] for r in tables.read_as_of(spark, path, "2024-03-01 00:00:00").collect()] == [3]
    with pytest.raises(ValueError):
        tables.read_as_of(spark, path, "2023-01-01 00:00:00")
    # a date is its midnight, fractions of a second count, and a moment may be a value instead of text
    assert tables.read_as_of(spark, path, "2024-01-08").head()[0] == 3
    tables.snapshot(spark.createDataFrame([(4,)], "v int"), path, "2024-01-08 00:00:00.5")
    assert tables.read_as_of(spark, path, datetime(2024, 1, 8, 0, 0, 0, 499_999)).head()[0] == 3
    assert tables.read_as_of(spark, path, "2024-01-08T00:00:00.500000").head()[0] == 4
    several = spark.createDataFrame([("2024-02-01 00:00:00.25", 5), ("2024-02-01 00:00:00", 6)], "t string, v int")
    tables.snapshot_each(several.withColumn("t", F.col("t").cast("timestamp_ntz")), path, "t")
    assert tables.read_as_of(spark, path, "2024-02-01 00:00:00.2").head()["v"] == 6


def test_pointer_text_is_replaced_in_place(spark, tmp_path):
    for text in ("one", "two"):
        tables.write_text(spark, str(tmp_path / "p"), text)
        assert (tmp_path / "p").read_text() == text
    assert [f.name for f in tmp_path.iterdir() if not f.name.startswith(".")] == ["p"]


def test_export_product(lake, tmp_path):
    inst = lake.institutions()
    tables.export_product({"institution_summary": inst}, str(tmp_path / "p"), AS_OF, {"slo_minutes": 30})
    m = json.loads(Path(tmp_path / "p" / "manifest.json").read_text())
    assert m["tables"]["institution_summary"]["rows"] == 25 and m["contract"]["slo_minutes"] == 30


def test_full_refresh_of_all_zones(spark, lake, tmp_path):
    bronze = {n: lake.raw(n.lower()) for n in BRONZE_INPUTS}
    store = medallion.ZoneStore(spark, str(tmp_path / "lake"))
    nodes = standard_nodes(AS_OF)
    medallion.refresh_all(store, bronze, nodes)
    medallion.refresh_all(store, bronze, nodes)
    assert rows(store.read("GOLD", "DAILY_MEMBER_SUMMARY")) == rows(lake.daily)
    assert rows(store.read("GOLD", "MEMBER_ACTIVITY")) == rows(lake.activity())
    log = spark.read.parquet(str(tmp_path / "lake/governance/refresh_log"))
    assert log.where("state = 'SUCCEEDED'").count() == 24
    assert spark.table("ad_detect_data").count() > 0
    assert rows(store.read("GOLD", "FRAUD_SIGNALS")) == rows(lake.signals)
    assert rows(store.read("FEATURE_STORE", "OFFLINE_MEMBER_FEATURES")) == rows(lake.offline)
    assert lineage(nodes, store).count() == sum(len(n.inputs) for n in nodes)


def test_failed_refresh_keeps_the_old_table(spark, lake, tmp_path):
    store = medallion.ZoneStore(spark, str(tmp_path / "lake"))
    ok = medallion.Node("T", "GOLD", ("X",), lambda x: x)
    bad = medallion.Node("T", "GOLD", ("X",), lambda x: x.select(F.raise_error(F.lit("boom")).cast("int").alias("a")))
    x = spark.createDataFrame([(1,)], "a int")
    medallion.refresh_all(store, {"X": x}, [ok])
    with pytest.raises(Exception):
        medallion.refresh_all(store, {"X": x}, [bad])
    assert store.read("GOLD", "T").count() == 1
    log = spark.read.parquet(str(tmp_path / "lake/governance/refresh_log"))
    assert log.where("state = 'FAILED'").count() == 1


def test_incremental_refresh_moves_a_row_to_another_day(spark, tmp_path):
    cols = ("txn_id string, member_id string, institution_id string, txn_timestamp timestamp_ntz, amount decimal(15,2), "
            "currency_code string, txn_type string, channel string, merchant_category string, merchant_name string, "
            "merchant_country string, status string, auth_code string, card_last_four string, ip_address string, "
            "device_fingerprint string, risk_score decimal(5,2), _loaded_at timestamp_ntz, _source_file string")
    from datetime import datetime as d
    from decimal import Decimal as D
    def row(i, day, load, amount="1.00"):
        return (i, "m", "f", d(2024, 1, day), D(amount), "usd", "debit", "pos", "c", "n", "us", "s", None, None, None, None, None,
                d(2024, 2, load), "f")
    old = spark.createDataFrame([row("a", 1, 1), row("b", 2, 1), row("c", 3, 1)], cols)
    new = spark.createDataFrame([row("a", 5, 2, "7.00"), row("d", 3, 2)], cols)
    s, g = str(tmp_path / "s"), str(tmp_path / "g")
    medallion.write_parts(silver.cleanse_transactions(old), s, "txn_timestamp")
    medallion.write_parts(gold.daily_member_summary(spark.read.parquet(s)), g, "txn_date")
    kept = [p.name for p in Path(g, "part_date=2024-01-02").glob("*.parquet")]
    days = medallion.refresh_daily(spark, s, g, new)
    assert {str(r[0]) for r in days.collect()} == {"2024-01-01", "2024-01-03", "2024-01-05"}
    full = gold.daily_member_summary(silver.cleanse_transactions(old.union(new)))
    assert rows(spark.read.parquet(g).select(*full.columns)) == rows(full)
    assert not Path(g, "part_date=2024-01-01").exists()
    assert [p.name for p in Path(g, "part_date=2024-01-02").glob("*.parquet")] == kept


def test_daily_refresh_keeps_no_copy_of_the_affected_rows(spark, tmp_path, monkeypatch):
    """Only the list of partitions is kept as it is in memory; a partition whose rows all moved is dropped."""
    from datetime import datetime as d
    raw = spark.createDataFrame([("a", 1, d(2024, 1, 1), d(2024, 2, 1)), ("b", 2, d(2024, 1, 2), d(2024, 2, 1)), ("a", 3, d(2024, 1, 2), d(2024, 2, 2))],
                                "txn_id string, n int, txn_timestamp timestamp_ntz, _loaded_at timestamp_ntz")
    null = {c: F.lit(None).cast("string") for c in ("currency_code txn_type channel merchant_category merchant_name merchant_country status auth_code "
                                                   "card_last_four ip_address device_fingerprint _source_file institution_id").split()}
    raw = raw.withColumns({**null, "member_id": F.lit("m"), "amount": F.lit(1).cast("decimal(15,2)"), "risk_score": F.lit(0).cast("decimal(5,2)")})
    s, g, kept = str(tmp_path / "s"), str(tmp_path / "g"), []
    medallion.write_parts(silver.cleanse_transactions(raw.where("n < 3")), s, "txn_timestamp")
    medallion.write_parts(gold.daily_member_summary(spark.read.parquet(s)), g, "txn_date")
    cut = medallion.cut
    monkeypatch.setattr(medallion, "cut", lambda df: kept.append(df.columns) or cut(df))
    medallion.refresh_daily(spark, s, g, raw.where("n = 3"))
    assert kept == [[medallion.PART]]
    assert [p.name for p in Path(s).glob("part_date=*")] == [p.name for p in Path(g).glob("part_date=*")] == ["part_date=2024-01-02"]
    full = gold.daily_member_summary(silver.cleanse_transactions(raw))
    assert rows(spark.read.parquet(g).select(*full.columns)) == rows(full)


def test_daily_refresh_leaves_neither_shuffles_nor_its_delta(spark, tmp_path):
    from datetime import datetime as d
    raw = spark.createDataFrame([("a", d(2024, 1, 1), d(2024, 2, 1)), ("b", d(2024, 1, 2), d(2024, 2, 1)), ("a", d(2024, 1, 2), d(2024, 2, 2))],
                                "txn_id string, txn_timestamp timestamp_ntz, _loaded_at timestamp_ntz")
    null = {c: F.lit(None).cast("string") for c in ("currency_code txn_type channel merchant_category merchant_name merchant_country status auth_code "
                                                   "card_last_four ip_address device_fingerprint _source_file institution_id").split()}
    raw = raw.withColumns({**null, "member_id": F.lit("m"), "amount": F.lit(1).cast("decimal(15,2)"), "risk_score": F.lit(0).cast("decimal(5,2)")})
    s, g, late = str(tmp_path / "s"), str(tmp_path / "g"), F.col("_loaded_at") >= "2024-02-02"
    shuffles, kept = shuffle_ids(spark), scratch_folders(spark)
    medallion.write_parts(silver.cleanse_transactions(raw.where(~late)), s, "txn_timestamp")
    medallion.write_parts(gold.daily_member_summary(spark.read.parquet(s)), g, "txn_date")
    medallion.refresh_daily(spark, s, g, raw.where(late))
    assert scratch_folders(spark) == kept
    assert soon(lambda: not shuffle_ids(spark) - shuffles)
    full = gold.daily_member_summary(silver.cleanse_transactions(raw))
    assert rows(spark.read.parquet(g).select(*full.columns)) == rows(full)


def test_refreshed_rows_are_sent_once(spark):
    """Ids that the delta does not bring stay as they are, whatever they look like; the newest version of the others wins."""
    ties = "txn_timestamp timestamp_ntz, amount int, txn_type string, status string, risk_score int, _source_file string"
    def table(*found):
        return spark.createDataFrame([(i, n, datetime(2024, 1, load), None, n, None, None, None, None) for i, n, load in found],
                                     f"txn_id string, n int, _loaded_at timestamp_ntz, {ties}")
    old = table(("kept", 1, 1), ("twice", 2, 1), ("twice", 3, 2), (None, 4, 1), (None, 5, 1), ("older", 6, 1), ("newer", 7, 9), ("same", 8, 3))
    merged = medallion._merged(old, table(("older", 16, 2), ("newer", 17, 2), ("same", 9, 3), ("added", 18, 2)))
    assert merged.columns == old.columns
    assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    found = [r["n"] for r in merged.collect()]
    # of two versions that are alike in all that is compared, one stays
    assert len(found) == 9 and {n for n in found if n != 8} | {9} == {1, 2, 3, 4, 5, 16, 7, 9, 18}


def test_written_rows_leave_no_shuffle(spark, tmp_path):
    shuffles, setting = shuffle_ids(spark), spark.conf.get(RELEASE)
    df = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    tables.replace(df, str(tmp_path / "a"))
    tables.replace_partitions(df, str(tmp_path / "b"), ("k",), spread=True)
    kept = stored(df)
    with held(df) as some:
        assert rows(some) == rows(kept) == rows(spark.read.parquet(str(tmp_path / "a")))
        path = Path(some.inputFiles()[0].removeprefix("file://")).parent
        assert path.exists()
    assert not path.exists() and spark.conf.get(RELEASE) == setting
    assert soon(lambda: not shuffle_ids(spark) - shuffles)
    with pytest.raises(Exception):
        tables.replace(df.select(F.raise_error(F.lit("boom"))), str(tmp_path / "d"))
    assert spark.conf.get(RELEASE) == setting


def test_daily_summary_sends_each_row_once(spark):
    df = spark.createDataFrame([("m", "f", None, "c1"), ("m", "f", "pos", "c2"), ("m", "f", "pos", "c1"), ("m", None, None, None)],
                               "member_id string, institution_id string, channel string, merchant_category string")
    df = df.withColumns({"txn_timestamp": F.lit("2024-01-01").cast("timestamp_ntz"), "txn_type": F.lit("DEBIT"),
                         "amount": F.lit(1).cast("decimal(15,2)"), "risk_score": F.lit(0).cast("decimal(5,2)")})
    daily = gold.daily_member_summary(df)
    got = {(r["institution_id"], r["unique_channels"], r["unique_merchant_categories"]) for r in daily.collect()}
    assert got == {("f", 1, 2), (None, 0, 0)}
    assert "Expand" not in daily._jdf.queryExecution().optimizedPlan().toString()


def test_daily_summary_keeps_no_table_of_sets(spark):
    """Rows are folded group by group: a table of sets falls back to a sort of wide partial results beyond 128 groups."""
    df = spark.range(400).selectExpr(
        "CASE WHEN id % 7 > 0 THEN concat('m', id % 5) END AS member_id", "CASE WHEN id % 3 > 0 THEN 'f' END AS institution_id",
        "CASE WHEN id % 11 > 0 THEN TIMESTAMP_NTZ '2024-01-01 05:00:00' + make_interval(0, 0, 0, CAST(id % 3 AS INT)) END AS txn_timestamp",
        "CAST(CASE WHEN id % 4 > 0 THEN id - 150 END AS DECIMAL(15,2)) AS amount", "CASE id % 3 WHEN 0 THEN 'DEBIT' WHEN 1 THEN 'CREDIT' END AS txn_type",
        "CASE WHEN id % 6 > 0 THEN concat('c', id % 6) END AS channel", "concat('k', id % 9) AS merchant_category",
        "CAST(CASE WHEN id % 5 > 0 THEN id % 100 / 100 END AS DECIMAL(5,2)) AS risk_score")
    df.createOrReplaceTempView("days_of_rows")
    plain = spark.sql("""SELECT member_id, institution_id, to_date(txn_timestamp) AS txn_date, count(*) AS txn_count, count_if(txn_type = 'DEBIT') AS debit_count,
        count_if(txn_type = 'CREDIT') AS credit_count, CAST(sum(amount) AS DECIMAL(18,2)) AS total_amount,
        CAST(sum(CASE WHEN amount > 0 THEN amount ELSE 0 END) AS DECIMAL(18,2)) AS total_credits,
        CAST(sum(CASE WHEN amount < 0 THEN -amount ELSE 0 END) AS DECIMAL(18,2)) AS total_debits, min(amount) AS min_amount,
        count(DISTINCT merchant_category) AS unique_merchant_categories, CAST(sum(amount) AS DOUBLE) / nullif(count(amount), 0) AS avg_amount,
        max(amount) AS max_amount, count(DISTINCT channel) AS unique_channels, max(risk_score) AS max_risk_score,
        CAST(sum(risk_score) AS DOUBLE) / nullif(count(risk_score), 0) AS avg_risk_score FROM days_of_rows GROUP BY 1, 2, 3""")
    daily = gold.daily_member_summary(df)
    assert daily.dtypes == plain.dtypes and rows(daily) == rows(plain)
    slim = gold.daily_member_summary(df, slim=True)
    assert rows(slim) == rows(plain.select(*slim.columns))
    assert "ObjectHashAggregate" not in daily._jdf.queryExecution().executedPlan().toString()


def test_a_whole_table_is_not_sent_again_to_be_written(spark, tmp_path, monkeypatch):
    from riskloom.sources import tables
    spread = []
    monkeypatch.setattr(tables, "_spread", lambda df, by: spread.append(by) or df)
    df = spark.range(90).selectExpr("id", "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id AS INT)) AS t")
    medallion.write_parts(df, str(tmp_path / "t"), "t", "month")
    assert spread == []
    assert {p.name for p in Path(tmp_path / "t").glob("part_date=*")} == {f"part_date=2024-0{m}-01" for m in (1, 2, 3)}
    assert rows(spark.read.parquet(str(tmp_path / "t")).drop("part_date")) == rows(df)


def test_policies(spark):
    df = spark.createDataFrame([("a@x.com", "EAST"), ("bob@y.org", "WEST")], "email string, region string")
    analyst, admin = masking.Access("ANALYST", "EAST"), masking.Access("ADMIN")
    assert {r[0] for r in df.select(masking.mask_email("email", analyst)).collect()} == {"a***@x.com", "b***@y.org"}
    assert df.select(masking.mask_pii("email", admin)).collect()[1][0] == "bob@y.org"
    assert masking.row_policy(df, "region", analyst).count() == 1
    assert masking.row_policy(df, "region", admin).count() == 2
    unset = masking.Access("ANALYST")
    assert masking.row_policy(df, "region", unset).count() == 2
    assert masking.row_policy(df, "region", unset, default_regions=None).count() == 0
    tagged = masking.tag_columns(df, {"email": {"sensitivity": "PII"}})
    assert masking.tagged(tagged, "sensitivity", "PII") == ["email"]
    assert {r[0] for r in masking.apply_masks(tagged, analyst).select("email").collect()} == {masking.MASK_TEXT}
    with pytest.raises(ValueError):
        masking.tag_columns(df, {"email": {"sensitivity": "TOP"}})


def test_metrics_on_an_empty_table(spark):
    empty = {"RAW_ALERTS": spark.createDataFrame([], "alert_id string, alert_timestamp timestamp_ntz")}
    checks = [a for a in quality.BRONZE_CHECKS if a.table == "RAW_ALERTS"]
    got = {r["metric"]: r["value"] for r in quality.run_metrics(empty, checks, AS_OF).collect()}
    assert got == {"NULL_RATE": 0.0, "FRESHNESS_HOURS": -1.0}


def test_metrics_observed_during_a_write(spark, tmp_path):
    from pyspark.sql import Observation
    df = spark.createDataFrame([("a", "m"), (None, "m")], "txn_id string, member_id string")
    checks = [a for a in quality.BRONZE_CHECKS if a.table == "RAW_TRANSACTIONS" and a.column != "txn_timestamp"]
    seen = Observation("load")
    quality.observe_metrics(df, seen, checks, AS_OF).write.parquet(str(tmp_path / "o"))
    assert {k: float(v) for k, v in seen.get.items()} == {"txn_id:NULL_RATE": 0.5, "member_id:NULL_RATE": 0.0}


def test_gate_and_quarantine(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "v int")
    good, held = quality.quarantine(df, {"positive": F.col("v") >= 0})
    assert good.count() == 1 and held.count() == 2
    res = spark.createDataFrame([("T", "c", "NULL_RATE", 0.2)], "table_name string, column_name string, metric string, value double")
    assert not quality.may_promote(quality.gate(res, {("T", "NULL_RATE"): (None, 0.1)}))
    assert quality.may_promote(quality.gate(res, {("T", "NULL_RATE"): (None, 0.3)}))


def test_model_catalogue_and_errors(spark, lake):
    cat = FRAUD_MODEL.catalog(spark)
    assert cat.where("kind = 'METRIC'").count() == 6 and cat.where("kind = 'DIMENSION'").count() == 7
    with pytest.raises(ValueError):
        FRAUD_MODEL.over({"members": lake.activity()}).query(["total_members"], ["severity"])


def test_small_helpers(spark):
    df = spark.createDataFrame([(0.2,), (0.6,), (0.8,), (0.95,), (None,)], "x double")
    assert [r[0] for r in df.select(risk_band("x")).collect()] == ["LOW", "MEDIUM", "HIGH", "CRITICAL", None]
    assert spark.range(1).select(percent_text(F.lit(41.6))).head()[0] == "42%"


def test_past_states_do_not_look_ahead(spark, lake):
    """A later load changes no earlier state; it changes the states after it."""
    moments = ("2024-01-01 00:00:00", "2024-01-24 00:00:00", "2024-01-31 00:00:00")
    members, txns, alerts = (lake.raw(n) for n in ("raw_members", "raw_transactions", "raw_alerts"))
    before = features.backfill_features(members, txns, alerts, moments)
    late = lambda df, **new: df.limit(20).withColumns(
        {"_loaded_at": F.lit("2024-01-28 00:00:00").cast("timestamp_ntz")} | {c: F.lit(v).cast(df.schema[c].dataType) for c, v in new.items()})
    recent = txns.where("txn_timestamp >= '2024-01-10' AND _loaded_at < '2024-01-27'").orderBy("txn_id")
    after = features.backfill_features(
        members.unionByName(late(members.orderBy("member_id"), risk_tier="extreme")), txns.unionByName(late(recent, amount=99999)),
        alerts.unionByName(late(alerts.orderBy("alert_id"), status="open", resolved_at=None)), moments)
    old = "system_time < '2024-01-28'"
    assert rows(before.where(old)) == rows(after.where(old))
    changed = after.where("NOT " + old).exceptAll(before.where("NOT " + old))
    assert changed.where("risk_tier = 'EXTREME'").count() >= 15 and changed.where("total_spend_30d > 90000").count() > 0


def test_an_alert_is_open_until_it_was_resolved(spark, lake):
    members = lake.raw("raw_members").limit(1)
    txns = lake.raw("raw_transactions").limit(0)
    who = members.head()["member_id"]
    alert = lake.raw("raw_alerts").limit(1).withColumns({
        "member_id": F.lit(who), "status": F.lit("resolved"), "alert_timestamp": F.expr("TIMESTAMP_NTZ '2024-01-10 00:00:00'"),
        "resolved_at": F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'"), "_loaded_at": F.expr("TIMESTAMP_NTZ '2024-01-10 00:00:00'")})
    got = features.backfill_features(members, txns, alert, ("2024-01-05 00:00:00", "2024-01-12 00:00:00", "2024-01-16 00:00:00"))
    assert {str(r["system_time"]): r["open_alerts"] for r in got.collect()}.get("2024-01-12 00:00:00") == 1
    assert got.agg(F.sum("open_alerts")).head()[0] == 1


def test_ninety_states_equal_ninety_single_ones(spark, lake):
    """Differences give the same states as one pass for each moment, and at most two rows a version."""
    from datetime import date, timedelta
    moments = [f"{date(2024, 1, 31) - timedelta(days=n)} 00:00:00" for n in range(90)]
    raw = [lake.raw(n) for n in ("raw_members", "raw_transactions", "raw_alerts")]
    together = features.backfill_features(*raw, moments).persist()
    for m in moments[0:30:14]:  # members are there from January on
        here = together.where(F.col("system_time") == F.lit(m).cast("timestamp_ntz"))
        assert rows(here) == rows(features.backfill_features(*raw, [m])) != []
    versions = features.known_by(moments[0], raw[1], "txn_id", silver.TXN_TIES)
    steps = features.steps(versions, features.in_order(moments), F.col("_loaded_at"), F.col("_until"))
    assert 0 < steps.count() <= 2 * raw[1].count()
    totals = features.past_totals(raw[1], moments)
    for m in moments[::40]:
        known = silver.cleanse_transactions(raw[1].where(F.col("_loaded_at") <= F.lit(m).cast("timestamp_ntz")))
        want = known.groupBy("member_id").agg(F.count("*").alias("txn_count"), F.sum("amount").cast("decimal(20,2)").alias("total_amount"),
                                              F.count_distinct(F.to_date("txn_timestamp")).alias("active_days"))
        assert rows(features.totals_at(totals, m)) == rows(want) != []


def test_a_moment_is_found_by_comparisons(spark):
    moments = [f"2024-01-0{n} 00:00:00" for n in (1, 3, 5, 6, 9)]
    df = spark.createDataFrame([(None, 5)] + [(f"2024-01-{d:02d} {h}", n) for d, h, n in (
        (1, "00:00:00", 0), (1, "00:00:01", 1), (3, "00:00:00", 1), (5, "12:00:00", 3), (9, "00:00:00", 4), (9, "01:00:00", 5))], "t string, n int")
    got = df.withColumn("t", F.col("t").cast("timestamp_ntz")).withColumn("i", features.place("t", moments))
    assert all(r["i"] == r["n"] for r in got.collect())


def test_refresh_after_a_failure_between_its_two_writes(spark, lake, tmp_path, monkeypatch):
    """A row moves to another month, Silver is written, Gold is not. The next run mends both months."""
    raw = lake.raw("raw_transactions").where("txn_timestamp >= '2023-10-01'")
    s, g = str(tmp_path / "silver"), str(tmp_path / "gold")
    first = raw.where("_loaded_at < '2024-01-05'")
    moved = (first.where("txn_timestamp < '2023-12-01'").orderBy("txn_id").limit(3).withColumns(
        {"txn_timestamp": F.expr("TIMESTAMP_NTZ '2024-01-20 00:00:00'"), "_loaded_at": F.expr("TIMESTAMP_NTZ '2024-01-21 00:00:00'")}))
    delta = raw.where("_loaded_at >= '2024-01-05'").unionByName(moved)
    medallion.write_parts(silver.cleanse_transactions(first), s, "txn_timestamp", "month")
    medallion.write_parts(gold.daily_member_summary(spark.read.parquet(s)), g, "txn_date", "month")
    real, calls = medallion.replace_partitions, []

    def fails_on_gold(df, path, by):
        calls.append(path)
        if path == g:
            raise OSError("executor lost")
        real(df, path, by)

    monkeypatch.setattr(medallion, "replace_partitions", fails_on_gold)
    with pytest.raises(OSError):
        medallion.refresh_daily(spark, s, g, delta, "month")
    monkeypatch.undo()
    assert calls == [s, g]
    medallion.refresh_daily(spark, s, g, delta, "month")
    want = gold.daily_member_summary(silver.cleanse_transactions(raw.unionByName(moved)))
    assert rows(spark.read.parquet(g).select(*want.columns)) == rows(want)
    assert not (tmp_path / "gold_unfinished").exists()


def test_stored_zone_opens_only_needed_folders(spark, lake, tmp_path):
    store = medallion.ZoneStore(spark, str(tmp_path / "z"))
    store.write("GOLD", "DAILY", lake.daily, ("txn_date", "month"))
    recent = store.read("GOLD", "DAILY", since="2024-01-10")
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_date" in plan
    want = lake.daily.where("txn_date >= DATE '2024-01-10'")
    assert rows(recent.where("txn_date >= DATE '2024-01-10'")) == rows(want)


def _txn(i, member, channel, when, load, amount="1.00", fi="f", risk=None):
    from decimal import Decimal as D
    return (i, member, fi, datetime.fromisoformat(when), D(amount), "usd", "debit", channel, "c", "n", "us", "s", None, None, None, None,
            D(risk) if risk else None, datetime.fromisoformat(load), "f")


TXN_COLUMNS = ("txn_id string, member_id string, institution_id string, txn_timestamp timestamp_ntz, amount decimal(15,2), currency_code string, "
               "txn_type string, channel string, merchant_category string, merchant_name string, merchant_country string, "
               "status string, auth_code string, card_last_four string, ip_address string, "
               "device_fingerprint string, risk_score decimal(5,2), _loaded_at timestamp_ntz, _source_file string")


def test_totals_follow_loads_removals_and_the_window(spark, tmp_path):
    """Replaced, moved, older and repeated versions; a lost maximum; members and channels that vanish; null channels."""
    loads = [
        [_txn("a", "m1", "pos", "2024-01-20", "2024-01-21", "5.00", risk="0.50"), _txn("b", "m1", "web", "2024-01-25", "2024-01-26"),
         _txn("c", "m2", "web", "2024-01-27", "2024-01-28", risk="0.10"), _txn("d", "m3", None, "2024-01-02", "2024-01-03", "9.00"),
         _txn("e", "m1", "pos", "2024-01-11", "2024-01-12", "2.00", fi="g")],
        [_txn("b", "m1", "pos", "2024-01-10", "2024-02-01", "7.00"), _txn("c", "m4", "web", "2023-11-27", "2024-02-01"),
         _txn("a", "m1", "pos", "2024-01-21", "2024-01-01", "50.00"), _txn("n", "m2", "web", "2024-01-28", "2024-02-01")],
        [_txn("n", "m2", "web", "2024-01-03", "2024-02-02", fi="g"), _txn("a", "m1", "pos", "2024-01-04", "2024-02-02", "4.00")],
    ]
    frames = [spark.createDataFrame(x, TXN_COLUMNS) for x in loads]
    zone = contributions.Zone(spark, str(tmp_path / "z"), "2024-01-31 00:00:00")
    seen = None

    def check(as_of):
        recent = silver.cleanse_transactions(seen).where(F.col("txn_timestamp") >= F.lit(as_of).cast("timestamp_ntz") - F.expr("INTERVAL 30 DAYS"))
        want = recent.groupBy("member_id", "channel").agg(F.count("*").alias("n"), F.sum("amount").cast("decimal(28,2)").alias("amount"),
                                                          F.max("txn_timestamp").alias("last_txn_time"))
        assert rows(zone.held(contributions.MEMBER_TOTALS)) == rows(want)
        want = recent.groupBy("institution_id", "member_id").agg(
            F.count("*").alias("n"), F.sum("amount").cast("decimal(28,2)").alias("amount"),
            F.sum(F.coalesce("risk_score", F.lit(0))).cast("decimal(28,2)").alias("risk"), F.count("risk_score").alias("risk_n"))
        assert rows(zone.held(contributions.INSTITUTION_TOTALS)) == rows(want)
        assert rows(zone.silver().drop("part_date")) == rows(silver.cleanse_transactions(seen))

    for number, df in enumerate(frames, 1):
        seen = df if seen is None else seen.unionByName(df)
        for _ in range(2):
            zone.load(df, number)
            check("2024-01-31")
    zone.advance("2024-02-10 00:00:00", 4)
    check("2024-02-10")
    index = {r["txn_id"]: str(r["part_date"]) for r in spark.read.parquet(zone.path("index")).collect()}
    assert index["c"] == "2023-11-01" and index["n"] == "2024-01-01"
    plan = zone.replaced(frames[0].select("txn_id"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part_date" in plan or "PartitionFilters: [part_date" in plan


def test_a_load_that_stopped_between_its_steps(spark, tmp_path, monkeypatch):
    first = spark.createDataFrame([_txn("a", "m", "pos", "2024-01-20", "2024-01-21", "5.00")], TXN_COLUMNS)
    second = spark.createDataFrame([_txn("a", "m", "web", "2023-12-30", "2024-01-25", "6.00"), _txn("b", "m", "pos", "2024-01-29", "2024-01-30")], TXN_COLUMNS)
    zone = contributions.Zone(spark, str(tmp_path / "z"), "2024-01-31 00:00:00")
    zone.load(first, 1)
    real = contributions.Zone.apply

    def stops(self, t, signed, number):
        if t is contributions.INSTITUTION_TOTALS:
            raise OSError("lost")
        real(self, t, signed, number)

    monkeypatch.setattr(contributions.Zone, "apply", stops)
    with pytest.raises(OSError):
        zone.load(second, 2)
    monkeypatch.undo()
    zone.load(second, 2)
    got = {(r["member_id"], r["channel"]): (r["n"], str(r["amount"])) for r in zone.held(contributions.MEMBER_TOTALS).collect()}
    assert got == {("m", "POS"): (1, "1.00")} or got == {("M", "POS"): (1, "1.00")}
    assert [(r["n"], str(r["amount"])) for r in zone.held(contributions.INSTITUTION_TOTALS).collect()] == [(1, "1.00")]


def _two_loads(spark):
    first = [_txn("a", "m", "pos", "2024-01-20", "2024-01-21", "5.00"), _txn("b", "m", "pos", "2023-12-20", "2023-12-21"),
             _txn("c", "m", "pos", "2023-11-20", "2023-11-21"), _txn("e", "m", "pos", "2023-10-20", "2023-10-21")]
    second = [_txn("a", "m", "web", "2023-12-30", "2024-01-25", "6.00"), _txn("d", "m", "pos", "2024-01-29", "2024-01-30"),
              _txn("e", "n", "pos", "2023-09-20", "2024-01-30")]
    return [spark.createDataFrame(x, TXN_COLUMNS) for x in (first, second)]


def test_a_repeated_load_writes_only_what_is_missing(spark, tmp_path):
    """Silver that holds a load already keeps its files; a folder that is as before the load is written again."""
    import shutil
    loads, zone = _two_loads(spark), contributions.Zone(spark, str(tmp_path / "z"), "2024-01-31 00:00:00")
    files = lambda: {p.parent.name: p.name for p in Path(zone.path("silver")).glob("*/*.parquet")}
    zone.load(loads[0], 1)
    shutil.copytree(tmp_path / "z/silver/part_date=2023-12-01", tmp_path / "old")
    zone.load(loads[1], 2)
    done, want = files(), rows(zone.silver())
    assert set(done) == {f"part_date={m}-01" for m in ("2023-09", "2023-11", "2023-12", "2024-01")}
    zone.load(loads[1], 2)
    assert files() == done
    shutil.rmtree(tmp_path / "z/silver/part_date=2023-12-01")
    shutil.copytree(tmp_path / "old", tmp_path / "z/silver/part_date=2023-12-01")
    zone.load(loads[1], 2)
    again = files()
    assert rows(zone.silver()) == want and {k for k in done if again[k] != done[k]} == {"part_date=2023-12-01"}


def test_a_load_goes_through_bronze_once(spark, tmp_path, monkeypatch):
    """The rows of a load and those that they replace are stored before they are compared."""
    loads, zone, plans = _two_loads(spark), contributions.Zone(spark, str(tmp_path / "z"), "2024-01-31 00:00:00"), []
    zone.load(loads[0], 1)
    real = contributions.keep_latest
    monkeypatch.setattr(contributions, "keep_latest", lambda df, *a: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, *a))
    zone.load(loads[1], 2)
    assert len(plans) == 1 and "Join" not in plans[0] and "Window" not in plans[0]
    assert rows(zone.silver().drop("part_date")) == rows(silver.cleanse_transactions(loads[0].unionByName(loads[1])))


def test_a_breach_keeps_the_earlier_state(spark, tmp_path):
    shape, path = "id string, v int", str(tmp_path / "t")
    first = spark.createDataFrame([("a", 1), ("b", 2)], shape)
    checks = [quality.Attachment("T", "id", "NULL_RATE"), quality.Attachment("T", "id", "DUPLICATE_RATE"), quality.Attachment("U", "id", "NULL_RATE")]
    limits = {("T", "NULL_RATE"): (None, 0.0), ("T", "DUPLICATE_RATE"): (None, 0.0)}
    states = [first, spark.createDataFrame([(None, 3)], shape), spark.createDataFrame([("c", 3), ("c", 4)], shape), spark.createDataFrame([("d", 5)], shape)]
    seen = []
    for df in states:
        verdicts = quality.publish(df, path, "T", checks, limits, AS_OF)
        assert verdicts.count() == 2
        seen.append((quality.may_promote(verdicts), rows(spark.read.parquet(path))))
    assert [ok for ok, _ in seen] == [True, False, False, True]
    assert seen[0][1] == seen[1][1] == seen[2][1] == rows(first) and seen[3][1] == rows(states[3])
