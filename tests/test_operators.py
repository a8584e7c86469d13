"""Operators on small hand-made tables, against plain Python."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskloom.functions.expressions import at
from riskloom.operators import skew
from riskloom.operators.latest import keep_latest
from riskloom.operators.merge import apply_defaults, fold_deltas, merge_features, update_by_key
from riskloom.operators.ranking import exact_percentiles, previous_values, ranked_values
from riskloom.plans import features, ops
from riskloom.plans.gold import fraud_signals
from tests.conftest import rows


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9), st.integers(0, 99)), min_size=1, max_size=40))
def test_keep_latest_matches_python_and_is_idempotent(spark, data):
    df = spark.createDataFrame(data, "k int, t int, v int")
    once = keep_latest(df, ["k"], ["t"], ["v"])
    best = {}
    for k, t, v in data:
        best[k] = max(best.get(k, (-1, -1)), (t, v))
    assert rows(once) == sorted((str(k), str(t), str(v)) for k, (t, v) in best.items())
    assert rows(keep_latest(once, ["k"], ["t"], ["v"])) == rows(once)
    assert rows(keep_latest(df, ["k"], ["t"], ["v"], method="max_by")) == rows(once)


def test_keep_latest_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 3 AS k", "id AS t")
    plan = keep_latest(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def _hot(spark):
    left = spark.range(2000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('k', id % 50) END AS k", "id AS v")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("alone", 4)], "k string, w int")
    return left, right


def test_heavy_keys_finds_the_hot_one(spark):
    left, _ = _hot(spark)
    assert "hot" in skew.heavy_keys(left, "k")


def test_lookup_join_with_salt_equals_plain_join(spark):
    left, right = _hot(spark)
    want = rows(left.join(right, "k", "left").select("k", "v", "w"))
    assert rows(skew.lookup_join(left, right, "k", hot=["hot", "k1"])) == want
    assert rows(skew.lookup_join(left, right, "k", hot=[])) == want
    assert rows(skew.lookup_join(left, right, "k")) == want


@pytest.mark.parametrize("hot", [[], ["hot"], ["hot", "k2", "k9"]])
def test_outer_join_with_salt_equals_plain_join(spark, hot):
    left, right = _hot(spark)
    a = left.withColumnRenamed("k", "lk")
    cond = (F.col("v") % 2 == 0) | (F.col("w") > 1)
    want = rows(a.join(right, F.col("lk") == F.col("k"), "full_outer").where(cond))
    got = skew.outer_join_unique_right(a, right, "lk", "k", cond, F.col("v") % 2 == 0, hot=hot)
    assert rows(got) == want


def test_salt_on_a_time_key(spark):
    left = spark.range(100).selectExpr("TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id % 3) AS k", "id AS v")
    right = left.select("k").distinct().withColumn("w", F.lit(1))
    hot = skew.heavy_keys(left, "k")
    assert len(hot) == 3
    assert rows(skew.lookup_join(left, right, "k", hot=hot[:2])) == rows(left.join(right, "k", "left").select("k", "v", "w"))


def test_fraud_signals_same_with_forced_salt(lake):
    plain = fraud_signals(lake.alerts, lake.events)
    ids = [r[0] for r in lake.alerts.where("related_txn_id IS NOT NULL").select("related_txn_id").limit(20).collect()]
    assert rows(fraud_signals(lake.alerts, lake.events, hot=ids)) == rows(plain)


def test_ranks_and_percentiles(spark):
    rng = random.Random(3)
    data = [rng.choice([5, 5, 5, rng.randint(0, 1000)]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in data], "x bigint")
    got = {r["x"]: (r["first_rank"], r["last_rank"]) for r in ranked_values(df, "x").collect()}
    s = sorted(data)
    for v, (lo, hi) in got.items():
        assert (s.index(v), len(s) - 1 - s[::-1].index(v)) == (lo, hi)
    row = exact_percentiles(df, "x", {"p50": 0.5, "p99": 0.99}).head()
    for name, p in (("p50", 0.5), ("p99", 0.99)):
        pos = p * (len(s) - 1)
        lo = int(pos)
        assert row[name] == pytest.approx(s[lo] + (s[min(lo + 1, len(s) - 1)] - s[lo]) * (pos - lo))
    prev = {r["x"]: r["previous"] for r in previous_values(df, "x").collect()}
    d = sorted(set(data))
    assert prev == {v: (d[i - 1] if i else None) for i, v in enumerate(d)}


FEATURE_ROWS = [
    # member, business_date, system_time, txn_count
    ("A", "2024-01-01", "2024-01-01 00:00:00", 1), ("A", "2024-01-08", "2024-01-08 00:00:00", 2),
    ("A", "2024-01-01", "2024-01-20 00:00:00", 9),  # late correction of the first date
    ("B", "2024-01-08", "2024-01-08 00:00:00", 3), ("C", "2024-02-01", "2024-02-01 00:00:00", 4),
]


def _features(spark):
    df = spark.createDataFrame(FEATURE_ROWS, "member_id string, b string, s string, txn_count_30d bigint")
    df = df.select("member_id", "txn_count_30d", F.col("b").cast("date").alias("business_date"),
                   F.col("s").cast("timestamp_ntz").alias("system_time"))
    fill = [c for c in features.FEATURE_COLUMNS if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in fill})


def test_point_in_time_never_looks_ahead(spark):
    f = _features(spark)
    got = {r["member_id"]: r["txn_count_30d"]
           for r in features.pit_features(f, "2024-01-15", "2024-01-25 00:00:00", "latest").collect()}
    assert got == {"A": 2, "B": 3}
    literal = {r["member_id"] for r in features.pit_features(f, "2024-01-15", "2024-01-25 00:00:00", "literal").collect()}
    assert literal == {"B"}


@pytest.mark.parametrize("chunk", ["day", "month"])
def test_spine_matches_brute_force(spark, chunk):
    f = _features(spark).select("member_id", "business_date", "system_time", "txn_count_30d")
    t0 = datetime(2023, 12, 30)
    asks = [(i, m, t0 + timedelta(hours=17 * i)) for i in range(60) for m in "ABCD"]
    spine = spark.createDataFrame(asks, "ask int, member_id string, decision_ts timestamp_ntz")
    got = {(r["ask"], r["member_id"]): r["txn_count_30d"]
           for r in features.pit_spine(spine, f, values=("txn_count_30d",), chunk=chunk).collect()}
    for ask, m, t in asks:
        seen = [(b, s, n) for k, b, s, n in FEATURE_ROWS if k == m
                and datetime.fromisoformat(b) <= t and datetime.fromisoformat(s) <= t]
        assert got[(ask, m)] == (max(seen)[2] if seen else None)
    assert len(got) == len(asks)


def _rt(spark, data):
    return spark.createDataFrame(data, "member_id string, event_count_24h bigint, unique_channels_24h bigint, "
                                 "total_spend_24h decimal(18,2), max_risk_score_24h decimal(5,2), last_activity_time timestamp_ntz")


def test_merging_step_by_step_equals_one_fold(spark):
    from decimal import Decimal as D
    t = datetime(2024, 1, 1)
    d1 = _rt(spark, [("A", 1, 2, D("1.50"), D("0.10"), t), ("B", 2, 1, D("0"), None, t)])
    d2 = _rt(spark, [("A", 4, 1, D("2.25"), D("0.90"), t + timedelta(1)), ("C", 1, 1, D("7"), D("0.2"), t)])
    stamp = at("2024-01-02 00:00:00")
    base = d1.withColumn("feature_computed_at", stamp)
    merged = merge_features(base, d2, stamp)
    folded = fold_deltas(base.unionByName(d2.withColumn("feature_computed_at", stamp)))
    assert rows(merged) == rows(folded)


def test_update_by_key_and_defaults(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    up = update_by_key(df, spark.createDataFrame([(2, "z")], "id int, s string"), "id", "at", at("2024-01-01 00:00:00"))
    assert rows(up.select("id", "s")) == [("1", "a"), ("2", "z")]
    assert up.where("at IS NULL").count() == 1
    filled = apply_defaults(spark.createDataFrame([(None,), ("x",)], "c string"), {"c": F.lit("USD"), "flag": F.lit(False)})
    assert rows(filled) == [("USD", "False"), ("x", "False")]


def test_closure_with_a_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("e", "f")],
                                  "upstream string, downstream string")
    got = {(r[0], r[1]): r[2] for r in ops.lineage_closure(edges).collect()}
    graph = {}
    for u, d in [(r[0], r[1]) for r in edges.collect()]:
        graph.setdefault(u, []).append(d)
    want = {}
    for start in graph:
        frontier, dist, seen = graph[start], 1, {}
        while frontier:
            nxt = []
            for n in frontier:
                if n not in seen:
                    seen[n] = dist
                    nxt += graph.get(n, [])
            frontier, dist = nxt, dist + 1
        want.update({(start, n): x for n, x in seen.items()})
    assert got == want


def test_impact_of_given_objects(spark):
    """Cycles, several ways to one object, a start that depends on another start, and objects that nothing depends on."""
    from riskloom.plans import ops
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("c", "d"), ("x", "y"), ("x", "y")], "upstream string, downstream string")
    got = {r["object"]: r["distance"] for r in ops.impact(edges, spark.createDataFrame([("a",), ("d",)], "upstream string")).collect()}
    assert got == {"b": 1, "c": 1}
    assert ops.impact(edges, edges.limit(0)).count() == 0


def test_histogram_trees_learn_weekdays_and_flag_a_spike(spark):
    import datetime as dt
    from decimal import Decimal

    from riskloom.plans import anomaly

    rows = []
    for k in range(6):
        for i in range(90):
            day = dt.date(2024, 1, 1) + dt.timedelta(days=i)
            spend = 1000 + 500 * (day.weekday() >= 5) + k + (i * 7 + k) % 5
            rows.append((f"i{k}", day, Decimal(spend + (5000 if (k, i) == (2, 87) else 0))))
    daily = spark.createDataFrame(rows, "institution_id string, txn_date date, total_amount decimal(20,2)")
    found = anomaly.detect_histogram(daily, "2024-03-31 00:00:00", trees=8).collect()
    flagged = {(r["institution_id"], r["ts"]) for r in found if r["is_anomaly"]}
    assert ("i2", dt.date(2024, 3, 28)) in flagged
    others = [r for r in found if r["institution_id"] != "i2"]
    assert len(others) == 5 * 7 and all(abs(r["y"] - r["forecast"]) < 10_000 for r in others)  # cents; weekends move by 50,000
    assert anomaly.detect_histogram(daily.limit(0), "2024-03-31 00:00:00").count() == 0


def test_closure_writes_each_pair_once(spark, monkeypatch):
    written, stored = [], ops.stored
    def counted(df, label):
        out = stored(df, label)
        written.append(out.count())
        return out
    monkeypatch.setattr(ops, "stored", counted, raising=False)
    edges = spark.createDataFrame([(str(i), str(i + 1)) for i in range(9)] + [("0", "5"), ("9", None), ("4", "0")], "upstream string, downstream string")
    got = {(r[0], r[1]): r[2] for r in ops.lineage_closure(edges).collect()}
    assert sum(written) == len(got) and got[("0", "9")] == 5 and got[("0", None)] == 6 and got[("0", "0")] == 5
