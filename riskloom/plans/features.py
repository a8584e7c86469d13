"""Online and offline features, point-in-time retrieval, drift and freshness."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.functions.expressions import (ago, at, count_when, day_of, elapsed, mean, moved_more_than, required,
                                            safe_ratio, since, squash, sum_when, total, verdict)
from riskloom.operators.latest import keep_latest, top_k
from riskloom.operators.ranking import exact_percentiles
from riskloom.plans.gold import OPEN_STATES
from riskloom.plans.silver import ALERT_TIES, MEMBER_TIES, TXN_TIES

# Names and order of the offline features.
FEATURE_COLUMNS = ("member_id", "institution_id", "risk_tier", "account_age_days", "txn_count_30d", "total_spend_30d",
                   "avg_txn_30d", "channels_used_30d", "open_alerts", "business_date", "system_time")


def online_features(events: DataFrame, as_of: str, hours: int = 24, slim: bool = False) -> DataFrame:
    """Activity of the last hours per member, from de-duplicated events."""
    n = F.count(F.lit(1)).alias("event_count_24h")
    channels = F.count_distinct("channel").alias("unique_channels_24h")
    ips = F.count_distinct("ip_address").alias("unique_ips_24h")
    spend = sum_when(F.col("amount") > 0, "amount").alias("total_spend_24h")
    avg_amount = mean("amount").alias("avg_amount_24h")
    top_risk = F.max("risk_score").alias("max_risk_score_24h")
    last = F.max("event_time").alias("last_activity_time")
    if slim:
        measures = [n, channels, ips, spend, avg_amount, top_risk, last]
    else:
        measures = [n, channels, ips, F.count_distinct("device_id").alias("unique_devices_24h"), spend, avg_amount,
                    F.max("amount").alias("max_amount_24h"), top_risk, mean("risk_score").alias("avg_risk_score_24h"),
                    count_when(F.col("risk_score") > 0.7).alias("high_risk_events_24h"), last,
                    F.min("event_time").alias("first_activity_24h")]
    return (events.where(since("event_time", as_of, hours, "hour")).groupBy("member_id").agg(*measures)
            .withColumn("feature_computed_at", at(as_of)))


def offline_features(members: DataFrame, activity: DataFrame, as_of: str) -> DataFrame:
    """Training features with account age, zero defaults and both times."""
    zero = F.lit(0)
    measures = activity.select("member_id", "txn_count_30d", "total_spend_30d", "avg_txn_30d", "channels_used_30d",
                               "open_alerts")
    return members.select("member_id", "institution_id", "risk_tier", "member_since").join(
        measures, "member_id", "left").select(
        "member_id", "institution_id", "risk_tier", "member_since",
        F.date_diff(day_of(as_of), F.col("member_since")).cast("bigint").alias("account_age_days"),
        F.coalesce("txn_count_30d", zero).alias("txn_count_30d"),
        F.coalesce("total_spend_30d", zero).cast("decimal(18,2)").alias("total_spend_30d"),
        F.coalesce("avg_txn_30d", F.lit(0.0)).alias("avg_txn_30d"),
        F.coalesce("channels_used_30d", zero).alias("channels_used_30d"),
        F.coalesce("open_alerts", zero).alias("open_alerts"),
        day_of(as_of).alias("business_date"), at(as_of).alias("system_time"))


def with_validity(raw: DataFrame, key: str, order: Sequence[str], loaded: str = "_loaded_at") -> DataFrame:
    """Versions of every key with ``_until``, the load time of the next one; null for the newest."""
    by = [F.col(c).asc_nulls_first() for c in (loaded, *order)]
    return raw.withColumn("_until", F.lead(loaded).over(Window.partitionBy(key).orderBy(*by)))


# --- past states as differences -----------------------------------------------------------------
#
# Moments are numbered in order. A version counts from the first moment that knows it to the last one before its end, so it
# adds to the first and takes off again behind the last: two rows, however many moments lie between. Running sums per member
# give the state at every moment.

def in_order(moments: Sequence[str]) -> list[str]:
    return sorted(set(moments), key=datetime.fromisoformat)


def just_after(time: Column) -> Column:
    return time + F.expr("INTERVAL '0.000001' SECOND")


def place(time: str, moments: Sequence[str]) -> Column:
    """How many of the ordered moments are before the time in a column, by a tree of comparisons; all, if it is null."""
    def below(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(F.col(time) > at(moments[mid]), below(mid + 1, high)).otherwise(below(low, mid))
    return F.when(F.col(time).isNull(), F.lit(len(moments))).otherwise(below(0, len(moments)))


def between(versions: DataFrame, moments: Sequence[str], begin: Column, end: Column) -> DataFrame:
    """``versions`` that count at some moment, with the numbers of the first one (``_first``) and the one behind the last
    (``_end``). They count from ``begin`` on and no longer from ``end`` on, if that is not null."""
    timed = versions.withColumns({"_begin": begin, "_stop": end})
    return timed.withColumns({"_first": place("_begin", moments), "_end": place("_stop", moments)}).where("_first < _end").drop("_begin", "_stop")


def steps(versions: DataFrame, moments: Sequence[str], begin: Column, end: Column) -> DataFrame:
    """``versions`` at the moment ``i`` where they begin to count (``sign`` 1) and the one where they no longer do (-1)."""
    marks = F.array(*[F.struct(F.col(c).alias("i"), F.lit(sign).alias("sign")) for c, sign in (("_first", 1), ("_end", -1))])
    here = between(versions, moments, begin, end)
    return here.select("*", F.inline(F.filter(marks, lambda x: x["i"] < len(moments)))).drop("_first", "_end")


def known_by(last: str, raw: DataFrame, key: str, order: Sequence[str], loaded: str = "_loaded_at") -> DataFrame:
    """Versions that were loaded up to the last moment. Those loaded later could only end others after it."""
    return with_validity(raw.where(F.col(loaded) <= at(last)), key, order, loaded)


def signed(value: str) -> Column:
    return F.when(F.col("sign") > 0, F.col(value)).otherwise(-F.col(value))


def distinct_steps(changes: DataFrame, keys: Sequence[str], item: str, count: str = "n") -> DataFrame:
    """Adds ``opened``: 1 where an item's running count leaves zero, -1 where it is back there, else 0."""
    so_far = F.sum(count).over(Window.partitionBy(*keys, item).orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    is_on = lambda c: F.when(F.col(item).isNotNull() & (c > 0), 1).otherwise(0)
    return changes.withColumn("_sum", so_far).withColumn("opened", is_on(F.col("_sum")) - is_on(F.col("_sum") - F.col(count))).drop("_sum")


def backfill_features(raw_members: DataFrame, raw_txns: DataFrame, raw_alerts: DataFrame, moments: Sequence[str],
                      days: int = 30) -> DataFrame:
    """Offline features at several past moments from one pass over Bronze, each by what was known then; ``system_time``
    is the moment.

    A version of a row counts from its load until the next version's. A transaction counts for the moments whose
    window holds it. An alert is open at a moment if it was raised before it and, by its version known then, is in an open
    state or was resolved only later. The only rows made per moment are those of the result.
    """
    moments = in_order(moments)
    last = moments[-1]
    lag = F.expr(f"INTERVAL {days} DAYS")
    ts = F.col("txn_timestamp")
    usable = raw_txns.where(required("txn_id", "member_id", "amount", "txn_timestamp"))
    spent = steps(known_by(last, usable, "txn_id", TXN_TIES), moments, F.greatest("_loaded_at", just_after(ts)), F.least("_until", just_after(ts + lag)))
    spent = spent.groupBy(squash("member_id").alias("member_id"), F.upper("channel").alias("channel"), "i").agg(
        F.sum("sign").alias("n"), F.sum(signed("amount")).alias("spend"))
    spent = distinct_steps(spent, ["member_id"], "channel").groupBy("member_id", "i").agg(
        F.sum("n").alias("n"), F.sum("spend").alias("spend"), F.sum("opened").alias("channels"))
    is_open = F.upper("status").isin(*OPEN_STATES)
    settled = F.when(is_open, None).otherwise(F.coalesce("resolved_at", at("0001-01-01 00:00:00")))
    raised = known_by(last, raw_alerts.where(required("alert_id")), "alert_id", ALERT_TIES).where("alert_timestamp IS NOT NULL")
    raised = steps(raised, moments, F.greatest("_loaded_at", just_after(F.col("alert_timestamp"))), F.least("_until", settled))
    raised = raised.groupBy("member_id", "i").agg(F.sum("sign").alias("alerts"))
    people = known_by(last, raw_members.where(required("member_id", "institution_id")), "member_id", MEMBER_TIES)
    people = between(people, moments, F.col("_loaded_at"), F.col("_until"))
    base = people.select("member_id", F.struct(squash("institution_id").alias("institution_id"), F.upper("risk_tier").alias("risk_tier"),
                                               "member_since").alias("who"),
                         F.explode(F.sequence(F.col("_first"), F.col("_end") - 1)).alias("i"))
    rows = base.unionByName(spent, allowMissingColumns=True).unionByName(raised, allowMissingColumns=True)
    until_here = Window.partitionBy("member_id").orderBy("i").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    run = {c: F.coalesce(F.sum(c).over(until_here), F.lit(0)) for c in ("n", "spend", "channels", "alerts")}
    rows = rows.select("member_id", "who", "i", *[v.alias(c) for c, v in run.items()]).where("who IS NOT NULL")
    moment = F.element_at(F.array(*[at(m) for m in moments]), F.col("i") + 1)
    average = F.coalesce(F.col("spend").cast("double") / F.nullif(F.col("n"), F.lit(0)).cast("double"), F.lit(0.0))
    return rows.select(
        "member_id", "who.institution_id", "who.risk_tier",
        F.date_diff(moment.cast("date"), F.col("who.member_since")).cast("bigint").alias("account_age_days"),
        F.col("n").alias("txn_count_30d"), F.col("spend").cast("decimal(18,2)").alias("total_spend_30d"),
        average.alias("avg_txn_30d"), F.col("channels").alias("channels_used_30d"), F.col("alerts").alias("open_alerts"),
        moment.cast("date").alias("business_date"), moment.alias("system_time"))


def past_totals(raw_txns: DataFrame, moments: Sequence[str]) -> DataFrame:
    """Transactions, volume and active days per member at past moments, by what was known then. A row holds from its moment
    (``known_at``) until the member's next row; members without a change have none."""
    moments = in_order(moments)
    usable = raw_txns.where(required("txn_id", "member_id", "amount", "txn_timestamp"))
    changes = steps(known_by(moments[-1], usable, "txn_id", TXN_TIES), moments, F.col("_loaded_at"), F.col("_until"))
    daily = changes.groupBy(squash("member_id").alias("member_id"), F.to_date("txn_timestamp").alias("txn_date"), "i").agg(
        F.sum("sign").alias("n"), F.sum(signed("amount")).alias("volume"))
    per_member = distinct_steps(daily, ["member_id"], "txn_date").groupBy("member_id", "i").agg(
        F.sum("n").alias("n"), F.sum("volume").alias("volume"), F.sum("opened").alias("days"))
    until_here = Window.partitionBy("member_id").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    times = F.array(*[at(m) for m in moments])
    return per_member.select(
        "member_id", F.element_at(times, F.col("i") + 1).alias("known_at"), F.sum("n").over(until_here).alias("txn_count"),
        F.sum("volume").over(until_here).cast("decimal(20,2)").alias("total_amount"), F.sum("days").over(until_here).alias("active_days"))


def totals_at(states: DataFrame, moment: str) -> DataFrame:
    """``past_totals`` as they stood at a moment."""
    here = keep_latest(states.where(F.col("known_at") <= at(moment)), ["member_id"], ["known_at"])
    return here.where("txn_count > 0").drop("known_at")


# --- point in time ------------------------------------------------------------------------------

def _known(features: DataFrame, decision_date: str, query_ts: str) -> DataFrame:
    return features.where((F.col("business_date") <= F.lit(decision_date).cast("date"))
                          & (F.col("system_time") <= at(query_ts)))


def pit_features(features: DataFrame, decision_date: str, query_ts: str, mode: str = "latest") -> DataFrame:
    """Feature row per member as known at ``query_ts`` for ``decision_date``.

    ``latest`` takes the newest business date and its newest version. ``literal`` asks for the newest business date
    and the newest system time separately; a late correction of an older date then leaves a member without a row.
    """
    known = _known(features, decision_date, query_ts).select(*FEATURE_COLUMNS)
    if mode == "latest":
        return keep_latest(known, ["member_id"], ["business_date", "system_time"])
    newest = known.groupBy("member_id").agg(F.max("business_date").alias("business_date"),
                                            F.max("system_time").alias("system_time"))
    return known.join(newest, ["member_id", "business_date", "system_time"]).select(*FEATURE_COLUMNS)


def pit_spine(spine: DataFrame, features: DataFrame, key: str = "member_id", decision: str = "decision_ts",
              valid: str = "business_date", known: str = "system_time", values: tuple[str, ...] = (),
              chunk: str = "day") -> DataFrame:
    """Features as known at many decision times, in one linear pass.

    A version is visible from the later of its business date and its system time on, so visibility has one time axis.
    Spine rows and versions are stacked and a running maximum over (business date, system time) picks the newest
    visible version. Runs are cut into time chunks, so a busy key spreads over tasks: each chunk keeps its own
    maximum, and chunks pass the maximum on, one row per key and chunk.
    """
    values = values or tuple(c for c in features.columns if c not in (key, valid, known))
    version = F.struct(F.col(valid), F.col(known), *[F.col(v) for v in values])
    f = features.select(key, F.greatest(F.col(valid).cast("timestamp_ntz"), F.col(known)).alias("_t"),
                        version.alias("_v"), F.lit(0).alias("_side"))
    s = spine.select(key, F.col(decision).alias("_t"), F.struct(*spine.columns).alias("_spine"), F.lit(1).alias("_side"))
    both = f.unionByName(s, allowMissingColumns=True).withColumn("_chunk", F.date_trunc(chunk, F.col("_t")))

    per_chunk = both.groupBy(key, "_chunk").agg(F.max("_v").alias("_m"))
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_chunk.select(key, "_chunk", F.max("_m").over(before).alias("_carry"))

    here = Window.partitionBy(key, "_chunk").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    inside = both.withColumn("_seen", F.max("_v").over(here)).where("_side = 1").drop("_v", "_side", "_t")
    hit = F.greatest("_seen", "_carry")
    return inside.join(carried, [key, "_chunk"], "left").select("_spine.*", hit.alias("_hit")).select(
        *spine.columns, *[F.col(f"_hit.{c}").alias(c) for c in (valid, known, *values)])


# --- comparisons --------------------------------------------------------------------------------

def feature_drift(current: DataFrame, past: DataFrame, min_abs: float = 1000, k: int = 20) -> DataFrame:
    """Members whose spend moved most against an earlier snapshot."""
    c = current.select("member_id", F.col("txn_count_30d").alias("current_txn_count"),
                       F.col("total_spend_30d").alias("current_spend"))
    h = past.select("member_id", F.col("txn_count_30d").alias("historical_txn_count"),
                    F.col("total_spend_30d").alias("historical_spend"))
    change = safe_ratio(F.col("current_spend") - F.col("historical_spend"), "historical_spend", 100, 1)
    moved = (c.join(h, "member_id").where(moved_more_than("current_spend", "historical_spend", min_abs))
             .select("member_id", "current_txn_count", "historical_txn_count",
                     (F.col("current_txn_count") - F.col("historical_txn_count")).alias("txn_count_change"),
                     "current_spend", "historical_spend", change.alias("spend_change_pct")))
    return top_k(moved, [F.abs("spend_change_pct").desc_nulls_last()], k, ["member_id"])


def lookback_totals(totals: DataFrame, min_volume: float = 10000, k: int = 50) -> DataFrame:
    """Largest members of an earlier state, by their totals then."""
    large = totals.where(F.col("total_amount") > min_volume).select(
        "member_id", F.col("txn_count").alias("total_txns_at_90d"), F.col("total_amount").alias("total_volume_at_90d"),
        F.col("active_days").alias("active_days_at_90d"))
    return top_k(large, [F.col("total_volume_at_90d").desc_nulls_last()], k, ["member_id"])


def latency_slo(df: DataFrame, start: str, end: str, limit_ms: int = 1500, metric: str = "FEATURE FRESHNESS SLO",
                probs: dict[str, float] | None = None) -> DataFrame:
    """Average and exact percentiles of ``end - start`` in milliseconds with a verdict on the highest one."""
    probs = probs or {"p50_latency_ms": 0.50, "p95_latency_ms": 0.95, "p99_latency_ms": 0.99}
    last = max(probs, key=probs.get)
    ms = df.select(elapsed("MILLISECOND", start, end).alias("_ms"))
    weight = F.col("last_rank") - F.col("first_rank") + 1
    row = exact_percentiles(ms, "_ms", probs, extra=[
        F.sum(weight).alias("sample_size"),
        (F.sum(F.col("_ms").cast("decimal(20,0)") * weight).cast("double") / F.sum(weight)).alias("avg_latency_ms")])
    secs = f"{limit_ms / 1000:g}s"
    return row.select(
        F.lit(metric).alias("metric"), "sample_size", F.round("avg_latency_ms", 0).alias("avg_latency_ms"),
        *[F.round(p, 0).alias(p) for p in probs],
        verdict(F.col(last) <= limit_ms, f"PASS: p99 <= {secs}", f"FAIL: p99 > {secs}").alias("slo_status"))


def differences(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys whose rows differ between two feature tables, with the side(s) that have them."""
    cols = [c for c in a.columns if c != key]
    left = a.select(key, F.struct(*cols).alias("_a"))
    right = b.select(key, F.struct(*cols).alias("_b"))
    state = (F.when(F.col("_b").isNull(), "ONLY_FIRST").when(F.col("_a").isNull(), "ONLY_SECOND")
             .otherwise("DIFFERENT"))
    return left.join(right, key, "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b"))).select(key, state.alias("state"))
