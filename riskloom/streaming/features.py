"""Features kept fresh by micro-batches, and the rebuild that corrects them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskloom.functions.expressions import at, sum_when
from riskloom.operators.merge import ADD, RT_COLUMNS
from riskloom.plans.features import differences, online_features
from riskloom.sources.tables import replace_partitions
from riskloom.streaming.keyed import PANE, Panes, keep_states, late_rows, same, started, states_and_rows, upsert


BUCKETS = 64


def keep_features(stream: DataFrame, path: str, checkpoint: str, computed_at: str | None = None,
                  seconds: float | None = None) -> StreamingQuery:
    """Upsert of features on every micro-batch. Spark's state holds each member's counts, sums and maxima, one row a member;
    the number of channels is the largest that one batch saw. A batch replaces the buckets of the members it touched.

    Delivery is at least once, so a copy counts again; ``reconcile`` shows the members that the rebuild corrects. A
    stream of Silver events, which has each event once, needs no correction.
    """
    now = at(computed_at) if computed_at else F.current_timestamp().cast("timestamp_ntz")
    measures = [F.count(F.lit(1)).alias("event_count_24h"), sum_when(F.col("amount") > 0, "amount").alias("total_spend_24h"),
                F.max("risk_score").alias("max_risk_score_24h"), F.max("event_time").alias("last_activity_time")]

    def widest(new: DataFrame, old: DataFrame) -> DataFrame:
        before = old.select("member_id", F.col("unique_channels_24h").alias("_before")).alias("b")
        j = new.alias("a").join(before, same("a", "b", ["member_id"]), "left").drop(F.col("b.member_id"))
        return j.withColumn("unique_channels_24h", F.greatest("unique_channels_24h", "_before")).drop("_before")

    def sink(batch: DataFrame, _: int) -> None:
        batch = batch.persist()
        try:
            states = batch.where("_state IS NOT NULL").select("_state.*").alias("a")
            seen = batch.where("_row IS NOT NULL").groupBy(F.col("_row.member_id").alias("member_id")).agg(
                F.count_distinct("_row.channel").alias("unique_channels_24h")).alias("b")
            rows = states.join(seen, same("a", "b", ["member_id"])).drop(F.col("b.member_id"))
            spend = F.col("total_spend_24h").cast(ADD["total_spend_24h"]).alias("total_spend_24h")
            rows = rows.withColumns({"total_spend_24h": spend, "feature_computed_at": now}).select(
                *RT_COLUMNS, F.pmod(F.xxhash64("member_id"), F.lit(BUCKETS)).cast("int").alias("_bucket"))
            upsert(rows, path, "_bucket", ["member_id"], widest)
        finally:
            batch.unpersist()

    both = states_and_rows(stream, ["member_id"], measures, columns=["member_id", "channel"])
    return started(both.writeStream.outputMode("update").foreachBatch(sink), checkpoint, seconds)


def current_features(spark: SparkSession, path: str) -> DataFrame:
    """One row per member."""
    return spark.read.parquet(path).select(*RT_COLUMNS)


# --- sliding windows ----------------------------------------------------------------------------

PANE_MEASURES = ("event_count", "total_spend", "max_risk_score", "last_activity_time")
# Hourly panes: state is let go so long after the newest event's time.
PANE_DELAY = "2 days"
# Windows of panes in one task, on average.
WINDOW_ROWS = 4_000_000


def _pane_measures() -> list[Column]:
    return [F.count(F.lit(1)).alias("event_count"), sum_when(F.col("amount") > 0, "amount").alias("total_spend"),
            F.max("risk_score").alias("max_risk_score"), F.max("event_time").alias("last_activity_time")]


def keep_panes(stream: DataFrame, base: str, checkpoint: str, delay: str = PANE_DELAY, seconds: float | None = None) -> StreamingQuery:
    """Measures per member and hour, kept in Spark's state and written to folders of days. Events behind the watermark are
    set aside until ``fold_late``."""
    return keep_states(stream, base, checkpoint, ["member_id"], _pane_measures(), Panes("event_time", "hour", delay), seconds)


def fold_late(spark: SparkSession, base: str, history: DataFrame) -> None:
    """Panes of all days that late events fall on, made anew from the stored events. Doing it again changes nothing."""
    late = late_rows(spark, base)
    if late is None:
        return
    days = [r[0] for r in late.select(F.col("event_time").cast("date").alias("day")).distinct().collect()]
    rows = history.where(F.col("event_time").cast("date").isin(days))
    panes = rows.groupBy("member_id", F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias(PANE)).agg(*_pane_measures())
    replace_partitions(panes.withColumn("_day", F.col(PANE).cast("date")), f"{base}/table", ("_day",), spread=True)


def sliding_windows(panes: DataFrame, hours: int = 24) -> DataFrame:
    """Measures per member and sliding window of ``hours``, one window per hour, open windows included. Each member and hour
    enters its windows as one row, however many events it holds. Panes are moved to their member's task before they are
    repeated, so the windows themselves are not shuffled; the number of tasks follows from the number of panes."""
    least = int(panes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    panes = panes.repartition(max(least, -(-panes.count() * hours // WINDOW_ROWS)), "member_id")
    back = F.explode(F.sequence(F.lit(0), F.lit(hours - 1))).alias("_back")
    placed = panes.select("*", back).withColumn("window_start", F.col(PANE) - F.make_dt_interval(hours=F.col("_back")))
    return placed.groupBy("window_start", "member_id").agg(
        F.sum("event_count").cast("bigint").alias("event_count"), F.sum("total_spend").cast("decimal(18,2)").alias("total_spend"),
        F.max("max_risk_score").alias("max_risk_score"), F.max("last_activity_time").alias("last_activity_time")).select(
        "window_start", (F.col("window_start") + F.expr(f"INTERVAL {hours} HOURS")).alias("window_end"), "member_id", *PANE_MEASURES)


def rematerialize(history: DataFrame, as_of: str) -> DataFrame:
    """Online features from stored history, without replaying the stream."""
    return online_features(history, as_of)


def reconcile(realtime: DataFrame, history: DataFrame, as_of: str) -> DataFrame:
    """Members whose real-time row differs from the rebuild, over the measures both have."""
    shared = ["member_id", "event_count_24h", "total_spend_24h", "max_risk_score_24h", "last_activity_time"]
    return differences(realtime.select(*shared), rematerialize(history, as_of).select(*shared), "member_id")
