"""Row-level changes expressed as DataFrames: upsert, update by key, defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.expressions import sum_when

# How the real-time feature measures combine: counts and sums add, maxima take the larger value (NULLs ignored).
ADD = {"event_count_24h": "bigint", "total_spend_24h": "decimal(18,2)"}
LARGEST = ("unique_channels_24h", "max_risk_score_24h", "last_activity_time")
RT_COLUMNS = ("member_id", "event_count_24h", "unique_channels_24h", "total_spend_24h", "max_risk_score_24h",
              "last_activity_time", "feature_computed_at")


def feature_delta(batch: DataFrame) -> DataFrame:
    """Measures of one batch of events per member."""
    return batch.groupBy("member_id").agg(
        F.count(F.lit(1)).alias("event_count_24h"), F.count_distinct("channel").alias("unique_channels_24h"),
        sum_when(F.col("amount") > 0, "amount").alias("total_spend_24h"),
        F.max("risk_score").alias("max_risk_score_24h"), F.max("event_time").alias("last_activity_time"))


def merge_features(target: DataFrame, delta: DataFrame, computed_at: Column) -> DataFrame:
    """Target with a delta folded in: matched members combine, new members enter, the rest stay as they are."""
    t, d = target.alias("t"), delta.withColumn("_new", F.lit(True)).alias("d")
    j = t.join(d, "member_id", "full_outer")
    def both(c: str) -> Column:
        if c in ADD:
            zero = F.lit(0).cast(ADD[c])
            return (F.coalesce(f"t.{c}", zero) + F.coalesce(f"d.{c}", zero)).cast(ADD[c]).alias(c)
        return F.greatest(f"t.{c}", f"d.{c}").alias(c)
    stamp = F.when(F.col("_new"), computed_at).otherwise(F.col("t.feature_computed_at"))
    return j.select("member_id", *[both(c) for c in RT_COLUMNS[1:-1]], stamp.alias("feature_computed_at"))


def fold_deltas(deltas: DataFrame) -> DataFrame:
    """All deltas of a feature log as one row per member. The measures combine in any order, so this equals
    merging them one by one."""
    return deltas.groupBy("member_id").agg(
        *[F.sum(c).cast(kind).alias(c) for c, kind in ADD.items()], *[F.max(c).alias(c) for c in LARGEST],
        F.max("feature_computed_at").alias("feature_computed_at")).select(*RT_COLUMNS)


def update_by_key(df: DataFrame, updates: DataFrame, key: str, stamp: str | None = None, now: Column | None = None) -> DataFrame:
    """Rows with the given columns replaced where ``updates`` has the key; ``stamp`` records when."""
    changed = [c for c in updates.columns if c != key]
    u = updates.select(key, *[F.col(c).alias(f"_u_{c}") for c in changed], F.lit(True).alias("_hit"))
    j = df.join(u, key, "left")
    out = {c: F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)) for c in changed}
    if stamp:
        old = F.col(stamp) if stamp in df.columns else F.lit(None).cast("timestamp_ntz")
        out[stamp] = F.when(F.col("_hit"), now).otherwise(old)
    cols = df.columns + ([stamp] if stamp and stamp not in df.columns else [])
    return j.withColumns(out).select(*cols)


def apply_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Fill NULLs, and add missing columns, from default expressions."""
    return df.withColumns({c: F.coalesce(F.col(c), v) if c in df.columns else v for c, v in defaults.items()})
