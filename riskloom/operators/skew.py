"""Joins that stay balanced when one key holds a large share of the rows.

A sketch with a fixed size finds the keys that hold more than ``1/HEAVY`` of the left rows; there can be at
most ``HEAVY`` of them. Rows of those keys are spread over ``SALTS`` slots on the left and repeated once per
slot on the right, where a key has one row. Everything else joins as usual. The result never depends on which
keys the sketch reports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAVY = 64
SALTS = 32
_TRACKED = 10_000


def heavy_keys(df: DataFrame, key: str) -> list[str]:
    """Keys, as text, with more than ``1/HEAVY`` of the non-NULL rows; at most ``HEAVY`` values."""
    row = df.where(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k(CAST(`{key}` AS STRING), {HEAVY}, {_TRACKED})").alias("top"),
        F.count(F.lit(1)).alias("n")).head()
    return [t["item"] for t in (row["top"] or []) if t["count"] * HEAVY > row["n"]]


def _salted(left: DataFrame, right: DataFrame, key: str, hot: list) -> tuple[DataFrame, DataFrame]:
    is_hot = F.col(key).cast("string").isin(hot)
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(SALTS)).cast("int")
    slots = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return (left.withColumn("_slot", F.when(is_hot, spread).otherwise(F.lit(0))),
            right.withColumn("_slot", F.explode(slots)))


def lookup_join(left: DataFrame, right: DataFrame, key: str, hot: list | None = None) -> DataFrame:
    """Left join to a side with one row per key.

    Left rows with a NULL key skip the shuffle. Adaptive execution splits heavy keys of a left join by itself; keys
    given in ``hot`` are salted as well. Whether the right side is broadcast is the optimiser's choice.
    """
    keyed, bare = left.where(F.col(key).isNotNull()), left.where(F.col(key).isNull())
    if hot:
        a, b = _salted(keyed, right, key, hot)
        joined = a.join(b, [key, "_slot"], "left").drop("_slot")
    else:
        joined = keyed.join(right, key, "left")
    return joined.unionByName(bare, allowMissingColumns=True).select(*left.columns, *[c for c in right.columns if c != key])


def outer_join_unique_right(left: DataFrame, right: DataFrame, left_key: str, right_key: str, condition: Column,
                            left_only: Column, hot: list | None = None) -> DataFrame:
    """Full outer join to a side with one row per key, keeping rows that meet ``condition``.

    Left rows with a NULL key match nothing, so they bypass the shuffle and only need ``left_only``. A heavy left key
    is salted; its right row is then repeated, and the repeats that stay unmatched are dropped (the key exists on the
    left, so its right row is never unmatched). Column names of the two sides must differ.
    """
    keyed, bare = left.where(F.col(left_key).isNotNull()), left.where(F.col(left_key).isNull() & left_only)
    if hot is None:
        hot = heavy_keys(keyed, left_key)
    if hot:
        a = keyed.withColumnRenamed(left_key, "_k")
        b = right.withColumn("_k", F.col(right_key))
        a, b = _salted(a, b, "_k", hot)
        a = a.withColumn(left_key, F.col("_k"))
        out = a.join(b, ["_k", "_slot"], "full_outer")
        out = out.where(~(F.col(left_key).isNull() & F.col(right_key).cast("string").isin(hot))).drop("_k", "_slot")
    else:
        out = keyed.join(right, F.col(left_key) == F.col(right_key), "full_outer")
    return out.where(condition).unionByName(bare, allowMissingColumns=True)
