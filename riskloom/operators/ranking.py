"""Exact global ranks without a one-task sort.

Values are first counted, so a value that fills much of the table becomes one row. The counted values are range
partitioned, written once, and each chunk adds the row count of the chunks before it. Only the chunk totals, one
row per chunk, meet in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import cut


def _chunked(df: DataFrame, value: str) -> DataFrame:
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(df.repartitionByRange(n, value).withColumn("_chunk", F.spark_partition_id()))


def ranked_values(df: DataFrame, value: str) -> DataFrame:
    """Distinct non-NULL values with ``first_rank`` and ``last_rank`` (from 0) and ``total`` rows."""
    counted = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    placed = _chunked(counted, value)
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (placed.groupBy("_chunk").agg(F.sum("_n").alias("_rows"))
              .select("_chunk", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
                      F.sum("_rows").over(Window.partitionBy(F.lit(1))).alias("total")))
    run = Window.partitionBy("_chunk").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("_before") + F.sum("_n").over(run) - 1
    return (placed.join(F.broadcast(chunks), "_chunk")
            .select(value, (last - F.col("_n") + 1).alias("first_rank"), last.alias("last_rank"), "total"))


def value_at(value: str, rank: Column) -> Column:
    """Aggregate over ``ranked_values``: the value that holds ``rank``."""
    return F.max(F.when((F.col("first_rank") <= rank) & (rank <= F.col("last_rank")), F.col(value)))


def percentile_columns(value: str, probs: dict[str, float]) -> list[Column]:
    """Interpolated percentiles over ``ranked_values``, one aggregate column per name."""
    out = []
    for name, p in probs.items():
        pos = F.lit(float(p)) * (F.col("total") - 1).cast("double")
        lo = value_at(value, F.floor(pos)).cast("double")
        hi = value_at(value, F.ceil(pos)).cast("double")
        frac = F.max(pos - F.floor(pos))
        out.append((lo + (hi - lo) * frac).alias(name))
    return out


def previous_values(df: DataFrame, value: str) -> DataFrame:
    """Distinct values with the next smaller one in ``previous``, over the whole table."""
    placed = _chunked(df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("_n")), value)
    tails = placed.groupBy("_chunk").agg(F.max(value).alias("_tail"))
    carried = tails.select("_chunk", F.lag("_tail").over(Window.orderBy("_chunk")).alias("_carry"))
    inside = F.lag(value).over(Window.partitionBy("_chunk").orderBy(value))
    return (placed.join(F.broadcast(carried), "_chunk")
            .select(value, F.coalesce(inside, F.col("_carry")).alias("previous")))


def exact_percentiles(df: DataFrame, value: str, probs: dict[str, float], extra: Sequence[Column] = ()) -> DataFrame:
    """One row with the named percentiles of a column."""
    return ranked_values(df, value).agg(*percentile_columns(value, probs), *extra)
