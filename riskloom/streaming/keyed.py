"""Tables that follow a stream by keyed state.

Spark's state store holds one row per key (and window); a micro-batch emits the new value of every key that it touched. The
values are whole, not differences, and replace the old ones in the partitions they belong to, so a batch that is repeated
after a failure changes nothing.

Where a watermark lets go of old windows, rows behind it change no state. Since a batch emits each key it touched, a row
whose key is not among them was behind the watermark: such rows are set aside in a late table, none is lost. Rows without a
time are set aside as well.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from riskloom.sources.tables import exists, replace_partitions

BATCH = "_batch_id"
PANE = "pane"


@dataclass(frozen=True)
class Panes:
    """Windows of one ``unit`` ("hour", "day") over the column ``time``; state is let go ``delay`` after the newest time."""

    time: str
    unit: str
    delay: str


def started(writer: DataStreamWriter, checkpoint: str, seconds: float | None) -> StreamingQuery:
    """Runs on an interval, or takes what is there and stops."""
    w = writer.option("checkpointLocation", checkpoint)
    return (w.trigger(processingTime=f"{seconds} seconds") if seconds else w.trigger(availableNow=True)).start()


def same(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def states_and_rows(stream: DataFrame, keys: Sequence[str], measures: Sequence[Column], panes: Panes | None = None,
                    columns: Sequence[str] | None = None) -> DataFrame:
    """The new state of each touched key (``_state``) and the batch's own rows (``_row``; all their columns, or the given ones),
    in one stream."""
    rows = stream
    if panes:
        rows = rows.withColumn("_at", F.col(panes.time).cast("timestamp")).withWatermark("_at", panes.delay)
        window = F.window("_at", f"1 {panes.unit}").alias("_w")
        found = rows.groupBy(*keys, window).agg(*measures).withColumn(PANE, F.col("_w.start").cast("timestamp_ntz")).drop("_w")
        rows = rows.withColumn("_pane", F.date_trunc(panes.unit, "_at").cast("timestamp_ntz")).drop("_at")
    else:
        found = rows.groupBy(*keys).agg(*measures)
    states = found.select(F.struct(*found.columns).alias("_state"))
    own = rows.select(F.struct(*(columns or stream.columns)).alias("_row"), *([F.col("_pane")] if panes else []))
    return states.unionByName(own, allowMissingColumns=True)


def late_of(batch: DataFrame, states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a batch that its states do not know of."""
    touched = states.select(*keys, PANE).alias("s")
    rows = batch.where("_row IS NOT NULL").select("_row.*", F.col("_pane").alias(PANE)).alias("r")
    return rows.join(touched, same("r", "s", [*keys, PANE]), "left_anti").drop(PANE)


def upsert(rows: DataFrame, path: str, part: str, keys: Sequence[str], merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> None:
    """Writes ``rows`` over those of the same keys. Only partitions (column ``part``) that they touch are read and replaced;
    the values of ``part`` in one batch are collected, so it must be coarse (a day, a bucket). ``merge`` may combine new and
    old rows first, in a way that a repetition does not change."""
    spark = rows.sparkSession
    if exists(spark, path):
        touched = [r[0] for r in rows.select(part).distinct().collect()]
        old = spark.read.schema(rows.schema).parquet(path).where(F.col(part).isin(touched))
        new = merge(rows, old) if merge else rows
        rest = old.alias("o").join(rows.select(*keys).alias("n"), same("o", "n", keys), "left_anti")
        rows = new.unionByName(rest)
    replace_partitions(rows, path, (part,), spread=True)


def keep_states(stream: DataFrame, base: str, checkpoint: str, keys: Sequence[str], measures: Sequence[Column], panes: Panes,
                seconds: float | None = None) -> StreamingQuery:
    """Follows a stream with one row per key and pane under ``base``/table, in folders of days, and the rows behind the
    watermark under ``base``/late, in folders of batches."""
    def sink(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            states = batch.where("_state IS NOT NULL").select("_state.*")
            late = late_of(batch, states, keys)
            replace_partitions(late.withColumn(BATCH, F.lit(number).cast("bigint")), f"{base}/late", (BATCH,), spread=True)
            upsert(states.withColumn("_day", F.col(PANE).cast("date")), f"{base}/table", "_day", [*keys, PANE])
        finally:
            batch.unpersist()

    return started(states_and_rows(stream, keys, measures, panes).writeStream.outputMode("update").foreachBatch(sink), checkpoint, seconds)


def kept_states(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(f"{base}/table")


def late_rows(spark: SparkSession, base: str) -> DataFrame | None:
    """Rows that came behind the watermark; none if there is no folder of them."""
    return spark.read.parquet(f"{base}/late").drop(BATCH) if exists(spark, f"{base}/late") else None
