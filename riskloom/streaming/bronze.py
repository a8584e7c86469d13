"""Event files to the Bronze table: each file once, late rows kept, bad documents and events set aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskloom.functions.expressions import required
from riskloom.plans.silver import EVENT_TIES, dedup_events
from riskloom.sources.files import FILE, RECORD, checked_events
from riskloom.sources.tables import replace_partitions
from riskloom.streaming.keyed import BATCH, Panes, keep_states, kept_states, late_rows, started


def stream_documents(spark: SparkSession, src: str, max_files: int | None = None) -> DataFrame:
    """New lines of a landing prefix with their file. Date folders below the prefix are followed."""
    r = spark.readStream.option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.text(src).select(F.col("value").alias(RECORD), F.col("_metadata.file_path").alias(FILE))


def stream_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Append-only change feed of a Parquet table."""
    schema = schema or spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(path)


def bronze_stream(spark: SparkSession, src: str, out: str, errors: str, checkpoint: str,
                  channel: str = "file_delivery", ingest_time: str | None = None, seconds: float | None = None,
                  max_files: int | None = None) -> StreamingQuery:
    """The single way in: every reader of events reads the table this writes.

    The source remembers which files it has taken. Each micro-batch replaces its own ``_batch_id`` partition, so a batch
    that is repeated after a failure leaves no second copy; a table belongs to one checkpoint. No watermark: late events stay queryable. With
    ``seconds`` the query runs on that interval, else it takes what is there and stops.
    """
    now = F.expr(f"TIMESTAMP_NTZ '{ingest_time}'") if ingest_time else F.convert_timezone(
        None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = checked_events(batch).persist()
        number = F.lit(batch_id).cast("bigint").alias(BATCH)
        try:
            good = rows.where(F.size("errors") == 0).select(
                *[c for c in rows.columns if c not in ("errors", RECORD)], now.alias("_ingest_time"), F.lit(channel).alias("_channel_name"),
                F.concat_ws(":", F.lit(batch_id), F.element_at(F.split(FILE, "/"), -1)).alias("_offset_token"), number)
            replace_partitions(good, out, (BATCH,), spread=True)
            bad = rows.select(FILE, RECORD, F.explode("errors").alias("_e")).select(
                FILE, RECORD, F.col("_e.column_name").alias("error_column_name"), F.col("_e.error").alias("error_message"), number)
            replace_partitions(bad, errors, (BATCH,), spread=True)
        finally:
            rows.unpersist()

    return started(stream_documents(spark, src, max_files).writeStream.foreachBatch(sink), checkpoint, seconds)


# Newest copies: state of a day is let go so long after the newest event's time.
EVENT_DELAY = "10 days"


def latest_events(stream: DataFrame, base: str, checkpoint: str, delay: str = EVENT_DELAY, seconds: float | None = None) -> StreamingQuery:
    """Newest copy of every event and day, kept in Spark's state. Copies behind the watermark are set aside and count in
    ``current_events``, so a later copy wins however late it comes."""
    usable = stream.where(required("event_id", "member_id"))
    newest = F.max_by(F.struct(*usable.columns), F.struct("_ingest_time", *EVENT_TIES)).alias("event")
    return keep_states(usable, base, checkpoint, ["event_id"], [newest], Panes("event_time", "day", delay), seconds)


def current_events(spark: SparkSession, base: str) -> DataFrame:
    """Silver events: the newest of the kept copies, those of other days and late ones included."""
    rows, late = kept_states(spark, base).select("event.*"), late_rows(spark, base)
    return dedup_events(rows.unionByName(late) if late is not None else rows)
