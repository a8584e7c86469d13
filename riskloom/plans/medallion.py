"""Materialised zones: full and incremental refresh of derived tables in Parquet folders."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from riskloom.operators.latest import newest_first
from riskloom.plans.gold import daily_member_summary
from riskloom.plans.silver import TXN_TIES, cleanse_transactions
from riskloom.session import cut, held, released, remove
from riskloom.sources.tables import append, replace, replace_partitions, write_text

PART = "part_date"
ZONES = ("BRONZE", "SILVER", "GOLD", "FEATURE_STORE", "ANALYTICS", "STAGING", "GOVERNANCE")


@dataclass(frozen=True)
class Node:
    """A derived table: its zone, what it reads, and how it is computed from that."""

    name: str
    zone: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    view: bool = False
    part: tuple[str, str] | None = None
    """Time column and grain (day, month) of the folders that the table is stored in."""


class ZoneStore:
    """Tables as versioned folders. A refresh writes a new version, then moves the pointer, so readers see either the
    old or the new table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _base(self, zone: str, name: str) -> str:
        return f"{self.root}/{zone.lower()}/{name.lower()}"

    def path(self, zone: str, name: str) -> str:
        base = self._base(zone, name)
        return f"{base}/{self.spark.read.text(f'{base}/current').head()[0]}"

    def read(self, zone: str, name: str, since: str | None = None) -> DataFrame:
        """A table; with ``since``, only the folders that may hold rows from that moment on are opened. The time filter
        itself stays with the reader."""
        df = self.spark.read.parquet(self.path(zone, name))
        if PART not in df.columns:
            return df
        # a folder's date is the first day of its month at the coarsest
        rows = df.where(F.col(PART) >= F.trunc(F.lit(since).cast("date"), "month")) if since else df
        return rows.drop(PART)

    def write(self, zone: str, name: str, df: DataFrame, part: tuple[str, str] | None = None) -> str:
        version = f"v-{uuid.uuid4().hex[:12]}"
        base = self._base(zone, name)
        if part:
            write_parts(df, f"{base}/{version}", *part)
        else:
            replace(df, f"{base}/{version}")
        write_text(self.spark, f"{base}/current", version)
        return f"{base}/{version}"


def refresh_all(store: ZoneStore, bronze: dict[str, DataFrame], nodes: Sequence[Node]) -> dict[str, DataFrame]:
    """Full refresh of every node in the given (dependency) order; each run is logged."""
    have = dict(bronze)
    for node in nodes:
        start = datetime.now(timezone.utc)
        df = node.build(*[have[i] for i in node.inputs])
        if node.view:
            df.createOrReplaceTempView(node.name.lower())
            have[node.name] = df
            continue
        state, message = "SUCCEEDED", None
        try:
            store.write(node.zone, node.name, df, node.part)
            have[node.name] = store.read(node.zone, node.name)
        except Exception as e:
            state, message = "FAILED", str(e)
            raise
        finally:
            _log_run(store, node, "FULL", start, state, message)
    return have


def _log_run(store: ZoneStore, node: Node, action: str, start: datetime, state: str, message: str | None) -> None:
    end = datetime.now(timezone.utc)
    text = "%Y-%m-%d %H:%M:%S.%f"
    row = store.spark.createDataFrame(
        [(node.name, node.zone, state, message, "MANUAL", action, start.strftime(text), end.strftime(text))],
        "name string, schema_name string, state string, state_message string, refresh_trigger string, "
        "refresh_action string, s string, e string")
    append(row.select("*", F.col("s").cast("timestamp_ntz").alias("refresh_start_time"),
                      F.col("e").cast("timestamp_ntz").alias("refresh_end_time")).drop("s", "e"),
           f"{store.root}/governance/refresh_log")


# --- incremental refresh ------------------------------------------------------------------------


def with_part(df: DataFrame, time: str, grain: str) -> DataFrame:
    """Rows with the first day of their partition: the day itself, or its month for smaller tables."""
    return df.withColumn(PART, F.to_date(F.date_trunc(grain, F.col(time))))


def write_parts(df: DataFrame, path: str, time: str, grain: str = "day") -> None:
    """A whole table in folders by date. Each task sorts its rows by folder and writes them where they are: bringing a
    folder's rows together would send the whole table once more, which costs more than the additional files."""
    replace(with_part(df, time, grain), path, (PART,), spread=False)


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder was written to its end."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _drop_parts(spark: SparkSession, path: str, parts: list) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path
    for d in parts:
        target = p(f"{path}/{PART}={d}")
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def refresh_daily(spark: SparkSession, silver_path: str, gold_path: str, delta_raw: DataFrame, grain: str = "day") -> DataFrame:
    """Fold new raw transactions into Silver and recompute only the affected part of the daily table.

    A delta row may replace an older version from another day, so both days are affected. Both tables are partitioned
    by date; only affected partitions are overwritten, others keep their files. The list of affected partitions is
    stored before the first write and removed after the last, so a run that follows a failed one also mends the
    partitions which that one had begun. Returns the affected partitions.

    The delta is the only table of rows that is kept beside Silver and Gold, until Silver has it. Replaced rows are looked for
    by id and partition alone; rows are then read from the affected partitions only, and Gold is made from these once they
    are written. Rows of Silver and of the delta meet in one shuffle and are written by the task in which they met.
    """
    journal = gold_path.rstrip("/") + "_unfinished"
    silver = spark.read.parquet(silver_path)
    with held(with_part(cleanse_transactions(delta_raw), "txn_timestamp", grain), "delta") as delta:
        replaced = silver.select("txn_id", PART).join(delta.select("txn_id"), "txn_id", "left_semi")
        parts = replaced.select(PART).union(delta.select(PART))
        if _exists(spark, journal):
            parts = parts.union(spark.read.parquet(journal).select(PART))
        with released(spark):
            parts = cut(parts.distinct())
        replace(parts, journal)
        # One row per calendar partition: a list the driver can hold.
        affected = [r[0] for r in parts.collect()]
        if not affected:
            remove(spark, journal)
            return parts
        seen = Observation()
        fresh = _merged(silver.where(F.col(PART).isin(affected)), delta).observe(
            seen, F.concat_ws(",", F.collect_set(F.col(PART).cast("string"))).alias("parts"))
        replace_partitions(fresh, silver_path, (PART,))
    present = set(seen.get["parts"].split(","))
    emptied = [d for d in affected if str(d) not in present]
    _drop_parts(spark, silver_path, emptied)
    after = spark.read.schema(silver.schema).parquet(silver_path).where(F.col(PART).isin(affected))
    replace_partitions(with_part(daily_member_summary(after), "txn_date", grain), gold_path, (PART,))
    _drop_parts(spark, gold_path, emptied)
    remove(spark, journal)
    return parts


def _merged(silver: DataFrame, delta: DataFrame) -> DataFrame:
    """Rows of both, the newest one of each id that the delta brings; other ids stay as they are in Silver. Both sides hold an
    id once, so no rows are dropped before the shuffle: that would take another sort."""
    rows = silver.withColumn("_new", F.lit(False)).unionByName(delta.withColumn("_new", F.lit(True)))
    one = Window.partitionBy("txn_id")
    ranked = rows.withColumns({"_rank": F.row_number().over(one.orderBy(*newest_first(["_loaded_at", *TXN_TIES]))),
                               "_touched": F.max("_new").over(one)})
    return ranked.where((F.col("_rank") == 1) | ~F.col("_touched")).drop("_new", "_rank", "_touched")
