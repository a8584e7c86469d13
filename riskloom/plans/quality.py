"""Data quality: attached metrics, gates and quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskloom.functions import metrics as m
from riskloom.functions.expressions import at
from riskloom.session import cut, new_path
from riskloom.sources.tables import replace


@dataclass(frozen=True)
class Attachment:
    """A metric on a column of a table."""

    table: str
    column: str
    metric: str


# The metrics attached to the Bronze tables.
BRONZE_CHECKS = (
    Attachment("RAW_TRANSACTIONS", "txn_id", "NULL_RATE"),
    Attachment("RAW_TRANSACTIONS", "member_id", "NULL_RATE"),
    Attachment("RAW_TRANSACTIONS", "txn_id", "DUPLICATE_RATE"),
    Attachment("RAW_TRANSACTIONS", "txn_timestamp", "FRESHNESS_HOURS"),
    Attachment("RAW_MEMBERS", "member_id", "NULL_RATE"),
    Attachment("RAW_MEMBERS", "member_id", "DUPLICATE_RATE"),
    Attachment("RAW_ALERTS", "alert_id", "NULL_RATE"),
    Attachment("RAW_ALERTS", "alert_timestamp", "FRESHNESS_HOURS"),
)

# Freshness, volume and validity of the daily Gold table.
DAILY_CHECKS = (
    Attachment("DAILY_MEMBER_SUMMARY", "txn_date", "FRESHNESS_HOURS"),
    Attachment("DAILY_MEMBER_SUMMARY", "member_id", "ROW_COUNT"),
    Attachment("DAILY_MEMBER_SUMMARY", "txn_count", "POSITIVE_RATE"),
)


def metric_column(metric: str, column: str, as_of: str) -> Column:
    build = {
        "NULL_RATE": lambda: m.null_rate(column),
        "DUPLICATE_RATE": lambda: m.duplicate_rate(column),
        "FRESHNESS_HOURS": lambda: m.freshness_hours(column, as_of),
        "POSITIVE_RATE": lambda: m.positive_rate(column),
        "ROW_COUNT": lambda: m.row_count(),
    }
    return build[metric]()


def run_metrics(tables: dict[str, DataFrame], attachments: Sequence[Attachment], as_of: str) -> DataFrame:
    """Long result table: one aggregate pass per table, then one row per attached metric."""
    parts = []
    for name in dict.fromkeys(a.table for a in attachments):
        mine = [a for a in attachments if a.table == name]
        wide = tables[name].agg(*[metric_column(a.metric, a.column, as_of).cast("double").alias(f"m{i}")
                                  for i, a in enumerate(mine)])
        rows = F.array(*[F.struct(F.lit(name).alias("table_name"), F.lit(a.column).alias("column_name"),
                                  F.lit(a.metric).alias("metric"), F.col(f"m{i}").alias("value"))
                         for i, a in enumerate(mine)])
        parts.append(wide.select(F.inline(rows)))
    return reduce(DataFrame.unionByName, parts).withColumn("measured_at", at(as_of))


def observe_metrics(df: DataFrame, name, attachments: Sequence[Attachment], as_of: str) -> DataFrame:
    """The same metrics taken while the rows pass through a write or a micro-batch. ``name`` is an observation or, for a
    stream, the name its listener reports. Distinct counts cannot be observed and are left to ``run_metrics``."""
    seen = [metric_column(a.metric, a.column, as_of).alias(f"{a.column}:{a.metric}")
            for a in attachments if a.metric != "DUPLICATE_RATE"]
    return df.observe(name, *seen)


def gate(results: DataFrame, limits: dict[tuple[str, str], tuple[float | None, float | None]]) -> DataFrame:
    """Metric results with their limits ``{(table, metric): (low, high)}`` and whether promotion may go on."""
    low = high = F.lit(None).cast("double")
    for (t, metric), (lo, hi) in limits.items():
        here = (F.col("table_name") == t) & (F.col("metric") == metric)
        low = F.when(here, F.lit(lo).cast("double")).otherwise(low)
        high = F.when(here, F.lit(hi).cast("double")).otherwise(high)
    out = results.withColumns({"low": low, "high": high})
    breach = (F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))
    return out.withColumn("status", F.when(F.coalesce(breach, F.lit(False)), "BLOCK").otherwise("PASS"))


def may_promote(gated: DataFrame) -> bool:
    """True when no metric blocks; reads at most one row."""
    return gated.where("status = 'BLOCK'").limit(1).count() == 0


def observed(observation: Observation, table: str, spark: SparkSession, as_of: str) -> DataFrame:
    """Metrics that a finished write has reported, in the shape of ``run_metrics``."""
    rows = [(table, *name.split(":"), None if v is None else float(v)) for name, v in observation.get.items()]
    return spark.createDataFrame(rows, "table_name string, column_name string, metric string, value double").withColumn("measured_at", at(as_of))


def publish(df: DataFrame, path: str, table: str, attachments: Sequence[Attachment],
            limits: dict[tuple[str, str], tuple[float | None, float | None]], as_of: str) -> DataFrame:
    """Puts ``df`` in the place of the table at ``path`` if its metrics are within their limits; else readers keep the
    earlier state. The metrics are taken while the rows are written to a folder of their own, so they are those of what may be
    published; what cannot be observed is measured there. Returns the metrics with their verdicts."""
    spark = df.sparkSession
    staged, seen = new_path(spark, "staged"), Observation()
    mine = [a for a in attachments if a.table == table]
    observe_metrics(df, seen, mine, as_of).write.parquet(staged)
    ready = spark.read.parquet(staged)
    results = observed(seen, table, spark, as_of)
    rest = [a for a in mine if a.metric == "DUPLICATE_RATE"]
    if rest:
        results = results.unionByName(run_metrics({table: ready}, rest, as_of))
    verdicts = cut(gate(results, limits))
    if may_promote(verdicts):
        replace(ready, path)
    return verdicts


def with_broken_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows with the names of the row rules they break. A rule that evaluates to NULL counts as broken."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]))
    return df.withColumn("broken_rules", broken)


def quarantine(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that meet every rule, and the others with the rules they break."""
    marked = with_broken_rules(df, rules)
    return marked.where(F.size("broken_rules") == 0).drop("broken_rules"), marked.where(F.size("broken_rules") > 0)
