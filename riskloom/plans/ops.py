"""Reports over operational logs, status tables and dependency lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.functions.expressions import ago, elapsed, prefix, safe_ratio, scaled, since
from riskloom.operators.latest import keep_latest
from riskloom.operators.ranking import ranked_values, value_at
from riskloom.session import cut, stored

_SECONDS = ("SECOND", "refresh_start_time", "refresh_end_time")


def refresh_status(log: DataFrame) -> DataFrame:
    """State of every node after its newest refresh."""
    newest = keep_latest(log, ["schema_name", "name"], ["refresh_end_time"], ["run_id"])
    return newest.select("name", "schema_name", "target_lag", "refresh_mode", "scheduling_state",
                         F.col("refresh_end_time").alias("last_refresh_time"), "data_timestamp").orderBy(
        "schema_name", "name")


def refresh_history(log: DataFrame, as_of: str, hours: int = 24, k: int = 50) -> DataFrame:
    return (log.where(since("refresh_start_time", as_of, hours, "hour")).select(
        "name", "schema_name", "state", "refresh_trigger", "refresh_action",
        elapsed(*_SECONDS).alias("refresh_duration_sec"), "refresh_start_time", "refresh_end_time", "statistics", "run_id")
        .orderBy(F.desc_nulls_last("refresh_start_time"), "run_id").limit(k))


def slow_refreshes(log: DataFrame, seconds: int = 60) -> DataFrame:
    return log.where((elapsed(*_SECONDS) > seconds) & (F.col("state") == "SUCCEEDED")).select(
        "name", "schema_name", "refresh_action", elapsed(*_SECONDS).alias("duration_sec"), "refresh_start_time").orderBy(
        F.desc("duration_sec"))


def failed_refreshes(log: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    return log.where((F.col("state") == "FAILED") & since("refresh_start_time", as_of, days)).select(
        "name", "schema_name", "state", "state_message", "refresh_start_time", "statistics").orderBy(
        F.desc("refresh_start_time"))


def rebuild_runs(log: DataFrame, name: str, k: int = 5) -> DataFrame:
    return log.where(F.col("name") == name).select(
        "name", "state", "refresh_action", "refresh_start_time", "refresh_end_time",
        elapsed(*_SECONDS).alias("rebuild_seconds"), "run_id").orderBy(
        F.desc_nulls_last("refresh_start_time"), "run_id").limit(k)


def query_profile(log: DataFrame, as_of: str, warehouse: str = "ANALYTICS", hours: int = 1, k: int = 20) -> DataFrame:
    return (log.where((F.col("warehouse_name") == warehouse) & since("start_time", as_of, hours, "hour")
                      & (F.col("execution_status") == "SUCCESS"))
            .orderBy(F.desc_nulls_last("total_elapsed_time"), "query_id").limit(k)
            .select("query_id", "query_text", "warehouse_name", "execution_status",
                    scaled("total_elapsed_time", 1000).alias("elapsed_seconds"),
                    scaled("bytes_scanned", 1 << 30).alias("gb_scanned"), "rows_produced", "partitions_scanned",
                    "partitions_total",
                    safe_ratio("partitions_scanned", "partitions_total", 100, 1).alias("prune_pct")))


def latency_summary(df: DataFrame, value: str, ok) -> DataFrame:
    """Counts over all rows; average, middle, 95 % and largest value over the successful ones, by rank."""
    counts = df.agg(F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("successful"))
    weight = F.col("last_rank") - F.col("first_rank") + 1
    ranks = ranked_values(df.where(ok).select(value), value).agg(
        (F.sum(F.col(value).cast("decimal(20,4)") * weight).cast("double") / F.sum(weight)).alias("avg_latency"),
        value_at(value, F.floor(F.col("total") / 2)).alias("p50_latency"),
        value_at(value, F.floor(F.col("total") * F.lit(0.95))).alias("p95_latency"), F.max(value).alias("max_latency"))
    both = counts.withColumn("_one", F.lit(1)).join(ranks.withColumn("_one", F.lit(1)), "_one")
    return both.select("total", "successful", (F.col("total") - F.col("successful")).alias("failed"), "avg_latency",
                       "p50_latency", "p95_latency", "max_latency")


# --- usage --------------------------------------------------------------------------------------

def credits_daily(usage: DataFrame, as_of: str, pre: str = "RISK_", days: int = 30) -> DataFrame:
    return usage.where(prefix("warehouse_name", pre) & since("start_time", as_of, days)).groupBy(
        "warehouse_name", F.to_date("start_time").alias("usage_date")).agg(
        F.sum("credits_used").cast("decimal(20,4)").alias("credits_used")).orderBy("usage_date", "warehouse_name")


def credits_total(usage: DataFrame, as_of: str, pre: str = "RISK_", days: int = 30) -> DataFrame:
    return credits_daily(usage, as_of, pre, days).groupBy("warehouse_name").agg(
        F.sum("credits_used").cast("decimal(20,4)").alias("credits_used"))


def pivot_fill(df: DataFrame, index: str, column: str, value: str, how=F.sum) -> DataFrame:
    """One column per value that occurs, in sorted order, zero where a cell has no rows. A missing value's column is
    called ``null``. The values become columns, so their number is limited by Spark's pivot limit, which fails loudly."""
    wide = df.groupBy(index).pivot(column).agg(how(value))
    return wide.select(index, *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(v) for v in wide.columns if v != index])


# --- status tables ------------------------------------------------------------------------------

def status_totals(df: DataFrame, status: str = "status") -> DataFrame:
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def progress(df: DataFrame, group: str, done: str = "Complete", status: str = "status", rounding: str = "floor") -> DataFrame:
    """Done share per group; the percent is cut (``floor``) or rounded half to even (``bround``)."""
    pct = F.col("done") / F.col("total") * 100
    pct = F.floor(pct) if rounding == "floor" else F.bround(pct, 0).cast("bigint")
    return df.groupBy(group).agg(F.count(status).alias("total"), F.count_if(F.col(status) == done).alias("done")).withColumn(
        "pct", pct)


def gantt(df: DataFrame) -> DataFrame:
    """End dates and labels of planned tasks."""
    return df.select(F.concat(F.col("id").cast("string"), F.lit(" "), F.col("task")).alias("label"), "phase", "owner",
                     "status", F.col("start_date").alias("start"), F.date_add("start_date", F.col("days")).alias("end"))


def case_filter(df: DataFrame, case: str = "All", column: str = "use_case") -> DataFrame:
    return df if case == "All" else df.where(F.col(column) == case)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def recent_count(events: DataFrame, as_of: str, channel: str | None = None, minutes: int = 5,
                 time: str = "_ingest_time") -> DataFrame:
    rows = events.where(F.col(time) >= ago(as_of, minutes, "minute"))
    if channel:
        rows = rows.where(F.col("_channel_name") == channel)
    return rows.groupBy("_channel_name").agg(F.count(F.lit(1)).alias("events_last_minutes"))


# --- lineage ------------------------------------------------------------------------------------

def first_dependencies(edges: DataFrame, k: int = 50) -> DataFrame:
    return edges.select("downstream", "upstream", "type").orderBy("upstream", "downstream", "type").limit(k)


def lineage_closure(edges: DataFrame) -> DataFrame:
    """Everything downstream of every object, with the shortest distance.

    Each round extends the paths of length ``step`` by all known paths up to that length, so ``step`` doubles and the
    number of rounds grows with the logarithm of the depth. Cycles end because a pair keeps its shortest distance. A pair
    with a distance up to ``step`` has its shortest one already, so a round writes only the pairs that it adds.
    """
    paths = newest = stored(edges.select("upstream", "downstream").distinct().withColumn("distance", F.lit(1).cast("bigint")), "paths")
    step = 1
    while not (reach := newest.where(F.col("distance") == step)).isEmpty():
        head = reach.select("upstream", F.col("downstream").alias("_mid"))
        tail = paths.select(F.col("upstream").alias("_mid"), "downstream", (F.col("distance") + step).alias("distance"))
        longer = head.join(tail, "_mid").select("upstream", "downstream", "distance")
        shortest = paths.unionByName(longer).groupBy("upstream", "downstream").agg(F.min("distance").alias("distance"))
        newest = stored(shortest.where(F.col("distance") > step), "paths")
        paths = paths.unionByName(newest)
        step *= 2
    return paths


def impact(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """Everything downstream of the given objects (column ``upstream``), with the shortest distance from any of them.

    Each round follows the edges of the objects that the last one found and leaves out those seen before, so cycles end and
    the result holds an object once, however many paths lead to it. There is one round for each step of depth.
    """
    edges = edges.select("upstream", "downstream").distinct()
    front = cut(starts.select(F.col("upstream").alias("object")).distinct().withColumn("distance", F.lit(0).cast("bigint")))
    seen = front
    while not front.isEmpty():
        found = front.join(edges, front["object"] == edges["upstream"]).select(F.col("downstream").alias("object"), F.col("distance") + 1)
        front = cut(found.toDF("object", "distance").distinct().join(seen, "object", "left_anti"))
        seen = seen.unionByName(front)
    return seen.where("distance > 0")
