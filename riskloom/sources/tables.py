"""Zone tables: append, replace, snapshots and as-of reads over Parquet folders."""

from __future__ import annotations

import json
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import released

SNAPSHOT = "snapshot_ts"


def table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A table by catalogue name, or a Parquet folder by path."""
    return spark.read.parquet(name_or_path) if "/" in name_or_path else spark.table(name_or_path)


def _spread(df: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """Rows of one output partition together, so it gets few files; adaptive execution splits a partition that is large."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def append(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    _spread(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def replace(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), spread: bool = True) -> None:
    """Overwrite a table. Without ``spread`` rows stay in their task, so there is no shuffle, but up to one file per task and
    output partition."""
    _overwrite(df, path, partition_by, spread, "static")


def replace_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...], spread: bool = False) -> None:
    """Overwrite only the partitions that ``df`` has rows for; ``spread`` as in ``replace``."""
    _overwrite(df, path, partition_by, spread, "dynamic")


def _overwrite(df: DataFrame, path: str, partition_by: tuple[str, ...], spread: bool, mode: str) -> None:
    df = _spread(df, partition_by) if spread else df
    with released(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").option("partitionOverwriteMode", mode).partitionBy(*partition_by).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder has data: a writer's markers alone do not count."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return any("=" in n or not n.startswith(("_", ".")) for n in names)


def _key(ts: str | datetime | date) -> str:
    """Sortable, path-safe form of a moment, to the microsecond. A date alone is its midnight."""
    if isinstance(ts, str):
        ts = datetime.fromisoformat(ts.strip())
    if not isinstance(ts, datetime):
        ts = datetime(ts.year, ts.month, ts.day)
    if ts.tzinfo is not None:
        ts = ts.astimezone(timezone.utc)
    return ts.strftime("%Y-%m-%dT%H-%M-%S.%f")


def snapshot(df: DataFrame, path: str, ts: str | datetime | date) -> None:
    """Keep the state of a table at ``ts``. Writing the same ``ts`` again replaces it, so a retry is safe."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(f"{path}/{SNAPSHOT}={_key(ts)}")


def snapshot_each(df: DataFrame, path: str, time: str) -> None:
    """Several snapshots in one write, one per value of the column ``time``."""
    keyed = df.withColumn(SNAPSHOT, F.date_format(time, "yyyy-MM-dd'T'HH-mm-ss.SSSSSS"))
    replace_partitions(keyed, path, (SNAPSHOT,), spread=True)


def snapshots(spark: SparkSession, path: str) -> list[str]:
    """Snapshot keys of a table, oldest first: a folder listing, one entry per snapshot."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{SNAPSHOT}="))


def read_as_of(spark: SparkSession, path: str, ts: str | datetime | date) -> DataFrame:
    """The table as it stood at ``ts``: the newest snapshot not after it. Only that snapshot's files are read."""
    known = [k for k in snapshots(spark, path) if k <= _key(ts)]
    if not known:
        raise ValueError(f"no snapshot of {path} at or before {ts}")
    return spark.read.parquet(f"{path}/{SNAPSHOT}={known[-1]}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small text file. It is written beside its place and then renamed over it in one step, so a reader finds the
    old or the new text at any time."""
    fs = spark._jvm.org.apache.hadoop.fs
    target, part = fs.Path(path), fs.Path(path + ".tmp")
    conf = spark._jsc.hadoopConfiguration()
    out = target.getFileSystem(conf).create(part, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    options = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    options[0] = fs.Options.Rename.OVERWRITE
    fs.FileContext.getFileContext(target.toUri(), conf).rename(part, target, options)


def export_product(tables: dict[str, DataFrame], path: str, as_of: str, contract: dict | None = None) -> dict:
    """Write Gold tables as a data product: Parquet folders and a manifest with schema, row count and time."""
    spark = next(iter(tables.values())).sparkSession
    entries = {}
    for name, df in tables.items():
        target = f"{path}/{name}"
        replace(df, target)
        entries[name] = {"path": name, "rows": spark.read.parquet(target).count(),
                         "schema": [[f.name, f.dataType.simpleString()] for f in df.schema.fields]}
    manifest = {"as_of": as_of, "contract": contract or {}, "tables": entries}
    write_text(spark, f"{path}/manifest.json", json.dumps(manifest, indent=1))
    return manifest
