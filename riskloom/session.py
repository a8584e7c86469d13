"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "riskloom", master: str | None = None, shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session with the settings the library is tuned for; cluster settings stay with the cluster."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        b = b.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder from ``spark.checkpoint.dir``; where it is unset, a folder in the session's warehouse, which all
    executors share as well."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    return root.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the scratch folder."""
    return f"{scratch_root(spark)}/riskloom/{label}-{uuid.uuid4().hex[:12]}"


def cut(df):
    """Materialise ``df`` in reliable storage and drop its lineage."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(scratch_root(spark))
    return df.checkpoint()


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write in this block go when the write has ended. Otherwise Spark keeps them until the driver happens
    to collect its garbage, so a query of several writes holds the shuffles of all of them."""
    before = spark.conf.get(RELEASE, "false")
    spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASE, before)


def _store(df, path: str):
    with released(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df, label: str = "stored"):
    """Materialise ``df`` once as compressed columns in the scratch folder and drop its lineage. For wide or many rows this
    takes a fraction of the disk of ``cut``, which keeps rows as they are in memory but also how they are distributed."""
    return _store(df, new_path(df.sparkSession, label))


@contextmanager
def held(df, label: str = "held") -> Iterator:
    """``stored`` rows that are needed in this block only; their folder goes at its end."""
    path = new_path(df.sparkSession, label)
    try:
        yield _store(df, path)
    finally:
        remove(df.sparkSession, path)


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
