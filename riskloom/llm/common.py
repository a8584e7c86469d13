"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.session import cut, new_path

__all__ = ["ascii_lower", "cut", "read_table", "ship_package", "stored", "sub_batches", "text_or_empty"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_SHIPPED: set[str] = set()


ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package through Spark's file server, once per application, and limit the
    batches of texts that are sent to them by bytes, so that long texts do not need more memory."""
    spark.conf.set(ARROW_BYTES, "8m")
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="riskloom-"), "riskloom.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("riskloom", os.path.relpath(path, top)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: str | Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(col, UPPER, LOWER)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written once in the shared folder and read again, so later readers scan only the columns they use."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sub_batches(sizes: Iterable[int], limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each, one row at least."""
    start = total = at = 0
    for at, size in enumerate(sizes):
        if total and total + size > limit:
            yield start, at
            start, total = at, 0
        total += size
    if total or at >= start:
        yield start, at + 1
