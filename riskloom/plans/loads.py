"""A batch load from landing folder to target, once per file.

``run_load`` lists the landing prefix, takes the files that no committed load has, parses them once, and stores the checked
rows, dead letters and the audit of that pass. The good rows are those of the checked ones without an error: they are stored
once, without the text of their record, which only rejects need. The ledger of files is written last and is the commit: readers see only loads that
are in it. A load is named by its files, so a load that failed is written over by the next one with the same files, and
what a failed load left behind is never read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.plans import ingest
from riskloom.sources.files import RECORD, list_landing, pending_files
from riskloom.sources.formats import Contract
from riskloom.sources.tables import replace

LOAD = "load_id"
Reader = Callable[[list[str]], DataFrame]


@dataclass
class LoadStore:
    """Tables ``checked``, ``dead_letter``, ``audit`` and ``ledger`` of one target, in one folder per load, and the good rows
    (``good``) of the first."""

    spark: SparkSession
    root: str

    def _part(self, table: str, load_id: str) -> str:
        return f"{self.root}/{table}/{LOAD}={load_id}"

    def committed(self) -> list[str]:
        """Names of the loads in the ledger: a folder listing, one entry per load."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/ledger")
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [s.getPath() for s in fs.listStatus(p)] if fs.exists(p) else []
        done = [d.getName().split("=", 1)[1] for d in found if "=" in d.getName()
                and fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(d, "_SUCCESS"))]
        return sorted(done)

    def read(self, table: str) -> DataFrame | None:
        """Rows of all committed loads; None before the first."""
        if table == "good":
            rows = self.read("checked")
            return None if rows is None else ingest.good_rows(rows)
        parts = [self._part(table, i) for i in self.committed()]
        return self.spark.read.option("basePath", f"{self.root}/{table}").parquet(*parts) if parts else None

    def write(self, table: str, load_id: str, df: DataFrame) -> DataFrame:
        replace(df, self._part(table, load_id))
        return self.spark.read.parquet(self._part(table, load_id))


def run_load(store: LoadStore, landing: str, contract: Contract, reader: Reader, now: Column) -> dict:
    """Load what is new below ``landing``. Returns the load's id (None: nothing new) and its counts."""
    spark = store.spark
    ledger = store.read("ledger")
    listing = list_landing(spark, landing)
    fresh = pending_files(listing, ledger) if ledger is not None else listing
    # The driver needs the paths to read them, as Spark's own listing does: one short text per file.
    paths = sorted(r["path"] for r in fresh.select("path").collect())
    if not paths:
        return {LOAD: None, "files": 0, "rows_loaded": 0, "rows_rejected": 0}
    load_id = spark.range(1).select(F.sha2(F.lit("\n".join(paths)), 256)).head()[0][:24]
    load = ingest.load_batch(reader(paths), contract, now)
    checked = store.write("checked", load_id, load.checked.withColumn(RECORD, F.when(F.size("errors") > 0, F.col(RECORD))))
    once = ingest.Load(checked, contract)
    store.write("dead_letter", load_id, ingest.dead_letter(once.rejects, contract.table, now))
    counts = store.write("audit", load_id, ingest.load_audit(once, now)).agg(
        F.sum("rows_loaded").alias("rows_loaded"), F.sum("rows_rejected").alias("rows_rejected")).head()
    store.write("ledger", load_id, spark.createDataFrame([(p,) for p in paths], "path string"))
    return {LOAD: load_id, "files": len(paths), "rows_loaded": counts["rows_loaded"] or 0, "rows_rejected": counts["rows_rejected"] or 0}
