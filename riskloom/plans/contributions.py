"""Incremental refresh of recent totals: what a load changes is added and taken off, nothing else is read again.

A load is turned into signed rows: the new version of a transaction (1) and the version that it replaces (-1). The replaced
versions are found through an index from transaction to Silver partition, so only partitions that hold one are opened.

``Totals`` keep, per key, sums that can be added to and taken off from, and maxima. A distinct count is the number of keys of
a finer grain whose count is not zero, so it survives removals as well. A maximum is made anew only for keys that lost it.

The signed rows of a load are written first and are the only source of its later steps. Each step replaces whole partitions,
and a row of totals knows the last load in it, so a load that stopped anywhere can be run again under its number.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.expressions import ago
from riskloom.operators.latest import keep_latest
from riskloom.plans.medallion import PART, _drop_parts, _exists, with_part
from riskloom.plans.silver import TXN_TIES, cleanse_transactions
from riskloom.session import stored
from riskloom.sources.tables import exists, replace, replace_partitions
from riskloom.streaming.keyed import same, upsert

BUCKETS = 64
SIGN, LOAD, BUCKET = "sign", "_load", "_bucket"


def bucket(*keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int").alias(BUCKET)


@dataclass(frozen=True)
class Totals:
    """Sums (type and value of a row) and maxima (column) per key."""

    name: str
    keys: tuple[str, ...]
    sums: dict[str, tuple[str, Callable[[], Column]]]
    largest: dict[str, str]


MEMBER_TOTALS = Totals("member_totals", ("member_id", "channel"), {
    "n": ("bigint", lambda: F.lit(1)), "amount": ("decimal(28,2)", lambda: F.col("amount"))}, {"last_txn_time": "txn_timestamp"})
INSTITUTION_TOTALS = Totals("institution_totals", ("institution_id", "member_id"), {
    "n": ("bigint", lambda: F.lit(1)), "amount": ("decimal(28,2)", lambda: F.col("amount")),
    "risk": ("decimal(28,2)", lambda: F.coalesce("risk_score", F.lit(0))),
    "risk_n": ("bigint", lambda: F.when(F.col("risk_score").isNotNull(), 1).otherwise(0))}, {})


class Zone:
    """Silver transactions in monthly folders with their index and totals, below one folder."""

    def __init__(self, spark: SparkSession, root: str, as_of: str, days: int = 30, totals: tuple[Totals, ...] = (MEMBER_TOTALS, INSTITUTION_TOTALS)):
        self.spark, self.root, self.totals, self.as_of, self.days = spark, root.rstrip("/"), totals, as_of, days

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def silver(self) -> DataFrame:
        return self.spark.read.parquet(self.path("silver"))

    def start(self) -> Column:
        return ago(self.as_of, self.days)

    def recent(self) -> DataFrame:
        """Silver rows of the window; older folders are not opened."""
        return self.silver().where((F.col(PART) >= F.trunc(F.to_date(self.start()), "month")) & (F.col("txn_timestamp") >= self.start()))

    # --- a load -----------------------------------------------------------------------------------

    def load(self, raw: DataFrame, number: int) -> None:
        """Folds raw rows into Silver and all totals. The same number again finishes or repeats the load."""
        signed = self._signed(raw, number)
        self._silver(signed)
        upsert(signed.where("sign > 0").select("txn_id", PART, bucket("txn_id")), self.path("index"), BUCKET, ["txn_id"])
        for t in self.totals:
            self.apply(t, signed.where(F.col("txn_timestamp") >= self.start()), number)

    def _signed(self, raw: DataFrame, number: int) -> DataFrame:
        path = self.path(f"loads/{number}")
        if not _exists(self.spark, path):
            new = with_part(cleanse_transactions(raw), "txn_timestamp", "month")
            if exists(self.spark, self.path("index")):
                # Both are read several times: made once, neither Bronze nor Silver is gone through again.
                new = stored(new, "load")
                old = stored(self.replaced(new.select("txn_id")), "replaced")
                best = keep_latest(old.withColumn("_old", F.lit(True)).unionByName(new.withColumn("_old", F.lit(False))),
                                   ["txn_id"], ["_loaded_at"], TXN_TIES)
                new = best.where("NOT _old").drop("_old")
                lost = old.join(new.select("txn_id"), "txn_id", "left_semi")
                new = new.withColumn(SIGN, F.lit(1)).unionByName(lost.withColumn(SIGN, F.lit(-1)))
            else:
                new = new.withColumn(SIGN, F.lit(1))
            replace(new, path)
        return self.spark.read.parquet(path)

    def replaced(self, ids: DataFrame) -> DataFrame:
        """Stored versions of the given transactions. The index is read in the buckets of the ids, Silver in the partitions
        that the index names: one value a month, and at most ``BUCKETS`` buckets, come to the driver."""
        asked = ids.select("txn_id", bucket("txn_id"))
        wanted = [r[0] for r in asked.select(BUCKET).distinct().collect()]
        index = self.spark.read.parquet(self.path("index")).where(F.col(BUCKET).isin(wanted))
        parts = [r[0] for r in index.join(asked.select("txn_id"), "txn_id", "left_semi").select(PART).distinct().collect()]
        return self.silver().where(F.col(PART).isin(parts)).join(ids, "txn_id", "left_semi")

    def _silver(self, signed: DataFrame) -> None:
        """Rows are written by the task that holds them, as in ``write_parts``."""
        path = self.path("silver")
        new = signed.where("sign > 0").drop(SIGN)
        emptied: list = []
        if exists(self.spark, path):
            parts, emptied = self._unmerged(signed)
            rest = self.silver().where(F.col(PART).isin(parts)).join(new.select("txn_id"), "txn_id", "left_anti")
            new = new.where(F.col(PART).isin(parts)).unionByName(rest)
            if not parts:
                return
        replace_partitions(new, path, (PART,))
        _drop_parts(self.spark, path, emptied)

    def _unmerged(self, signed: DataFrame) -> tuple[list, list]:
        """Partitions whose rows are not yet those that the load leaves there, and which of them it leaves empty. Only ids,
        partitions and a hash of each row are joined. A repeated load finds that it is in Silver already."""
        parts = [r[0] for r in signed.select(PART).distinct().collect()]
        columns = sorted(c for c in signed.columns if c not in (PART, SIGN))
        def brief(df: DataFrame) -> DataFrame:
            return df.select("txn_id", PART, F.xxhash64(*columns).alias("_hash"))
        held = brief(self.silver().where(F.col(PART).isin(parts))).alias("s")
        new = brief(signed.where("sign > 0"))
        loaded = F.col("n.txn_id").isNotNull()
        as_new = loaded & (F.col(f"s.{PART}") == F.col(f"n.{PART}")) & (F.col("s._hash") == F.col("n._hash"))
        found = held.join(new.alias("n"), F.col("s.txn_id") == F.col("n.txn_id"), "left").groupBy(F.col(f"s.{PART}").alias(PART)).agg(
            F.count_if(~loaded).alias("rest"), F.count_if(as_new).alias("same"), F.count_if(loaded & ~as_new).alias("stale"))
        wanted = new.groupBy(PART).agg(F.count(F.lit(1)).alias("rows"))
        # One row per calendar month.
        state = wanted.join(found, PART, "full_outer").na.fill(0).collect()
        open_ = [r[PART] for r in state if r["stale"] or r["same"] != r["rows"]]
        return open_, [r[PART] for r in state if r[PART] in open_ and not r["rest"] and not r["rows"]]

    # --- totals -----------------------------------------------------------------------------------

    def apply(self, t: Totals, signed: DataFrame, number: int) -> None:
        """Adds signed rows to the totals. A row that holds this load already stays as it is."""
        def value(expr: Column) -> Column:
            return F.sum(F.when(F.col(SIGN) > 0, expr).otherwise(-expr))
        added = [value(expr()).cast(kind).alias(c) for c, (kind, expr) in t.sums.items()]
        tops = [F.max(F.when(F.col(SIGN) > 0, F.col(v))).alias(c) for c, v in t.largest.items()]
        lost = [F.max(F.when(F.col(SIGN) < 0, F.col(v))).alias(f"_lost_{c}") for c, v in t.largest.items()]
        change = signed.groupBy(*t.keys).agg(*added, *tops, *lost).withColumns({LOAD: F.lit(number), BUCKET: bucket(*t.keys)})
        change = change.persist()
        columns = [*t.keys, *t.sums, *t.largest, LOAD, BUCKET]
        try:
            if not exists(self.spark, self.path(t.name)):
                replace_partitions(change.select(*columns), self.path(t.name), (BUCKET,), spread=True)
                return
            touched = [r[0] for r in change.select(BUCKET).distinct().collect()]
            old = self.spark.read.schema(change.select(*columns).schema).parquet(self.path(t.name)).where(F.col(BUCKET).isin(touched))
            j = change.alias("d").join(old.alias("o"), same("d", "o", t.keys), "left")
            held = F.coalesce(F.col(f"o.{LOAD}") >= number, F.lit(False))
            pick = {c: (F.coalesce(f"o.{c}", F.lit(0)) + F.col(f"d.{c}")).cast(kind) for c, (kind, _) in t.sums.items()}
            pick |= {c: F.greatest(f"o.{c}", f"d.{c}") for c in t.largest}
            gone = reduce(Column.__or__, [F.coalesce(F.col(f"d._lost_{c}") >= F.col(f"o.{c}"), F.lit(False)) for c in t.largest], F.lit(False))
            new = j.select(*[F.col(f"d.{k}") for k in t.keys], *[F.when(held, F.col(f"o.{c}")).otherwise(v).alias(c) for c, v in pick.items()],
                           F.when(held, F.col(f"o.{LOAD}")).otherwise(F.col(f"d.{LOAD}")).alias(LOAD), F.col(f"d.{BUCKET}"),
                           (gone & ~held).alias("_again"))
            new = self._largest_again(t, new) if t.largest else new.drop("_again")
            rest = old.alias("o").join(change.alias("n"), same("o", "n", t.keys), "left_anti")
            replace_partitions(new.select(*columns).unionByName(rest), self.path(t.name), (BUCKET,), spread=True)
        finally:
            change.unpersist()

    def _largest_again(self, t: Totals, new: DataFrame) -> DataFrame:
        """Maxima of the keys that lost theirs, from the window's Silver rows of these keys alone."""
        again = new.where("_again").select(*t.keys).alias("k")
        rows = self.recent().alias("r").join(again, same("r", "k", t.keys), "left_semi")
        tops = rows.groupBy(*t.keys).agg(*[F.max(v).alias(f"_{c}") for c, v in t.largest.items()]).alias("m")
        j = new.alias("n").join(tops, same("n", "m", t.keys), "left")
        return j.select(*[F.col(f"n.{c}") for c in new.columns if c not in (*t.largest, "_again")],
                        *[F.when(F.col("_again"), F.col(f"m._{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in t.largest])

    def advance(self, as_of: str, number: int) -> None:
        """Moves the window: rows that leave it are taken off. Only the folders of its edge are opened."""
        before, self.as_of = self.start(), as_of
        edge = (F.col(PART) >= F.trunc(F.to_date(before), "month")) & (F.col(PART) <= F.to_date(self.start()))
        left = self.silver().where(edge & (F.col("txn_timestamp") >= before) & (F.col("txn_timestamp") < self.start()))
        for t in self.totals:
            self.apply(t, left.withColumn(SIGN, F.lit(-1)), number)

    def held(self, t: Totals) -> DataFrame:
        """Keys that still have rows."""
        return self.spark.read.parquet(self.path(t.name)).where("n > 0").drop(LOAD, BUCKET)


def _ratio(part: str, whole: str) -> Column:
    return F.sum(part).cast("double") / F.nullif(F.sum(whole), F.lit(0)).cast("double")


def recent_by_member(totals: DataFrame) -> DataFrame:
    """The transaction side of member activity, from totals per member and channel."""
    return totals.groupBy("member_id").agg(
        F.sum("n").alias("_n"), F.sum("amount").cast("decimal(18,2)").alias("_sum"), _ratio("amount", "n").alias("avg_txn_30d"),
        F.max("last_txn_time").alias("last_txn_time"), F.count("channel").alias("_channels"))


def recent_by_institution(totals: DataFrame) -> DataFrame:
    """The transaction side of the institution summary, from totals per institution and member."""
    return totals.groupBy("institution_id").agg(
        F.count("member_id").alias("_members"), F.sum("n").alias("_n"), F.sum("amount").cast("decimal(18,2)").alias("_sum"),
        _ratio("risk", "risk_n").alias("avg_risk_score"))
