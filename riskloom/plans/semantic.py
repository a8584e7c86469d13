"""Metric model: tables, relationships, dimensions and metrics, compiled to joins and group-bys."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.functions.expressions import ago


@dataclass(frozen=True)
class ModelTable:
    name: str
    key: tuple[str, ...]
    synonyms: tuple[str, ...] = ()
    comment: str = ""
    time: str | None = None


@dataclass(frozen=True)
class Relationship:
    """Many rows of ``table`` refer to one row of ``references`` by ``column``."""

    name: str
    table: str
    column: str
    references: str


@dataclass(frozen=True)
class Dimension:
    name: str
    table: str
    column: str
    comment: str = ""


@dataclass(frozen=True)
class Metric:
    """``how`` is sum, count, count_when or count_distinct; ``arg`` a column or, for count_when, a SQL condition."""

    name: str
    table: str
    how: str
    arg: str
    comment: str = ""

    @property
    def additive(self) -> bool:
        return self.how != "count_distinct"

    def build(self) -> Column:
        if self.how == "sum":
            return F.sum(self.arg)
        if self.how == "count":
            return F.count(self.arg)
        if self.how == "count_when":
            return F.count_if(F.expr(self.arg))
        return F.count_distinct(self.arg)


class SemanticModel:
    """Queries name metrics and dimensions; the model finds the tables, the joins and the grain."""

    def __init__(self, tables: Sequence[ModelTable], relationships: Sequence[Relationship],
                 dimensions: Sequence[Dimension], metrics: Sequence[Metric], data: dict[str, DataFrame] | None = None):
        self.tables = {t.name: t for t in tables}
        self.relationships = list(relationships)
        self.dimensions = {d.name: d for d in dimensions}
        self.metrics = {m.name: m for m in metrics}
        self.data = data or {}

    def over(self, data: dict[str, DataFrame]) -> SemanticModel:
        return SemanticModel(list(self.tables.values()), self.relationships, list(self.dimensions.values()),
                             list(self.metrics.values()), data)

    def _link(self, base: str, target: str) -> Relationship:
        for r in self.relationships:
            if r.table == base and r.references == target:
                return r
        raise ValueError(f"{base} has no relationship to {target}")

    def _one_base(self, base: str, metrics: list[Metric], dims: list[str], filters: dict[str, Column],
                  as_of: str | None, last_days: int | None) -> DataFrame:
        df = self.data[base]
        time = self.tables[base].time
        if as_of and last_days is not None and time:
            df = df.where(F.col(time) >= ago(as_of, last_days))
        wanted = [self.dimensions[d] for d in dict.fromkeys([*dims, *filters])]
        local = [d for d in wanted if d.table == base]
        remote = [d for d in wanted if d.table != base]
        links = {d.table: self._link(base, d.table) for d in remote}
        for d in local:
            if d.name in filters:
                df = df.where(filters[d.name])
        local = [d for d in local if d.name in dims]

        grain = [F.col(d.column).alias(d.name) for d in local]
        fks = list(dict.fromkeys(r.column for r in links.values()))
        if all(m.additive for m in metrics):
            # Aggregate to the foreign keys first: the joins then carry one row per key combination.
            df = df.groupBy(*grain, *fks).agg(*[m.build().alias(m.name) for m in metrics])
            final = [F.sum(m.name).alias(m.name) for m in metrics]
        else:
            df = df.select(*grain, *fks, *[c for c in df.columns if c not in fks and c not in dims])
            final = [m.build().alias(m.name) for m in metrics]
        for target, r in links.items():
            picked = [d for d in remote if d.table == target]
            right = self.data[target].select(F.col(self.tables[target].key[0]).alias(r.column),
                                             *[F.col(d.column).alias(d.name) for d in picked])
            df = df.join(right, r.column, "left")
            for d in picked:
                if d.name in filters:
                    df = df.where(filters[d.name])
        return df.groupBy(*dims).agg(*final)

    def query(self, metrics: Sequence[str], dimensions: Sequence[str] = (), filters: dict[str, Column] | None = None,
              as_of: str | None = None, last_days: int | None = 30) -> DataFrame:
        """Metrics by dimensions. With ``as_of`` and no other wish the last 30 days count; decimals have two places."""
        asked = [self.metrics[m] for m in metrics]
        dims = list(dimensions)
        parts = []
        for base in dict.fromkeys(m.table for m in asked):
            parts.append(self._one_base(base, [m for m in asked if m.table == base], dims, filters or {}, as_of, last_days))
        if len(parts) == 1:
            out = parts[0]
        elif dims:
            keyed = [p.select(*[F.col(d) for d in dims], *[c for c in p.columns if c not in dims]) for p in parts]
            out = reduce(lambda a, b: _null_safe_outer(a, b, dims), keyed)
        else:
            one = [p.withColumn("_one", F.lit(1)) for p in parts]
            out = reduce(lambda a, b: a.join(b, "_one"), one).drop("_one")
        typed = []
        for m in asked:
            c = F.coalesce(F.col(m.name), F.lit(0)) if m.how != "sum" else F.col(m.name)
            wide = out.schema[m.name].dataType.simpleString().startswith("decimal")
            typed.append((F.round(c, 2).cast("decimal(24,2)") if wide else c.cast("bigint")).alias(m.name))
        return out.select(*dims, *typed)

    def catalog(self, spark: SparkSession) -> DataFrame:
        """All metrics and dimensions with table, expression, synonyms and comment."""
        rows = [("METRIC", m.name, m.table, f"{m.how}({m.arg})", ", ".join(self.tables[m.table].synonyms), m.comment)
                for m in self.metrics.values()]
        rows += [("DIMENSION", d.name, d.table, d.column, ", ".join(self.tables[d.table].synonyms), d.comment)
                 for d in self.dimensions.values()]
        return spark.createDataFrame(rows, "kind string, name string, table_name string, expression string, "
                                           "synonyms string, comment string")


def _null_safe_outer(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join that also matches NULL dimension values; both sides have one row per key."""
    right = b.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    cond = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    j = a.join(right, cond, "full_outer")
    return j.select(*[F.coalesce(k, f"_r_{k}").alias(k) for k in keys],
                    *[c for c in a.columns if c not in keys], *[c for c in b.columns if c not in keys])


# The fraud analytics model.
FRAUD_MODEL = SemanticModel(
    tables=(
        ModelTable("daily_summary", ("member_id", "txn_date"), ("transactions", "daily transactions"),
                   "Daily totals per member", "txn_date"),
        ModelTable("fraud_signals", ("signal_id",), ("fraud", "alerts", "fraud alerts"),
                   "Alerts and risky events", "signal_time"),
        ModelTable("members", ("member_id",), ("customers", "members"), "Member profiles with recent activity"),
        ModelTable("institutions", ("institution_id",), ("banks", "financial institutions"),
                   "Recent activity per institution"),
    ),
    relationships=(
        Relationship("daily_summary_to_members", "daily_summary", "member_id", "members"),
        Relationship("daily_summary_to_institutions", "daily_summary", "institution_id", "institutions"),
        Relationship("fraud_to_members", "fraud_signals", "member_id", "members"),
        Relationship("fraud_to_institutions", "fraud_signals", "institution_id", "institutions"),
    ),
    dimensions=(
        Dimension("transaction_date", "daily_summary", "txn_date", "Day of the transactions"),
        Dimension("signal_source", "fraud_signals", "signal_source", "ALERT or HIGH_RISK_EVENT"),
        Dimension("severity", "fraud_signals", "severity", "Alert severity"),
        Dimension("risk_tier", "members", "risk_tier", "LOW, MEDIUM, HIGH or CRITICAL"),
        Dimension("institution_name", "institutions", "institution_name", "Name of the institution"),
        Dimension("institution_type", "institutions", "institution_type", "BANK, CREDIT_UNION, FINTECH or PROCESSOR"),
        Dimension("region", "institutions", "region", "Region of the institution"),
    ),
    metrics=(
        Metric("total_transactions", "daily_summary", "sum", "txn_count", "Number of transactions"),
        Metric("total_volume", "daily_summary", "sum", "total_amount", "Sum of amounts"),
        Metric("total_fraud_signals", "fraud_signals", "count", "signal_id", "Number of signals"),
        Metric("critical_signals", "fraud_signals", "count_when", "severity = 'CRITICAL'", "Signals of critical severity"),
        Metric("total_members", "members", "count_distinct", "member_id", "Number of members"),
        Metric("total_institutions", "institutions", "count_distinct", "institution_id", "Number of institutions"),
    ),
)


# --- canned questions ---------------------------------------------------------------------------

def signals_this_week(model: SemanticModel, as_of: str) -> DataFrame:
    return model.query(["total_fraud_signals"], ["signal_source"], as_of=as_of, last_days=7)


def signals_by_severity(model: SemanticModel) -> DataFrame:
    return model.query(["total_fraud_signals"], ["severity"])


def critical_banks(model: SemanticModel, k: int = 10, kind: str = "BANK") -> DataFrame:
    rows = model.query(["critical_signals"], ["institution_name"], {"institution_type": F.col("institution_type") == kind})
    return rows.orderBy(F.desc("critical_signals"), "institution_name").limit(k)


def critical_banks_recent(model: SemanticModel, as_of: str, k: int = 10, kind: str = "BANK") -> DataFrame:
    """The refinement of the question before: only the last 30 days."""
    rows = model.query(["critical_signals"], ["institution_name"],
                       {"institution_type": F.col("institution_type") == kind}, as_of=as_of)
    return rows.orderBy(F.desc("critical_signals"), "institution_name").limit(k)


def volume_trend(model: SemanticModel, as_of: str) -> DataFrame:
    return model.query(["total_transactions", "total_volume"], ["transaction_date"], as_of=as_of).orderBy("transaction_date")


def top_institutions_by_volume(model: SemanticModel, as_of: str, k: int = 10) -> DataFrame:
    rows = model.query(["total_volume"], ["institution_name"], as_of=as_of)
    return rows.orderBy(F.col("total_volume").desc_nulls_last(), "institution_name").limit(k)


def signal_overview(signals: DataFrame) -> DataFrame:
    return signals.groupBy("signal_source", "severity").agg(
        F.count(F.lit(1)).alias("signals"), F.count_distinct("member_id").alias("members"),
        F.count_distinct("institution_id").alias("institutions"))
