"""Batch load with partial acceptance: typed good rows, rejects with reasons, an audit per file."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.expressions import ago, icontains
from riskloom.operators.merge import apply_defaults, update_by_key
from riskloom.sources.files import BLOCK, FILE, PLACE, RECORD, parse_time
from riskloom.sources.formats import Contract, Field


def good_rows(checked: DataFrame) -> DataFrame:
    """Rows without an error, in the columns of the target."""
    # The ordinal keeps the filter above the conversions; without it they would run once more inside the filter.
    return checked.where((F.size("errors") == 0) & (F.col("_row_number") >= 0)).drop("errors", RECORD, "_row_number", BLOCK, PLACE)


@dataclass(frozen=True)
class Load:
    """Outcome of one load. ``checked`` holds every row with its ``errors``; the two views split it."""

    checked: DataFrame
    contract: Contract

    @property
    def good(self) -> DataFrame:
        return good_rows(self.checked)

    @property
    def rejects(self) -> DataFrame:
        keep = [c for c in (FILE, "_row_number", RECORD, "errors", BLOCK, PLACE) if c in self.checked.columns]
        return self.checked.where((F.size("errors") > 0) & (F.col("_row_number") >= 0)).select(*keep)


def _convert(f: Field, pattern: str) -> Column:
    v = F.col(f.name)
    if f.kind == "string":
        return v
    if f.kind == "timestamp":
        return parse_time(v, pattern)
    if f.kind == "date":
        return F.try_to_date(v, "yyyy-MM-dd")
    return v.try_cast(f.kind)


def _errors(f: Field) -> list[Column]:
    """Problems of one column as ``(column, message)`` structs, NULL where there is none."""
    raw, typed = F.col(f"_raw.{f.name}"), F.col(f.name)
    def problem(cond: Column, text: str) -> Column:
        return F.when(cond, F.struct(F.lit(f.name).alias("column_name"), F.lit(text).alias("error")))
    out = []
    if f.required:
        out.append(problem(raw.isNull(), f"NULL result in a non-nullable column {f.name}"))
    if f.kind != "string" and f.strict:
        out.append(problem(raw.isNotNull() & typed.isNull(), f"Conversion of {f.name} to {f.kind} failed"))
    if f.max_len:
        out.append(problem(F.length(raw) > f.max_len, f"String of {f.name} exceeds {f.max_len} characters"))
    if f.pattern:
        out.append(problem(~raw.rlike(f"^(?:{f.pattern})$"), f"String of {f.name} does not match {f.pattern}"))
    return out


def load_batch(raw: DataFrame, contract: Contract, loaded_at: Column) -> Load:
    """Convert text columns to their types in one pass. A row with any error is a reject; the batch goes on.

    ``_row_number`` is the ordinal of the row with its input split in the high bits. Rows of ``read_numbered`` can be given
    their line in the file by ``line_numbers``.
    """
    watched = [f.name for f in contract.fields if f.required or f.max_len or f.pattern or (f.kind != "string" and f.strict)]
    keep = [c for c in raw.columns if c not in contract.names]
    typed = raw.select(*[_convert(f, contract.time_pattern).alias(f.name) for f in contract.fields], *keep,
                       F.struct(*watched).alias("_raw"))
    found = [e for f in contract.fields for e in _errors(f)]
    checked = typed.select(*contract.names, *keep, F.monotonically_increasing_id().alias("_row_number"),
                           F.array_compact(F.array(*found)).alias("errors"))
    defaults = {c: F.lit(v).cast(kind) for c, (kind, v) in contract.defaults.items()}
    return Load(apply_defaults(checked, defaults).withColumn("_loaded_at", loaded_at), contract)


def classify(message: Column) -> Column:
    """Class of a reject, first rule that applies."""
    return (F.when(icontains(message, "conversion"), "TYPE_MISMATCH").when(icontains(message, "parse"), "PARSE_ERROR")
            .when(icontains(message, "null") | icontains(message, "exceeds") | icontains(message, "match"), "CONSTRAINT").otherwise("UNKNOWN"))


def dead_letter(rejects: DataFrame, source_table: str, now: Column, deterministic_id: bool = True) -> DataFrame:
    """One dead-letter row per error of a rejected record."""
    each = rejects.withColumn("_row_number", F.col("_row_number") if "_row_number" in rejects.columns else F.lit(None))
    each = each.select(F.col(FILE).alias("source_file"), F.col("_row_number").cast("bigint").alias("row_number"),
                       F.col(RECORD).alias("rejected_record"), F.posexplode("errors").alias("_pos", "_e"))
    ident = (F.sha2(F.concat_ws("|", F.lit(source_table), "source_file", "row_number", "rejected_record", "_pos"), 256)
             if deterministic_id else F.uuid())
    return each.select(
        ident.alias("rejection_id"), F.lit(source_table).alias("source_table"), "source_file", "row_number",
        "rejected_record", F.col("_e.error").alias("error_message"), F.col("_e.column_name").alias("error_column_name"),
        classify(F.col("_e.error")).alias("error_category"), now.alias("rejection_timestamp"),
        F.lit(False).alias("reprocessed"), F.lit(None).cast("timestamp_ntz").alias("reprocessed_at"))


def union_dead_letters(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def reject_summary(dl: DataFrame) -> DataFrame:
    return dl.where(~F.col("reprocessed")).groupBy("source_table", "error_category").agg(
        F.count(F.lit(1)).alias("rejection_count"), F.min("rejection_timestamp").alias("first_rejection"),
        F.max("rejection_timestamp").alias("last_rejection")).orderBy("source_table", F.desc("rejection_count"))


def reject_by_file(dl: DataFrame, as_of: str) -> DataFrame:
    return dl.where(F.col("rejection_timestamp") >= ago(as_of, 1)).groupBy(
        "source_table", "source_file", F.to_date("rejection_timestamp").alias("load_date")).agg(
        F.count(F.lit(1)).alias("rejected_rows")).orderBy(F.desc("rejected_rows"))


def mark_reprocessed(dl: DataFrame, ids: DataFrame, now: Column) -> DataFrame:
    """Flag the given ``rejection_id`` values as reprocessed."""
    done = ids.select("rejection_id").distinct().withColumn("reprocessed", F.lit(True))
    return update_by_key(dl, done, "rejection_id", stamp="reprocessed_at", now=now)


def load_audit(load: Load, now: Column) -> DataFrame:
    """Rows parsed, loaded and rejected per file; also the ledger of loaded files."""
    bad = F.size("errors") > 0
    counts = load.checked.groupBy(F.col(FILE).alias("path")).agg(
        F.count(F.lit(1)).alias("rows_parsed"), F.count_if(~bad).alias("rows_loaded"), F.count_if(bad).alias("rows_rejected"))
    return with_status(counts.withColumns({"table_name": F.lit(load.contract.table), "last_load_time": now}))


def with_status(audit: DataFrame) -> DataFrame:
    """Outcome of a load from its counts."""
    return audit.withColumn("status", F.when(F.col("rows_rejected") == 0, "LOADED").when(F.col("rows_loaded") == 0, "LOAD_FAILED")
                            .otherwise("PARTIALLY_LOADED"))


def recent_loads(audit: DataFrame, as_of: str, hours: int = 1, k: int = 10) -> DataFrame:
    return (audit.where(F.col("last_load_time") >= ago(as_of, hours, "hour"))
            .orderBy(F.desc_nulls_last("last_load_time"), "table_name", "path").limit(k))
