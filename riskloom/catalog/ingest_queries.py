"""Batch ingest: landing files derived from the given tables are written, read back and loaded."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.catalog.registry import query
from riskloom.functions.expressions import at
from riskloom.plans import ingest
from riskloom.plans.lake import Lake
from riskloom.plans.loads import LoadStore, run_load
from riskloom.session import held, new_path, released, remove, stored
from riskloom.sources import files
from riskloom.sources import formats as fm

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
BUCKET = "_src"


def write_lines(lake: Lake, rows: DataFrame, header: str | None = None, bucket: str | None = None, compression: str = "none") -> str:
    """Text files of the ``line`` column, each with the header as its first line."""
    path = new_path(lake.spark, "landing")
    out = rows.select(F.col("line").alias(header or "line"), *([F.col(bucket).alias(BUCKET)] if bucket else []))
    w = out.write.option("header", str(header is not None).lower()).option("sep", "\u0001").option("quote", "")
    w = w.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").option("compression", compression)
    with released(lake.spark):
        (w.partitionBy(BUCKET) if bucket else w).csv(path)
    return path


def transaction_files(lake: Lake) -> str:
    return write_lines(lake, lake.raw("landing_transactions"), "|".join(fm.TRANSACTIONS.names), "_source_file")


def transaction_load(lake: Lake, path: str) -> ingest.Load:
    text = files.read_delimited(lake.spark, path, fm.PIPE, fm.TRANSACTIONS.names)
    return ingest.load_batch(text, fm.TRANSACTIONS, at(lake.as_of))


GOOD_TXN = "k % 53 <> 0 AND k % 59 <> 0 AND k % 61 <> 0"


@query("ingest_delimited", f"""
SELECT txn_id, trim(member_id) AS member_id, institution_id, txn_timestamp, amount, currency_code, txn_type, channel,
  trim(merchant_category) AS merchant_category, CASE WHEN k % 71 = 0 THEN 'a|b' ELSE trim(merchant_name) END AS merchant_name,
  merchant_country, status, CASE WHEN k % 73 <> 0 THEN auth_code END AS auth_code,
  CASE WHEN k % 73 <> 0 THEN card_last_four END AS card_last_four, CASE WHEN k % 73 <> 0 THEN ip_address END AS ip_address,
  CASE WHEN k % 73 <> 0 THEN device_fingerprint END AS device_fingerprint,
  CASE WHEN k % 73 <> 0 AND k % 67 <> 0 THEN risk_score END AS risk_score, {NOW} AS _loaded_at
FROM landing_transactions WHERE {GOOD_TXN}""")
def ingest_delimited(lake: Lake):
    return transaction_load(lake, transaction_files(lake)).good.drop(files.FILE)


def _reject(column: str, message: str, kind: str, cond: str) -> str:
    return (f"SELECT 'BRONZE.RAW_TRANSACTIONS' AS source_table, line AS rejected_record, '{column}' AS error_column_name, "
            f"'{message}' AS error_message, '{kind}' AS error_category FROM landing_transactions WHERE {cond}")


REJECTS = " UNION ALL ".join((
    _reject("txn_id", "NULL result in a non-nullable column txn_id", "CONSTRAINT", "k % 61 = 0"),
    _reject("txn_timestamp", "Conversion of txn_timestamp to timestamp failed", "TYPE_MISMATCH", "k % 59 = 0"),
    _reject("amount", "Conversion of amount to decimal(15,2) failed", "TYPE_MISMATCH", "k % 53 = 0")))


def _dead(lake: Lake) -> DataFrame:
    load = transaction_load(lake, transaction_files(lake))
    return ingest.dead_letter(load.rejects, fm.TRANSACTIONS.table, at(lake.as_of))


@query("ingest_rejects", REJECTS)
def ingest_rejects(lake: Lake):
    return _dead(lake).select("source_table", "rejected_record", "error_column_name", "error_message", "error_category")


@query("reject_lines", """
WITH numbered AS (SELECT *, row_number() OVER (PARTITION BY _source_file ORDER BY txn_id, line) + 1 AS row_number FROM landing_transactions),
bad AS (SELECT *, unnest([CASE WHEN k % 61 = 0 THEN 'txn_id' END, CASE WHEN k % 59 = 0 THEN 'txn_timestamp' END,
  CASE WHEN k % 53 = 0 THEN 'amount' END]) AS error_column_name FROM numbered)
SELECT _source_file AS source_name, row_number, line AS rejected_record, error_column_name FROM bad WHERE error_column_name IS NOT NULL""")
def reject_lines(lake: Lake):
    """Rejects with their line in the landing file, the header being the first. The lines are made once, before they are
    sorted by ranges; of each step only what the next one reads is kept."""
    order = ["_source_file", "txn_id", "line"]
    with held(lake.raw("landing_transactions").select(*order), "lines") as lines:
        rows = lines.repartitionByRange(*order).sortWithinPartitions(*order)
        parts = write_lines(lake, rows, bucket="_source_file", compression="gzip")
    path = new_path(lake.spark, "landing")
    files.join_parts(lake.spark, parts, path, "|".join(fm.TRANSACTIONS.names))
    remove(lake.spark, parts)
    text = files.read_numbered(lake.spark, path, fm.PIPE, fm.TRANSACTIONS.names)
    rejects = files.line_numbers(ingest.load_batch(text, fm.TRANSACTIONS, at(lake.as_of)).rejects, lake.spark, path)
    dead = ingest.dead_letter(rejects, fm.TRANSACTIONS.table, at(lake.as_of))
    name = F.regexp_extract("source_file", f"{BUCKET}=([^/]+)/", 1).alias("source_name")
    return dead.select(name, "row_number", "rejected_record", "error_column_name")


@query("reject_summary", f"""
SELECT source_table, error_category, count(*) AS rejection_count, {NOW} AS first_rejection, {NOW} AS last_rejection
FROM ({REJECTS}) r GROUP BY 1, 2""")
def reject_summary(lake: Lake):
    return ingest.reject_summary(_dead(lake))


def _by_bucket(df: DataFrame, path: str, *sums: str) -> DataFrame:
    name = F.regexp_extract(path, f"{BUCKET}=([^/]+)/", 1).alias("source_name")
    others = [c for c in df.columns if c not in (path, *sums)]
    return df.groupBy(name, *others).agg(*[F.sum(c).alias(c) for c in sums])


@query("reject_by_file", """
SELECT 'BRONZE.RAW_TRANSACTIONS' AS source_table, _source_file AS source_name, DATE '2024-01-31' AS load_date,
  CAST(sum(CAST(k % 53 = 0 AS INT) + CAST(k % 59 = 0 AS INT) + CAST(k % 61 = 0 AS INT)) AS BIGINT) AS rejected_rows
FROM landing_transactions GROUP BY 2 HAVING rejected_rows > 0""")
def reject_by_file(lake: Lake):
    return _by_bucket(ingest.reject_by_file(_dead(lake), lake.as_of), "source_file", "rejected_rows")


@query("reprocessed_rejects", f"""
SELECT error_category, error_category = 'TYPE_MISMATCH' AS reprocessed, count(*) AS n,
  count(*) FILTER (WHERE error_category = 'TYPE_MISMATCH') AS stamped
FROM ({REJECTS}) r GROUP BY 1, 2""")
def reprocessed_rejects(lake: Lake):
    """The dead letter after the rows of one class were loaded again."""
    dl = stored(_dead(lake), "dead-letter")
    done = ingest.mark_reprocessed(dl, dl.where("error_category = 'TYPE_MISMATCH'"), at(lake.as_of))
    return done.groupBy("error_category", "reprocessed").agg(F.count(F.lit(1)).alias("n"), F.count("reprocessed_at").alias("stamped"))


@query("load_audit", f"""
SELECT 'BRONZE.RAW_TRANSACTIONS' AS table_name, _source_file AS source_name, count(*) AS rows_parsed,
  count(*) FILTER (WHERE {GOOD_TXN}) AS rows_loaded, count(*) FILTER (WHERE NOT ({GOOD_TXN})) AS rows_rejected,
  CASE WHEN bool_and({GOOD_TXN}) THEN 'LOADED' WHEN bool_or({GOOD_TXN}) THEN 'PARTIALLY_LOADED' ELSE 'LOAD_FAILED' END AS status,
  {NOW} AS last_load_time
FROM landing_transactions GROUP BY 2""")
def load_audit(lake: Lake):
    """One source may lie in several files; its status is that of all its rows."""
    audit = ingest.load_audit(transaction_load(lake, transaction_files(lake)), at(lake.as_of))
    return ingest.with_status(_by_bucket(audit.drop("status"), "path", "rows_parsed", "rows_loaded", "rows_rejected"))


@query("recent_loads", f"""
SELECT 'BRONZE.RAW_TRANSACTIONS' AS table_name, _source_file AS source_name, count(*) AS rows_parsed
FROM landing_transactions GROUP BY 2 ORDER BY 2 LIMIT 10""")
def recent_loads(lake: Lake):
    """The ten loads of the last hour that come first in the report."""
    audit = ingest.load_audit(transaction_load(lake, transaction_files(lake)), at(lake.as_of))
    by_source = _by_bucket(audit.drop("status", "rows_loaded", "rows_rejected"), "path", "rows_parsed")
    found = ingest.recent_loads(by_source.withColumnRenamed("source_name", "path"), lake.as_of)
    return found.select("table_name", F.col("path").alias("source_name"), "rows_parsed")


@query("load_end_to_end", f"""
SELECT _source_file AS source_name, count(*) AS rows_parsed, count(*) FILTER (WHERE {GOOD_TXN}) AS in_target,
  count(*) FILTER (WHERE NOT ({GOOD_TXN})) AS rejected_rows, CAST(sum(CAST(k % 53 = 0 AS INT) + CAST(k % 59 = 0 AS INT)
    + CAST(k % 61 = 0 AS INT)) AS BIGINT) AS in_dead_letter, CAST(2 AS BIGINT) AS loads, CAST(0 AS BIGINT) AS files_of_third_run
FROM landing_transactions GROUP BY 1""")
def load_end_to_end(lake: Lake):
    """Four sources land and are loaded, then the rest, then nothing new."""
    landing, store = transaction_files(lake), LoadStore(lake.spark, new_path(lake.spark, "loads"))
    reader = lambda paths: files.read_delimited(lake.spark, paths, fm.PIPE, fm.TRANSACTIONS.names)
    runs = [run_load(store, prefix, fm.TRANSACTIONS, reader, at(lake.as_of))
            for prefix in (f"{landing}/{BUCKET}=txn_[0-3]*", landing, landing)]
    def per_source(table: str, path: str, name: str) -> DataFrame:
        source = F.regexp_extract(path, f"{BUCKET}=([^/]+)/", 1).alias("source_name")
        return store.read(table).groupBy(source).agg(F.count(F.lit(1)).alias(name))
    audit = _by_bucket(store.read("audit").select("path", "rows_parsed", "rows_rejected"), "path", "rows_parsed", "rows_rejected")
    out = audit.join(per_source("good", files.FILE, "in_target"), "source_name", "left")
    out = out.join(per_source("dead_letter", "source_file", "in_dead_letter"), "source_name", "left")
    zero = F.lit(0).cast("bigint")
    return out.select("source_name", "rows_parsed", F.coalesce("in_target", zero).alias("in_target"),
                      F.col("rows_rejected").alias("rejected_rows"), F.coalesce("in_dead_letter", zero).alias("in_dead_letter"),
                      F.lit(len(store.committed())).cast("bigint").alias("loads"), F.lit(runs[2]["files"]).cast("bigint").alias("files_of_third_run"))


@query("pending_files", "SELECT DISTINCT _source_file AS source_name FROM landing_transactions WHERE _source_file >= 'txn_4'")
def pending_files(lake: Lake):
    """Files left after a first load took the files of four sources."""
    path = transaction_files(lake)
    listing = files.list_landing(lake.spark, path)
    ledger = listing.where(F.regexp_extract("path", f"{BUCKET}=([^/]+)/", 1) < "txn_4")
    left = files.pending_files(listing.where(F.col("path").endswith(".csv")), ledger)
    return left.select(F.regexp_extract("path", f"{BUCKET}=([^/]+)/", 1).alias("source_name")).distinct()


MEMBER_ROWS = f"""
SELECT member_id, trim(institution_id) AS institution_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
  CASE WHEN (k + 100000) % 31 <> 0 THEN date_of_birth END AS date_of_birth, ssn_hash, trim(email) AS email, phone,
  trim(address_line1) AS address_line1, trim(city) AS city, state_code, trim(zip_code) AS zip_code,
  coalesce(country_code, 'US') AS country_code, member_since, status, risk_tier, CAST(NULL AS VARCHAR) AS address_line2,
  FALSE AS kyc_verified, CAST(NULL AS DATE) AS last_activity_date, {NOW} AS _loaded_at
FROM landing_members WHERE (k + 100000) % 37 <> 0"""


@query("ingest_fixed_width", MEMBER_ROWS)
def ingest_fixed_width(lake: Lake):
    path = write_lines(lake, lake.raw("landing_members"))
    text = files.read_fixed_width(lake.spark, path, fm.MEMBER_LAYOUT)
    return ingest.load_batch(text, fm.MEMBERS, at(lake.as_of)).good.drop(files.FILE)


@query("reject_hashes", """
WITH broken AS (SELECT *, substr(line, 1, 150) || CASE WHEN k % 2 = 0 THEN 'xyz' || substr(line, 154, 61)
    ELSE substr(line, 151, 40) || repeat(' ', 24) END || substr(line, 215) AS bad FROM landing_members WHERE k % 11 = 0 AND CAST(substr(member_id, 4) AS BIGINT) % 37 <> 0)
SELECT bad AS rejected_record, 'ssn_hash' AS error_column_name, 'String of ssn_hash does not match [0-9a-fA-F]{64}' AS error_message,
  'CONSTRAINT' AS error_category FROM broken""")
def reject_hashes(lake: Lake):
    """Members whose hash is too short or no hexadecimal number; the others load."""
    odd = F.col("k") % 11 == 0
    hashed = F.when(F.col("k") % 2 == 0, F.concat(F.lit("xyz"), F.expr("substr(line, 154, 61)"))).otherwise(
        F.concat(F.expr("substr(line, 151, 40)"), F.lit(" " * 24)))
    line = F.when(odd, F.concat(F.expr("substr(line, 1, 150)"), hashed, F.expr("substr(line, 215)"))).otherwise(F.col("line"))
    path = write_lines(lake, lake.raw("landing_members").where("CAST(substr(member_id, 4) AS BIGINT) % 37 <> 0").select(line.alias("line")))
    text = files.read_fixed_width(lake.spark, path, fm.MEMBER_LAYOUT)
    dead = ingest.dead_letter(ingest.load_batch(text, fm.MEMBERS, at(lake.as_of)).rejects, fm.MEMBERS.table, at(lake.as_of))
    return dead.select("rejected_record", "error_column_name", "error_message", "error_category")


@query("ingest_ebcdic", MEMBER_ROWS)
def ingest_ebcdic(lake: Lake):
    """The same records as files in a mainframe code page; every row knows its file."""
    path = new_path(lake.spark, "mainframe")
    path = path if "://" in path or path.startswith("file:") else f"file://{path}"
    files.write_records(lake.raw("landing_members").select(files.encode_text(F.col("line")).alias("raw")), "raw", path)
    good = ingest.load_batch(files.read_ebcdic(lake.spark, path, fm.MEMBER_LAYOUT), fm.MEMBERS, at(lake.as_of)).good
    return good.where(F.col(files.FILE).contains("/part-")).drop(files.FILE)


@query("ingest_converted", f"""
SELECT alert_id, member_id, institution_id, date_trunc('second', alert_timestamp) AS alert_timestamp, alert_type, severity,
  alert_source, description || ', noted' AS description, related_txn_id, rule_id,
  CASE WHEN k % 37 <> 0 THEN confidence_score END AS confidence_score, status, assigned_to,
  CAST(NULL AS VARCHAR) AS resolution_notes, CAST(NULL AS TIMESTAMP) AS resolved_at, {NOW} AS _loaded_at
FROM landing_alerts WHERE k % 29 <> 0 AND k % 31 <> 0""")
def ingest_converted(lake: Lake):
    path = write_lines(lake, lake.raw("landing_alerts"), ",".join(fm.ALERTS.names))
    text = files.read_delimited(lake.spark, path, fm.MAINFRAME_CSV, fm.ALERTS.names)
    return ingest.load_batch(text, fm.ALERTS, at(lake.as_of)).good.drop(files.FILE)


EVENT_ROWS = """
SELECT event_id, event_time, event_type, member_id, institution_id, amount, channel,
  CASE WHEN k % 47 <> 0 THEN device_id END AS device_id, CASE WHEN k % 47 <> 0 THEN ip_address END AS ip_address,
  CASE WHEN k % 47 <> 0 THEN geo_lat END AS geo_lat, CASE WHEN k % 47 <> 0 THEN geo_lon END AS geo_lon, risk_score
FROM landing_events WHERE k % 41 <> 0 AND k % 53 <> 0 AND k % 37 <> 0"""


@query("ingest_json", EVENT_ROWS)
def ingest_json(lake: Lake):
    path = write_lines(lake, lake.raw("landing_events"))
    return files.read_json_events(lake.spark, path).drop("payload", files.FILE)


@query("landing_hours", EVENT_ROWS + " AND event_time >= TIMESTAMP '2024-01-15 10:00:00' AND event_time < TIMESTAMP '2024-01-15 12:00:00'")
def landing_hours(lake: Lake):
    """Events of two landing hours out of a month of hour folders."""
    path, t = new_path(lake.spark, "hours"), F.col("event_time")
    rows = lake.raw("landing_events").select(F.col("line").alias("value"), *[
        F.date_format(t, p).alias(c) for c, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))])
    rows.repartition("year", "month", "day", "hour").write.partitionBy("year", "month", "day", "hour").text(path)
    lines = files.read_hours(lake.spark, path, datetime(2024, 1, 15, 10), datetime(2024, 1, 15, 11, 59))
    events = files.checked_events(lines.select(files.RECORD, files.FILE))
    return events.where(F.size("errors") == 0).drop("errors", files.RECORD, "payload", files.FILE)


EVENT_REJECTS = """
SELECT line AS record, 'payload' AS column_name, 'Error parsing JSON: could not parse' AS error FROM landing_events WHERE k % 41 = 0
UNION ALL
SELECT line, 'event_id', 'NULL result in a non-nullable column event_id' FROM landing_events WHERE k % 53 = 0 AND k % 41 <> 0
UNION ALL
SELECT line, 'amount', 'Conversion of amount to decimal(15,2) failed' FROM landing_events WHERE k % 37 = 0 AND k % 41 <> 0"""


@query("ingest_json_rejects", EVENT_REJECTS)
def ingest_json_rejects(lake: Lake):
    path = write_lines(lake, lake.raw("landing_events"))
    return files.json_rejects(lake.spark, path).select(F.col(files.RECORD).alias("record"), F.explode("errors").alias("_e")).select(
        "record", "_e.column_name", "_e.error")


@query("ingest_parquet", "SELECT * FROM streaming_events")
def ingest_parquet(lake: Lake):
    path = new_path(lake.spark, "events-parquet")
    lake.raw("streaming_events").write.option("compression", "zstd").parquet(path)
    return files.read_parquet_events(lake.spark, path)
