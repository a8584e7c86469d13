"""Readers for landing files. Everything is read as text; types come later, in the load step."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.sources.formats import EVENT_FIELDS, REQUIRED_EVENT_KEYS, Delimited

FILE = "_source_file"
LINE = "_line"
RECORD = "_record"
# Input split of a row, and its place among the rows of its task.
BLOCK, PLACE = "_block", "_place"


def parse_time(text: Column, pattern: str | None = None) -> Column:
    """Text to wall-clock time in UTC, NULL when it is no time. A text without a zone is taken as UTC."""
    zoned = to_utc(text.try_cast("timestamp"))
    plain = F.when(text.rlike(r"([+-]\d{2}:?\d{2}|Z)$"), zoned).otherwise(text.try_cast("timestamp_ntz"))
    return plain if pattern is None else F.coalesce(to_utc(F.try_to_timestamp(text, F.lit(pattern))), plain)


def to_utc(c: Column) -> Column:
    """Instant to wall-clock time in UTC, whatever the session time zone is."""
    return F.convert_timezone(None, F.lit("UTC"), c.cast("timestamp_ntz"))


# A character that no landing file carries: splitting on it leaves each line whole.
_NO_SEPARATOR = "\u0001"


def read_lines(spark: SparkSession, path: str | list[str], header: bool) -> DataFrame:
    """Raw lines and their file; with ``header`` the first line of every file is left out."""
    opts = {"sep": _NO_SEPARATOR, "quote": "", "header": str(header).lower(), "mode": "PERMISSIVE"}
    return (spark.read.schema(f"{RECORD} string").options(**opts).csv(path)
            .select(RECORD, F.col("_metadata.file_path").alias(FILE)))


def read_delimited(spark: SparkSession, path: str | list[str], fmt: Delimited, names: Sequence[str]) -> DataFrame:
    """All-text columns plus the source file and the original line.

    The raw line stays at hand for rejects; one ``from_csv`` splits it. Short lines leave NULLs, long ones lose the
    extra fields. Fields are trimmed and every NULL token becomes NULL.
    """
    return _split_fields(read_lines(spark, path, fmt.header), fmt, names).select(*names, FILE, RECORD)


def _split_fields(lines: DataFrame, fmt: Delimited, names: Sequence[str]) -> DataFrame:
    schema = ", ".join(f"`{n}` string" for n in names)
    options = {"sep": fmt.sep, "quote": fmt.quote, "mode": "PERMISSIVE", "ignoreLeadingWhiteSpace": "true",
               "ignoreTrailingWhiteSpace": "true"}
    parsed = lines.select("*", F.from_csv(RECORD, schema, options).alias("_f"))

    def clean(n: str) -> Column:
        v = F.trim(F.col(f"_f.{n}"))
        return F.when(v.isin(*fmt.nulls), None).otherwise(v).alias(n)
    return parsed.select(*[clean(n) for n in names], *lines.columns)


# --- line numbers -------------------------------------------------------------------------------

def read_numbered(spark: SparkSession, path: str | list[str], fmt: Delimited, names: Sequence[str]) -> DataFrame:
    """``read_delimited`` with the input split of each row (``BLOCK``), from which ``line_numbers`` finds the line. Blank
    lines count, as an editor counts them; quoted line breaks are not supported."""
    header = fmt.sep.join(names)
    lines = spark.read.text(path).select(F.col("value").alias(RECORD), F.col("_metadata.file_path").alias(FILE),
                                         F.col("_metadata.file_block_start").alias(BLOCK), F.monotonically_increasing_id().alias(PLACE))
    if fmt.header:
        lines = lines.where(~((F.col(BLOCK) == 0) & (F.lower(RECORD) == header.lower())))
    return _split_fields(lines.where(F.trim(RECORD) != ""), fmt, names).select(*names, FILE, RECORD, BLOCK, PLACE)


def line_numbers(rows: DataFrame, spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``rows`` of ``read_numbered`` with ``_row_number``, their line in the file. Every split of the files is counted; a
    file's counts are summed up in its order, one row for each split. Only the given rows, usually the rejects, are
    joined with that."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK),
                                         F.monotonically_increasing_id().alias("_id"))
    blocks = lines.groupBy(FILE, BLOCK).agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    number = (F.col("_before") + F.col(PLACE) - F.col("_first") + 1).alias("_row_number")
    return rows.join(blocks, [FILE, BLOCK]).select(*[rows[c] for c in rows.columns if c not in (BLOCK, PLACE, "_row_number")], number)


def slice_fields(record: Column, layout: Sequence[tuple[str, int, int]]) -> list[Column]:
    """Trimmed slices of a fixed-width record."""
    return [F.trim(F.substring(record, start, length)).alias(name) for name, start, length in layout]


def read_fixed_width(spark: SparkSession, path: str | list[str], layout: Sequence[tuple[str, int, int]]) -> DataFrame:
    lines = spark.read.text(path).select(F.col("value").alias(RECORD), F.col("_metadata.file_path").alias(FILE))
    blank = [F.when(F.col(n) == "", None).otherwise(F.col(n)).alias(n) for n, _, _ in layout]
    return lines.select(*slice_fields(F.col(RECORD), layout), FILE, RECORD).select(*blank, FILE, RECORD)


# --- mainframe records --------------------------------------------------------------------------

def _code_page(codepage: str) -> tuple[str, str]:
    """Signs that differ between ISO-8859-1 and a single-byte code page, byte by byte."""
    pairs = [(bytes([b]).decode("latin-1"), bytes([b]).decode(codepage)) for b in range(256)]
    return tuple("".join(x) for x in zip(*[p for p in pairs if p[0] != p[1]], strict=True))


def decode_text(raw: Column, codepage: str = "cp037") -> Column:
    """Bytes of a single-byte code page as text. Read as ISO-8859-1 every byte is a sign; those of the code page take their
    place, so no charset beyond the JVM's standard ones and no Python is needed."""
    return F.translate(F.decode(raw, "ISO-8859-1"), *_code_page(codepage))


def encode_text(text: Column, codepage: str = "cp037") -> Column:
    latin, page = _code_page(codepage)
    return F.encode(F.translate(text, page, latin), "ISO-8859-1")


def decode_records(df: DataFrame, raw: str, layout: Sequence[tuple[str, int, int]], codepage: str = "cp037") -> DataFrame:
    """Fixed records in a mainframe code page, one per row of the binary column ``raw``."""
    record = decode_text(F.col(raw), codepage)
    out = df.select(*[c for c in df.columns if c != raw], record.alias(RECORD))
    keep = [c for c in out.columns if c != RECORD]
    sliced = out.select(*slice_fields(F.col(RECORD), layout), *keep, RECORD)
    return sliced.select(*[F.when(F.col(n) == "", None).otherwise(F.col(n)).alias(n) for n, _, _ in layout], *keep, RECORD)


def read_ebcdic(spark: SparkSession, path: str, layout: Sequence[tuple[str, int, int]], codepage: str = "cp037") -> DataFrame:
    """Fixed-length mainframe files, with the file of each record. Files are split at record borders, whatever the size of the
    splits, and records go from the file system to columns inside the JVM."""
    length = max(start + size - 1 for _, start, size in layout)
    jvm, session = spark._jvm, spark._jsparkSession
    records = spark.sparkContext._jsc.sc().binaryRecords(path, length, spark.sparkContext._jsc.hadoopConfiguration())
    raw = DataFrame(session.createDataset(records, jvm.org.apache.spark.sql.Encoders.BINARY()).toDF(), spark)
    return decode_records(raw.select(F.col("value").alias("raw"), F.input_file_name().alias(FILE)), "raw", layout, codepage)


def write_records(rows: DataFrame, raw: str, path: str) -> None:
    """Records (a binary column) as files without separators, one for each task. A task that runs again writes the same file."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = FileSystem.from_uri(path)
        fs.create_dir(folder, recursive=True)
        with fs.open_output_stream(f"{folder}/part-{TaskContext.get().partitionId():05d}") as out:
            for batch in batches:
                for record in batch.column(0):
                    out.write(record.as_buffer())
        yield pa.record_batch([pa.array([1], pa.int64())], names=["n"])
    rows.select(F.col(raw).cast("binary").alias("raw")).mapInArrow(write, "n long").count()


def join_parts(spark: SparkSession, parts: str, path: str, header: str) -> None:
    """One file with a header for each folder below ``parts``, from the folder's files in the order of their names. Bytes are
    copied in small pieces, so a task needs the same memory whatever the size of its file; one that runs again writes the
    same file. Compressed parts are written out as plain text."""
    parts, path = (p if "://" in p or p.startswith("file:") else f"file://{p}" for p in (parts, path))
    names = F.split("path", "/")
    listing = list_landing(spark, parts).select(F.element_at(names, -2).alias("folder"), F.element_at(names, -1).alias("name"))
    folders = listing.groupBy("folder").agg(F.sort_array(F.collect_list("name")).alias("names"))

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (source, base), (target, out_base) = FileSystem.from_uri(parts), FileSystem.from_uri(path)
        for batch in batches:
            for row in batch.to_pylist():
                target.create_dir(f"{out_base}/{row['folder']}", recursive=True)
                with target.open_output_stream(f"{out_base}/{row['folder']}/part-00000.csv", compression=None) as out:
                    out.write(f"{header}\n".encode())
                    for name in row["names"]:
                        with source.open_input_stream(f"{base}/{row['folder']}/{name}") as part:
                            while piece := part.read(1 << 22):
                                out.write(piece)
            yield pa.record_batch([pa.array([batch.num_rows], pa.int64())], names=["n"])
    # One row a folder: spread by number, so that each file gets a task of its own.
    count = listing.select("folder").distinct().count()
    folders.repartition(max(count, 1), "folder").mapInArrow(copy, "n long").count()


# --- events -------------------------------------------------------------------------------------

def event_schema() -> T.StructType:
    """Delivered event keys as text-or-number leaves; the load step types them."""
    return T.StructType([T.StructField(n, T.StringType()) for n, _ in EVENT_FIELDS])


def extract_payload(df: DataFrame, payload: str, fields: Sequence[tuple[str, str]] = EVENT_FIELDS, keep: Sequence[str] = (),
                    required: Sequence[str] = REQUIRED_EVENT_KEYS) -> DataFrame:
    """Typed columns from a variant payload, and ``errors``: keys that are missing or null though required, and values
    that do not convert. The payload stays as it came."""
    def text(name: str) -> Column:
        return F.try_variant_get(F.col(payload), f"$.{name}", "string")

    def take(name: str, kind: str) -> Column:
        return parse_time(text(name)) if kind == "timestamp" else F.try_variant_get(F.col(payload), f"$.{name}", kind)

    def problem(name: str, bad: Column, message: str) -> Column:
        return F.when(bad, F.struct(F.lit(name).alias("column_name"), F.lit(message).alias("error")))

    typed = df.select(*[take(n, k).alias(n) for n, k in fields], F.struct(*[text(n).alias(n) for n, _ in fields]).alias("_text"),
                      F.col(payload).alias("payload"), *keep)
    found = [problem(n, F.col(f"_text.{n}").isNull(), f"NULL result in a non-nullable column {n}") for n in required]
    found += [problem(n, F.col(f"_text.{n}").isNotNull() & F.col(n).isNull(), f"Conversion of {n} to {k} failed")
              for n, k in fields if k != "string"]
    return typed.withColumn("errors", F.array_compact(F.array(*found))).drop("_text")


def checked_events(docs: DataFrame, fields: Sequence[tuple[str, str]] = EVENT_FIELDS) -> DataFrame:
    """Events of documents (``_record`` and the file), one row each with its ``errors``. A document is an object or an
    array of objects; one that does not parse, or repeats a key, gives one row without values."""
    parsed = docs.withColumn("_v", F.try_parse_json(RECORD))
    many = F.try_variant_get("_v", "$", "array<variant>")
    each = parsed.select(F.explode(F.coalesce(many, F.array("_v"))).alias("_e"), F.col("_v").isNull().alias("_broken"), RECORD, FILE)
    out = extract_payload(each, "_e", fields, ["_broken", RECORD, FILE])
    broken = F.array(F.struct(F.lit("payload").alias("column_name"), F.lit("Error parsing JSON: could not parse").alias("error")))
    return out.withColumn("errors", F.when(F.col("_broken"), broken).otherwise(F.col("errors"))).drop("_broken")


def _json_documents(spark: SparkSession, path: str | list[str], whole_files: bool) -> DataFrame:
    return spark.read.text(path, wholetext=whole_files).where("trim(value) <> ''").select(
        F.col("value").alias(RECORD), F.col("_metadata.file_path").alias(FILE))


def read_json_events(spark: SparkSession, path: str | list[str], fields: Sequence[tuple[str, str]] = EVENT_FIELDS,
                     whole_files: bool = False) -> DataFrame:
    """JSON events that meet the contract: an object, or an array of objects, per line; with ``whole_files`` per
    (buffer-sized) file. The others are in ``json_rejects``. Explicit nulls stay in the payload."""
    rows = checked_events(_json_documents(spark, path, whole_files), fields)
    return rows.where(F.size("errors") == 0).drop("errors", RECORD)


def json_rejects(spark: SparkSession, path: str | list[str], whole_files: bool = False) -> DataFrame:
    """Documents that do not parse and events that break the contract, in the shape of load rejects."""
    return checked_events(_json_documents(spark, path, whole_files)).where(F.size("errors") > 0).select(FILE, RECORD, "errors")


def read_parquet_events(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The columnar delivery format."""
    return spark.read.parquet(*([path] if isinstance(path, str) else path))


# --- listing ------------------------------------------------------------------------------------

def hour_path(root: str, when: datetime) -> str:
    """Landing folder of one hour; readers of a single hour list nothing else."""
    return f"{root}/year={when:%Y}/month={when:%m}/day={when:%d}/hour={when:%H}"


def hours_between(spark: SparkSession, root: str, first: datetime, last: datetime) -> list[str]:
    """Landing folders of the hours from ``first`` to ``last``. Only the folders of their days are listed."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    low, high = (hour_path("", t.replace(minute=0, second=0, microsecond=0)) for t in (first, last))
    days = [hour_path(root, first + timedelta(days=n)) for n in range((last.date() - first.date()).days + 1)]
    found = []
    for day in (hadoop(d).getParent() for d in days):
        fs = day.getFileSystem(spark._jsc.hadoopConfiguration())
        found += [s.getPath().toString() for s in fs.listStatus(day)] if fs.exists(day) else []
    return sorted(p for p in found if low <= "/" + "/".join(p.split("/")[-4:]) <= high)


def hour_number() -> Column:
    """Hour of a landing row as one number, from the columns of its folders."""
    return ((F.col("year") * 100 + F.col("month")) * 100 + F.col("day")) * 100 + F.col("hour")


def _hour_filter(df: DataFrame, first: datetime, last: datetime | None) -> DataFrame:
    df = df.where(hour_number() >= int(f"{first:%Y%m%d%H}"))
    return df if last is None else df.where(hour_number() <= int(f"{last:%Y%m%d%H}"))


LANDED = "value string, year int, month int, day int, hour int"


def read_hours(spark: SparkSession, root: str, first: datetime, last: datetime) -> DataFrame:
    """Lines that landed in the hours from ``first`` to ``last``, with their file and the columns of their folders. Other
    folders are neither listed nor read."""
    paths = hours_between(spark, root, first, last)
    if not paths:
        return spark.createDataFrame([], f"{RECORD} string, {FILE} string, year int, month int, day int, hour int")
    lines = _hour_filter(spark.read.schema(LANDED).option("basePath", root).text(paths), first, last)
    return lines.select(F.col("value").alias(RECORD), F.col("_metadata.file_path").alias(FILE), "year", "month", "day", "hour")


def stream_hours(spark: SparkSession, root: str, since: datetime, folders: str = "year=*/month=*/day=*/hour=*") -> DataFrame:
    """New lines of the landing folders from an hour on, as ``read_hours``. ``folders`` narrows what the source lists."""
    lines = spark.readStream.schema(LANDED).option("basePath", root).text(f"{root}/{folders}")
    return _hour_filter(lines, since, None).select(
        F.col("value").alias(RECORD), F.col("_metadata.file_path").alias(FILE), "year", "month", "day", "hour")


def list_landing(spark: SparkSession, path: str) -> DataFrame:
    """Files below a landing prefix: path, size, modification time. File contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")))


def pending_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that no earlier load has taken."""
    return listing.join(ledger.select("path").distinct(), "path", "left_anti")


def align_by_name(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns in target order and type, matched by name without regard to case; missing ones are NULL."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in target.fields])
