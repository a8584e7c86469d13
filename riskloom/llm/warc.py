"""WARC archives of pages: a writer, and a reader that splits archives by byte ranges.

Writer. Pages with equal payloads of at least ``REVISIT_BYTES`` share one ``response`` record, that of the smallest page
id; the others become ``revisit`` records that carry the digest and the id they refer to, but no payload. Each task
writes archives of about ``ARCHIVE_BYTES`` under names of its own and reports them. Only reported archives are read, so
the files of a failed or repeated attempt do no harm.

Reader. Every archive is cut into byte ranges. A task looks for the gzip magic in its range, accepts a place as the
start of a member only if the member decodes to a WARC header, and owns the records that start inside its range; it
reads past the range's end to finish the last one. No index and no order among tasks is needed.

Records that start with the same smallest page id twice (repeated rows) are all responses. A null payload is empty. A
null page id is kept: it reads back as null, and never is the record that others refer to unless all ids are null.
An empty table gives no archives and no rows. Line breaks and controls in a url are percent-encoded in the header.
Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import cut
from riskloom.session import new_path

REVISIT_BYTES = 100
ARCHIVE_BYTES = 32 << 20
RANGE_BYTES = 4 << 20
READ_BYTES = 1 << 20

# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
VERSIONS = (b"WARC/1.0\r\n", b"WARC/1.1\r\n")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = ("page_id long, record_type string, refers_to long, target_uri string, payload_digest string, "
          "payload_bytes long, payload binary, archive string, start long, record_digest string")


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a shared folder and the path in it. Hadoop's names for object stores are understood."""
    if urlsplit(uri).scheme in ("s3a", "s3n"):
        uri = "s3" + uri[3:]
    if not urlsplit(uri).scheme:
        return pafs.LocalFileSystem(), uri
    if urlsplit(uri).scheme == "file":
        return pafs.LocalFileSystem(), urlsplit(uri).path
    return pafs.FileSystem.from_uri(uri)


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Pages as records to write: type, the record it refers to, digest and size; a revisit's payload is dropped.

    Equal payloads are found by digest with a map-side minimum per digest. The payload itself does not move: only
    digests that occur more than once meet the pages again.
    """
    body = F.coalesce(F.encode(F.col(body_col).cast("string"), "UTF-8"), F.lit(b""))
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("target_uri"),
                     body.alias("payload"))
    p = p.withColumns({"payload_digest": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    first = (p.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest")
             .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    revisit = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    j = p.join(first, "payload_digest", "left")
    return j.select(
        "page_id", "target_uri", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_first")).alias("refers_to"), "payload_digest", "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"))


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(urn: str | None) -> int | None:
    digits = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(digits[1]) if digits else None


def member(page_id, uri, kind, refers, digest, size, payload: bytes | None) -> bytes:
    """One record as one gzip member."""
    block = payload or b""
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", "1970-01-01T00:00:00Z"),
              ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", size), ("Content-Length", len(block)),
              ("Content-Type", "text/html; charset=utf-8")]
    if uri is not None:
        fields.append(("WARC-Target-URI", quote(uri, safe=" !\"#$%&'()*+,/:;<=>?@[\\]^_`{|}~-.")))
    if kind == "revisit":
        fields += [("WARC-Refers-To", record_id(refers)), ("WARC-Profile", REVISIT_PROFILE)]
    head = VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    packer = zlib.compressobj(6, wbits=31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Archives of the planned records below ``folder``, one row each: ``archive`` (uri), ``size``, ``records``."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = file_system(folder)
        out, uri, size, n = None, "", 0, 0
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for row in range(batch.num_rows):
                data = member(*(c[row].as_py() for c in columns))
                if out is None:
                    fs.create_dir(path, recursive=True)
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                    uri, size, n = f"{folder}/{name}", 0, 0
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((uri, size, n))
                    out = None
        if out is not None:
            out.close()
            done.append((uri, size, n))
        yield pa.record_batch([pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64()),
                               pa.array([d[2] for d in done], pa.int64())], names=["archive", "size", "records"])

    planned = records.select("page_id", "target_uri", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload")
    return cut(planned.mapInArrow(write, "archive string, size long, records long"))


class _Source:
    """Bytes of an open file from any offset on, read in blocks."""

    def __init__(self, file, size: int):
        self.file, self.size = file, size

    def read(self, start: int, n: int) -> bytes:
        return self.file.read_at(max(0, min(n, self.size - start)), start)


def _header_at(source: _Source, at: int) -> bool:
    """Whether a gzip member that holds a WARC record starts here."""
    unpack = zlib.decompressobj(wbits=31)
    try:
        got = unpack.decompress(source.read(at, 512), 64)
    except zlib.error:
        return False
    return got[:10] in VERSIONS


def _member_at(source: _Source, at: int) -> tuple[bytes, int]:
    """The whole unpacked member and the offset behind it."""
    unpack, out, pos = zlib.decompressobj(wbits=31), io.BytesIO(), at
    step = 16 << 10
    while not unpack.eof:
        data = source.read(pos, step)
        if not data:
            raise EOFError(f"the member at {at} is cut off")
        out.write(unpack.decompress(data))
        pos += len(data)
        step = min(2 * step, READ_BYTES)
    return out.getvalue(), pos - len(unpack.unused_data)


def starts_in(source: _Source, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Records that start in a byte range. After a record the next is expected right behind it; anything else there
    sends the search back to the magic."""
    at = start
    while at < end:
        if source.read(at, 3) != MAGIC or not _header_at(source, at):
            window = source.read(at + 1, min(READ_BYTES, end - at - 1) + len(MAGIC) - 1)
            hit = window.find(MAGIC)
            at = at + 1 + hit if hit >= 0 else at + 1 + max(1, len(window) - len(MAGIC) + 1)
            continue
        data, behind = _member_at(source, at)
        yield at, data
        at = behind


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields, by lower-case name, and the block."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    return fields, rest[:int(fields.get("content-length", len(rest)))]


def read_archives(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of the archives (columns ``archive`` and ``size``), by byte range."""
    last = F.greatest(F.ceil(F.col("size") / range_bytes).cast("long"), F.lit(1)) - 1
    ranges = archives.select("archive", "size", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("part"))
    spread = max(2, int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranges = ranges.repartition(spread, "archive", "part")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, size, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, path = file_system(archive)
                rows, held = [], 0
                with fs.open_input_file(path) as file:
                    for at, data in starts_in(_Source(file, size), part * range_bytes, min(size, (part + 1) * range_bytes)):
                        f, block = parse_record(data)
                        kind = f.get("warc-type", "")
                        rows.append((page_of(f.get("warc-record-id")), kind, page_of(f.get("warc-refers-to")),
                                     f.get("warc-target-uri"), f.get("warc-payload-digest", "").partition(":")[2] or None,
                                     int(f.get("x-payload-length", len(block))), None if kind == "revisit" else block,
                                     archive, at, None if kind == "revisit" else hashlib.sha256(block).hexdigest()))
                        held += len(block)
                        if held > READ_BYTES:
                            yield _rows(rows)
                            rows, held = [], 0
                if rows:
                    yield _rows(rows)

    return ranges.mapInArrow(read, RECORD)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.int64(), pa.string())
    names = [x.split()[0] for x in RECORD.split(", ")]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Archives that already lie in a folder, for ``read_archives``; sizes come from the listing, contents stay unread."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return found.select(F.col("path").alias("archive"), F.col("length").alias("size"))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Pages written as archives in the shared folder and read back by byte range."""
    folder = new_path(pages.sparkSession, "warc")
    return read_archives(write_archives(plan_records(pages), folder))


__all__ = ["archive_round_trip", "list_archives", "plan_records", "read_archives", "write_archives"]
