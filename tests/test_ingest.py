"""Landing files: formats, partial acceptance, dead letter."""

import gzip
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from riskloom.functions.expressions import at
from riskloom.plans import ingest
from riskloom.plans.loads import LoadStore, run_load
from riskloom.sources import files
from riskloom.sources import formats as fm
from tests.conftest import AS_OF, rows
from tests.disk import scratch_folders, shuffle_ids, soon

GOOD = "T1|m1|fi1|2024-01-05 10:00:00.000 +0100|12.50|usd|debit|pos| cat ||us|completed|A1|0001|10.0.0.1|fp|0.50"


def _line(**over):
    parts = dict(zip(fm.TRANSACTIONS.names, GOOD.split("|"), strict=True))
    parts.update(over)
    return "|".join(parts.values())


def test_partial_acceptance(spark, tmp_path):
    lines = [
        "|".join(fm.TRANSACTIONS.names), GOOD,
        _line(txn_id="T2", amount="abc"), _line(txn_id="T3", txn_timestamp="soon"), _line(txn_id=""),
        _line(txn_id="NULL"), _line(txn_id="T6", risk_score="n/a"), _line(txn_id="T7", currency_code="\\N"),
        _line(txn_id="T8", merchant_name='"a|b"'), "T9|m1|fi1|2024-01-05 10:00:00.000 +0000|1.00", GOOD + "|more|still more",
        _line(txn_id="X" * 51), _line(txn_id="null", amount="x"),
    ]
    (tmp_path / "a.psv").write_text("\n".join(lines) + "\n")
    (tmp_path / "b.psv").write_text("\n".join([lines[0], _line(txn_id="B1")]) + "\n")
    text = files.read_delimited(spark, str(tmp_path), fm.PIPE, fm.TRANSACTIONS.names)
    load = ingest.load_batch(text, fm.TRANSACTIONS, at(AS_OF))
    good, bad = load.good.collect(), load.rejects.collect()
    assert len(good) + len(bad) == len(lines) - 1 + 1
    by_id = {r["txn_id"]: r for r in good}
    assert set(by_id) == {"T1", "T6", "T7", "T8", "T9", "B1"}
    assert str(by_id["T1"]["txn_timestamp"]) == "2024-01-05 09:00:00"
    assert by_id["T6"]["risk_score"] is None and by_id["T7"]["currency_code"] == "USD"
    assert by_id["T8"]["merchant_name"] == "a|b" and by_id["T9"]["channel"] is None
    dl = ingest.dead_letter(load.rejects, fm.TRANSACTIONS.table, at(AS_OF))
    kinds = sorted((r["error_column_name"], r["error_category"]) for r in dl.collect())
    assert kinds == [("amount", "TYPE_MISMATCH"), ("amount", "TYPE_MISMATCH"), ("txn_id", "CONSTRAINT"), ("txn_id", "CONSTRAINT"),
                     ("txn_id", "CONSTRAINT"), ("txn_id", "CONSTRAINT"), ("txn_timestamp", "TYPE_MISMATCH")]
    assert any(r["rejected_record"] == _line(txn_id="T2", amount="abc") for r in dl.collect())
    audit = {r["path"].rsplit("/", 1)[-1]: r["status"] for r in ingest.load_audit(load, at(AS_OF)).collect()}
    assert audit == {"a.psv": "PARTIALLY_LOADED", "b.psv": "LOADED"}
    done = ingest.mark_reprocessed(dl, dl.where("error_category = 'TYPE_MISMATCH'"), at(AS_OF))
    assert done.where("reprocessed").count() == 3
    assert ingest.reject_summary(done).agg(F.sum("rejection_count")).head()[0] == 4


def test_classification_order(spark):
    df = spark.createDataFrame([("Conversion of null failed",), ("cannot PARSE null",), ("Null value",), ("other",)], "m string")
    got = [r[0] for r in df.select(ingest.classify(F.col("m"))).collect()]
    assert got == ["TYPE_MISMATCH", "PARSE_ERROR", "CONSTRAINT", "UNKNOWN"]


def test_compressed_files_and_pending(spark, tmp_path):
    header = "|".join(fm.TRANSACTIONS.names)
    with gzip.open(tmp_path / "a.psv.gz", "wt") as f:
        f.write(header + "\n" + GOOD + "\n")
    text = files.read_delimited(spark, str(tmp_path), fm.PIPE, fm.TRANSACTIONS.names)
    assert [r["txn_id"] for r in text.collect()] == ["T1"]
    listing = files.list_landing(spark, str(tmp_path))
    assert files.pending_files(listing, listing.limit(0)).count() == 1
    assert files.pending_files(listing, listing).count() == 0


def _record(**v):
    return "".join(str(v.get(n, "")).ljust(size)[:size] for n, _, size in fm.MEMBER_LAYOUT)


def test_fixed_width_and_mainframe_files(spark, tmp_path):
    recs = [_record(member_id="M1", institution_id="F1", first_name="Zoë", date_of_birth="1980-02-03", status="active"),
            _record(member_id="M2", institution_id="F1", date_of_birth="03/02/1980"), _record(institution_id="F1")]
    assert all(len(r) == 539 for r in recs)
    (tmp_path / "m.dat").write_text("\n".join(recs) + "\n")
    (tmp_path / "ebc").mkdir()
    (tmp_path / "ebc" / "m.ebc").write_bytes("".join(recs).encode("cp037"))
    fixed = files.read_fixed_width(spark, str(tmp_path / "m.dat"), fm.MEMBER_LAYOUT)
    main = files.read_ebcdic(spark, str(tmp_path / "ebc"), fm.MEMBER_LAYOUT).withColumn(files.FILE, F.lit("x"))
    for text in (fixed, main):
        load = ingest.load_batch(text, fm.MEMBERS, at(AS_OF))
        got = {r["member_id"]: r for r in load.good.collect()}
        assert set(got) == {"M1", "M2"} and got["M1"]["first_name"] == "Zoë"
        assert str(got["M1"]["date_of_birth"]) == "1980-02-03" and got["M2"]["date_of_birth"] is None
        assert got["M1"]["country_code"] == "US" and got["M1"]["kyc_verified"] is False
        assert load.rejects.count() == 1


def test_json_arrays_duplicates_and_nulls(spark, tmp_path):
    e = {"event_id": "E1", "event_time": "2024-01-01T00:00:00+00:00", "event_type": "TXN", "member_id": "M1", "amount": 1.5,
         "risk_score": None, "extra": 1}
    bad = [dict(e, event_id=None), dict(e, event_id="E4", event_time="soon", amount="abc"), dict(e, event_id="E5", member_id=None)]
    (tmp_path / "l.json").write_text(json.dumps(e) + "\n" + '{"event_id":"D","event_id":"D2"}\n' + json.dumps(bad) + "\n"
                                     + json.dumps([dict(e, event_id="E2"), dict(e, event_id="E3")]) + "\n")
    got = {r["event_id"]: r for r in files.read_json_events(spark, str(tmp_path)).collect()}
    assert set(got) == {"E1", "E2", "E3"} and str(got["E1"]["event_time"]) == "2024-01-01 00:00:00"
    payload = files.read_json_events(spark, str(tmp_path)).select(F.to_json("payload").alias("p")).collect()
    assert all('"risk_score":null' in r["p"] and '"extra":1' in r["p"] for r in payload)
    rejects = files.json_rejects(spark, str(tmp_path))
    dl = ingest.dead_letter(rejects, "BRONZE.STREAMING_EVENTS", at(AS_OF)).collect()
    assert sorted((r["error_category"], r["error_column_name"]) for r in dl) == [
        ("CONSTRAINT", "event_id"), ("CONSTRAINT", "member_id"), ("PARSE_ERROR", "payload"),
        ("TYPE_MISMATCH", "amount"), ("TYPE_MISMATCH", "event_time")]
    (tmp_path / "whole").mkdir()
    (tmp_path / "whole" / "w.json").write_text(json.dumps([e, dict(e, event_id="E9")], indent=2))
    assert files.read_json_events(spark, str(tmp_path / "whole"), whole_files=True).count() == 2


def test_institutions_load(spark, tmp_path):
    (tmp_path / "i.psv").write_text("|".join(fm.INSTITUTIONS.names) + "\nFI1|One|BANK|1|c|OCC|NY|WEST|LARGE|2001-01-01|ACTIVE\n|x\n")
    text = files.read_delimited(spark, str(tmp_path), fm.PIPE, fm.INSTITUTIONS.names)
    load = ingest.load_batch(text, fm.INSTITUTIONS, at(AS_OF))
    assert rows(load.good.select("institution_id", "region")) == [("FI1", "WEST")] and load.rejects.count() == 1


def test_run_load_takes_each_file_once_and_survives_a_failure(spark, tmp_path, monkeypatch):
    landing, store = tmp_path / "in", LoadStore(spark, str(tmp_path / "store"))
    landing.mkdir()
    header = "|".join(fm.INSTITUTIONS.names)
    def land(name, *lines):
        (landing / name).write_text("\n".join([header, *lines]) + "\n")
    good = "{}|One|BANK|1|c|OCC|NY|WEST|LARGE|2001-01-01|ACTIVE"
    reader = lambda paths: files.read_delimited(spark, paths, fm.PIPE, fm.INSTITUTIONS.names)
    run = lambda: run_load(store, str(landing), fm.INSTITUTIONS, reader, at(AS_OF))
    land("a.psv", good.format("FI1"), "|x")
    real = LoadStore.write
    def lost(self, table, load_id, df):
        if table == "audit":
            raise OSError("executor lost")
        return real(self, table, load_id, df)
    monkeypatch.setattr(LoadStore, "write", lost)
    with pytest.raises(OSError):
        run()
    monkeypatch.undo()
    assert store.read("good") is None and store.committed() == []
    land("b.psv", good.format("FI2"))  # the next load has other files, so the failed one is left and never read
    first = run()
    assert (first["files"], first["rows_loaded"], first["rows_rejected"]) == (2, 2, 1)
    assert run()["files"] == 0
    land("c.psv", good.format("FI3"))
    assert run()["files"] == 1 and len(store.committed()) == 2
    assert sorted(r[0] for r in store.read("good").select("institution_id").collect()) == ["FI1", "FI2", "FI3"]
    assert store.read("dead_letter").count() == 1 and store.read("audit").count() == 3


def test_good_rows_are_stored_once(spark, tmp_path):
    """They are the checked rows without an error; the text of a record is kept for rejects alone."""
    landing, store = tmp_path / "in", LoadStore(spark, str(tmp_path / "store"))
    landing.mkdir()
    lines = ["FI1|One|BANK|1|c|OCC|NY|WEST|LARGE|2001-01-01|ACTIVE", "|x", "FI2|Two|BANK|1|c|OCC|NY|WEST|LARGE|2001-01-01|ACTIVE"]
    (landing / "a.psv").write_text("\n".join(["|".join(fm.INSTITUTIONS.names), *lines]) + "\n")
    reader = lambda paths: files.read_delimited(spark, paths, fm.PIPE, fm.INSTITUTIONS.names)
    run_load(store, str(landing), fm.INSTITUTIONS, reader, at(AS_OF))
    direct = ingest.load_batch(reader([str(landing)]), fm.INSTITUTIONS, at(AS_OF))
    assert rows(store.read("good").drop("load_id")) == rows(direct.good)
    assert store.read("dead_letter").select("rejected_record").distinct().collect() == [("|x",)]
    assert [r[0] for r in store.read("checked").select(files.RECORD).where(f"{files.RECORD} IS NOT NULL").collect()] == ["|x"]
    assert not (tmp_path / "store/good").exists()


def test_lines_are_those_of_the_file(spark, tmp_path):
    """Files that are cut in several splits, with blank lines and without a last line break."""
    fmt, names = fm.PIPE, ["a", "b"]
    want = {}
    for f in range(3):
        lines = ["a|b"] + [f"{f}-{i}|{'x' * (i % 50)}" if i % 7 else "" for i in range(1, 900)]
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"f{f}.txt").write_text("\n".join(lines))
        want |= {t: n for n, t in enumerate(lines, 1) if t and n > 1}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = files.read_numbered(spark, str(tmp_path / "in"), fmt, names)
        assert rows.select(files.FILE, files.BLOCK).distinct().count() > 9
        got = files.line_numbers(rows, spark, str(tmp_path / "in")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r[files.RECORD]: r["_row_number"] for r in got} == want and len(got) == len(want)


def test_only_the_hours_asked_for_are_listed(spark, tmp_path):
    from datetime import datetime
    root = tmp_path / "land"
    for day, hour in ((14, 23), (15, 0), (15, 9), (15, 10), (15, 11), (16, 0)):
        folder = Path(files.hour_path(str(root), datetime(2024, 1, day, hour)))
        folder.mkdir(parents=True)
        (folder / "e.json").write_text(f"{day}:{hour}\n")
    # a folder that would break the discovery of partitions, were it listed
    (root / "year=2024" / "month=01" / "day=15" / "hour=12" / "odd=1").mkdir(parents=True)
    (root / "year=2024" / "month=02" / "loose").mkdir(parents=True)
    first, last = datetime(2024, 1, 15, 9, 30), datetime(2024, 1, 15, 11)
    df = files.read_hours(spark, str(root), first, last)
    assert sorted(r[0] for r in df.select(files.RECORD).collect()) == ["15:10", "15:11", "15:9"]
    assert all("/day=15/hour=" in f for f in df.inputFiles()) and len(df.inputFiles()) == 3
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "hour#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    over = files.read_hours(spark, str(root), datetime(2024, 1, 14, 23), datetime(2024, 1, 15, 0))
    assert sorted(r["hour"] for r in over.collect()) == [0, 23]
    assert files.read_hours(spark, str(root), datetime(2030, 1, 1), datetime(2030, 1, 2)).count() == 0
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    stream = files.stream_hours(spark, str(root), datetime(2024, 1, 15, 10), "year=2024/month=01/day=1[56]/hour=*")
    stream.writeStream.format("parquet").option("checkpointLocation", ck).trigger(availableNow=True).start(out).awaitTermination()
    assert sorted(r[files.RECORD] for r in spark.read.parquet(out).collect()) == ["15:10", "15:11", "16:0"]


def test_mainframe_files_in_several_ranges(spark, tmp_path):
    """Every sign of the code page, files cut inside records, and the file of each record."""
    layout = (("a", 1, 3), ("b", 4, 4))
    signs = bytes(range(64, 255)).decode("cp037").replace(" ", "")
    words = [f"{i % 1000:03d}" + (signs[i % len(signs)] * 4) for i in range(5000)]
    (tmp_path / "m").mkdir()
    for n in range(2):
        (tmp_path / "m" / f"f{n}").write_bytes("".join(words[n::2]).encode("cp037"))
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("mapreduce.input.fileinputformat.split.maxsize", "4001")
    try:
        df = files.read_ebcdic(spark, str(tmp_path / "m"), layout)
        assert df.rdd.getNumPartitions() >= 8
        got = sorted((r["a"] + (r["b"] or ""), r[files.FILE].rsplit("/", 1)[1]) for r in df.collect())
    finally:
        hadoop.unset("mapreduce.input.fileinputformat.split.maxsize")
    assert got == sorted((w.strip(" "), f"f{k % 2}") for k, w in enumerate(words))
    text = spark.createDataFrame([("Zoë 123",), (None,)], "t string")
    back = text.select(files.decode_text(files.encode_text(F.col("t")))).collect()
    assert [r[0] for r in back] == ["Zoë 123", None]


def test_lengths_and_hashes(spark):
    names = fm.MEMBERS.names
    good = dict.fromkeys(names) | {"member_id": "M", "institution_id": "I", "ssn_hash": "aB" * 32}
    bad = [good | {"ssn_hash": "ab" * 31}, good | {"ssn_hash": "zz" * 32}, good | {"ssn_hash": "ab" * 33}, good | {"city": "x" * 101},
           good | {"state_code": "NYC"}]
    rows = [tuple(r[n] for n in names) + ("f", "record") for r in [good, *bad]]
    raw = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in [*names, files.FILE, files.RECORD]))
    load = ingest.load_batch(raw, fm.MEMBERS, at(AS_OF))
    assert load.good.count() == 1
    dead = ingest.dead_letter(load.rejects, "T", at(AS_OF)).collect()
    assert sorted(r["error_column_name"] for r in dead) == ["city"] + ["ssn_hash"] * 4 + ["state_code"]
    assert {r["error_category"] for r in dead} == {"CONSTRAINT"}


def test_parts_become_one_file_in_their_order(spark, tmp_path):
    """Ordered parts of two folders, one of them compressed, each joined below a header."""
    (tmp_path / "in" / "_src=a").mkdir(parents=True)
    (tmp_path / "in" / "_src=b").mkdir()
    for n in (2, 0, 1):
        with gzip.open(tmp_path / "in" / "_src=a" / f"part-{n}.csv.gz", "wt") as f:
            f.write(f"a{n}\n")
    (tmp_path / "in" / "_src=b" / "part-0.csv").write_text("b0\nb1\n")
    files.join_parts(spark, str(tmp_path / "in"), str(tmp_path / "out"), "head")
    got = {p.parent.name: p.read_text() for p in (tmp_path / "out").rglob("*.csv")}
    assert got == {"_src=a": "head\na0\na1\na2\n", "_src=b": "head\nb0\nb1\n"}


def test_reject_lines_keeps_the_landing_files_only(spark, monkeypatch):
    """Rows of two sources in mixed order, some with faults. When their lines are joined, the shuffles that sorted them and the
    unsorted rows are gone; later the sorted parts as well."""
    from riskloom.catalog.ingest_queries import reject_lines

    class Source:
        as_of = AS_OF

        def raw(self, name):
            ids = [f"T{n:02d}" for n in (5, 3, 9, 1, 7, 3)]
            found = [(f"{s}.psv", i, _line(txn_id=i, amount="abc" if i in bad else "1.00")) for s, bad in (("a", ("T05",)), ("b", ("T01", "T09"))) for i in ids]
            return spark.createDataFrame(found, "_source_file string, txn_id string, line string").repartition(3)

    lake, join = Source(), files.join_parts

    def joined(*args):
        assert [f.split("-")[0] for f in scratch_folders(spark) - folders] == ["landing"]
        assert soon(lambda: not shuffle_ids(spark) - shuffles)
        join(*args)

    monkeypatch.setattr(files, "join_parts", joined)
    lake.spark, shuffles, folders = spark, shuffle_ids(spark), scratch_folders(spark)
    found = reject_lines(lake)
    assert [f.split("-")[0] for f in scratch_folders(spark) - folders] == ["landing"]
    got = {(r["source_name"], r["row_number"], r["rejected_record"].split("|")[0], r["error_column_name"]) for r in found.collect()}
    assert got == {("a.psv", 5, "T05", "amount"), ("b.psv", 2, "T01", "amount"), ("b.psv", 7, "T09", "amount")}
