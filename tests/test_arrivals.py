"""Conversion of any mix of files in one job, and versions of files sent again."""

import datetime as dt
import glob
import os
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapsewise.sources.csvsink import csv_line
from lapsewise.streaming import ingest as I
from lapsewise.streaming.ingest import ParquetToCsvIngest, fits, footer_status, misfits, read_audit


def job_of(spark, root, **how):
    return ParquetToCsvIngest(spark, f"{root}/land", f"{root}/out", f"{root}/err", f"{root}/audit", f"{root}/ckpt", **how)


def put(root, name, table, when=None, **how):
    path = f"{root}/land/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(table, path, **how)
    if when is not None:
        os.utime(path, (when, when))
    return path


def texts(root, name):
    return [open(f, newline="").read() for f in sorted(glob.glob(f"{root}/out/source_key=processed%2F{name}.csv/part-*.csv"))]


def statuses(spark, *paths):
    listing = spark.createDataFrame([(f"file:{p}",) for p in paths], "path string")
    return sorted(footer_status(listing, 2).collect(), key=lambda r: r.path)


def test_one_job_whatever_the_schemas(spark, workdir):
    paths = [put(workdir, f"f{i}.parquet", pa.table({f"c{i}": [i, i + 1], "x": ["p", None]})) for i in range(8)]
    paths += [put(workdir, f"void{i}.parquet", pa.table({f"v{i}": pa.array([], pa.int32())})) for i in range(5)]
    job = job_of(spark, workdir)
    group = statuses(spark, *paths)
    assert len({r.schema for r in group}) == 13
    sc = spark.sparkContext
    sc.setJobGroup("convert", "one batch")
    try:
        job._convert(group)
        assert len(sc.statusTracker().getJobIdsForGroup("convert")) == 1
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    for i in range(8):
        assert texts(workdir, f"f{i}") == [f"c{i},x\n{i},p\n{i + 1},\n"]
    for i in range(5):
        assert texts(workdir, f"void{i}") == [f"v{i}\n"]


def test_names_of_all_kinds(spark, workdir):
    when = dt.datetime(2024, 3, 1, 12, 30, 0, 123456)
    table = pa.table({
        "a": [1, 2], "A": ["x", 'say "hi",\nthen go'], "source_key": ["k", ""], "_metadata": [None, 2.5], "line": [True, None],
        "we`ird, name": ["q", "r"], "dt.x": pa.array([dt.date(2024, 1, 2), None]),
        "ns": pa.array([when, None], pa.timestamp("ns")), "nz": pa.array([when, None], pa.timestamp("ns", "UTC")),
        "before": pa.array([-1, 1999], pa.int64()).cast(pa.timestamp("ns")),
    })
    put(workdir, "odd.parquet", table)
    put(workdir, "one.parquet", pa.table({"only": [None, "v", ""]}))
    job = job_of(spark, workdir)
    job.run_once()
    assert {r.event for r in read_audit(spark, job.audit_dir).collect()} == {"file_received", "conversion_success"}
    [text] = texts(workdir, "odd")
    import csv
    import io

    head, first, second = csv.reader(io.StringIO(text))
    assert head == table.column_names
    got = dict(zip(head, first)), dict(zip(head, second))
    assert got[1]["A"] == 'say "hi",\nthen go' and got[0]["we`ird, name"] == "q" and got[0]["dt.x"] == "2024-01-02"
    assert got[0]["ns"].startswith("2024-03-01T12:30:00.123456") and not got[0]["ns"].endswith("Z")
    assert got[0]["nz"].startswith("2024-03-01T12:30:00.123456") and got[1]["nz"] == ""
    assert got[0]["before"].startswith("1969-12-31T23:59:59.999999") and got[1]["before"].startswith("1970-01-01T00:00:00.000001")
    assert texts(workdir, "one")[0].splitlines() == ["only", '""', "v", '""']
    assert csv_line(["a b", 'q"t', "x,y"]) == 'a b,"q""t","x,y"'


def test_every_part_of_a_split_file_has_the_header(spark, workdir):
    n = 40_000
    put(workdir, "big.parquet", pa.table({"i": list(range(n)), "s": [f"value number {i}" for i in range(n)]}), row_group_size=2000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        job_of(spark, workdir).run_once()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    parts = texts(workdir, "big")
    assert len(parts) > 2 and all(p.startswith("i,s\n") for p in parts)
    back = spark.read.option("header", True).csv(f"{workdir}/out")
    assert back.count() == n and back.agg(F.sum(F.col("i").cast("long"))).first()[0] == n * (n - 1) // 2


def test_a_failed_job_leaves_the_earlier_version(spark, workdir, monkeypatch):
    path = put(workdir, "x.parquet", pa.table({"a": [1, 2, 3]}))
    job = job_of(spark, workdir)
    job._convert(statuses(spark, path))
    before = texts(workdir, "x")
    put(workdir, "x.parquet", pa.table({"a": [4, 5, 6, 7]}))
    bad = put(workdir, "bad.parquet", pa.table({"a": [f"text {i}" for i in range(5000)]}), compression="none", use_dictionary=False)
    column = pq.ParquetFile(bad).metadata.row_group(0).column(0)
    raw = bytearray(open(bad, "rb").read())
    raw[column.data_page_offset + 2: column.data_page_offset + 40] = b"\xff" * 38
    group = statuses(spark, path, bad)
    with open(bad, "wb") as f:
        f.write(raw)
    with pytest.raises(Exception):
        job._convert(group)
    assert texts(workdir, "x") == before and texts(workdir, "bad") == []
    job.process_batch(spark.createDataFrame([(f"file:{p}",) for p in (path, bad)], "path string"), 0)
    assert texts(workdir, "x") == ["a\n4\n5\n6\n7\n"] and os.path.exists(f"{workdir}/err/bad.parquet")


def rows_of(spark, root):
    return sorted(int(r.a) for r in spark.read.option("header", True).csv(f"{root}/out").collect())


def test_any_other_time_or_length_is_a_new_version(spark, workdir):
    put(workdir, "x.parquet", pa.table({"a": [1]}), when=2_000_000_000)
    put(workdir, "same.parquet", pa.table({"a": [50]}), when=1_900_000_000)
    job = job_of(spark, workdir)
    job.run_once()
    received = lambda: read_audit(spark, job.audit_dir).where("event = 'file_received'").count()
    assert rows_of(spark, workdir) == [1, 50] and received() == 2
    job.run_once()
    assert received() == 2  # nothing has changed
    put(workdir, "x.parquet", pa.table({"a": [2, 3, 4, 5, 6]}), when=1_000_000)  # older
    job.run_once()
    assert rows_of(spark, workdir) == [2, 3, 4, 5, 6, 50] and received() == 3
    put(workdir, "x.parquet", pa.table({"a": [7] * 500, "b": ["longer"] * 500}), when=1_000_000)  # same time, other length
    assert job.process_redelivered() == 1 and job.process_redelivered() == 0
    assert rows_of(spark, workdir) == [7] * 500 + [50] or sorted(rows_of(spark, workdir)) == [7] * 500 + [50]
    # another object reads the same state; a quarantined name that comes back is converted
    again = job_of(spark, workdir)
    assert again.process_redelivered() == 0
    path = put(workdir, "same.parquet", pa.table({"a": [51]}))
    with open(path, "wb") as f:
        f.write(b"junk")
    os.utime(path, (1, 1))
    assert again.process_redelivered() == 1 and os.path.exists(f"{workdir}/err/same.parquet")
    put(workdir, "same.parquet", pa.table({"a": [52]}), when=1)
    assert again.process_redelivered() == 1 and 52 in rows_of(spark, workdir)
    state = {r.source_key: r for r in again.arrivals().collect()}
    assert set(state) == {"x.parquet", "same.parquet"} and state["x.parquet"].length == os.path.getsize(f"{workdir}/land/x.parquet")


def test_state_is_seeded_from_an_older_audit_and_bounded(spark, workdir, monkeypatch):
    monkeypatch.setattr(I, "KEPT_VERSIONS", 4)
    put(workdir, "x.parquet", pa.table({"a": [1]}))
    job = job_of(spark, workdir)
    monkeypatch.setattr(ParquetToCsvIngest, "_remember", lambda self, versions: None)
    job.run_once()
    monkeypatch.undo()
    monkeypatch.setattr(I, "KEPT_VERSIONS", 4)
    assert job.process_redelivered() == 0
    for i in range(6):
        put(workdir, f"n{i}.parquet", pa.table({"a": [i]}))
        job.run_once()
    from lapsewise.operators.versioned import VersionedTable

    assert len(VersionedTable(spark, job.arrivals_path).versions()) <= 5 and job.arrivals().count() == 7


def test_continuous_mode_sees_new_files_and_changed_ones(spark, workdir):
    put(workdir, "x.parquet", pa.table({"a": [1]}))
    job = job_of(spark, workdir)
    streams = job.start_continuous("1 second")

    def until(want):
        end = time.time() + 90
        while time.time() < end:
            try:
                if rows_of(spark, workdir) == want:
                    return True
            except Exception:  # noqa: BLE001 - nothing written yet, or files replaced while they are read
                pass
            time.sleep(0.5)
        return False

    try:
        assert until([1])
        time.sleep(1)
        put(workdir, "x.parquet", pa.table({"a": [2, 3]}), when=1_000_000)
        assert until([2, 3])
        put(workdir, "y.parquet", pa.table({"a": [9]}))
        assert until([2, 3, 9])
    finally:
        for s in streams:
            s.stop()
    assert all(s.exception() is None for s in streams)


@pytest.mark.parametrize("given, wanted, ok", [
    ("int", "bigint", True), ("bigint", "int", False), ("int", "double", True), ("bigint", "double", False), ("smallint", "float", True),
    ("int", "float", False), ("float", "double", True), ("double", "float", False), ("decimal(10,2)", "decimal(12,2)", True),
    ("decimal(10,2)", "decimal(10,3)", False), ("decimal(10,2)", "decimal(11,3)", True), ("int", "decimal(12,2)", True),
    ("int", "decimal(11,2)", False), ("string", "string", True), ("string", "date", False), ("date", "timestamp", False), ("void", "date", True)])
def test_order_of_types(given, wanted, ok):
    a, b = (T._parse_datatype_string(x) if hasattr(T, "_parse_datatype_string") else T.DataType.fromDDL(x) for x in (given, wanted))
    assert fits(a, b) is ok


def test_a_contract_accepts_compatible_files(spark, workdir):
    contract = T.StructType([T.StructField("k", T.LongType(), False), T.StructField("v", T.DoubleType()), T.StructField("s", T.StringType())])
    put(workdir, "equal.parquet", pa.table({"k": [1], "v": [1.5], "s": ["a"]}))
    put(workdir, "narrow.parquet", pa.table({"v": pa.array([2.5], pa.float32()), "k": pa.array([2], pa.int32())}))
    put(workdir, "extra.parquet", pa.table({"k": [3], "z": [1]}))
    put(workdir, "nokey.parquet", pa.table({"v": [4.0]}))
    put(workdir, "wide.parquet", pa.table({"k": ["5"]}))
    job = job_of(spark, workdir, expected_schema=contract, compatible=True)
    job.run_once()
    failed = {r.source_key: r.error_type for r in read_audit(spark, job.audit_dir).where("event = 'conversion_failed'").collect()}
    assert failed == {f"{n}.parquet": "SchemaMismatch" for n in ("extra", "nokey", "wide")}
    assert texts(workdir, "equal") == ["k,v,s\n1,1.5,a\n"] and texts(workdir, "narrow") == ["k,v,s\n2,2.5,\n"]
    assert misfits(contract, contract) == [] and misfits(T.StructType([]), contract) == ["no column k"]


def test_events_have_times_of_their_own(spark, workdir):
    put(workdir, "x.parquet", pa.table({"a": [1]}))
    job = job_of(spark, workdir)
    job.run_once()
    at = {r.event: r.timestamp for r in read_audit(spark, job.audit_dir).collect()}
    assert at["file_received"] < at["conversion_success"]
