"""Inputs of odd shape: nothing is lost, and bad rows stop a load before it writes."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lapsewise.operators import textclean
from lapsewise.operators.loading import insert_if_absent
from lapsewise.plans import warehouse
from lapsewise.plans.incremental import upsert, write_date_partitioned
from lapsewise.sources import files
from lapsewise.streaming.ingest import ParquetToCsvIngest, glob_safe, read_audit


def ingest(spark, root):
    return ParquetToCsvIngest(spark, f"{root}/land", f"{root}/out", f"{root}/err", f"{root}/audit", f"{root}/ckpt")


def put(root, name, table):
    path = f"{root}/land/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    pq.write_table(table, path)
    return path


def rows_out(spark, root):
    return spark.read.option("header", True).csv(f"{root}/out")


def test_old_dates_odd_names_and_nested_columns(spark, workdir):
    put(workdir, "first.parquet", pa.table({"a": [1]}))
    job = ingest(spark, workdir)
    job.run_once()
    old = put(workdir, "old.parquet", pa.table({"a": [2]}))
    os.utime(old, (86_400, 86_400))
    put(workdir, "b[1]{x}*.parquet", pa.table({"a": [3]}))
    put(workdir, "nested.parquet", pa.table({"a": [4], "l": [[1, 2]], "s": [{"k": "v"}], "b": [b"xy"]}))
    put(workdir, "void.parquet", pa.table({"a": pa.array([], pa.int64()), "z": pa.array([], pa.string())}))
    job.run_once()
    events = {(r.event, r.source_key) for r in read_audit(spark, job.audit_dir).collect()}
    for name in ("first", "old", "b[1]{x}*", "nested", "void"):
        assert ("conversion_success", f"{name}.parquet") in events
    got = rows_out(spark, workdir)
    assert sorted(int(r.a) for r in got.collect()) == [1, 2, 3, 4]
    nested = spark.read.option("header", True).option("escape", '"').csv(
        next(f.path for f in os.scandir(f"{workdir}/out") if "nested" in f.name)).first()
    assert (nested.l, nested.s, nested.b) == ("[1,2]", '{"k":"v"}', "eHk=")
    void = next(f.path for f in os.scandir(f"{workdir}/out") if "void" in f.name)
    texts = [open(f.path).read() for f in os.scandir(void) if f.name.startswith("part-")]
    assert texts == ["a,z\n"]


def test_sent_again_is_converted_again(spark, workdir):
    path = put(workdir, "x.parquet", pa.table({"a": [1, 2, 3]}))
    job = ingest(spark, workdir)
    job.run_once()
    assert job.process_redelivered() == 0
    put(workdir, "x.parquet", pa.table({"a": [1, 2, 3, 4, 5]}))
    os.utime(path, (4e9, 4e9))
    job.run_once()
    assert rows_out(spark, workdir).count() == 5
    assert job.process_redelivered() == 0
    # a fresh checkpoint keeps the earlier audit rows
    before = read_audit(spark, job.audit_dir).count()
    ParquetToCsvIngest(spark, f"{workdir}/land", f"{workdir}/out", f"{workdir}/err", f"{workdir}/audit", f"{workdir}/ckpt2").run_once()
    assert read_audit(spark, job.audit_dir).count() > before


def test_files_that_cannot_be_written_stand_alone(spark, workdir, monkeypatch):
    for i in range(5):
        put(workdir, f"f{i}.parquet", pa.table({"a": [i]}))
    job = ingest(spark, workdir)
    write = ParquetToCsvIngest._write

    def refuse(self, df):
        if any("f3.parquet" in f for f in df.inputFiles()):
            raise RuntimeError("cannot write this one")
        write(self, df)

    monkeypatch.setattr(ParquetToCsvIngest, "_write", refuse)
    job.run_once()
    assert sorted(int(r.a) for r in rows_out(spark, workdir).collect()) == [0, 1, 2, 4]
    assert os.path.exists(f"{workdir}/err/f3.parquet") and not os.path.exists(f"{workdir}/land/f3.parquet")
    # quarantined again over the earlier copy
    put(workdir, "sub/f3.parquet", pa.table({"a": [3]}))
    job._move(f"{workdir}/land/sub/f3.parquet", f"{workdir}/err/f3.parquet")
    assert not os.path.exists(f"{workdir}/land/sub/f3.parquet")


def test_equal_schemas_share_a_job(spark, workdir):
    import pandas as pd

    from lapsewise.streaming.ingest import footer_status

    paths = []
    for i in range(3):
        table = pa.Table.from_pandas(pd.DataFrame({"a": [1] * (i + 1)}))
        paths.append(("file:" + put(workdir, f"p{i}.parquet", table),))
    got = footer_status(spark.createDataFrame(paths, "path string"), 2).collect()
    assert len({r.schema for r in got}) == 1 and got[0].spark_types == ["a: bigint"]
    assert glob_safe("a[1]*") == "a\\[1\\]\\*"


def test_clients_are_read_by_name(spark, workdir):
    path = f"{workdir}/clients.csv"
    with open(path, "w") as f:
        f.write('client_id,province,income,name\n1,"N/A",5.5,"Ann ""Jo"" Lee"\n2,KZN,NULL,Bob\n')
    got = {r.client_id: (r["name"], r.income and float(r.income), r.province) for r in files.read_clients_csv(spark, path).collect()}
    assert got == {1: ('Ann "Jo" Lee', 5.5, None), 2: ("Bob", None, "KZN")}
    with open(path, "w") as f:
        f.write("client_id,name,income\n1,a,2\n")
    with pytest.raises(ValueError, match="province"):
        files.read_clients_csv(spark, path)


def write_inputs(workdir, spark, client_rows, lapse_policy=1):
    os.makedirs(workdir, exist_ok=True)
    with open(f"{workdir}/clients.csv", "w") as f:
        f.write("client_id,name,income,province\n" + "".join(r + "\n" for r in client_rows))
    with open(f"{workdir}/products.csv", "w") as f:
        f.write("product_id,product_name,tier,status\nprod_001,A,Gold,Active\nprod_002,B,Gold,Active\n")
    spark.createDataFrame([(lapse_policy, "2024-01-02", 5.0, "Active")], "policy_id long, lapse_date string, premium_amount double, status string"
                          ).write.mode("overwrite").parquet(f"{workdir}/lapses")
    return dict(clients_path=f"{workdir}/clients.csv", products_path=f"{workdir}/products.csv", lapses_path=f"{workdir}/lapses")


@pytest.mark.parametrize("rows, clients", [(["1,a,5,KZN", "2,,5,KZN"], 2), (["1,a,5,KZN"], 2), ([",a,5,KZN", "1,a,5,KZN"], 1)])
def test_a_bad_dimension_row_stops_the_load_before_any_write(spark, workdir, rows, clients):
    """A missing name, a policy of an unknown client, a NULL key."""
    given = write_inputs(workdir, spark, rows)
    with pytest.raises((AssertionError, ValueError)):
        warehouse.load_warehouse(spark, f"{workdir}/wh", **given, policies=(1, 4), num_clients=clients, num_products=2)
    assert not os.path.exists(f"{workdir}/wh")


def test_long_product_numbers_stay_whole(spark):
    got = warehouse.policy_bridge(spark.createDataFrame([(1749,), (4,)], "policy_id long"), 10, 5000, first_client=0).collect()
    assert {r.policy_id: (r.client_id, r.product_id) for r in got} == {1749: (9, "prod_1750"), 4: (4, "prod_005")}


def test_null_keys_are_refused(spark, workdir):
    batch = spark.createDataFrame([(1, "a"), (None, "b")], "k long, v string")
    with pytest.raises(ValueError):
        insert_if_absent(spark, f"{workdir}/t", batch, ["k"])
    tied = spark.createDataFrame([(1, "b"), (1, "a")], "k long, v string")
    insert_if_absent(spark, f"{workdir}/t", tied, ["k"])
    assert [tuple(r) for r in spark.read.parquet(f"{workdir}/t").collect()] == [(1, "a")]


def test_upsert_keeps_its_bucket_count(spark, workdir):
    path = f"{workdir}/t"
    rows = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    upsert(spark, path, rows, ["k"], ["v"], buckets=4)
    with pytest.raises(ValueError):
        upsert(spark, path, rows.limit(5), ["k"], ["v"], buckets=8)
    got = upsert(spark, path, rows.where("k < 5").withColumn("v", F.lit(2)), ["k"], ["v"], buckets=4)
    assert got.count() == 100 and got.where("v = 2").count() == 5
    assert not [f for f in os.listdir(path) if "retired" in f]
    files_of = {f: len([x for x in os.listdir(f"{path}/{f}") if x.endswith(".parquet")]) for f in os.listdir(path) if f.startswith("_bucket")}
    assert len(files_of) == 4 and set(files_of.values()) == {1}


def test_cleaning_again_leaves_nothing_behind(spark, workdir):
    src, out = f"{workdir}/src", f"{workdir}/out"
    os.makedirs(src)
    for name, text in (("a.txt", "1|x|y\n2|x|y\n3|x|y|z\n"), ("b.txt", "1|x|y\n2|x|y\n"), ("none.txt", ""), ("preamble.txt", "---\n\n")):
        with open(f"{src}/{name}", "w") as f:
            f.write(text)
    res = textclean.clean_files(spark, src, out)
    assert res["rejects"].count() == 1
    assert sorted(os.path.basename(r._file) for r in res["empty_files"].collect()) == ["none.txt", "preamble.txt"]
    assert os.path.isdir(f"{out}/layout_3")
    with open(f"{src}/a.txt", "w") as f:
        f.write("1|x|y|z\n2|x|y|z\n")
    os.remove(f"{src}/b.txt")
    textclean.clean_files(spark, src, out)
    assert not os.path.exists(f"{out}/layout_3") and os.path.isdir(f"{out}/layout_4")
    with pytest.raises(FileNotFoundError):
        textclean.clean_files(spark, f"{workdir}/nowhere", out)


def test_a_busy_day_is_spread(spark, workdir):
    rows = spark.range(4000).select("id", F.lit("2024-05-01").cast("date").alias("d"))
    write_date_partitioned(rows, "d", f"{workdir}/days")
    folder = f"{workdir}/days/year=2024/month=5/day=1"
    assert spark.read.parquet(f"{workdir}/days").count() == 4000
    assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) >= 1
