import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from lapsewise.operators import textclean as TC
from lapsewise.plans import incremental as INC
from lapsewise.plans import models
from tests.fixtures import write


def test_upsert_newest_wins(spark, workdir):
    path = f"{workdir}/t"
    a = spark.createDataFrame([(1, 10, "old"), (2, 10, "keep")], "k long, v long, s string")
    INC.upsert(spark, path, a, ["k"], ["v"])
    b = spark.createDataFrame([(1, 11, "new"), (2, 9, "stale"), (3, 1, "added")], "k long, v long, s string")
    out = {r.k: r.s for r in INC.upsert(spark, path, b, ["k"], ["v"]).collect()}
    assert out == {1: "new", 2: "keep", 3: "added"}


def test_bucketed_upsert_rewrites_touched_buckets_only(spark, workdir):
    import glob
    import os

    path = f"{workdir}/b"
    a = spark.createDataFrame([(k, 1, f"v{k}") for k in range(200)], "k long, v long, s string")
    INC.upsert(spark, path, a, ["k"], ["v"], buckets=8)
    stamps = {d: os.path.getmtime(d) for d in glob.glob(f"{path}/_bucket=*")}
    assert len(stamps) == 8
    b = spark.createDataFrame([(5, 2, "new"), (500, 1, "added"), (7, 0, "stale")], "k long, v long, s string")
    out = {r.k: r.s for r in INC.upsert(spark, path, b, ["k"], ["v"], buckets=8).collect()}
    assert out[5] == "new" and out[500] == "added" and out[7] == "v7" and len(out) == 201
    touched = {r[0] for r in b.select(INC.key_bucket(["k"], 8)).collect()}
    for d, t in stamps.items():
        bucket = int(d.rsplit("=", 1)[1])
        assert (os.path.getmtime(d) != t) == (bucket in touched) or bucket in touched


def test_refresh_summary_equals_full_rebuild(spark):
    fact = spark.createDataFrame(
        [(1, dt.date(2024, 1, d), Decimal(f"{d}.50"), s) for d, s in [(1, "Lapsed"), (2, "Active")]]
        + [(2, dt.date(2024, 2, 1), Decimal("7.00"), "Pending"), (3, dt.date(2024, 3, 1), Decimal("1.00"), "Lapsed")],
        "policy_id long, lapse_date date, premium_amount decimal(10,2), status string",
    )
    policy = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 2, "a")], "policy_id long, client_id long, product_id string")
    patients = spark.createDataFrame([(1, 1.0, False, "X"), (2, 2.0, True, "Y")],
                                     "client_id long, income double, income_was_imputed boolean, province string")
    early = fact.where(F.col("lapse_date") < dt.date(2024, 2, 1))
    late = fact.where(F.col("lapse_date") >= dt.date(2024, 2, 1))
    old = models.patient_claims_summary(early, policy, patients)
    got = INC.refresh_summary(old, fact, policy, patients, late)
    full = models.patient_claims_summary(fact, policy, patients)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.select(*got.columns).collect()))


def test_refresh_summary_bounds_what_a_task_gets(spark, monkeypatch):
    from lapsewise import session

    fact = spark.createDataFrame(
        [(i // 3, dt.date(2024, 1 + i % 3, 1), Decimal(f"{i}.50"), "Active") for i in range(300)],
        "policy_id long, lapse_date date, premium_amount decimal(10,2), status string",
    )
    policy = spark.createDataFrame([(i, i // 4, f"p{i % 3}") for i in range(100)], "policy_id long, client_id long, product_id string")
    patients = spark.createDataFrame([(i, 1.0, False, "X") for i in range(25)],
                                     "client_id long, income double, income_was_imputed boolean, province string")
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    own, seen = [spark.conf.get(n) for n in names], []

    def noted(df, name="materialized"):
        seen.append([int(spark.conf.get(n)) for n in names])
        return session.materialize(df, name)

    monkeypatch.setattr(session, "PARTITION_ROWS", 10)
    monkeypatch.setattr(models, "materialize", noted)
    monkeypatch.setattr(INC, "materialize", noted)
    late = fact.where(F.col("lapse_date") >= dt.date(2024, 3, 1))
    old = models.written_claims_summary(fact.where(F.col("lapse_date") < dt.date(2024, 3, 1)), policy, patients)
    got = INC.refresh_summary(old, fact, policy, patients, late)
    assert seen == [[20, 8 << 20]] + 3 * [[30, 8 << 20]]
    assert [spark.conf.get(n) for n in names] == own
    full = models.patient_claims_summary(fact, policy, patients)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, full.select(*got.columns).collect()))


def test_date_partitioned_layout_prunes(spark, workdir):
    df = spark.createDataFrame(
        [(i, dt.date(2024, 1, 1) + dt.timedelta(days=i)) for i in range(60)], "id long, d date"
    )
    INC.write_date_partitioned(df, "d", f"{workdir}/p")
    back = spark.read.parquet(f"{workdir}/p")
    q = back.where((F.col("month") == 2) & (F.col("day") == 3))
    assert [r.id for r in q.collect()] == [33]
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_masking_and_retention(spark):
    df = spark.createDataFrame([("Ann", dt.date(2024, 1, 1)), ("Bob", dt.date(2023, 1, 1))], "name string, d date")
    masked = INC.mask_columns(df, ["name"], "s")
    assert all(len(r.name) == 64 for r in masked.collect())
    kept = INC.within_retention(df, "d", 30, today="2024-01-15")
    assert [r.name for r in kept.collect()] == ["Ann"]


def test_clean_counts_in_profile(spark, workdir):
    write(f"{workdir}/in/a.txt", "# x\na|b\nc|d\ne\n")
    res = TC.clean_files(spark, f"{workdir}/in", f"{workdir}/out")
    p = res["profiles"].first()
    assert (p.data_rows, p.clean_rows, p.rejected_rows) == (3, 2, 1)
    assert res["rejects"].count() == 1


def test_insert_if_absent_reports_counts(spark, workdir):
    from lapsewise.operators.loading import insert_if_absent

    path = f"{workdir}/dim"
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    assert insert_if_absent(spark, path, a, ["k"]) == {"rows_read": 2, "rows_inserted": 2}
    b = spark.createDataFrame([(2, "B"), (3, "c"), (3, "c2")], "k long, v string").withColumn("o", F.monotonically_increasing_id())
    got = insert_if_absent(spark, path, b, ["k"], order=["o"], drop=["o"])
    assert got == {"rows_read": 3, "rows_inserted": 1}
    rows = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert rows == {1: "a", 2: "b", 3: "c"}
