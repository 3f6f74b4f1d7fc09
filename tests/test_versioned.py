"""Tables in versions: every change is seen whole or not at all."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lapsewise.operators.loading import insert_if_absent, read_table, replace_table
from lapsewise.operators.versioned import SEGMENT_BITS, Conflict, VersionedTable, _bit, _probes
from lapsewise.plans import incremental as INC
from lapsewise.plans import models, warehouse
from tests import fixtures


def rows(spark, n, v, first=0):
    return spark.range(first, first + n).select(F.col("id").alias("k"), F.lit(v).alias("v"), F.concat(F.lit("s"), "id").alias("s"))


def content(table):
    return sorted(map(tuple, table.read().collect()))


CHANGES = {
    "replace": lambda t, s: t.replace(rows(s, 5, 9)),
    "insert": lambda t, s: t.insert_if_absent(rows(s, 60, 7, first=20), ["k"]),
    "upsert": lambda t, s: t.upsert(rows(s, 60, 8, first=20), ["k"], ["v"]),
    "merge": lambda t, s: t.merge(rows(s, 60, 3, first=20), ["k"], {"v": "sum", "s": "max"}, "b2"),
    "compact": lambda t, s: (t.insert_if_absent(rows(s, 5, 1, first=500), ["k"]), t.compact()),
}
STEPS = ["_write_part", "_write_index", "_stage_manifest", "_publish"]


class Crash(BaseException):
    pass


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_crash_between_any_two_steps_shows_old_or_new(spark, workdir, monkeypatch, step, when):
    table = VersionedTable(spark, f"{workdir}/t")
    table.insert_if_absent(rows(spark, 40, 1), ["k"], buckets=4)
    for name in ("replace", "insert", "upsert", "merge"):
        if name == "replace" and step == "_write_index":
            continue
        work = VersionedTable(spark, f"{workdir}/{name}")
        work.insert_if_absent(rows(spark, 40, 1), ["k"], buckets=4)
        old, before = content(work), work.versions()
        real = getattr(VersionedTable, step)

        def crash(self, *args, **kw):
            if when == "after":
                real(self, *args, **kw)
            raise Crash

        monkeypatch.setattr(VersionedTable, step, crash)
        with pytest.raises(Crash):
            CHANGES[name](work, spark)
        monkeypatch.setattr(VersionedTable, step, real)
        published = step == "_publish" and when == "after"
        assert (content(work) != old) == published and len(work.versions()) == len(before) + published
        # the next attempt works, and what the crash left is removed
        CHANGES[name](work, spark)
        want = content(work)
        work.vacuum(keep=1)
        assert content(work) == want
        folders = sum(len(os.listdir(f"{workdir}/{name}/{k}")) for k in ("data", "index") if os.path.isdir(f"{workdir}/{name}/{k}"))
        assert folders == sum(1 + bool(p["index"]) for p in work.snapshot().parts)


def test_readers_keep_the_version_they_resolved(spark, workdir):
    table = VersionedTable(spark, f"{workdir}/t")
    table.replace(rows(spark, 10, 1))
    held = table.read()
    table.replace(rows(spark, 3, 2))
    assert held.count() == 10 and table.read().count() == 3 and table.read(version=1).count() == 10
    with pytest.raises(ValueError):
        table.replace(rows(spark, 4, 3), validate=lambda df: (_ for _ in ()).throw(ValueError("refused")))
    assert table.read().count() == 3 and table.versions() == [1, 2]


def test_a_version_is_taken_once(spark, workdir):
    table = VersionedTable(spark, f"{workdir}/t")
    table.replace(rows(spark, 1, 1))
    text = table.snapshot().as_json()
    with pytest.raises(Conflict):
        table._publish(table._stage_manifest(text), 1)
    assert not [n for n in os.listdir(f"{workdir}/t/_versions") if "tmp" in n]


@pytest.mark.parametrize("change", ["insert", "upsert", "merge"])
def test_the_loser_of_a_race_starts_again(spark, workdir, monkeypatch, change):
    table = VersionedTable(spark, f"{workdir}/t")
    table.insert_if_absent(rows(spark, 40, 1), ["k"], buckets=4)
    real, raced = VersionedTable._stage_manifest, []

    def race(self, text):
        if not raced:
            raced.append(1)
            VersionedTable(spark, table.path).insert_if_absent(rows(spark, 10, 5, first=70), ["k"])
        return real(self, text)

    monkeypatch.setattr(VersionedTable, "_stage_manifest", race)
    got = CHANGES[change](table, spark)
    values = {k: v for k, v, _ in content(table)}
    assert sorted(values) == list(range(80)) and values[0] == 1
    if change == "insert":
        assert got["rows_inserted"] == 30 and values[75] == 5 and values[45] == 7
    if change == "merge":
        assert values[75] == 8 and values[25] == 4 and values[45] == 3


def test_a_small_load_reads_only_the_buckets_that_may_hold_its_keys(spark, workdir):
    path = f"{workdir}/t"
    table = VersionedTable(spark, path)
    assert table.insert_if_absent(rows(spark, 5000, 1), ["k"], buckets=16) == {
        "rows_read": 5000, "rows_inserted": 5000, "buckets_read": []}
    # new keys of every bucket: the filters rule (nearly) all of them out
    got = table.insert_if_absent(rows(spark, 300, 2, first=10_000), ["k"])
    assert got["rows_inserted"] == 300 and len(got["buckets_read"]) <= 10
    # two known keys and a new one: their buckets at most
    few = spark.createDataFrame([(3, 9, "x"), (4, 9, "y"), (20_000, 9, "z")], "k long, v int, s string")
    staged = table.stage(few, ["k"])
    assert len(staged.buckets_read) <= 3
    held = {os.path.dirname(f) for f in table.read(values=staged.buckets_read).inputFiles()}
    assert {h.rsplit("=", 1)[1] for h in held} == set(staged.buckets_read)
    assert table.insert(staged)["rows_inserted"] == 1
    values = {k: v for k, v, _ in content(table)}
    assert len(values) == 5301 and values[3] == 1 and values[10_005] == 2 and values[20_000] == 9
    assert len(table.compact().parts) == 1 and {k: v for k, v, _ in content(table)} == values
    assert table.insert_if_absent(rows(spark, 5000, 4), ["k"])["rows_inserted"] == 0


def test_filters_hold_every_key(spark):
    keys = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    bits = SEGMENT_BITS * 2
    at = keys.select("k", F.explode(_probes(["k"], bits)).alias("at"))
    index = at.groupBy((F.col("at") / SEGMENT_BITS).cast("int").alias("segment")).agg(
        F.bitmap_construct_agg(F.pmod("at", F.lit(SEGMENT_BITS))).alias("bits"))
    hit = at.withColumn("segment", (F.col("at") / SEGMENT_BITS).cast("int")).join(index, "segment")
    assert hit.where(_bit("bits", F.pmod("at", F.lit(SEGMENT_BITS))) != 1).count() == 0
    other = spark.range(5000, 9000).select(F.explode(_probes(["id"], bits)).alias("at"))
    other = other.withColumn("segment", (F.col("at") / SEGMENT_BITS).cast("int")).join(index, "segment")
    share = other.agg(F.avg(_bit("bits", F.pmod("at", F.lit(SEGMENT_BITS))))).first()[0]
    assert 0.1 < share < 0.4  # 15 000 of 65 536 bits


def test_null_keys_and_other_settings_are_refused(spark, workdir):
    table = VersionedTable(spark, f"{workdir}/t")
    with pytest.raises(ValueError, match="NULL"):
        table.insert_if_absent(spark.createDataFrame([(1, "a"), (None, "b")], "k long, v string"), ["k"])
    assert not table.exists()
    table.insert_if_absent(spark.createDataFrame([], "k long, v string"), ["k"], buckets=4)
    assert table.read().count() == 0
    for wrong in (dict(keys=["v"]), dict(keys=["k"], buckets=8)):
        with pytest.raises(ValueError):
            table.insert_if_absent(spark.createDataFrame([(1, "a")], "k long, v string"), **wrong)
    with pytest.raises(FileNotFoundError):
        VersionedTable(spark, f"{workdir}/none").read()


def test_functions_accept_both_kinds_of_tables(spark, workdir):
    path = f"{workdir}/v"
    replace_table(spark, path, rows(spark, 3, 1), versioned=True)
    assert replace_table(spark, path, rows(spark, 4, 2)).count() == 4 and read_table(spark, path).count() == 4
    replace_table(spark, f"{workdir}/p", rows(spark, 3, 1))
    assert read_table(spark, f"{workdir}/p").count() == 3
    with pytest.raises(ValueError):
        insert_if_absent(spark, f"{workdir}/p", rows(spark, 3, 1), ["k"], versioned=True)
    up = f"{workdir}/u"
    INC.upsert(spark, up, rows(spark, 50, 1), ["k"], ["v"], buckets=4, versioned=True)
    got = {r.k: r.v for r in INC.upsert(spark, up, rows(spark, 5, 2).unionByName(rows(spark, 5, 0, first=10)), ["k"], ["v"]).collect()}
    assert got[0] == 2 and got[10] == 1 and len(got) == 50


def test_a_large_bucket_is_written_by_several_tasks(spark, workdir):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = VersionedTable(spark, f"{workdir}/t")
        table.upsert(rows(spark, 4000, 1), ["k"], ["v"], buckets=1)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(table.read().inputFiles()) >= 3


def lapses(spark, days):
    return spark.createDataFrame(
        [(p, dt.date(2024, 1, 1) + dt.timedelta(days=d), Decimal(f"{p}.25"), s) for p, d, s in days],
        "policy_id long, lapse_date date, premium_amount decimal(10,2), status string")


def test_merged_state_equals_a_rebuild(spark, workdir):
    batches = [[(1, 3, "Lapsed"), (1, 9, "Active"), (2, 4, "Pending")], [(1, 1, "Lapsed"), (3, 5, "Other")], [], [(2, 40, "Active")] * 3]
    policy = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (3, 2, "a")], "policy_id long, client_id long, product_id string")
    patients = spark.createDataFrame([(1, 1.0, "X"), (2, 2.0, "Y")], "client_id long, income double, province string")
    path, seen = f"{workdir}/state", []
    for i, batch in enumerate(batches):
        seen += batch
        state = INC.merge_claims(spark, path, lapses(spark, batch), f"batch {i}", buckets=4)
        again = INC.merge_claims(spark, path, lapses(spark, batch), f"batch {i}")  # sent again
        want = models.patient_claims_summary(lapses(spark, seen), policy, patients)
        for s in (state, again):
            got = INC.summary_from_state(s, policy, patients)
            assert got.schema == want.schema
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    # a batch of one policy rewrites one bucket
    parts = VersionedTable(spark, path).snapshot().parts
    assert len(parts) > 1 and VersionedTable(spark, path).snapshot().rows() == 3


def test_expiry_removes_months_and_logs_them(spark, workdir):
    table = VersionedTable(spark, f"{workdir}/t")
    days = [(i % 7, d, "Active") for i, d in enumerate(range(0, 130))]
    df = lapses(spark, days).unionByName(lapses(spark, [(9, 0, "Active")]).withColumn("lapse_date", F.lit(None).cast("date")))
    table.append_dated(df, "lapse_date")
    table.append_dated(lapses(spark, [(8, 33, "Active")] * 4), "lapse_date")
    before = {f for f in table.read().inputFiles() if "2024-04" in f}
    removed = {r.period: (r.rows_removed, r.how) for r in table.expire("2024-03-10").collect()}
    assert removed == {"2024-01": (31, "dropped"), "2024-02": (33, "dropped"), "2024-03": (9, "rewritten")}
    left = [r.lapse_date for r in table.read().collect()]
    assert None in left and min(d for d in left if d) == dt.date(2024, 3, 10) and len(left) == 1 + 130 - 69
    assert before <= set(table.read().inputFiles())  # later months are not written again
    pruned = table.read_dates("2024-04-05", "2024-04-20")
    assert all("2024-04" in f for f in pruned.inputFiles()) and pruned.count() == 16
    assert table.expire("2024-03-10").count() == 0 and len(table.versions()) == 3
    table.expire("2025-01-01")
    assert [r.lapse_date for r in table.read().collect()] == [None]
    assert table.expired().agg(F.sum("rows_removed")).first()[0] == 31 + 33 + 9 + 22 + 30 + 9
    assert table.expired().where("version = 3").count() == 3


def test_a_versioned_warehouse_loads_twice(spark, workdir):
    given = fixtures.reference_inputs(workdir)
    from lapsewise.operators import textclean

    textclean.clean_files(spark, f"{workdir}/raw", f"{workdir}/cleaned")
    args = dict(clients_path=given["clients"], products_path=f"{workdir}/cleaned/layout_4", lapses_path=given["lapses"])
    plain = warehouse.read_warehouse(spark, warehouse.load_warehouse(spark, f"{workdir}/plain", **args))
    for _ in range(2):
        paths = warehouse.load_warehouse(spark, f"{workdir}/wh", **args, versioned=True)
        tables = warehouse.read_warehouse(spark, paths)
        for name, df in tables.items():
            assert sorted(map(str, df.collect())) == sorted(map(str, plain[name].select(*df.columns).collect())), name
    marts = warehouse.build_marts(spark, tables, f"{workdir}/marts", versioned=True)
    assert read_table(spark, marts["dim_patients"]).count() == plain["dim_clients"].count()
