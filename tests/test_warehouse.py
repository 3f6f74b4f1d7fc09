"""End-to-end load of the documented fixture: clean -> load -> marts -> tests."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from lapsewise.operators import quality as Q
from lapsewise.operators import textclean as TC
from lapsewise.operators.loading import read_table
from lapsewise.plans import models, warehouse
from tests import fixtures


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("wh"))
    inputs = fixtures.reference_inputs(root)
    TC.clean_files(spark, f"{root}/raw", f"{root}/cleaned")
    paths = warehouse.load_warehouse(
        spark, f"{root}/warehouse", inputs["clients"], f"{root}/cleaned/layout_4", inputs["lapses"]
    )
    return spark, root, inputs, paths


def _rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_table_counts(loaded):
    spark, _, _, paths = loaded
    t = warehouse.read_warehouse(spark, paths)
    counts = {k: v.count() for k, v in t.items()}
    assert counts == {
        "dim_clients": 8, "dim_products": 5, "dim_date": 121, "dim_policy": 100, "fct_health_lapses": 100,
    }


def test_products_cleaned_lowercase(loaded):
    spark, _, _, paths = loaded
    ids = [r.product_id for r in spark.read.parquet(paths["dim_products"]).orderBy("product_id").collect()]
    assert ids == [f"prod_00{i}" for i in range(1, 6)]


def test_bridge_rule(loaded):
    spark, _, _, paths = loaded
    b = {r.policy_id: (r.client_id, r.product_id) for r in spark.read.parquet(paths["dim_policy"]).collect()}
    assert b[1001] == (2, "prod_002") and b[1005] == (6, "prod_001")


def test_calendar_row(loaded):
    spark, _, _, paths = loaded
    d = spark.read.parquet(paths["dim_date"]).where("date_key = 20240229").first()
    assert d.full_date == dt.date(2024, 2, 29) and d.day_of_week == 4 and d.day_name == "Thursday"
    assert d.is_month_end and not d.is_month_start and d.quarter == 1 and d.month_name == "February"
    assert spark.read.parquet(paths["dim_date"]).where("is_weekend").count() == 34


def test_fact_keys_follow_file_order(loaded):
    spark, _, _, paths = loaded
    f = spark.read.parquet(paths["fct_health_lapses"])
    rows = _rows(f, "lapse_id", "policy_id", "date_key")
    assert [r[0] for r in rows] == list(range(1, 101))
    assert all(r[1] == 1000 + r[0] for r in rows)
    assert dict(f.dtypes)["premium_amount"] == "decimal(10,2)"


def test_reload_is_idempotent(loaded):
    spark, root, inputs, paths = loaded
    before = {k: _rows(v, *v.columns) for k, v in warehouse.read_warehouse(spark, paths).items()}
    warehouse.load_warehouse(
        spark, f"{root}/warehouse", inputs["clients"], f"{root}/cleaned/layout_4", inputs["lapses"]
    )
    after = {k: _rows(v, *v.columns) for k, v in warehouse.read_warehouse(spark, paths).items()}
    assert before == after


def test_fact_gate_blocks_orphans(loaded, tmp_path):
    spark, root, inputs, paths = loaded
    bad = fixtures.lapse_table(5, first_policy=5000)  # unknown policies
    p = fixtures.write_lapses(f"{tmp_path}/bad.parquet", bad)
    with pytest.raises(AssertionError, match="relationships"):
        warehouse.load_warehouse(spark, f"{root}/warehouse", inputs["clients"], f"{root}/cleaned/layout_4", p)
    # the old fact survived the failed reload
    assert spark.read.parquet(paths["fct_health_lapses"]).count() == 100


def test_missing_input_fails_before_writing(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        warehouse.load_warehouse(spark, f"{tmp_path}/wh", f"{tmp_path}/none.csv", f"{tmp_path}/x", f"{tmp_path}/y")


def _many_products(spark, root, ids, lapsed=2):
    """A load of 100,000 products, of which the file holds those that the policies name."""
    clients = fixtures.write(f"{root}/c.csv", "client_id,name,income,province\n0,A,10.0,X\n1,B,20.0,X\n")
    rows = "".join(f"{i},Plan,Tier 1,Active\n" for i in ids)
    products = fixtures.write(f"{root}/p/p.csv", f"product_id,product_name,tier,status\n{rows}")
    lapses = fixtures.write_lapses(f"{root}/l.parquet", fixtures.lapse_table(lapsed, first_policy=99_998))
    return warehouse.load_warehouse(spark, f"{root}/wh", clients, products, lapses, policies=(99_998, 99_999),
                                    num_clients=2, num_products=100_000, first_client=0, versioned=True)


def test_ids_of_100000_products_are_loaded_and_their_length_reported(spark, workdir):
    from lapsewise.registry import WAREHOUSE_CHECKS

    t = warehouse.read_warehouse(spark, _many_products(spark, workdir, ["prod_99999", "prod_100000"]))
    assert _rows(t["dim_policy"], "policy_id", "product_id") == [(99_998, "prod_99999"), (99_999, "prod_100000")]
    failed = {r.test_name: r.failures for r in Q.run_checks(WAREHOUSE_CHECKS, t).where("failures > 0").collect()}
    assert failed == {"max_length__dim_products__product_id": 1, "max_length__dim_policy__product_id": 1}


def test_marts_of_100000_products(spark, workdir):
    t = warehouse.read_warehouse(spark, _many_products(spark, workdir, ["prod_99999", "prod_100000"]))
    marts = warehouse.build_marts(spark, t, f"{workdir}/marts", versioned=True)
    summary = read_table(spark, marts["fct_patient_claims_summary"])
    assert _rows(summary, "client_id", "income", "total_claims", "distinct_products") == [(0, 10.0, 1, 1), (1, 20.0, 1, 1)]


def test_product_id_longer_than_the_rule_aborts_the_load(spark, workdir):
    with pytest.raises(AssertionError, match="max_length__dim_products__product_id=1"):
        _many_products(spark, workdir, ["prod_99999", "prod_100000", "prod_1000000"])


def test_keys_with_gaps(spark, workdir):
    """Clients 0 and 5, of which the rule names 0 and 1: refused, or loaded and reported."""
    from lapsewise.registry import WAREHOUSE_CHECKS

    clients = fixtures.write(f"{workdir}/c.csv", "client_id,name,income,province\n0,A,10.0,X\n5,B,20.0,X\n")
    products = fixtures.write(f"{workdir}/p/p.csv", "product_id,product_name,tier,status\nprod_001,Plan,Tier 1,Active\nprod_003,Plan,Tier 1,Active\n")
    lapses = fixtures.write_lapses(f"{workdir}/l.parquet", fixtures.lapse_table(4, first_policy=10))

    def load(root, **how):
        return warehouse.load_warehouse(spark, f"{workdir}/{root}", clients, products, lapses, policies=(10, 13),
                                        num_clients=2, num_products=2, first_client=0, versioned=True, **how)

    with pytest.raises(AssertionError, match="relationships__dim_policy__client_id"):
        load("refused")
    t = warehouse.read_warehouse(spark, load("loaded", bridge_gaps=True))
    assert _rows(t["dim_policy"], "policy_id", "client_id") == [(10, 0), (11, 1), (12, 0), (13, 1)]
    failed = {r.test_name: r.failures for r in Q.run_checks(WAREHOUSE_CHECKS, t).where("failures > 0").collect()}
    assert set(failed) == {"relationships__dim_policy__client_id", "relationships__dim_policy__product_id"}
    marts = warehouse.build_marts(spark, t, f"{workdir}/marts", versioned=True)
    assert _rows(read_table(spark, marts["fct_patient_claims_summary"]), "client_id", "total_claims") == [(0, 2)]


def test_policies_without_parents_are_reported(spark, workdir):
    """With ``bridge_gaps`` the policy's foreign keys are checked too: its orphans are told, once."""
    clients = fixtures.write(f"{workdir}/c.csv", "client_id,name,income,province\n0,A,10.0,X\n5,B,20.0,X\n")
    products = fixtures.write(f"{workdir}/p/p.csv", "product_id,product_name,tier,status\nprod_001,Plan,Tier 1,Active\nprod_003,Plan,Tier 1,Active\n")
    lapses = fixtures.write_lapses(f"{workdir}/l.parquet", fixtures.lapse_table(4, first_policy=10))
    for root, versioned in (("plain", False), ("versions", True)):
        for _ in range(2):
            warehouse.load_warehouse(spark, f"{workdir}/{root}", clients, products, lapses, policies=(10, 13), num_clients=2,
                                     num_products=2, first_client=0, versioned=versioned, bridge_gaps=True)
        told = read_table(spark, warehouse.orphans_path(f"{workdir}/{root}"))
        assert _rows(told, "test_name", "policy_id", "client_id", "product_id") == [
            (f"relationships__dim_policy__{c}", p, 1, "prod_002") for c in ("client_id", "product_id") for p in (11, 13)]


def _small_tables(spark, root, clients, parts):
    for name, key, n in (("customer", "c_custkey", clients), ("part", "p_partkey", parts)):
        df = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        df.where(F.col(key).isin(n)).write.parquet(f"{root}/{name}.parquet")
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").where(F.col(key) < 20).write.parquet(f"{root}/{name}.parquet")
    for name in ("nation", "supplier"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{root}/{name}.parquet")
    return root


def test_a_client_lost_on_the_way_stops_the_queries_load(spark, workdir, monkeypatch):
    """The queries' load holds the policy's foreign keys against the feeds where the tables' keys have no gaps."""
    from lapsewise import registry
    from lapsewise.sources import standins

    whole = _small_tables(spark, f"{workdir}/whole", [0, 1, 2, 3], [0, 1, 2])
    root, paths = registry._loaded_warehouse(spark, whole)
    assert read_table(spark, paths["dim_policy"]).count() == 20
    gaps = _small_tables(spark, f"{workdir}/gaps", [0, 1, 3], [0, 1, 2])
    root, paths = registry._loaded_warehouse(spark, gaps)
    told = read_table(spark, warehouse.orphans_path(f"{root}/warehouse"))
    assert _rows(told, "policy_id", "client_id") == [(p, 2) for p in range(20) if p % 3 == 2]
    feed = standins.client_records
    monkeypatch.setattr(standins, "client_records", lambda s, d: feed(s, d).where("client_id <> 2"))
    with pytest.raises(AssertionError, match="relationships__dim_policy__client_id=5"):
        registry._loaded_warehouse(spark, whole)


def test_staging_and_marts(loaded, tmp_path):
    spark, _, _, paths = loaded
    t = warehouse.read_warehouse(spark, paths)
    stg = models.stg_clients(t["dim_clients"], ["client_id"])
    inc = {r.client_id: (r.income, r.income_was_imputed) for r in stg.collect()}
    assert inc[3] == (60500.0, True) and inc[5] == (58500.0, True) and inc[8] == (45000.0, True)
    assert inc[1] == (50000.0, False)
    out = warehouse.build_marts(spark, t, str(tmp_path))
    patients = spark.read.parquet(out["dim_patients"])
    assert "name" not in patients.columns and patients.count() == 8
    summary = {r.client_id: r for r in spark.read.parquet(out["fct_patient_claims_summary"]).collect()}
    # recompute one client by hand from the fixture
    lapses = fixtures.lapse_table().to_pylist()
    mine = [x for x in lapses if (x["policy_id"] % 8) + 1 == 2]
    total = sum(Decimal(str(x["premium_amount"])) for x in mine)
    r = summary[2]
    assert r.total_claims == len(mine) and r.total_premiums == total
    assert r.avg_premium == (total / len(mine)).quantize(Decimal("0.01"), ROUND_HALF_UP)
    lapsed = sum(x["status"] == "Lapsed" for x in mine)
    assert r.lapse_rate_pct == (Decimal(lapsed * 100) / len(mine)).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert r.first_claim_date == min(x["lapse_date"] for x in mine)
    assert r.distinct_products == len({(x["policy_id"] % 5) + 1 for x in mine})


def test_model_tests_pass_on_fixture(loaded, tmp_path):
    spark, _, _, paths = loaded
    t = warehouse.read_warehouse(spark, paths)
    stg = models.stg_clients(t["dim_clients"], ["client_id"])
    patients = models.dim_patients(stg)
    frames = {
        "stg_clients": stg,
        "stg_products": models.stg_products(t["dim_products"]),
        "stg_health_lapses": models.stg_health_lapses(t["fct_health_lapses"], t["dim_policy"]),
        "dim_patients": patients,
        "fct_patient_claims_summary": models.patient_claims_summary(
            t["fct_health_lapses"], t["dim_policy"], patients
        ),
    }
    summary = Q.run_checks(warehouse.model_tests(warehouse.DEFAULT_PROVINCES), frames)
    assert summary.count() == 20
    Q.assert_passing(summary)


def test_unified_dataset_rows_match_fact(loaded):
    spark, _, _, paths = loaded
    t = warehouse.read_warehouse(spark, paths)
    u = models.unified_dataset(
        t["fct_health_lapses"], t["dim_policy"], models.imputed_clients(t["dim_clients"]),
        t["dim_products"], t["dim_date"],
    )
    assert u.count() == 100 and len(u.columns) == 19
    assert u.where(F.col("income").isNull()).count() == 0


def test_hashed_patients_use_raw_income(loaded):
    spark, _, _, paths = loaded
    h = models.dim_patients_hashed(spark.read.parquet(paths["dim_clients"]))
    row = h.where("client_id = 3").first()
    assert row.income is None and len(row.patient_hash) == 32
    salted = models.dim_patients_hashed(spark.read.parquet(paths["dim_clients"]), salt="s3cret")
    assert len(salted.first().patient_hash) == 64


def test_claims_summary_edge_cases(spark):
    fact = spark.createDataFrame(
        [(1, dt.date(2024, 1, 1), Decimal("10.00"), "Pending"), (1, dt.date(2024, 1, 2), Decimal("10.01"), "Pending")],
        "policy_id long, lapse_date date, premium_amount decimal(10,2), status string",
    )
    policy = spark.createDataFrame([(1, 1, "p1"), (2, 2, "p2")], "policy_id long, client_id long, product_id string")
    patients = spark.createDataFrame(
        [(1, 1.0, False, "A"), (2, 2.0, False, "B")], "client_id long, income double, income_was_imputed boolean, province string"
    )
    rows = models.patient_claims_summary(fact, policy, patients).collect()
    assert len(rows) == 1  # client 2 has no lapses -> not in the summary
    r = rows[0]
    assert r.lapsed_count == 0 and r.lapse_rate_pct == Decimal("0.00") and r.avg_premium == Decimal("10.01")


def test_client_csv_na_spellings_and_types(spark, tmp_path):
    from lapsewise.sources.files import read_clients_csv

    p = fixtures.write(
        f"{tmp_path}/c.csv",
        "client_id,name,income,province\n1,A,NA,X\n2,B,null,X\n3,C, ,X\n4,D,12.5,X\n5,E,n/a,X\n",
    )
    rows = {r.client_id: r.income for r in read_clients_csv(spark, p).collect()}
    assert rows == {1: None, 2: None, 3: None, 4: Decimal("12.50"), 5: None}
