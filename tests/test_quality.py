"""Every check kind must be seen failing as well as passing."""

from decimal import Decimal

from lapsewise import schemas
from lapsewise.operators import quality as Q


def _summary(spark, checks, frames):
    return {r.test_name: r.failures for r in Q.run_checks(checks, frames).collect()}


def test_negative_fixtures(spark):
    clients = spark.createDataFrame(
        [
            (1, "A" * 101, Decimal("1.00"), "Gauteng"),
            (1, "dup", None, "KZN"),
            (2, "ok", Decimal("2.00"), "Mars"),
            (3, "ok", Decimal("3.00"), "Mars"),
            (None, "no id", Decimal("4.00"), None),
        ],
        "client_id long, name string, income decimal(12,2), province string",
    )
    policy = spark.createDataFrame([(10, 1, "p"), (11, 9, "p"), (12, None, "p")], "policy_id long, client_id long, product_id string")
    frames = {"clients": clients, "policy": policy, "ok": spark.createDataFrame([("Gauteng",), ("KZN",)], "v string")}
    checks = [
        *Q.primary_key("clients", "client_id"),
        Q.not_null("clients", "province"),
        Q.accepted_values("clients", "province", ["Gauteng", "KZN"]),
        Q.Check("accepted_values", "clients", "province", {"values": "ok"}, name="accepted_from_model"),
        Q.max_length("clients", "name", 100),
        Q.value_range("clients", "income", Decimal("0"), Decimal("2.50")),
        Q.relationships("policy", "client_id", "clients", "client_id"),
        Q.row_count_equal("policy", "clients"),
        Q.forbidden_columns("clients", ["name"]),
    ]
    got = _summary(spark, checks, frames)
    assert got == {
        "unique__clients__client_id": 1,
        "not_null__clients__client_id": 1,
        "not_null__clients__province": 1,
        "accepted_values__clients__province": 1,  # one offending value (Mars), nulls ignored
        "accepted_from_model": 1,
        "max_length__clients__name": 1,
        "value_range__clients__income": 2,
        "relationships__policy__client_id": 1,  # 9 is an orphan; NULL is not checked
        "row_count_equal__policy": 1,
        "forbidden_columns__clients": 1,
    }
    bad = Q.failing_rows(Q.relationships("policy", "client_id", "clients", "client_id"), frames)
    assert [r.policy_id for r in bad.collect()] == [11]


def test_passing_fixture(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    frames = {"t": df, "u": df}
    checks = [*Q.primary_key("t", "k"), Q.accepted_values("t", "v", ["a", "b"]), Q.row_count_equal("t", "u")]
    Q.assert_passing(Q.run_checks(checks, frames))


def test_schema_checks_from_declared_types(spark):
    checks = Q.schema_checks("fct", schemas.FCT_HEALTH_LAPSES)
    kinds = {(c.kind, c.column) for c in checks}
    assert ("not_null", "premium_amount") in kinds and ("max_length", "status") in kinds
    assert ("value_range", "premium_amount") in kinds
    assert Q.decimal_bounds(schemas.MONEY_10_2) == Decimal("99999999.99")


def test_pii_tags(spark):
    df = spark.createDataFrame([(1, "x", 1.0)], "client_id long, name string, income double")
    assert Q.pii_leaks(df, schemas.DIM_CLIENTS) == ["name", "income"]
    assert Q.pii_leaks(df.drop("name"), schemas.DIM_CLIENTS, allowed=["income"]) == []
    assert schemas.pii_columns(schemas.DIM_CLIENTS) == ["name", "income"]


def test_every_model_is_scanned_once(spark, workdir):
    from pyspark.sql import functions as F

    spark.range(50).select(F.col("id").alias("k"), (F.col("id") % 7).cast("int").alias("c"), F.lit("x").alias("v")).write.parquet(f"{workdir}/a")
    spark.range(9).select(F.col("id").cast("decimal(10,2)").alias("p"), F.lit("y").alias("v")).write.parquet(f"{workdir}/b")
    frames = {n: spark.read.parquet(f"{workdir}/{n}") for n in "ab"}
    checks = [
        *Q.primary_key("a", "k"), Q.unique("a", "v"), Q.not_null("a", "c"), Q.accepted_values("a", "c", [0, 1, 2]), *Q.primary_key("b", "p"),
        Q.relationships("a", "c", "b", "p"), Q.relationships("b", "p", "a", "k"), Q.relationships("a", "k", "b", "p"), Q.max_length("b", "v", 0),
        Q.Check("accepted_values", "a", "v", {"values": "b_values"}, name="from_model"), Q.row_count_equal("a", "b"),
    ]
    frames["b_values"] = frames["b"].select("v")
    summary = Q.run_checks(checks, frames)
    got = {r.test_name: r.failures for r in summary.collect()}
    assert got == {
        "unique__a__k": 0, "not_null__a__k": 0, "unique__a__v": 1, "not_null__a__c": 0, "accepted_values__a__c": 4, "unique__b__p": 0,
        "not_null__b__p": 0, "relationships__a__c": 0, "relationships__b__p": 0, "relationships__a__k": 41, "max_length__b__v": 9,
        "from_model": 1, "row_count_equal__a": 1}
    plan = summary._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 3  # a, b, and b again as the model of accepted values


def test_counted_models_are_not_scanned_to_compare_counts(spark, workdir):
    from lapsewise.session import materialize_counted

    a, b = materialize_counted(spark.range(30).toDF("x")), materialize_counted(spark.range(31).toDF("x"))
    summary = Q.run_checks([Q.row_count_equal("a", "b"), Q.Check("row_count_equal", "a", None, {"other": "a2"}, name="same")],
                           {"a": a, "b": b, "a2": materialize_counted(spark.range(30).toDF("x"))})
    assert "Relation [" not in summary._jdf.queryExecution().optimizedPlan().toString()
    assert {r.test_name: r.failures for r in summary.collect()} == {"row_count_equal__a": 1, "same": 0}


def test_values_equal_across_types(spark):
    doubles = spark.createDataFrame([(0.0,), (-0.0,), (2.5,), (None,)], "d double")
    whole = spark.createDataFrame([(0,), (2,), (7,)], "i int")
    text = spark.createDataFrame([("0",), ("9",)], "s string")
    assert _summary(spark, [Q.unique("doubles", "d")], {"doubles": doubles}) == {"unique__doubles__d": 1}
    rows = Q.run_checks([Q.relationships("whole", "i", "doubles", "d"), Q.Check("relationships", "whole", "i", {"to": "text", "field": "s"}, name="t")],
                        {"doubles": doubles, "whole": whole, "text": text}).collect()
    assert {r.test_name: r.failures for r in rows} == {"relationships__whole__i": 2, "t": 2}
