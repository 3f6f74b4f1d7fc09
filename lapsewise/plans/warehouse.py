"""Loading the star schema: dimensions, bridge and fact, then the marts.

Load order: dimensions and the policy bridge (independent of each other,
loaded concurrently), then the fact.  Dimensions
use insert-if-absent (re-running a load never duplicates or updates a row);
the fact is rebuilt (truncate + reload with surrogate keys restarting at 1)
and is checked against its foreign keys *before* it replaces the old copy.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise import schemas
from lapsewise.functions.dates import date_key, parse_date
from lapsewise.functions.text import pad_key
from lapsewise.operators import quality as Q
from lapsewise.operators.calendar import dim_date
from lapsewise.operators.keys import dense_index
from lapsewise.operators.loading import in_versions, insert_if_absent, read_table, replace_table, stage_absent, with_existing
from lapsewise.operators.versioned import BUCKET, VersionedTable
from lapsewise.plans import models
from lapsewise.session import bounded_partitions, materialize, run_concurrently
from lapsewise.sources import files

FILE_ORDER = ["_file", "_split", "_pos"]


def policy_bridge(
    policy_ids: DataFrame,
    num_clients: int,
    num_products: int,
    prefix: str = "prod_",
    width: int = 3,
    id_col: str = "policy_id",
    first_client: int = 1,
) -> DataFrame:
    """Deterministic policy -> (client, product) assignment by modulo.

    client = (policy mod num_clients) + first_client; product = prefix +
    ((policy mod num_products) + 1) padded with zeros to at least ``width``
    characters (longer numbers stay whole, so ids never merge).
    """
    pid = F.col(id_col).cast("long")
    client = (F.pmod(pid, F.lit(num_clients)) + first_client).cast("long")
    product = F.concat(F.lit(prefix), pad_key(F.pmod(pid, F.lit(num_products)) + 1, width))
    return policy_ids.select(
        pid.alias("policy_id"), client.alias("client_id"), product.alias("product_id")
    )


def product_id_length(num_products: int, prefix: str = "prod_", width: int = 3) -> int:
    """Characters of the longest id that the bridge rule gives to ``num_products`` products."""
    return len(prefix) + max(width, len(str(num_products)))


def policy_range(spark: SparkSession, first: int, last: int) -> DataFrame:
    """Policy ids ``first..last`` inclusive."""
    return spark.range(first, last + 1).withColumnRenamed("id", "policy_id")


def lapse_rows(raw: DataFrame) -> DataFrame:
    """Typed lapse events (no surrogate key yet)."""
    d = parse_date(F.col("lapse_date"), raw.schema["lapse_date"].dataType)
    return raw.select(
        F.col("policy_id").cast("long").alias("policy_id"),
        d.alias("lapse_date"),
        date_key(d).alias("date_key"),
        F.col("premium_amount").cast(schemas.MONEY_10_2).alias("premium_amount"),
        F.col("status").cast("string").alias("status"),
        *[c for c in raw.columns if c.startswith("_")],
    )


def fact_with_keys(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Assign ``lapse_id`` = 1..n following ``order`` (insertion order)."""
    keyed = dense_index(rows, list(order), name="lapse_id")
    return keyed.select(*[f.name for f in schemas.FCT_HEALTH_LAPSES.fields])


def fact_gate(policy: DataFrame, dates: DataFrame):
    """Validation run on the staged fact: NOT NULL columns and both FKs."""

    def check(staged: DataFrame) -> None:
        checks = Q.schema_checks("fct", schemas.FCT_HEALTH_LAPSES) + [
            Q.relationships("fct", "policy_id", "policy", "policy_id"),
            Q.relationships("fct", "date_key", "dates", "date_key"),
        ]
        Q.assert_passing(
            Q.run_checks(checks, {"fct": staged, "policy": policy, "dates": dates})
        )

    return check


def dimension_checks(table: str, lengths: Mapping[str, int] | None = None) -> list[Q.Check]:
    """Key, NOT NULL, length and range checks declared for ``table``.

    ``lengths``: columns that may be so long, if that is more than declared.
    """
    keys = schemas.PRIMARY_KEYS[table]
    checks = [c for k in keys for c in Q.primary_key(table, k)]
    checks += [Q.unique(table, c) for cols in schemas.UNIQUE_KEYS.get(table, []) for c in cols]
    checks += [
        c for c in Q.schema_checks(table, schemas.TABLES[table])
        if not (c.kind == "not_null" and c.column in keys)
    ]
    return [
        Q.max_length(table, c.column, max(c.params["n"], (lengths or {}).get(c.column, 0))) if c.kind == "max_length" else c
        for c in checks
    ]


def orphans_path(root: str) -> str:
    """Where a load with ``bridge_gaps`` reports the policies whose client or product is in no feed."""
    return f"{root.rstrip('/')}_orphans"


def report_orphans(spark: SparkSession, root: str, checks: Sequence[Q.Check], tables: Mapping[str, DataFrame],
                   found: DataFrame, versioned: bool = False) -> None:
    """Add the new policies that fail ``checks`` to the report, each with the check's name, once
    however often they are loaded; ``found``: the checks' counts (a row a check)."""
    failed = {r.test_name for r in found.where("failures > 0").collect()}
    rows = [
        Q.failing_rows(c, tables).select(F.lit(c.test_name).alias("test_name"), *[f.name for f in schemas.DIM_POLICY.fields])
        for c in checks if c.test_name in failed
    ]
    if rows:
        insert_if_absent(spark, orphans_path(root), Q.union_all(rows), ["test_name", "policy_id"], versioned=versioned)


def load_warehouse(
    spark: SparkSession,
    root: str,
    clients_path: str,
    products_path: str,
    lapses_path: str,
    calendar: tuple[str, str] = ("2024-01-01", "2024-04-30"),
    policies: tuple[int, int] = (1001, 1100),
    num_clients: int = 8,
    num_products: int = 5,
    first_client: int = 1,
    versioned: bool = False,
    bridge_gaps: bool = False,
) -> dict[str, str]:
    """Load the five warehouse tables under ``root``; returns their paths.

    ``versioned`` creates them as tables in versions: every table changes atomically
    and a load finds the keys it lacks by the key index (read with ``read_table``).

    The new rows of all four dimension tables are staged and validated (keys,
    NOT NULL, lengths, ranges and the policy's foreign keys) before any table
    is written; a failing row aborts the load.  A product id may be as long as the
    bridge rule makes it for ``num_products``, also where that is more than the declared
    length (from 100,000 products on); the declared one is for the checks of the loaded tables.
    The bridge rule numbers clients and products without gaps.  With ``bridge_gaps`` the feeds' keys
    may have some: its foreign keys are checked all the same, but a policy whose client or product is in
    no feed is loaded too and added to a report (``orphans_path``) before any table is written; without,
    it aborts the load.
    """
    files.require_inputs(spark, [clients_path, products_path, lapses_path])
    paths = {name: f"{root.rstrip('/')}/{name}" for name in schemas.TABLES}

    clients = files.read_clients_csv(spark, clients_path)
    products = files.read_products_csv(spark, products_path)
    bridge = policy_bridge(policy_range(spark, *policies), num_clients, num_products, first_client=first_client)
    batches = {
        "dim_clients": (clients, FILE_ORDER),
        "dim_products": (products, FILE_ORDER),
        "dim_date": (dim_date(spark, *calendar), []),
        "dim_policy": (bridge, []),
    }

    keyed = {n: VersionedTable(spark, paths[n]) for n in batches if in_versions(spark, paths[n], versioned)}
    inserts = {}

    def stage(name):
        batch, order = batches[name]
        if name in keyed:
            inserts[name] = keyed[name].stage(batch, schemas.PRIMARY_KEYS[name], order, order)
            return inserts[name].absent.drop(BUCKET)
        return stage_absent(spark, paths[name], batch, schemas.PRIMARY_KEYS[name], order=order, drop=order)

    # the four dimensions are independent until their foreign keys are checked
    staged = dict(zip(batches, run_concurrently(*[lambda n=n: stage(n) for n in batches])))
    after = {n: with_existing(spark, paths[n], staged[n]) for n in ("dim_clients", "dim_products")}
    lengths = {"product_id": product_id_length(num_products)}
    checks = [c for n in batches for c in dimension_checks(n, lengths)]
    foreign = [
        Q.relationships("dim_policy", col, f"all_{parent}", pcol)
        for child, col, parent, pcol in schemas.FOREIGN_KEYS if child == "dim_policy"
    ]
    known = {**staged, **{f"all_{n}": df for n, df in after.items()}}
    found = Q.run_checks(checks + foreign, known)
    if bridge_gaps:
        found = materialize(found, "dimension_checks")  # a row a check
        is_foreign = F.col("test_name").isin([c.test_name for c in foreign])
        report_orphans(spark, root, foreign, known, found.where(is_foreign), versioned)
        found = found.where(~is_foreign)
    Q.assert_passing(found)
    run_concurrently(*[
        (lambda n=n: keyed[n].insert(inserts[n])) if n in keyed
        else (lambda n=n: staged[n].write.mode("append").parquet(paths[n])) for n in batches
    ])

    policy = read_table(spark, paths["dim_policy"])
    dates = read_table(spark, paths["dim_date"])
    rows = lapse_rows(files.read_lapses_parquet(spark, lapses_path))
    fact = fact_with_keys(rows, FILE_ORDER)
    replace_table(spark, paths["fct_health_lapses"], fact, validate=fact_gate(policy, dates), versioned=versioned)
    return paths


def read_warehouse(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    return {name: read_table(spark, p) for name, p in paths.items()}


def build_marts(spark: SparkSession, tables: dict[str, DataFrame], out_root: str, versioned: bool = False) -> dict[str, str]:
    """Materialise ``dim_patients`` and ``fct_patient_claims_summary``.

    The summary reads the written ``dim_patients`` back instead of
    recomputing deduplication and imputation.
    """
    out = {
        "dim_patients": f"{out_root.rstrip('/')}/dim_patients",
        "fct_patient_claims_summary": f"{out_root.rstrip('/')}/fct_patient_claims_summary",
    }
    stg = models.stg_clients(tables["dim_clients"], order=["client_id", "name", "income", "province"])
    patients = replace_table(spark, out["dim_patients"], models.dim_patients(stg), versioned=versioned)
    fact = tables["fct_health_lapses"]
    rows = getattr(fact, "counted_rows", None)
    with bounded_partitions(spark, fact.count() if rows is None else rows):
        summary = models.patient_claims_summary(fact, tables["dim_policy"], patients)
        replace_table(spark, out["fct_patient_claims_summary"], summary, versioned=versioned)
    return out


# The twenty model tests of the published models.
def model_tests(accepted_provinces) -> list[Q.Check]:
    return [
        *Q.primary_key("stg_clients", "client_id"),
        Q.not_null("stg_clients", "income"),
        Q.not_null("stg_clients", "province"),
        *Q.primary_key("stg_products", "product_id"),
        *Q.primary_key("stg_health_lapses", "lapse_id"),
        Q.not_null("stg_health_lapses", "client_id"),
        Q.not_null("stg_health_lapses", "policy_id"),
        *Q.primary_key("dim_patients", "client_id"),
        Q.not_null("dim_patients", "income"),
        Q.not_null("dim_patients", "province"),
        Q.accepted_values("dim_patients", "province", accepted_provinces),
        *Q.primary_key("fct_patient_claims_summary", "client_id"),
        Q.not_null("fct_patient_claims_summary", "total_premiums"),
        Q.not_null("fct_patient_claims_summary", "total_claims"),
        Q.not_null("fct_patient_claims_summary", "lapse_rate_pct"),
    ]


# The provinces the patient model accepts by default.
DEFAULT_PROVINCES = ["Gauteng", "Western Cape", "KZN"]
