"""Registered queries over the driver's tables and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame computed from
the whole input tables.  ``ORACLES`` holds, for each query, ANSI SQL that
computes the same result from the same tables in DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.boundary import decimals_to_double
from lapsewise.operators.calendar import dim_date_covering
from lapsewise.operators.dedup import first_wins
from lapsewise.operators.loading import read_table
from lapsewise.operators.median import group_median
from lapsewise.plans import models, warehouse
from lapsewise.sources import standins as S

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return decimals_to_double(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return run

    return wrap


# --------------------------------------------------------------- SQL pieces

SQL_CLIENTS = """
clients AS (
  SELECT c.c_custkey AS client_id, c.c_name AS name,
         CASE WHEN c.c_acctbal >= 0 THEN CAST(c.c_acctbal AS DECIMAL(12,2)) END AS income,
         n.n_name AS province
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
raw_clients AS (
  SELECT *, 0 AS _file, client_id AS _line FROM clients
  UNION ALL
  SELECT *, 1 AS _file, client_id AS _line FROM clients
),
dedup AS (
  SELECT client_id, name, income, province FROM (
    SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY _file, _line) AS rn
    FROM raw_clients) t
  WHERE rn = 1
),
ranked AS (
  SELECT province, income,
         row_number() OVER (PARTITION BY province ORDER BY income) AS r,
         count(*) OVER (PARTITION BY province) AS n
  FROM dedup WHERE income IS NOT NULL
),
medians AS (
  SELECT province, CAST(sum(income) AS DOUBLE) / count(*) AS median_income
  FROM ranked WHERE r IN ((n + 1) // 2, (n + 2) // 2)
  GROUP BY province
),
stg_clients AS (
  SELECT d.client_id, d.name,
         COALESCE(CAST(d.income AS DOUBLE), m.median_income) AS income,
         d.income IS NULL AS income_was_imputed, d.province
  FROM dedup d LEFT JOIN medians m ON d.province = m.province
),
dim_patients AS (
  SELECT client_id, income, income_was_imputed, province FROM stg_clients
)"""

def padded_sql(number: str, width: int = 3) -> str:
    """Oracle padding: zeros up to ``width`` digits, longer numbers whole."""
    return f"(repeat('0', greatest(0, {width} - length(CAST(({number}) AS VARCHAR)))) || CAST(({number}) AS VARCHAR))"


SQL_PRODUCTS = f"""
params AS (
  SELECT count(*) AS np FROM part
),
products AS (
  SELECT 'prod_' || {padded_sql("p_partkey + 1")} AS product_id,
         p_name AS product_name, p_type AS tier, p_brand AS status
  FROM part
),
policy AS (
  SELECT o_orderkey AS policy_id, o_custkey AS client_id,
         'prod_' || {padded_sql("(o_orderkey % (SELECT np FROM params)) + 1")} AS product_id
  FROM orders
)"""

SQL_LAPSES = """
lapses AS (
  SELECT l_orderkey AS policy_id, CAST(l_shipdate AS DATE) AS lapse_date,
         CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS date_key,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS premium_amount,
         CASE l_returnflag WHEN 'R' THEN 'Lapsed' WHEN 'A' THEN 'Active'
                           WHEN 'N' THEN 'Pending' END AS status,
         l_orderkey AS _k1, l_linenumber AS _k2, l_partkey AS _k3, l_suppkey AS _k4,
         l_shipdate AS _k5, l_extendedprice AS _k6, l_returnflag AS _k7
  FROM lineitem
),
fact AS (
  SELECT row_number() OVER (ORDER BY _k1, _k2, _k3, _k4, _k5, _k6, _k7) AS lapse_id,
         policy_id, lapse_date, date_key, premium_amount, status
  FROM lapses
)"""

SQL_CALENDAR = """
days AS (
  SELECT CAST(unnest(generate_series(min(CAST(l_shipdate AS DATE)),
                                     max(CAST(l_shipdate AS DATE)),
                                     INTERVAL 1 DAY)) AS DATE) AS d
  FROM lineitem
),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
         CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
         CAST(day(d) AS INTEGER) AS day, CAST(dayofweek(d) AS INTEGER) AS day_of_week,
         dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend,
         d = CAST(date_trunc('month', d) AS DATE) AS is_month_start,
         d = last_day(d) AS is_month_end
  FROM days
)"""


def with_(*pieces: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in pieces) + "\n"


def half_up_sql(num: str, den: str, scale: int = 2) -> str:
    """Oracle rounding: half-up quotient on integers (non-negative inputs)."""
    f = 10 ** scale
    return (
        f"CAST((2 * CAST(({num}) * {f} AS HUGEINT) + ({den})) // (2 * ({den})) AS DOUBLE) / {f}"
    )


# ------------------------------------------------------------------ queries

@register(
    "stg_clients_dedup",
    with_(SQL_CLIENTS) + "SELECT client_id, name, CAST(income AS DOUBLE) AS income, province FROM dedup",
)
def q_stg_clients_dedup(spark, sf_dir):
    """First-wins deduplication of the raw client feed (file order)."""
    return models.deduplicated_clients(S.raw_clients(spark, sf_dir), S.CLIENT_ORDER)


@register(
    "province_median",
    with_(SQL_CLIENTS) + "SELECT province, median_income FROM medians",
)
def q_province_median(spark, sf_dir):
    """Exact median income per province over deduplicated clients."""
    return group_median(_dedup_clients(spark, sf_dir), ["province"], "income", name="median_income")


def _dedup_clients(spark, sf_dir):
    """Deduplicated clients written once (read by several branches)."""
    from lapsewise.session import materialize

    dedup = models.deduplicated_clients(S.raw_clients(spark, sf_dir), S.CLIENT_ORDER)
    return materialize(dedup, "deduplicated_clients")


@register(
    "stg_clients_imputed",
    with_(SQL_CLIENTS) + "SELECT * FROM stg_clients",
)
def q_stg_clients_imputed(spark, sf_dir):
    """Deduplicated clients with missing income imputed by province median."""
    return models.stg_clients(S.raw_clients(spark, sf_dir), S.CLIENT_ORDER)


@register(
    "dim_patients",
    with_(SQL_CLIENTS) + "SELECT * FROM dim_patients",
)
def q_dim_patients(spark, sf_dir):
    """Patient dimension without the name column."""
    return models.dim_patients(models.stg_clients(S.raw_clients(spark, sf_dir), S.CLIENT_ORDER))


@register(
    "dim_patients_hashed",
    with_(SQL_CLIENTS)
    + "SELECT client_id, md5(name) AS patient_hash, CAST(income AS DOUBLE) AS income, province FROM dedup",
)
def q_dim_patients_hashed(spark, sf_dir):
    """Loaded clients with the name replaced by its MD5 digest."""
    loaded = models.deduplicated_clients(S.raw_clients(spark, sf_dir), S.CLIENT_ORDER)
    return models.dim_patients_hashed(loaded)


@register(
    "stg_products",
    with_(SQL_PRODUCTS)
    + "SELECT product_id, product_name, tier, status AS product_status FROM products",
)
def q_stg_products(spark, sf_dir):
    return models.stg_products(S.products(spark, sf_dir))


@register(
    "policy_bridge_modulo",
    f"""
WITH params AS (
  SELECT (SELECT count(*) FROM customer) AS nc, (SELECT count(*) FROM part) AS np
)
SELECT o_orderkey AS policy_id,
       (o_orderkey % (SELECT nc FROM params)) + 1 AS client_id,
       'prod_' || {padded_sql("(o_orderkey % (SELECT np FROM params)) + 1")} AS product_id
FROM orders
""",
)
def q_policy_bridge_modulo(spark, sf_dir):
    """Modulo policy -> client/product assignment (ids of at least 3 digits)."""
    nc = S.table(spark, sf_dir, "customer").count()
    np_ = S.product_count(spark, sf_dir)
    orders = S.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("policy_id"))
    return warehouse.policy_bridge(orders, nc, np_, width=3)


@register("dim_date", with_(SQL_CALENDAR) + "SELECT * FROM dim_date")
def q_dim_date(spark, sf_dir):
    """Calendar covering every lapse date."""
    return dim_date_covering(S.raw_lapses(spark, sf_dir), "lapse_date")


@register(
    "fct_lapses_keyed",
    with_(SQL_LAPSES)
    + "SELECT lapse_id, policy_id, lapse_date, date_key, CAST(premium_amount AS DOUBLE) AS premium_amount, status FROM fact",
)
def q_fct_lapses_keyed(spark, sf_dir):
    """Typed fact with dense surrogate keys 1..n in insertion order."""
    rows = warehouse.lapse_rows(S.raw_lapses(spark, sf_dir))
    return warehouse.fact_with_keys(rows, S.LAPSE_ORDER)


@register(
    "stg_lapses",
    with_(SQL_PRODUCTS, SQL_LAPSES)
    + """SELECT f.lapse_id, f.policy_id, p.client_id, p.product_id, f.lapse_date, f.date_key,
       CAST(f.premium_amount AS DOUBLE) AS premium_amount, f.status AS lapse_status
FROM fact f JOIN policy p ON f.policy_id = p.policy_id""",
)
def q_stg_lapses(spark, sf_dir):
    """Lapse events enriched with client and product of their policy."""
    rows = warehouse.lapse_rows(S.raw_lapses(spark, sf_dir))
    fact = warehouse.fact_with_keys(rows, S.LAPSE_ORDER)
    return models.stg_health_lapses(fact, S.policy(spark, sf_dir))


@register(
    "unified_dataset",
    with_(SQL_CLIENTS, SQL_PRODUCTS, SQL_LAPSES, SQL_CALENDAR)
    + """SELECT c.client_id, c.income, c.income_was_imputed, c.province, p.policy_id,
       pr.product_id, pr.product_name, pr.tier, pr.status AS product_status,
       f.lapse_id, f.lapse_date, CAST(f.premium_amount AS DOUBLE) AS premium_amount,
       f.status AS lapse_status, d.year, d.quarter, d.month, d.month_name, d.day_name, d.is_weekend
FROM fact f
JOIN policy p ON f.policy_id = p.policy_id
JOIN stg_clients c ON p.client_id = c.client_id
JOIN products pr ON p.product_id = pr.product_id
JOIN dim_date d ON f.date_key = d.date_key""",
)
def q_unified_dataset(spark, sf_dir):
    """Analytical dataset: fact joined to every dimension."""
    raw = S.raw_lapses(spark, sf_dir)
    fact = warehouse.fact_with_keys(warehouse.lapse_rows(raw), S.LAPSE_ORDER)
    clients = models.stg_clients(S.raw_clients(spark, sf_dir), S.CLIENT_ORDER)
    return models.unified_dataset(
        fact,
        S.policy(spark, sf_dir),
        clients,
        S.products(spark, sf_dir),
        dim_date_covering(raw, "lapse_date"),
    )


SQL_SUMMARY_CTES = (
    """
ps AS (
  SELECT p.client_id,
         count(DISTINCT f.policy_id) AS total_policies,
         count(*) AS total_claims,
         sum(f.premium_amount) AS total_premiums,
         min(f.premium_amount) AS min_premium,
         max(f.premium_amount) AS max_premium,
         CAST(sum(CASE WHEN f.status = 'Lapsed' THEN 1 ELSE 0 END) AS BIGINT) AS lapsed_count,
         CAST(sum(CASE WHEN f.status = 'Active' THEN 1 ELSE 0 END) AS BIGINT) AS active_count,
         CAST(sum(CASE WHEN f.status = 'Pending' THEN 1 ELSE 0 END) AS BIGINT) AS pending_count,
         min(f.lapse_date) AS first_claim_date,
         max(f.lapse_date) AS latest_claim_date,
         count(DISTINCT p.product_id) AS distinct_products
  FROM lapses f JOIN policy p ON f.policy_id = p.policy_id
  GROUP BY p.client_id
),
summary AS (
SELECT ps.client_id, dp.income, dp.province, ps.total_policies, ps.total_claims,
       CAST(ps.total_premiums AS DOUBLE) AS total_premiums,
       """
    + half_up_sql("ps.total_premiums", "ps.total_claims")
    + """ AS avg_premium,
       CAST(ps.min_premium AS DOUBLE) AS min_premium, CAST(ps.max_premium AS DOUBLE) AS max_premium,
       ps.lapsed_count, ps.active_count, ps.pending_count,
       ps.first_claim_date, ps.latest_claim_date, ps.distinct_products,
       """
    + half_up_sql("ps.lapsed_count * 100", "ps.total_claims")
    + """ AS lapse_rate_pct
FROM ps JOIN dim_patients dp ON ps.client_id = dp.client_id
)"""
)

SQL_SUMMARY = with_(SQL_CLIENTS, SQL_PRODUCTS, SQL_LAPSES, SQL_SUMMARY_CTES) + "SELECT * FROM summary"


@register("patient_claims_summary", SQL_SUMMARY)
def q_patient_claims_summary(spark, sf_dir):
    """Per-patient claims summary (the flagship mart)."""
    clients = models.stg_clients(S.raw_clients(spark, sf_dir), S.CLIENT_ORDER)
    fact = warehouse.lapse_rows(S.raw_lapses(spark, sf_dir))
    return models.written_claims_summary(
        fact, S.policy(spark, sf_dir), models.dim_patients(clients)
    )


@register(
    "dedup_lineitem_first",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       CAST(l_shipdate AS DATE) AS ship_date
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_partkey, l_suppkey, CAST(l_shipdate AS DATE),
                                            l_quantity, l_extendedprice) AS rn
      FROM lineitem) t
WHERE rn = 1""",
)
def q_dedup_lineitem_first(spark, sf_dir):
    """Keep the first line per (order, line number) by part, supplier, date, amounts."""
    li = S.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice", F.to_date("l_shipdate").alias("ship_date"),
    )
    return first_wins(
        li, ["l_orderkey", "l_linenumber"],
        ["l_partkey", "l_suppkey", "ship_date", "l_quantity", "l_extendedprice"],
    )


@register(
    "dedup_documents_exact",
    """
SELECT doc_id, text_md5, lang, source, n_chars
FROM (SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars,
             row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS rn
      FROM documents) t
WHERE rn = 1""",
)
def q_dedup_documents_exact(spark, sf_dir):
    """Exact-duplicate documents: keep the lowest doc_id per text digest."""
    docs = S.table(spark, sf_dir, "documents").select(
        "doc_id", F.md5("text").alias("text_md5"), "lang", "source", "n_chars"
    )
    return first_wins(docs, ["text_md5"], ["doc_id"])


# ------------------------------------------------------------ data quality

def check_sql(chk) -> str:
    """Oracle SQL for one check: a single summary row with its failure count."""
    m, c, p = chk.model, chk.column, chk.params
    if chk.kind == "not_null":
        body = f"SELECT count(*) FROM {m} WHERE {c} IS NULL"
    elif chk.kind == "unique":
        body = (f"SELECT count(*) FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL "
                f"GROUP BY {c} HAVING count(*) > 1) t")
    elif chk.kind == "accepted_values":
        allowed = p["values"]
        if isinstance(allowed, str):
            inner = f"SELECT * FROM {allowed}"
        else:
            inner = " UNION ALL ".join("SELECT '" + v.replace("'", "''") + "'" for v in allowed)
        body = (f"SELECT count(*) FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL "
                f"AND {c} NOT IN ({inner}) GROUP BY {c}) t")
    elif chk.kind == "relationships":
        body = (f"SELECT count(*) FROM {m} x WHERE x.{c} IS NOT NULL AND NOT EXISTS "
                f"(SELECT 1 FROM {p['to']} y WHERE y.{p['field']} = x.{c})")
    elif chk.kind == "max_length":
        body = f"SELECT count(*) FROM {m} WHERE length(CAST({c} AS VARCHAR)) > {p['n']}"
    elif chk.kind == "value_range":
        conds = []
        if p.get("lo") is not None:
            conds.append(f"{c} < {p['lo']}")
        if p.get("hi") is not None:
            conds.append(f"{c} > {p['hi']}")
        body = f"SELECT count(*) FROM {m} WHERE {c} IS NOT NULL AND ({' OR '.join(conds)})"
    elif chk.kind == "row_count_equal":
        body = (f"SELECT CASE WHEN (SELECT count(*) FROM {m}) <> "
                f"(SELECT count(*) FROM {p['other']}) THEN 1 ELSE 0 END")
    else:
        raise ValueError(chk.kind)
    col = "CAST(NULL AS VARCHAR)" if c is None else f"'{c}'"
    return (f"SELECT '{chk.test_name}' AS test_name, '{chk.kind}' AS kind, '{m}' AS model, "
            f"{col} AS column_name, CAST(({body}) AS BIGINT) AS failures")


def suite_sql(ctes: str, checks) -> str:
    return ctes + "\nUNION ALL\n".join(check_sql(c) for c in checks)


def _model_suite_frames(spark, sf_dir):
    from lapsewise.session import materialize

    stg = materialize(models.stg_clients(S.raw_clients(spark, sf_dir), S.CLIENT_ORDER))
    patients = models.dim_patients(stg)
    policy = S.policy(spark, sf_dir)
    fact = warehouse.fact_with_keys(warehouse.lapse_rows(S.raw_lapses(spark, sf_dir)), S.LAPSE_ORDER)
    nation = S.table(spark, sf_dir, "nation")
    return {
        "stg_clients": stg,
        "stg_products": models.stg_products(S.products(spark, sf_dir)),
        "stg_health_lapses": models.stg_health_lapses(fact, policy),
        "dim_patients": patients,
        "fct_patient_claims_summary": models.written_claims_summary(fact, policy, patients),
        "accepted_provinces": nation.where(F.col("n_regionkey") == 0).select("n_name"),
    }


MODEL_TESTS = warehouse.model_tests("accepted_provinces")

SQL_MODEL_CTES = with_(
    SQL_CLIENTS,
    SQL_PRODUCTS,
    SQL_LAPSES,
    SQL_SUMMARY_CTES,
    """
stg_products AS (SELECT product_id, product_name, tier, status AS product_status FROM products),
stg_health_lapses AS (
  SELECT f.lapse_id, f.policy_id, p.client_id, p.product_id, f.lapse_date, f.date_key,
         f.premium_amount, f.status AS lapse_status
  FROM fact f JOIN policy p ON f.policy_id = p.policy_id),
fct_patient_claims_summary AS (SELECT * FROM summary),
accepted_provinces AS (SELECT n_name FROM nation WHERE n_regionkey = 0)
""",
)


@register("dq_model_tests", suite_sql(SQL_MODEL_CTES, MODEL_TESTS))
def q_dq_model_tests(spark, sf_dir):
    """The twenty model tests (unique / not_null / accepted_values)."""
    from lapsewise.operators import quality as Q

    return Q.run_checks(MODEL_TESTS, _model_suite_frames(spark, sf_dir))


def _warehouse_checks():
    from lapsewise import schemas
    from lapsewise.operators import quality as Q

    checks = []
    for table, schema in schemas.TABLES.items():
        for key in schemas.PRIMARY_KEYS[table]:
            checks += Q.primary_key(table, key)
        for cols in schemas.UNIQUE_KEYS.get(table, []):
            checks += [Q.unique(table, c) for c in cols]
        checks += [c for c in Q.schema_checks(table, schema)
                   if not (c.kind == "not_null" and c.column in schemas.PRIMARY_KEYS[table])]
    for child, col, parent, pcol in schemas.FOREIGN_KEYS:
        checks.append(Q.relationships(child, col, parent, pcol))
    return checks


WAREHOUSE_CHECKS = _warehouse_checks()

SQL_WAREHOUSE_CTES = with_(
    SQL_CLIENTS,
    SQL_PRODUCTS,
    SQL_LAPSES,
    SQL_CALENDAR,
    """
dim_clients AS (SELECT * FROM dedup),
dim_products AS (SELECT * FROM products),
dim_policy AS (SELECT * FROM policy),
fct_health_lapses AS (SELECT * FROM fact)
""",
)


@register("dq_warehouse_constraints", suite_sql(SQL_WAREHOUSE_CTES, WAREHOUSE_CHECKS))
def q_dq_warehouse_constraints(spark, sf_dir):
    """Keys, NOT NULL, lengths, numeric ranges and foreign keys of the star schema."""
    from lapsewise.operators import quality as Q

    raw_lapses = S.raw_lapses(spark, sf_dir)
    tables = {
        "dim_clients": _dedup_clients(spark, sf_dir),
        "dim_products": S.products(spark, sf_dir),
        "dim_date": dim_date_covering(raw_lapses, "lapse_date"),
        "dim_policy": S.policy(spark, sf_dir),
        "fct_health_lapses": warehouse.fact_with_keys(
            warehouse.lapse_rows(raw_lapses), S.LAPSE_ORDER
        ),
    }
    return Q.run_checks(WAREHOUSE_CHECKS, tables)


def _transform_checks():
    from lapsewise.operators import quality as Q

    return [
        Q.Check("unique", "v_deduplicated_clients", "client_id", name="no_duplicate_clients"),
        Q.Check("not_null", "v_imputed_clients", "income", name="no_missing_income"),
        Q.Check("row_count_equal", "v_unified_dataset", None, {"other": "fct_health_lapses"},
                name="unified_rows_match_fact"),
    ]


TRANSFORM_CHECKS = _transform_checks()


@register(
    "dq_transform_checks",
    suite_sql(
        with_(
            SQL_CLIENTS, SQL_PRODUCTS, SQL_LAPSES, SQL_CALENDAR,
            """
v_deduplicated_clients AS (SELECT * FROM dedup),
v_imputed_clients AS (SELECT * FROM stg_clients),
fct_health_lapses AS (SELECT * FROM fact),
v_unified_dataset AS (
  SELECT f.lapse_id FROM fact f
  JOIN policy p ON f.policy_id = p.policy_id
  JOIN stg_clients c ON p.client_id = c.client_id
  JOIN products pr ON p.product_id = pr.product_id
  JOIN dim_date d ON f.date_key = d.date_key)
""",
        ),
        TRANSFORM_CHECKS,
    ),
)
def q_dq_transform_checks(spark, sf_dir):
    """Post-transformation checks: dedup, imputation, unified row count.  The fact and the unified
    table are counted while they are written; no join runs to be counted only."""
    from lapsewise.operators import quality as Q
    from lapsewise.session import materialize, materialize_counted

    dedup = _dedup_clients(spark, sf_dir)
    imputed = materialize(models.imputed_clients(dedup), "imputed_clients")
    raw_lapses = S.raw_lapses(spark, sf_dir)
    fact = materialize_counted(warehouse.fact_with_keys(warehouse.lapse_rows(raw_lapses), S.LAPSE_ORDER), "fct_health_lapses")
    unified = materialize_counted(models.unified_dataset(
        fact, S.policy(spark, sf_dir), imputed, S.products(spark, sf_dir),
        dim_date_covering(raw_lapses, "lapse_date"),
    ), "unified_dataset")
    frames = {
        "v_deduplicated_clients": dedup,
        "v_imputed_clients": imputed,
        "v_unified_dataset": unified,
        "fct_health_lapses": fact,
    }
    return Q.run_checks(TRANSFORM_CHECKS, frames)


@register(
    "duplicate_client_ids",
    with_(SQL_CLIENTS)
    + "SELECT client_id, count(*) AS n_rows FROM raw_clients GROUP BY client_id HAVING count(*) > 1",
)
def q_duplicate_client_ids(spark, sf_dir):
    """Client ids delivered more than once in the raw feed."""
    from lapsewise.operators.dedup import duplicate_keys

    return duplicate_keys(S.raw_clients(spark, sf_dir), ["client_id"])


# ------------------------------------------------------------ load semantics

CUTOFF = "1998-01-01"


@register(
    "insert_if_absent",
    with_(SQL_CLIENTS)
    + f"""SELECT client_id, name, CAST(income AS DOUBLE) AS income, province,
       CASE WHEN client_id IN (SELECT o_custkey FROM orders WHERE o_orderdate < DATE '{CUTOFF}')
            THEN 1 ELSE 2 END AS load_run
FROM clients""",
)
def q_insert_if_absent(spark, sf_dir):
    """Two loads into one table: clients active before the cutoff, then the
    whole (duplicated) feed; the second load adds only absent clients."""
    from lapsewise.operators.loading import insert_if_absent
    from lapsewise.session import scratch_path

    path = scratch_path(spark, "dim_clients")
    early_orders = S.table(spark, sf_dir, "orders").where(
        F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz")
    )
    run1 = (
        S.client_records(spark, sf_dir)
        .join(early_orders, F.col("client_id") == F.col("o_custkey"), "left_semi")
        .withColumn("load_run", F.lit(1))
    )
    insert_if_absent(spark, path, run1, ["client_id"])
    run2 = S.raw_clients(spark, sf_dir).withColumn("load_run", F.lit(2))
    insert_if_absent(spark, path, run2, ["client_id"], order=S.CLIENT_ORDER, drop=S.CLIENT_ORDER)
    return spark.read.parquet(path)


@register(
    "truncate_reload",
    with_(SQL_LAPSES)
    + "SELECT lapse_id, policy_id, lapse_date, date_key, CAST(premium_amount AS DOUBLE) AS premium_amount, status FROM fact",
)
def q_truncate_reload(spark, sf_dir):
    """Fact loaded with early events, then truncated and fully reloaded
    (keys restart at 1; the reload is validated before its version is published)."""
    from lapsewise.operators.loading import replace_table
    from lapsewise.session import scratch_path

    path = scratch_path(spark, "fct_health_lapses")
    raw = S.raw_lapses(spark, sf_dir)
    rows = warehouse.lapse_rows(raw)
    early = rows.where(F.col("lapse_date") < F.lit(CUTOFF).cast("date"))
    replace_table(spark, path, warehouse.fact_with_keys(early, S.LAPSE_ORDER), versioned=True)
    gate = warehouse.fact_gate(S.policy(spark, sf_dir), dim_date_covering(raw, "lapse_date"))
    return replace_table(
        spark, path, warehouse.fact_with_keys(rows, S.LAPSE_ORDER), validate=gate
    )


@register(
    "upsert_latest",
    with_(SQL_LAPSES)
    + """SELECT policy_id, lapse_date, CAST(premium_amount AS DOUBLE) AS premium_amount, status,
       _k2 AS line_no
FROM (SELECT *, row_number() OVER (PARTITION BY policy_id
                                   ORDER BY lapse_date DESC, _k2 DESC, _k3 DESC, _k4 DESC,
                                            premium_amount DESC, status DESC) AS rn
      FROM lapses) t
WHERE rn = 1""",
)
def q_upsert_latest(spark, sf_dir):
    """Latest lapse per policy kept by two upserts (before / after cutoff)."""
    from lapsewise.plans.incremental import upsert
    from lapsewise.session import scratch_path

    path = scratch_path(spark, "latest_lapse")
    rows = warehouse.lapse_rows(S.raw_lapses(spark, sf_dir)).select(
        "policy_id", "lapse_date", "premium_amount", "status",
        F.col("_k2").alias("line_no"), F.col("_k3").alias("_part"), F.col("_k4").alias("_supp"),
    )
    newest = ["lapse_date", "line_no", "_part", "_supp", "premium_amount", "status"]
    cutoff = F.lit(CUTOFF).cast("date")
    upsert(spark, path, rows.where(F.col("lapse_date") < cutoff), ["policy_id"], newest, buckets=32, versioned=True)
    out = upsert(
        spark, path, rows.where(F.col("lapse_date") >= cutoff), ["policy_id"], newest, buckets=32
    )
    return out.drop("_part", "_supp")


@register("incremental_summary", SQL_SUMMARY)
def q_incremental_summary(spark, sf_dir):
    """Claims summary from a state that early and later events are merged into,
    one batch after the other; no event is read twice."""
    from lapsewise.plans.incremental import merge_claims, summary_from_state
    from lapsewise.session import bounded_partitions, materialize, scratch_path

    clients = models.stg_clients(S.raw_clients(spark, sf_dir), S.CLIENT_ORDER)
    patients = materialize(models.dim_patients(clients))
    policy = S.policy(spark, sf_dir)
    fact = warehouse.lapse_rows(S.raw_lapses(spark, sf_dir))
    cutoff = F.lit(CUTOFF).cast("date")
    path = scratch_path(spark, "claims_state")
    merge_claims(spark, path, fact.where(F.col("lapse_date") < cutoff), "early")
    state = merge_claims(spark, path, fact.where(F.col("lapse_date") >= cutoff), "late")
    with bounded_partitions(spark, state.counted_rows):
        return materialize(summary_from_state(state, policy, patients), "claims_summary")


@register("refreshed_summary", SQL_SUMMARY)
def q_refreshed_summary(spark, sf_dir):
    """Claims summary built from early events, then refreshed for the
    clients touched by later events only."""
    from lapsewise.plans.incremental import refresh_summary
    from lapsewise.session import materialize

    clients = models.stg_clients(S.raw_clients(spark, sf_dir), S.CLIENT_ORDER)
    patients = materialize(models.dim_patients(clients))
    policy = S.policy(spark, sf_dir)
    fact = warehouse.lapse_rows(S.raw_lapses(spark, sf_dir))
    cutoff = F.lit(CUTOFF).cast("date")
    early = fact.where(F.col("lapse_date") < cutoff)
    late = fact.where(F.col("lapse_date") >= cutoff)
    old = models.written_claims_summary(early, policy, patients)
    return refresh_summary(old, fact, policy, patients, late)


@register(
    "monthly_partitioned_fact",
    with_(SQL_LAPSES)
    + """SELECT CAST(year(lapse_date) AS INTEGER) AS lapse_year, CAST(month(lapse_date) AS INTEGER) AS lapse_month,
       count(*) AS lapses, CAST(sum(premium_amount) AS DOUBLE) AS premiums,
       min(lapse_id) AS first_lapse_id, max(lapse_id) AS last_lapse_id
FROM fact GROUP BY 1, 2""",
)
def q_monthly_partitioned_fact(spark, sf_dir):
    """Fact written partitioned by lapse month and read back per month."""
    from lapsewise.plans.incremental import write_partitioned_fact
    from lapsewise.session import scratch_path

    path = scratch_path(spark, "fct_by_month")
    fact = warehouse.fact_with_keys(warehouse.lapse_rows(S.raw_lapses(spark, sf_dir)), S.LAPSE_ORDER)
    write_partitioned_fact(fact, path)
    back = spark.read.parquet(path)
    return back.groupBy("lapse_year", "lapse_month").agg(
        F.count(F.lit(1)).alias("lapses"),
        F.sum("premium_amount").alias("premiums"),
        F.min("lapse_id").alias("first_lapse_id"),
        F.max("lapse_id").alias("last_lapse_id"),
    )


# ------------------------------------------------------------ text cleaning

def _text_job(spark, sf_dir):
    from lapsewise.operators import textclean as TC
    from lapsewise.session import scratch_path

    root = scratch_path(spark, "exports")
    S.write_text_exports(spark, sf_dir, root)
    lines = TC.read_lines(spark, root)
    profiles = TC.file_profiles(lines)
    rows = TC.split_rows(lines, profiles)
    return root, lines, profiles, rows


SQL_EXPORT_IDS = f"""
exported AS (
  SELECT 'prod_' || {padded_sql("p_partkey + 1")} AS pid, *
  FROM part
)"""


@register(
    "clean_delimited_text",
    with_(SQL_EXPORT_IDS)
    + """SELECT lower(pid) AS product_id, p_name AS product_name, p_type AS tier, p_brand AS status
FROM exported WHERE p_size <= 45""",
)
def q_clean_delimited_text(spark, sf_dir):
    """Product export cleaned to CSV (preamble, '|', padding, mixed case) and read back."""
    from lapsewise.operators import textclean as TC
    from lapsewise.session import scratch_path

    root = scratch_path(spark, "exports")
    out = scratch_path(spark, "cleaned")
    S.write_text_exports(spark, sf_dir, root)
    TC.clean_files(spark, root, out)
    schema = "product_id string, product_name string, tier string, status string"
    back = (
        spark.read.schema(schema).option("header", True).option("escape", '"')
        .csv(f"{out}/layout_4")
    )
    return back.select("product_id", "product_name", "tier", "status")


@register(
    "file_profile",
    """
SELECT 'products' AS dataset, CAST(2 AS BIGINT) AS skip_lines, '|' AS delimiter,
       CAST(4 AS INTEGER) AS n_columns, 'product_id,product_name,tier,status' AS columns,
       count(*) FILTER (WHERE p_size <= 45) AS data_rows,
       count(*) FILTER (WHERE p_size > 45) AS rejected_rows
FROM part
UNION ALL
SELECT 'suppliers', CAST(0 AS BIGINT), ',', CAST(3 AS INTEGER), 'product_id,product_name,status',
       count(*), CAST(0 AS BIGINT)
FROM supplier
UNION ALL
SELECT 'customers', CAST(3 AS BIGINT), chr(9), CAST(6 AS INTEGER),
       'column_1,column_2,column_3,column_4,column_5,column_6', count(*), CAST(0 AS BIGINT)
FROM customer""",
)
def q_file_profile(spark, sf_dir):
    """Inferred preamble length, delimiter and columns of each export."""
    _, _, profiles, _ = _text_job(spark, sf_dir)
    per_file = profiles.select(
        F.regexp_extract("_file", "/([^/]+)/[^/]+$", 1).alias("dataset"),
        "skip_lines", "delimiter", "n_columns",
        F.array_join("columns", ",").alias("columns"),
        F.col("clean_rows").alias("data_rows"), "rejected_rows",
    )
    return per_file.groupBy("dataset", "skip_lines", "delimiter", "n_columns", "columns").agg(
        F.sum("data_rows").alias("data_rows"), F.sum("rejected_rows").alias("rejected_rows")
    )


@register(
    "rejects_by_arity",
    with_(SQL_EXPORT_IDS)
    + """SELECT CAST(4 AS INTEGER) AS expected_fields, CAST(5 AS INTEGER) AS got_fields,
       CASE WHEN p_size > 25 THEN upper(pid) ELSE pid END || ' | ' || p_name || chr(9) || '| '
         || p_type || '|' || p_brand || ' |discontinued' AS data
FROM exported WHERE p_size > 45""",
)
def q_rejects_by_arity(spark, sf_dir):
    """Export rows with a field count other than their file's column count."""
    from lapsewise.operators import textclean as TC

    _, _, _, rows = _text_job(spark, sf_dir)
    return TC.rejected_rows(rows).select("expected_fields", "got_fields", "data")


# ------------------------------------------------------------------ ingest

def _run_ingest(spark, sf_dir):
    from lapsewise.operators.loading import hadoop_fs
    from lapsewise.session import scratch_path
    from lapsewise.streaming.ingest import ParquetToCsvIngest

    base = scratch_path(spark, "ingest")
    landing = f"{base}/landing"
    typed = warehouse.lapse_rows(S.raw_lapses(spark, sf_dir)).select(
        "policy_id", "lapse_date", "premium_amount", "status"
    )
    typed.write.parquet(f"{landing}/lapses")
    # a damaged upload and a stray non-Parquet file arrive with the data
    fs, p = hadoop_fs(spark, f"{landing}/uploads/damaged.parquet")
    out = fs.create(p, True)
    out.write(bytearray(b"PAR1 truncated upload"))
    out.close()
    fs, p = hadoop_fs(spark, f"{landing}/uploads/readme.txt")
    out = fs.create(p, True)
    out.write(bytearray(b"lapse exports"))
    out.close()
    job = ParquetToCsvIngest(
        spark, landing, f"{base}/processed", f"{base}/error", f"{base}/audit", f"{base}/_checkpoint"
    )
    job.run_once()
    return job


@register(
    "ingest_convert",
    with_(SQL_LAPSES)
    + "SELECT policy_id, lapse_date, CAST(premium_amount AS DOUBLE) AS premium_amount, status FROM lapses",
)
def q_ingest_convert(spark, sf_dir):
    """Lapse Parquet uploads converted to CSV by the ingest stream, read back."""
    job = _run_ingest(spark, sf_dir)
    schema = "policy_id long, lapse_date date, premium_amount decimal(10,2), status string"
    back = spark.read.schema(schema).option("header", True).csv(job.output_dir)
    return back.select("policy_id", "lapse_date", "premium_amount", "status")


@register(
    "ingest_audit",
    """
SELECT 'conversion_success' AS event, count(*) AS rows_converted FROM lineitem
UNION ALL SELECT 'file_received', CAST(NULL AS BIGINT)
UNION ALL SELECT 'conversion_failed', CAST(NULL AS BIGINT)
UNION ALL SELECT 'file_moved_to_error', CAST(NULL AS BIGINT)
UNION ALL SELECT 'skipped_non_parquet', CAST(NULL AS BIGINT)""",
)
def q_ingest_audit(spark, sf_dir):
    """Audit trail of one ingest run: rows converted per event type."""
    from lapsewise.streaming.ingest import read_audit

    job = _run_ingest(spark, sf_dir)
    audit = read_audit(spark, job.audit_dir)
    return audit.groupBy("event").agg(F.sum("rows_converted").alias("rows_converted"))


# ------------------------------------------------------- whole pipeline run

def _write_pipeline_inputs(spark, sf_dir, root):
    """Source files derived from the tables, shaped like the documented inputs:
    a client CSV delivered twice, a pipe-delimited product export with a
    preamble, and lapse events as Parquet."""
    from lapsewise.session import run_concurrently

    clients = S.client_records(spark, sf_dir)

    def deliver(n):
        clients.write.mode("overwrite").option("header", True).csv(f"{root}/clients/delivery={n}")

    run_concurrently(
        lambda: deliver(0),
        lambda: deliver(1),
        lambda: S.write_text_exports(spark, sf_dir, f"{root}/exports", datasets=("products",), ragged_lines=False),
        lambda: warehouse.lapse_rows(S.raw_lapses(spark, sf_dir)).select(
            "policy_id", "lapse_date", "premium_amount", "status"
        ).write.mode("overwrite").parquet(f"{root}/lapses"),
    )
    return {
        "clients": f"{root}/clients",
        "products_raw": f"{root}/exports/products",
        "lapses": f"{root}/lapses",
    }


@register(
    "warehouse_pipeline",
    with_(
        SQL_CLIENTS,
        f"""
params AS (
  SELECT (SELECT count(*) FROM customer) AS nc, (SELECT count(*) FROM part) AS np,
         (SELECT max(o_orderkey) FROM orders) AS last_policy,
         (SELECT min(c_custkey) FROM customer) AS first_client
),
policy AS (
  SELECT p AS policy_id, (p % (SELECT nc FROM params)) + (SELECT first_client FROM params) AS client_id,
         'prod_' || {padded_sql("(p % (SELECT np FROM params)) + 1")} AS product_id
  FROM (SELECT unnest(generate_series(0, (SELECT last_policy FROM params))) AS p) s
)""",
        SQL_LAPSES,
        SQL_SUMMARY_CTES,
    )
    + "SELECT * FROM summary",
)
def q_warehouse_pipeline(spark, sf_dir):
    """Whole pipeline on derived source files: clean the product export,
    load the star schema (dims insert-if-absent, bridge by modulo rule with its
    foreign keys checked, fact with keys behind the FK gate), build the marts,
    return the summary."""
    root, paths = _loaded_warehouse(spark, sf_dir)
    marts = warehouse.build_marts(spark, warehouse.read_warehouse(spark, paths), f"{root}/marts", versioned=True)
    return read_table(spark, marts["fct_patient_claims_summary"])


def _loaded_warehouse(spark, sf_dir):
    """The star schema loaded from derived source files: (root, paths)."""
    from lapsewise.operators import textclean as TC
    from lapsewise.session import scratch_path

    root = scratch_path(spark, "pipeline")
    src = _write_pipeline_inputs(spark, sf_dir, root)
    TC.clean_files(spark, src["products_raw"], f"{root}/cleaned")
    # bounds of the written feeds: the lapses' dates and policies, the clients' ids
    lapses = spark.read.parquet(src["lapses"]).agg(
        F.min("lapse_date").cast("date").alias("lo"), F.max("lapse_date").cast("date").alias("hi")).first()
    last_policy = S.table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0]
    clients = S.key_range(spark, sf_dir, "customer", "c_custkey")
    products = S.key_range(spark, sf_dir, "part", "p_partkey")
    # the bridge rule numbers both without gaps: only where the tables' own keys have some may
    # policies miss their parents, as the rule then names keys that don't exist; else they stop the load
    gaps = clients.gaps or products.gaps or products.first != 0
    paths = warehouse.load_warehouse(
        spark,
        f"{root}/warehouse",
        src["clients"],
        f"{root}/cleaned/layout_4",
        src["lapses"],
        calendar=(str(lapses.lo), str(lapses.hi)),
        policies=(0, int(last_policy)),
        num_clients=clients.rows,
        num_products=products.rows,
        first_client=clients.first,
        versioned=True,
        bridge_gaps=gaps,
    )
    return root, paths


# ------------------------------------------- inputs of odd shape, end to end

def _deliver(spark, df, folder, name, files=8):
    """Write ``df`` as ``files`` Parquet files ``folder/<name>`` ({} is a number);
    files of these names are replaced."""
    from lapsewise.operators.loading import hadoop_fs
    from lapsewise.session import scratch_path

    staging = scratch_path(spark, "delivery")
    df.repartition(files).write.parquet(staging)
    fs, src = hadoop_fs(spark, staging)
    _, target = hadoop_fs(spark, folder)
    fs.mkdirs(target)
    parts = sorted(s.getPath().toString() for s in fs.listStatus(src) if s.getPath().getName().startswith("part-"))
    for i, part in enumerate(parts):
        _, a = hadoop_fs(spark, part)
        _, b = hadoop_fs(spark, f"{folder}/{name.format(i)}")
        fs.delete(b, False)
        fs.rename(a, b)
        yield b


@register(
    "ingest_recovery",
    with_(SQL_LAPSES)
    + """SELECT policy_id, lapse_date, CAST(premium_amount AS DOUBLE) AS premium_amount, status,
       CASE WHEN policy_id % 4 = 1 THEN '["' || status || '"]' END AS tags
FROM lapses""",
)
def q_ingest_recovery(spark, sf_dir):
    """Ingest of files that are old-dated, nested, oddly named, empty, sent again
    or unreadable: every row of every readable file comes out, in its last version."""
    from lapsewise.operators.loading import hadoop_fs
    from lapsewise.session import scratch_path
    from lapsewise.streaming.ingest import ParquetToCsvIngest

    base = scratch_path(spark, "ingest_recovery")
    landing = f"{base}/landing"
    lapses = warehouse.lapse_rows(S.raw_lapses(spark, sf_dir))
    plain = lapses.select("policy_id", "lapse_date", "premium_amount", "status")
    group = F.pmod("policy_id", F.lit(4))
    first = lapses.where((group == 3) & (F.col("_k2") == 1)).select(*plain.columns)
    list(_deliver(spark, first, f"{landing}/again", "sent-{}.parquet"))
    fs, p = hadoop_fs(spark, f"{landing}/damaged.parquet")
    out = fs.create(p, True)
    out.write(bytearray(b"PAR1 truncated upload"))
    out.close()
    list(_deliver(spark, plain.where("false"), landing, "empty.parquet", files=1))
    list(_deliver(spark, plain.where(group == 1).withColumn("tags", F.array("status")), f"{landing}/nested", "n-{}.parquet"))
    job = ParquetToCsvIngest(
        spark, landing, f"{base}/processed", f"{base}/error", f"{base}/audit", f"{base}/_checkpoint")
    job.run_once()
    # later arrivals: files that kept an old time, names with glob characters, a re-delivery
    for path in _deliver(spark, plain.where(group == 0), f"{landing}/old", "o-{}.parquet"):
        fs.setTimes(path, 86_400_000, 86_400_000)
    list(_deliver(spark, plain.where(group == 2), f"{landing}/b", "b[{}].parquet"))
    list(_deliver(spark, plain.where(group == 3), f"{landing}/again", "sent-{}.parquet"))
    job.run_once()
    schema = "policy_id long, lapse_date date, premium_amount decimal(10,2), status string, tags string"
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(job.output_dir).select(
        "policy_id", "lapse_date", "premium_amount", "status", "tags")


def _ingest(spark, name, **how):
    from lapsewise.session import scratch_path
    from lapsewise.streaming.ingest import ParquetToCsvIngest

    base = scratch_path(spark, name)
    return ParquetToCsvIngest(
        spark, f"{base}/landing", f"{base}/processed", f"{base}/error", f"{base}/audit", f"{base}/_checkpoint", **how)


@register(
    "ingest_any_schema",
    with_(SQL_LAPSES)
    + """SELECT policy_id, lapse_date, CAST(premium_amount AS DOUBLE) AS premium_amount, status,
       CASE policy_id % 4 WHEN 0 THEN 'a ' || status WHEN 1 THEN 'k ' || status WHEN 2 THEN 'm ' || status END AS note
FROM lapses""",
)
def q_ingest_any_schema(spark, sf_dir):
    """Uploads of four schemas in one batch, with names that differ by case only or are Spark's
    own; one upload is sent again with an older time: every row comes out in its last version."""
    from lapsewise.operators.loading import hadoop_fs

    job = _ingest(spark, "ingest_any_schema")
    landing = job.source_dir
    rows = warehouse.lapse_rows(S.raw_lapses(spark, sf_dir))
    plain = rows.select("policy_id", "lapse_date", "premium_amount", "status")
    group = F.pmod("policy_id", F.lit(4))
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        list(_deliver(spark, plain.where(group == 0).withColumn("Status", F.concat(F.lit("a "), "status")), f"{landing}/case", "a-{}.parquet"))
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    list(_deliver(spark, plain.where(group == 1).withColumn("source_key", F.concat(F.lit("k "), "status")), f"{landing}/key", "k-{}.parquet"))
    list(_deliver(spark, plain.where(group == 2).withColumn("_metadata", F.concat(F.lit("m "), "status")), f"{landing}/meta", "m-{}.parquet"))
    first = rows.where((group == 3) & (F.col("_k2") == 1)).select(*plain.columns)
    list(_deliver(spark, first, f"{landing}/again", "s-{}.parquet"))
    list(_deliver(spark, plain.where("false"), landing, "void.parquet", files=1))
    job.run_once()
    fs, _ = hadoop_fs(spark, landing)
    for path in _deliver(spark, plain.where(group == 3), f"{landing}/again", "s-{}.parquet"):
        fs.setTimes(path, 86_400_000, 86_400_000)
    job.run_once()

    def back(folder, note):
        schema = "policy_id long, lapse_date date, premium_amount decimal(10,2), status string"
        schema += ", note string" if note else ""
        path = f"{job.output_dir}/source_key=processed%2F{folder}%2F*"
        df = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)
        return df if note else df.withColumn("note", F.lit(None).cast("string"))

    out = back("again", False)
    for folder in ("case", "key", "meta"):
        out = out.unionByName(back(folder, True))
    return out


@register(
    "ingest_contract",
    with_(SQL_LAPSES)
    + """SELECT CASE policy_id % 4 WHEN 0 THEN 'equal' WHEN 1 THEN 'narrower' WHEN 2 THEN 'no_status' ELSE 'wider' END AS upload,
       CASE WHEN policy_id % 4 = 3 THEN 'conversion_failed' ELSE 'conversion_success' END AS event,
       CASE WHEN policy_id % 4 <> 3 THEN count(*) END AS rows_out,
       CASE WHEN policy_id % 4 <> 3 THEN CAST(sum(premium_amount) AS DOUBLE) END AS premiums,
       CASE WHEN policy_id % 4 <> 3 THEN count(CASE WHEN policy_id % 4 <> 2 THEN status END) END AS with_status
FROM lapses GROUP BY policy_id % 4""",
)
def q_ingest_contract(spark, sf_dir):
    """Uploads that equal a contract, are compatible with it (narrower numbers, a nullable column
    missing) or are refused (a wider number), and what comes out of each."""
    from pyspark.sql import types as T

    from lapsewise.streaming.ingest import read_audit

    contract = T.StructType([
        T.StructField("policy_id", T.LongType(), False), T.StructField("lapse_date", T.DateType()),
        T.StructField("premium_amount", T.DecimalType(12, 2)), T.StructField("status", T.StringType())])
    job = _ingest(spark, "ingest_contract", expected_schema=contract, compatible=True)
    rows = warehouse.lapse_rows(S.raw_lapses(spark, sf_dir)).select("policy_id", "lapse_date", "premium_amount", "status")
    group = F.pmod("policy_id", F.lit(4))
    uploads = {
        "equal": rows.where(group == 0).withColumn("premium_amount", F.col("premium_amount").cast("decimal(12,2)")),
        "narrower": rows.where(group == 1).withColumn("policy_id", F.col("policy_id").cast("int")),
        "no_status": rows.where(group == 2).drop("status"),
        "wider": rows.where(group == 3).withColumn("premium_amount", F.col("premium_amount").cast("decimal(14,4)")),
    }
    for name, df in uploads.items():
        list(_deliver(spark, df, f"{job.source_dir}/{name}", "u-{}.parquet", files=4))
    job.run_once()
    upload = lambda c: F.regexp_extract(c, "([a-z_]+)/u-", 1).alias("upload")
    events = read_audit(spark, job.audit_dir).where("event LIKE 'conversion%'").select(upload("source_key"), "event").distinct()
    schema = "policy_id long, lapse_date date, premium_amount decimal(12,2), status string, source_key string"
    totals = spark.read.schema(schema).option("header", True).csv(job.output_dir).groupBy(upload("source_key")).agg(
        F.count(F.lit(1)).alias("rows_out"), F.sum("premium_amount").cast("double").alias("premiums"), F.count("status").alias("with_status"))
    return events.join(totals, "upload", "left").select("upload", "event", "rows_out", "premiums", "with_status")


@register(
    "audit_json",
    """
SELECT 'conversion_success' AS event, (SELECT count(*) FROM lineitem) AS rows_converted, true AS in_order
UNION ALL SELECT 'file_received', CAST(NULL AS BIGINT), true
UNION ALL SELECT 'conversion_failed', CAST(NULL AS BIGINT), true
UNION ALL SELECT 'file_moved_to_error', CAST(NULL AS BIGINT), true
UNION ALL SELECT 'error_handling_failed', CAST(NULL AS BIGINT), true
UNION ALL SELECT 'skipped_non_parquet', CAST(NULL AS BIGINT), true""",
)
def q_audit_json(spark, sf_dir):
    """The audit as JSON documents, all six events among them, each with a time of its own: a file's
    events are in the order of their times."""
    from lapsewise.operators.loading import hadoop_fs
    from lapsewise.streaming.ingest import audit_as_json, read_audit

    job = _run_ingest(spark, sf_dir)
    # an unreadable upload that cannot be moved: its quarantine folder is a file
    fs, p = hadoop_fs(spark, f"{job.source_dir}/stuck/late.parquet")
    for where in (p, hadoop_fs(spark, f"{job.error_dir}/stuck")[1]):
        out = fs.create(where, True)
        out.write(bytearray(b"PAR1 truncated upload"))
        out.close()
    job.run_once()
    docs = audit_as_json(read_audit(spark, job.audit_dir))
    got = docs.select(F.from_json("json", "event string, source_key string, rows_converted long, timestamp timestamp").alias("e")).select("e.*")
    received = got.where("event = 'file_received'").groupBy("source_key").agg(F.max("timestamp").alias("received"))
    timed = got.join(received, "source_key", "left")
    return timed.groupBy("event").agg(
        F.sum("rows_converted").alias("rows_converted"),
        F.bool_and(F.col("timestamp").isNotNull() & (F.col("received").isNull() | (F.col("timestamp") >= F.col("received")))).alias("in_order"))


@register(
    "required_inputs",
    """
SELECT 'customer' AS input, true AS present, (SELECT count(*) FROM customer) AS n_rows
UNION ALL SELECT 'lineitem', true, (SELECT count(*) FROM lineitem)
UNION ALL SELECT 'no_such_input', false, CAST(NULL AS BIGINT)""",
)
def q_required_inputs(spark, sf_dir):
    """The check of required inputs before a load, and the rows of those that are there."""
    from lapsewise.sources import files

    found = []
    for name in ("customer", "lineitem", "no_such_input"):
        try:
            files.require_inputs(spark, [f"{sf_dir}/{name}.parquet"])
            rows = S.table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("n_rows"))
        except FileNotFoundError:
            rows = spark.range(1).select(F.lit(None).cast("long").alias("n_rows"))
        found.append(rows.select(F.lit(name).alias("input"), F.col("n_rows").isNotNull().alias("present"), "n_rows"))
    return found[0].unionByName(found[1]).unionByName(found[2])


@register(
    "clients_from_csv",
    """
SELECT c_custkey AS client_id, 'The "' || c_name || '", Ltd' AS name,
       CASE WHEN c_acctbal >= 0 THEN CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS DOUBLE) END AS income,
       CASE WHEN c_custkey % 7 <> 0 THEN n_name END AS province
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def q_clients_from_csv(spark, sf_dir):
    """Client files with reordered columns, doubled quotes and missing-value spellings."""
    from lapsewise.session import scratch_path
    from lapsewise.sources import files

    path = scratch_path(spark, "client_csv")
    records = S.client_records(spark, sf_dir).select(
        F.coalesce(F.when(F.pmod("client_id", F.lit(7)) != 0, F.col("province")), F.lit("N/A")).alias("province"),
        F.concat(F.lit('The "'), F.col("name"), F.lit('", Ltd')).alias("name"),
        F.coalesce(F.col("income").cast("string"), F.lit("#N/A")).alias("income"),
        "client_id",
    )
    records.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    return files.read_clients_csv(spark, path).select("client_id", "name", "income", "province")


SQL_LOADED_CTES = with_(
    SQL_CLIENTS,
    f"""
params AS (
  SELECT (SELECT count(*) FROM customer) AS nc, (SELECT count(*) FROM part) AS np,
         (SELECT max(o_orderkey) FROM orders) AS last_policy,
         (SELECT min(c_custkey) FROM customer) AS first_client
),
dim_clients AS (SELECT * FROM dedup),
dim_products AS (
  SELECT 'prod_' || {padded_sql("p_partkey + 1")} AS product_id, p_name AS product_name,
         p_type AS tier, p_brand AS status
  FROM part
),
dim_policy AS (
  SELECT p AS policy_id, (p % (SELECT nc FROM params)) + (SELECT first_client FROM params) AS client_id,
         'prod_' || {padded_sql("(p % (SELECT np FROM params)) + 1")} AS product_id
  FROM (SELECT unnest(generate_series(0, (SELECT last_policy FROM params))) AS p) s
)""",
    SQL_LAPSES,
    SQL_CALENDAR,
    "fct_health_lapses AS (SELECT * FROM fact)",
)


@register("dq_loaded_warehouse", suite_sql(SQL_LOADED_CTES, WAREHOUSE_CHECKS))
def q_dq_loaded_warehouse(spark, sf_dir):
    """Every constraint of the star schema on the tables that the load has written."""
    from lapsewise.operators import quality as Q

    return Q.run_checks(WAREHOUSE_CHECKS, warehouse.read_warehouse(spark, _loaded_warehouse(spark, sf_dir)[1]))


@register(
    "load_counts",
    """
SELECT 1 AS load, (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0) AS rows_read,
       (SELECT count(DISTINCT o_orderkey) FROM orders WHERE o_orderkey % 2 = 0) AS rows_inserted
UNION ALL
SELECT 2, (SELECT count(*) FROM orders),
       (SELECT count(DISTINCT o_orderkey) FROM orders WHERE o_orderkey % 2 <> 0)""",
)
def q_load_counts(spark, sf_dir):
    """Rows read and inserted by two overlapping loads of the policies."""
    from lapsewise.operators.loading import insert_if_absent
    from lapsewise.session import scratch_path

    path = scratch_path(spark, "policies")
    policy = S.policy(spark, sf_dir)
    loads = [insert_if_absent(spark, path, batch, ["policy_id"], versioned=True)
             for batch in (policy.where("policy_id % 2 = 0"), policy)]
    return spark.createDataFrame(
        [(i + 1, c["rows_read"], c["rows_inserted"]) for i, c in enumerate(loads)],
        "load int, rows_read long, rows_inserted long")


@register(
    "dq_pii_columns",
    with_(SQL_CLIENTS)
    + """SELECT 'stg_clients' AS model, 'name' AS column_name, count(name) AS n_values FROM stg_clients
UNION ALL SELECT 'stg_clients', 'income', count(income) FROM stg_clients
UNION ALL SELECT 'dim_patients', 'income', count(income) FROM dim_patients""",
)
def q_dq_pii_columns(spark, sf_dir):
    """Columns with a privacy tag in the client models, and how many values they hold."""
    from lapsewise import schemas
    from lapsewise.operators import quality as Q
    from lapsewise.session import materialize

    stg = materialize(models.stg_clients(S.raw_clients(spark, sf_dir), S.CLIENT_ORDER), "stg_clients")
    found = [
        df.agg(F.count(c).alias("n_values")).select(F.lit(name).alias("model"), F.lit(c).alias("column_name"), "n_values")
        for name, df in (("stg_clients", stg), ("dim_patients", models.dim_patients(stg)))
        for c in Q.pii_leaks(df, schemas.DIM_CLIENTS)
    ]
    return Q.union_all(found)


@register(
    "masked_clients",
    with_(SQL_CLIENTS) + "SELECT client_id, sha256('s1' || name) AS name, CAST(income AS DOUBLE) AS income, province FROM dedup",
)
def q_masked_clients(spark, sf_dir):
    """Clients for non-production use: names as salted digests."""
    from lapsewise.plans.incremental import mask_columns

    return mask_columns(models.deduplicated_clients(S.raw_clients(spark, sf_dir), S.CLIENT_ORDER), ["name"], "s1")


@register(
    "retained_lapses",
    with_(SQL_LAPSES)
    + """SELECT policy_id, lapse_date, CAST(premium_amount AS DOUBLE) AS premium_amount, status FROM lapses
WHERE lapse_date >= CAST('1998-06-01' AS DATE) - 1000""",
)
def q_retained_lapses(spark, sf_dir):
    """Lapses within 1000 days before a given day."""
    from lapsewise.plans.incremental import within_retention

    rows = warehouse.lapse_rows(S.raw_lapses(spark, sf_dir)).select("policy_id", "lapse_date", "premium_amount", "status")
    return within_retention(rows, "lapse_date", 1000, today="1998-06-01")


@register(
    "expired_lapses",
    with_(SQL_LAPSES)
    + """SELECT 'kept' AS what, strftime(lapse_date, '%Y-%m') AS period, count(*) AS lapses,
       CAST(sum(premium_amount) AS DOUBLE) AS premiums
FROM lapses WHERE lapse_date >= DATE '1995-06-17' GROUP BY ALL
UNION ALL SELECT 'removed', strftime(lapse_date, '%Y-%m'), count(*), CAST(NULL AS DOUBLE)
FROM lapses WHERE lapse_date < DATE '1995-06-17' GROUP BY ALL""",
)
def q_expired_lapses(spark, sf_dir):
    """A dated table after two expiries: what is left by month, and the log of what went."""
    from lapsewise.operators.versioned import VersionedTable
    from lapsewise.session import scratch_path

    rows = warehouse.lapse_rows(S.raw_lapses(spark, sf_dir)).select("policy_id", "lapse_date", "premium_amount", "status")
    table = VersionedTable(spark, scratch_path(spark, "dated_lapses"))
    table.append_dated(rows.where("policy_id % 2 = 0"), "lapse_date")
    table.append_dated(rows.where("policy_id % 2 <> 0"), "lapse_date")
    table.expire("1994-02-01")
    table.expire("1995-06-17")
    kept = table.read().groupBy(F.date_format("lapse_date", "yyyy-MM").alias("period")).agg(
        F.count(F.lit(1)).alias("lapses"), F.sum("premium_amount").alias("premiums"))
    removed = table.expired().groupBy("period").agg(F.sum("rows_removed").alias("lapses"))
    return kept.select(F.lit("kept").alias("what"), "period", "lapses", F.col("premiums").cast("double").alias("premiums")).unionByName(
        removed.select(F.lit("removed").alias("what"), "period", "lapses", F.lit(None).cast("double").alias("premiums")))


@register(
    "lapses_by_day",
    with_(SQL_LAPSES)
    + """SELECT CAST(year(lapse_date) AS INTEGER) AS year, CAST(month(lapse_date) AS INTEGER) AS month,
       CAST(day(lapse_date) AS INTEGER) AS day, count(*) AS lapses,
       CAST(sum(premium_amount) AS DOUBLE) AS premiums
FROM lapses GROUP BY ALL""",
)
def q_lapses_by_day(spark, sf_dir):
    """Daily totals from the year/month/day folder layout."""
    from lapsewise.plans.incremental import write_date_partitioned
    from lapsewise.session import scratch_path

    path = scratch_path(spark, "by_day")
    rows = warehouse.lapse_rows(S.raw_lapses(spark, sf_dir)).select("policy_id", "lapse_date", "premium_amount", "status")
    write_date_partitioned(rows, "lapse_date", path, levels=("year", "month"))
    return spark.read.parquet(path).groupBy("year", "month", F.dayofmonth("lapse_date").alias("day")).agg(
        F.count(F.lit(1)).alias("lapses"), F.sum("premium_amount").alias("premiums"))
