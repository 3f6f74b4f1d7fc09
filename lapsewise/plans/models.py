"""Staging and mart models of the lapse warehouse as DataFrame functions.

Views become functions returning lazy DataFrames (Catalyst inlines them);
table-materialised models are written by ``plans.warehouse``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.functions.hashing import md5_hash, salted_sha256
from lapsewise.functions.numeric import ratio_half_up
from lapsewise.operators.dedup import first_wins
from lapsewise.operators.median import impute_group_median
from lapsewise.session import bounded_partitions, materialize

CLIENT_COLUMNS = ["client_id", "name", "income", "province"]


def deduplicated_clients(clients: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per client_id, the first by ``order`` (a total order)."""
    order = list(order)
    hidden = [c for c in order if c not in CLIENT_COLUMNS]
    picked = clients.select(*CLIENT_COLUMNS, *hidden)
    return first_wins(picked, ["client_id"], order, drop=hidden)


def imputed_clients(clients: DataFrame, **median_kwargs) -> DataFrame:
    """Missing income replaced by the province median of known incomes.

    ``income`` becomes double (as a continuous percentile is);
    ``income_was_imputed`` is true whenever the income was missing.
    """
    out = impute_group_median(
        clients.select(*CLIENT_COLUMNS),
        ["province"],
        "income",
        flag="income_was_imputed",
        **median_kwargs,
    )
    return out.select(
        "client_id",
        "name",
        F.col("income").cast("double").alias("income"),
        "income_was_imputed",
        "province",
    )


def stg_clients(
    clients: DataFrame, order: Sequence[str], materialize_dedup: bool = True, **median_kwargs
) -> DataFrame:
    """Deduplicated, income-imputed clients.

    The imputation reads the deduplicated clients several times (group
    counts, histogram, middle values, final join).  By default the
    deduplicated table is written once to the shared folder so that the
    deduplication shuffle runs once instead of once per reader.
    """
    dedup = deduplicated_clients(clients, order)
    if materialize_dedup:
        dedup = materialize(dedup, "deduplicated_clients")
    return imputed_clients(dedup, **median_kwargs)


def stg_products(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id", "product_name", "tier", F.col("status").alias("product_status")
    )


def stg_health_lapses(fact: DataFrame, policy: DataFrame) -> DataFrame:
    """Lapse events enriched with the policy's client and product."""
    p = policy.select("policy_id", "client_id", "product_id")
    return fact.join(p, "policy_id").select(
        "lapse_id",
        "policy_id",
        "client_id",
        "product_id",
        "lapse_date",
        "date_key",
        "premium_amount",
        F.col("status").alias("lapse_status"),
    )


def dim_patients(stg_clients_df: DataFrame) -> DataFrame:
    """Patient dimension without the name column."""
    return stg_clients_df.select("client_id", "income", "income_was_imputed", "province")


def dim_patients_hashed(dim_clients: DataFrame, salt: str | None = None) -> DataFrame:
    """Pseudonymised clients: the name replaced by a digest.

    Without ``salt`` the digest is a plain MD5 of the name (compatible, but a
    name dictionary reverses it); with ``salt`` it is SHA-256 of salt+name.
    """
    digest = md5_hash("name") if salt is None else salted_sha256("name", salt)
    return dim_clients.select(
        "client_id", digest.alias("patient_hash"), "income", "province"
    )


#: How the measures of two sets of lapses of one policy merge.
LAPSE_TOTALS = {
    "_claims": "sum", "_premiums": "sum", "_min_premium": "min", "_max_premium": "max", "_lapsed_count": "sum",
    "_active_count": "sum", "_pending_count": "sum", "_first": "min", "_latest": "max",
}

_STATUS_COUNTS = (("lapsed_count", "Lapsed"), ("active_count", "Active"), ("pending_count", "Pending"))


def policy_lapse_totals(fact: DataFrame, status_col: str = "status") -> DataFrame:
    """Per-policy partial aggregates of the lapse fact.

    Every summary measure is decomposable by policy, so the fact is reduced
    to policy grain before it meets the bridge (eager aggregation below the
    join; exact even if the bridge repeated a policy, because aggregates and
    rows multiply alike through the join).
    """
    return fact.groupBy("policy_id").agg(
        F.count(F.lit(1)).alias("_claims"),
        F.sum("premium_amount").alias("_premiums"),
        F.min("premium_amount").alias("_min_premium"),
        F.max("premium_amount").alias("_max_premium"),
        *[F.count_if(F.col(status_col) == s).alias(f"_{name}") for name, s in _STATUS_COUNTS],
        F.min("lapse_date").alias("_first"),
        F.max("lapse_date").alias("_latest"),
    )


def client_claims(fact: DataFrame, policy: DataFrame, status_col: str = "status") -> DataFrame:
    """Per-client claim measures (the ``patient_summary`` step)."""
    return claims_of_totals(policy_lapse_totals(fact, status_col), policy)


def claims_of_totals(per_policy: DataFrame, policy: DataFrame) -> DataFrame:
    """Per-client claim measures from per-policy ones."""
    joined = per_policy.join(policy.select("policy_id", "client_id", "product_id"), "policy_id")
    return joined.groupBy("client_id").agg(
        F.count_distinct("policy_id").alias("total_policies"),
        F.sum("_claims").alias("total_claims"),
        F.sum("_premiums").alias("total_premiums"),
        F.min("_min_premium").alias("min_premium"),
        F.max("_max_premium").alias("max_premium"),
        *[F.sum(f"_{name}").alias(name) for name, _ in _STATUS_COUNTS],
        F.min("_first").alias("first_claim_date"),
        F.max("_latest").alias("latest_claim_date"),
        F.count_distinct("product_id").alias("distinct_products"),
    )


def patient_claims_summary(
    fact: DataFrame, policy: DataFrame, patients: DataFrame, status_col: str = "status"
) -> DataFrame:
    """One row per client with lapses and a patient record.

    ``avg_premium`` and ``lapse_rate_pct`` are rounded half away from zero in
    one exact step (sum / count), never ``round(avg())``.
    """
    return summary_of_totals(policy_lapse_totals(fact, status_col), policy, patients)


def written_claims_summary(
    fact: DataFrame, policy: DataFrame, patients: DataFrame, rows: int | None = None
) -> DataFrame:
    """``patient_claims_summary`` written to the work folder by tasks of bounded memory.

    ``rows``: at least the rows of ``fact``, if known; else they are counted.
    """
    with bounded_partitions(fact.sparkSession, fact.count() if rows is None else rows):
        return materialize(patient_claims_summary(fact, policy, patients), "claims_summary")


def summary_of_totals(per_policy: DataFrame, policy: DataFrame, patients: DataFrame) -> DataFrame:
    """The claims summary from per-policy measures."""
    claims = claims_of_totals(per_policy, policy)
    p = patients.select("client_id", "income", "province")
    return claims.join(p, "client_id").select(
        "client_id",
        "income",
        "province",
        "total_policies",
        "total_claims",
        "total_premiums",
        ratio_half_up(F.col("total_premiums"), F.col("total_claims"), 2).alias("avg_premium"),
        "min_premium",
        "max_premium",
        "lapsed_count",
        "active_count",
        "pending_count",
        "first_claim_date",
        "latest_claim_date",
        "distinct_products",
        ratio_half_up(F.col("lapsed_count") * 100, F.col("total_claims"), 2).alias("lapse_rate_pct"),
    )


def unified_dataset(
    fact: DataFrame,
    policy: DataFrame,
    clients_imputed: DataFrame,
    products: DataFrame,
    dates: DataFrame,
) -> DataFrame:
    """Star join of every dimension onto the lapse fact.

    Dimensions are joined at policy grain first, so the (largest) fact is
    shuffled once, on policy_id.  The calendar is bounded by the date span
    and is broadcast.
    """
    policy_dims = (
        policy.select("policy_id", "client_id", "product_id")
        .join(
            clients_imputed.select("client_id", "income", "income_was_imputed", "province"),
            "client_id",
        )
        .join(
            products.select(
                "product_id", "product_name", "tier", F.col("status").alias("product_status")
            ),
            "product_id",
        )
    )
    cal = dates.select("date_key", "year", "quarter", "month", "month_name", "day_name", "is_weekend")
    return (
        fact.select(
            "lapse_id",
            "policy_id",
            "lapse_date",
            "date_key",
            "premium_amount",
            F.col("status").alias("lapse_status"),
        )
        .join(cal, "date_key")
        .join(policy_dims, "policy_id")
        .select(
            "client_id",
            "income",
            "income_was_imputed",
            "province",
            "policy_id",
            "product_id",
            "product_name",
            "tier",
            "product_status",
            "lapse_id",
            "lapse_date",
            "premium_amount",
            "lapse_status",
            "year",
            "quarter",
            "month",
            "month_name",
            "day_name",
            "is_weekend",
        )
    )
