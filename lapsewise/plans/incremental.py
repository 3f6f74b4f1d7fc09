"""Incremental maintenance: upserts, partial mart refresh, partitioned layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.operators.dedup import last_wins
from lapsewise.operators.loading import in_versions, path_exists, replace_table
from lapsewise.operators.versioned import VersionedTable
from lapsewise.plans import models
from lapsewise.session import bounded_partitions, materialize


BUCKET = "_bucket"


def key_bucket(keys: Sequence[str], buckets: int) -> F.Column:
    """Stable bucket of a key: ``pmod(xxhash64(keys), buckets)``."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def upsert(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[str],
    buckets: int | None = None,
    versioned: bool = False,
) -> DataFrame:
    """Insert new keys, replace existing ones when the batch row is newer.

    "Newer" is the greater value of ``newest_first`` (compared in order).
    Parquet has no in-place update, so rows are merged (one partial
    aggregate over existing + batch) and rewritten:

    * ``buckets=None``: the whole table is rewritten (staged, then swapped);
    * ``buckets=n``: the table is laid out in ``n`` key-hash buckets
      (``_bucket=i`` folders) and only the buckets the batch touches are
      read (partition pruning), merged, staged and swapped in, so the cost
      follows the batch, not the table.

    The bucket count is stored beside the table; a later call with another one
    is refused, as its keys would fall into other buckets.  Returns the table
    without the bucket column.

    A table in versions (``versioned=True``) is always bucketed; all touched
    buckets are published at once, so no reader sees some new and some old.
    """
    keys = list(keys)
    if in_versions(spark, path, versioned):
        return VersionedTable(spark, path).upsert(batch, keys, newest_first, buckets)
    if buckets is None:
        if path_exists(spark, path):
            existing = spark.read.parquet(path)
            merged = existing.unionByName(batch.select(*existing.columns))
        else:
            merged = batch
        return replace_table(spark, path, last_wins(merged, keys, newest_first))

    tagged = batch.withColumn(BUCKET, key_bucket(keys, buckets))

    def by_bucket(merged: DataFrame, n: int) -> DataFrame:
        # after the merge every key is one row, so hashing buckets to tasks
        # is balanced; one task per bucket writes one file per bucket
        # (ranges of the bucket number: hashing it again would make buckets collide)
        return merged.repartitionByRange(max(1, n), BUCKET)

    _same_bucket_count(spark, path, buckets)
    if not path_exists(spark, path):
        (
            by_bucket(last_wins(tagged, keys, newest_first), buckets)
            .write.mode("overwrite").partitionBy(BUCKET).parquet(path)
        )
        return spark.read.parquet(path).drop(BUCKET)
    # at most ``buckets`` small ints reach the driver
    touched = sorted(r[0] for r in tagged.select(BUCKET).distinct().collect())
    existing = spark.read.parquet(path).where(F.col(BUCKET).isin(touched))
    merged = last_wins(
        existing.unionByName(tagged.select(*existing.columns)), keys, newest_first
    )
    staging = path.rstrip("/") + "._staging"
    by_bucket(merged, len(touched)).write.mode("overwrite").partitionBy(BUCKET).parquet(staging)
    for b in touched:
        _swap_dir(spark, f"{staging}/{BUCKET}={b}", f"{path.rstrip('/')}/{BUCKET}={b}")
    _delete(spark, staging)
    return spark.read.parquet(path).drop(BUCKET)


def _same_bucket_count(spark: SparkSession, path: str, buckets: int) -> None:
    """Store the bucket count of a new table; refuse another for an existing one."""
    from lapsewise.operators.loading import hadoop_fs

    note = path.rstrip("/") + "._buckets"
    fs, p = hadoop_fs(spark, note)
    if path_exists(spark, path) and fs.exists(p):
        stored = int(spark.read.text(note).first()[0])
        if stored != buckets:
            raise ValueError(f"{path} has {stored} buckets, not {buckets}")
        return
    if path_exists(spark, path):
        raise ValueError(f"{path} has no stored bucket count")
    spark.createDataFrame([(str(buckets),)], "value string").coalesce(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "static").text(note)


def _swap_dir(spark: SparkSession, new: str, target: str) -> None:
    from lapsewise.operators.loading import hadoop_fs

    fs, tgt = hadoop_fs(spark, target)
    _, src = hadoop_fs(spark, new)
    # outside the table: what a crash leaves there is never read as data
    table, bucket = target.rsplit("/", 1)
    _, old = hadoop_fs(spark, f"{table}._retired/{bucket}")
    fs.mkdirs(old.getParent())
    fs.delete(old, True)
    if fs.exists(tgt) and not fs.rename(tgt, old):
        raise RuntimeError(f"could not retire {target}")
    if not fs.rename(src, tgt):
        fs.rename(old, tgt)
        raise RuntimeError(f"could not publish {target}")
    fs.delete(old, True)


def _delete(spark: SparkSession, path: str) -> None:
    from lapsewise.operators.loading import hadoop_fs

    fs, p = hadoop_fs(spark, path)
    fs.delete(p, True)


def refresh_summary(
    old_summary: DataFrame,
    fact: DataFrame,
    policy: DataFrame,
    patients: DataFrame,
    new_rows: DataFrame,
) -> DataFrame:
    """Recompute the claims summary only for clients touched by ``new_rows``.

    Without a stored state (see ``merge_claims``) the touched clients' whole
    history is re-read: a semi-join on the touched policies' clients; untouched
    clients keep their old rows.
    """
    spark = fact.sparkSession
    rows = fact.count()
    with bounded_partitions(spark, rows):
        touched = materialize(
            new_rows.select("policy_id").distinct()
            .join(policy.select("policy_id", "client_id"), "policy_id")
            .select("client_id").distinct(),
            "touched_clients",
        )
        their_policies = policy.join(touched, "client_id", "left_semi")
        their_facts = fact.join(their_policies.select("policy_id"), "policy_id", "left_semi")
        fresh = models.written_claims_summary(their_facts, their_policies, patients, rows)
        kept = old_summary.join(touched, "client_id", "left_anti")
        return materialize(kept.unionByName(fresh), "refreshed_summary")


def merge_claims(spark: SparkSession, path: str, new_rows: DataFrame, batch: str, buckets: int | None = None) -> DataFrame:
    """Add a batch of lapses to the claims state at ``path``; returns the state.

    The state holds one row per policy: counts, sum, least and greatest premium,
    status counts, first and latest date.  All of them merge, so only the buckets
    of the batch's policies are read and written, never a lapse that is in already.
    The name of each batch is kept with the version that added it: a batch that is sent
    again changes nothing.
    """
    table = VersionedTable(spark, path)
    return table.merge(models.policy_lapse_totals(new_rows), ["policy_id"], models.LAPSE_TOTALS, batch, buckets)


def summary_from_state(state: DataFrame, policy: DataFrame, patients: DataFrame) -> DataFrame:
    """The claims summary of a merged state: no lapse is read."""
    return models.summary_of_totals(state, policy, patients)


def write_partitioned_fact(fact: DataFrame, path: str) -> None:
    """Fact laid out by lapse month (``lapse_year=/lapse_month=`` folders).

    Rows are clustered by month before writing so each task writes few
    files; queries filtering on the month columns prune whole folders.
    """
    laid = fact.withColumn("lapse_year", F.year("lapse_date")).withColumn(
        "lapse_month", F.month("lapse_date")
    )
    (
        laid.repartitionByRange("lapse_year", "lapse_month", "lapse_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("lapse_year", "lapse_month")
        .parquet(path)
    )


def write_date_partitioned(
    df: DataFrame, date_col: str, path: str, levels: Sequence[str] = ("year", "month", "day")
) -> None:
    """Folder layout ``year=/month=/day=`` derived from ``date_col``.

    Filters on the derived columns prune whole folders at read time.
    """
    parts = {"year": F.year, "month": F.month, "day": F.dayofmonth}
    laid = df
    for level in levels:
        laid = laid.withColumn(level, parts[level](F.col(date_col)))
    (
        # the row's digest ends the order: one busy day spreads over several tasks
        laid.repartitionByRange(*levels, date_col, F.xxhash64(*df.columns))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*levels)
        .parquet(path)
    )


def mask_columns(df: DataFrame, columns: Sequence[str], salt: str) -> DataFrame:
    """Copy for non-production use: named columns replaced by salted digests."""
    from lapsewise.functions.hashing import salted_sha256

    return df.select(
        *[salted_sha256(c, salt).alias(c) if c in set(columns) else F.col(c) for c in df.columns]
    )


def within_retention(df: DataFrame, date_col: str, days: int, today: str | None = None) -> DataFrame:
    """Rows whose ``date_col`` lies within the last ``days`` days (inclusive)."""
    ref = F.lit(today).cast("date") if today else F.current_date()
    return df.where(F.col(date_col) >= F.date_sub(ref, days))
