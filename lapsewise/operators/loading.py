"""Write semantics of the warehouse tables.

* insert-if-absent (``INSERT ... ON CONFLICT (key) DO NOTHING``): first-wins
  deduplication of the batch, anti-join against the existing keys, append.
  Existing rows are never updated.
* replace (``TRUNCATE ... RESTART IDENTITY`` + reload): the new version is
  written to a staging folder, validated, and only then swapped in, so a
  failed reload never leaves a half-written table behind.

Both work on two kinds of tables.  A table in versions (``versioned=True`` when it
is created, see ``versioned.py``) publishes every change atomically and loads by
its key index; read it with ``read_table``.  A plain folder of Parquet files can be read
by anything, but a reload swaps it by renaming and a load reads all its keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lapsewise.operators.dedup import first_wins
from lapsewise.operators.versioned import VersionedTable, is_versioned
from lapsewise.session import materialize


def rows_absent(
    batch: DataFrame,
    existing: DataFrame | None,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``existing`` (first per key)."""
    keys = list(keys)
    if order:
        batch = first_wins(batch, keys, order, drop=drop)
    else:
        # no order given: the least of all columns survives, not an arbitrary row
        rest = [c for c in batch.columns if c not in keys]
        batch = first_wins(batch, keys, rest) if rest else batch.dropDuplicates(keys)
    if existing is None:
        return batch
    return batch.join(existing.select(*keys), keys, "left_anti")


def hadoop_fs(spark: SparkSession, path: str):
    """(Hadoop FileSystem, Path) for ``path`` - works for HDFS, object stores and local."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jpath.getFileSystem(conf), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path``: its newest version, or a plain folder."""
    return VersionedTable(spark, path).read() if is_versioned(spark, path) else spark.read.parquet(path)


def in_versions(spark: SparkSession, path: str, versioned: bool) -> bool:
    """Whether ``path`` is, or is to become, a table in versions; a plain one is not turned into one."""
    if is_versioned(spark, path):
        return True
    if versioned and path_exists(spark, path):
        raise ValueError(f"{path} is a plain folder, not a table in versions")
    return versioned


def insert_if_absent(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    drop: Sequence[str] = (),
    fmt: str = "parquet",
    versioned: bool = False,
) -> dict[str, int]:
    """Append the absent rows of ``batch`` to the table at ``path``.

    Returns ``{"rows_read": n, "rows_inserted": m}``, observed while the rows
    are staged and appended (no second scan of the batch).
    """
    if in_versions(spark, path, versioned):
        counts = VersionedTable(spark, path).insert_if_absent(batch, keys, order, drop)
        return {k: counts[k] for k in ("rows_read", "rows_inserted")}
    read_obs = Observation("rows_read")
    batch = batch.observe(read_obs, F.count(F.lit(1)).alias("n"))
    staged = stage_absent(spark, path, batch, keys, order, drop, fmt)
    inserted_obs = Observation("rows_inserted")
    staged.observe(inserted_obs, F.count(F.lit(1)).alias("n")).write.mode("append").format(fmt).save(path)
    return {"rows_read": read_obs.get["n"], "rows_inserted": inserted_obs.get["n"]}


def stage_absent(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str] | None = None,
    drop: Sequence[str] = (),
    fmt: str = "parquet",
) -> DataFrame:
    """The absent rows of ``batch``, written to the shared work folder.

    A row with a NULL in its key would be absent again on every load; it is
    refused before anything is appended.
    """
    existing = spark.read.format(fmt).load(path) if path_exists(spark, path) else None
    new_rows = rows_absent(batch, existing, keys, order, drop)
    if existing is not None:
        new_rows = new_rows.select(*existing.columns)
    staged = materialize(new_rows, "staged_rows")
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    if not staged.where(no_key).isEmpty():
        raise ValueError(f"NULL in the key ({', '.join(keys)}) of rows for {path}")
    return staged


def with_existing(spark: SparkSession, path: str, staged: DataFrame, fmt: str = "parquet") -> DataFrame:
    """The table at ``path`` as it will be once ``staged`` is appended."""
    if not path_exists(spark, path):
        return staged
    existing = read_table(spark, path) if is_versioned(spark, path) else spark.read.format(fmt).load(path)
    return existing.unionByName(staged)


def replace_table(
    spark: SparkSession,
    path: str,
    df: DataFrame,
    validate: Callable[[DataFrame], None] | None = None,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    versioned: bool = False,
) -> DataFrame:
    """Write ``df`` as the new content of ``path`` (truncate + reload).

    ``validate`` runs on the staged copy; if it raises, the old table stays.
    """
    if in_versions(spark, path, versioned):
        return VersionedTable(spark, path).replace(df, validate)
    staging = path.rstrip("/") + "._staging"
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    # a full reload replaces every partition, not only those written
    writer = writer.option("partitionOverwriteMode", "static")
    writer.save(staging)
    staged = spark.read.format(fmt).load(staging)
    if validate is not None:
        validate(staged)
    fs, target = hadoop_fs(spark, path)
    _, staged_path = hadoop_fs(spark, staging)
    retired = None
    if fs.exists(target):
        _, retired = hadoop_fs(spark, path.rstrip("/") + "._retired")
        fs.delete(retired, True)
        if not fs.rename(target, retired):
            raise RuntimeError(f"could not retire {path}")
    if not fs.rename(staged_path, target):
        if retired is not None:
            fs.rename(retired, target)
        raise RuntimeError(f"could not publish {path}")
    if retired is not None:
        fs.delete(retired, True)
    return spark.read.format(fmt).load(path)
