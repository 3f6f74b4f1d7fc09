"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Settings every job relies on: AQE (runtime coalescing, broadcast conversion
# and skew-join splitting), UTC session time and ANSI semantics.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "lapsewise",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it if needed.

    The folder comes from ``spark.checkpoint.dir`` (a shared store such as HDFS
    or an object store); without that setting nothing can be written safely.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        raise RuntimeError("spark.checkpoint.dir must name a shared folder")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def use_private_checkpoints(spark: SparkSession) -> None:
    """Give a *local* session without ``spark.checkpoint.dir`` a folder of its own.

    For entry scripts and tests: driver and executors are one process there.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or not sc.master.startswith("local["):
        return
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="lapsewise-ckpt-"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint location.

    Used for intermediate tables that cut lineage and for the outputs the
    registered queries write and read back.
    """
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/lapsewise-work/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Cut lineage by writing ``df`` as a Parquet table in the shared folder.

    The table lives under ``spark.checkpoint.dir`` (a shared store on a
    cluster), so a lost executor never forces recomputation of the upstream
    plan, and values computed non-deterministically before the write (such
    as ``monotonically_increasing_id``) are frozen.  One columnar write is
    cheaper than ``Dataset.checkpoint``, which runs the plan twice and
    stores Java-serialised rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def materialize_counted(df: DataFrame, name: str = "materialized") -> DataFrame:
    """``materialize``, with the rows counted while they are written (``counted_rows``)."""
    seen = Observation()
    table = materialize(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
    table.counted_rows = int(seen.get["n"])
    return table


#: Rows of one shuffle partition, and its bytes, while wide rows are joined and aggregated.
PARTITION_ROWS = 250_000
PARTITION_BYTES = 8 << 20


@contextmanager
def bounded_partitions(spark: SparkSession, rows: int):
    """Shuffles of ``rows`` rows in so many partitions that the sort buffers and hash maps of one
    task stay small whatever ``rows`` is.

    Shuffled bytes are compressed and several operators of a stage hold them at once: the
    usual 64 MB that adaptive execution puts in a task take 1.4 GB there.  Holds for what
    runs inside, so results are to be written there; the session's own settings are back afterwards.
    """
    number, size = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {number: spark.conf.get(number), size: spark.conf.get(size)}
    in_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    spark.conf.set(number, str(max(int(before[number]), -(-rows // PARTITION_ROWS))))
    spark.conf.set(size, str(min(in_bytes(before[size]), PARTITION_BYTES)))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so Python file APIs can use the path."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def release_scratch(spark: SparkSession) -> None:
    """Delete this session's work tables (under its own checkpoint folder).

    Call when the results that read them are no longer needed (end of a
    job); later reads of DataFrames built on them would fail.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        return
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{current.rstrip('/')}/lapsewise-work")
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


def run_concurrently(*steps):
    """Run independent Spark actions from parallel threads; return their results.

    Each step submits its own jobs; the scheduler interleaves their tasks, so
    small jobs overlap their fixed latency instead of queueing.  The first
    exception is re-raised after all steps finished.
    """
    from concurrent.futures import ThreadPoolExecutor

    if len(steps) <= 1:
        return [step() for step in steps]
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        futures = [pool.submit(step) for step in steps]
        errors = [f.exception() for f in futures]
    for err in errors:
        if err is not None:
            raise err
    return [f.result() for f in futures]


def ship_package(spark: SparkSession) -> None:
    """Make ``lapsewise`` importable by the executors' Python workers.

    Functions handed to ``mapInPandas`` are pickled by reference to this
    package, so workers must be able to import it.  Done once per
    SparkContext with ``addPyFile`` (what ``--py-files`` does on submit); a
    no-op when the package is already importable everywhere because it was
    shipped before.
    """
    sc = spark.sparkContext
    if getattr(sc, "_lapsewise_shipped", False):
        return
    import shutil

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    staging = tempfile.mkdtemp(prefix="lapsewise-pyfiles-")
    archive = shutil.make_archive(
        os.path.join(staging, f"lapsewise-{uuid.uuid4().hex[:8]}"),
        "zip",
        root_dir=os.path.dirname(pkg_dir),
        base_dir=os.path.basename(pkg_dir),
    )
    sc.addPyFile(archive)
    sc._lapsewise_shipped = True
