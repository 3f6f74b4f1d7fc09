"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapsewise.session import materialize as write_table
from lapsewise.session import ship_package

#: Bytes of text handled at once inside a task; bounds a task's temporaries.
SLICE_BYTES = 1 << 18
#: Largest table (bytes of its rows) that is sent to every executor.
#: The size is counted before each such broadcast; beyond it the operators
#: take the shuffle join that follows each use.
BROADCAST_BYTES = 16 << 20
#: The same for a plain column of longs that the executors' Python workers hold.
LONGS_BYTES = 96 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, text): ``h`` digests the text, so (doc_id, h) names a row
    by its content.  Rows that repeat both are alike in every result."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("h"),
        F.col(text_col).alias("text"),
    )


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch by rows so that each slice holds about ``limit`` bytes of text."""
    if not batch.num_rows:
        return
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes) // limit
    cuts = np.flatnonzero(np.diff(group)) + 1
    for a, b in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows]):
        yield batch.slice(a, b - a)


#: Rows that travel between the JVM and a Python worker at once, while a job of many stages runs.
BATCH_ROWS = 1000


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS):
    """Arrow batches of at most ``rows`` rows: both sides hold a batch in memory, and its
    bytes follow its rows.  The session's own settings are back afterwards."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def free_memory() -> None:
    """Give what a finished task held back to the system: Arrow's pool and the C library keep
    freed memory, and a Python worker lives through all stages of a job."""
    import gc

    gc.collect()
    give_back()


def give_back() -> None:
    """Return memory that is free already to the system."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def drop_encoders() -> None:
    """Let go of the tokenizers and remembered pieces of this worker."""
    import sys

    tokens = sys.modules.get("lapsewise.llm.tokens")
    if tokens is not None:
        tokens.clear_encoders()


def released(run: Callable, encodes: bool = False) -> Callable:
    """``run`` (batches -> batches) that gives its memory back when its task ends.

    A Python worker lives through all stages of a job: a task that does not encode also
    drops what an encoding one has left for the next of its kind.
    """

    def task(batches):
        if not encodes:
            drop_encoders()
        try:
            yield from run(batches)
        finally:
            free_memory()

    return task


def map_text(df: DataFrame, kernel: Callable, schema: str, column: str = "text") -> DataFrame:
    """Apply ``kernel(record_batch) -> record_batch | None`` to slices of ``df``."""
    ship_package(df.sparkSession)

    def run(batches):
        for batch in batches:
            for part in slices(batch, column):
                out = kernel(part)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(released(run), schema)


def _row_bytes(df: DataFrame):
    """Bytes of a row in memory, about."""
    wide = F.lit(8 * (len(df.columns) + 2))
    for f in df.schema.fields:
        name = f"`{f.name}`"
        if isinstance(f.dataType, T.ArrayType):
            wide = wide + 8 + 8 * F.greatest(F.lit(0), F.coalesce(F.size(name), F.lit(0)))
        elif isinstance(f.dataType, T.StructType):
            wide = wide + 8 * (1 + len(f.dataType.fields))
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            wide = wide + F.coalesce(F.octet_length(name), F.lit(0))
    return wide.cast("long")


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """``df`` written to the shared folder and read back; its rows and bytes are
    counted in the same pass (see ``small``)."""
    seen = Observation()
    table = write_table(df.observe(seen, F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(df)).alias("bytes")), name)
    got = seen.get
    table.counted_rows, table.counted_bytes = int(got["rows"]), int(got["bytes"] or 0)
    return table


def small(table: DataFrame, limit: int | None = None, row_bytes: int | None = None) -> bool:
    """Whether a materialized table may be broadcast: its counted bytes (or its rows
    times ``row_bytes``) are within the limit."""
    size = table.counted_bytes if row_bytes is None else table.counted_rows * row_bytes
    return size <= (BROADCAST_BYTES if limit is None else limit)


def longs(df: DataFrame, column: str) -> np.ndarray:
    """A size-checked table's column of longs on the driver, as sorted uint64."""
    got = df.select(column).toArrow().column(0).to_numpy()
    return np.sort(got.astype(np.int64).view(np.uint64))


def member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """values in ordered (sorted)?"""
    if not len(ordered) or not len(values):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values


def attach(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", limit: int | None = None) -> DataFrame:
    """Null-safe equi-join of ``left`` to a written table: broadcast if its
    counted size is within the limit, else a shuffle join."""
    fits = small(right, limit)
    right = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        one = left[k].eqNullSafe(F.col(f"_r_{k}"))
        cond = one if cond is None else cond & one
    if fits:
        right = F.broadcast(right)
    joined = left.join(right, cond, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{k}" for k in keys])


__all__ = [
    "BROADCAST_BYTES", "attach", "keyed", "longs", "map_text", "materialize",
    "member", "released", "slices", "small", "table",
]
