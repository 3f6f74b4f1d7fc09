"""Token ids as ORC files.

One row is one document: its id, its ids as a list of ints (ORC's integer
run-length encoding), its number of ids and where it starts among the ids of
its file part.  Rows stand in ascending doc_id order over the parts, so the row
indexes of the stripes give narrow id ranges, and a Bloom filter on doc_id
prunes what the ranges leave.  Stripes are read in parallel by Spark's ORC
reader.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapsewise.llm.common import materialize, released, slices, small
from lapsewise.llm.tokens import append_id, default_path, encoder
from lapsewise.session import ship_package

END_ID = 0
STRIPE_BYTES = 32 << 20
INDEX_ROWS = 1000
#: Bytes of text that are encoded at once, and pieces of text that a worker remembers:
#: with more of them fewer pieces are looked up and encoded again.
ENCODE_BYTES = 8 << 20
ENCODE_PIECES = 1_000_000


def write_ids(docs: DataFrame, path: str, end_id: int = END_ID, tokenizer_path: str | None = None,
              id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every whole text and write the ids to ORC files under ``path``.

    Null and empty texts are the end id alone.  Null ids come first; equal ids
    stand in the order of their text's digest.  Ranges are split by (doc_id,
    digest), so that no range has to take all texts of one id.
    """
    vocabulary = tokenizer_path or default_path()
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")

    def run(batches):
        from pyspark import TaskContext

        part_no = TaskContext.get().partitionId()
        before = row = 0
        encode = encoder(vocabulary, ENCODE_PIECES).encode
        for batch in batches:
            for part in slices(batch, limit=ENCODE_BYTES):
                ids, borders = append_id(*encode(part.column("text")), end_id)
                n = part.num_rows
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array(np.full(n, part_no, dtype=np.int32)), "row": pa.array(np.arange(row, row + n)),
                    "doc_id": part.column("doc_id"), "part_start": pa.array(borders[:-1] + before),
                    "n_tokens": pa.array(np.diff(borders)),
                    "ids": pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), pa.array(ids.astype(np.int32)))})
                row += n
                before += int(borders[-1])

    (rows.mapInArrow(released(run, encodes=True), "part int, row long, doc_id long, part_start long, n_tokens long, ids array<int>")
     .write.option("compression", "zstd").option("orc.stripe.size", STRIPE_BYTES)
     .option("orc.row.index.stride", INDEX_ROWS).option("orc.create.index", "true")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .mode("overwrite").orc(path))


def read_ids(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of all documents; start counts the ids of all
    documents before it.  Only the two counters are read for the part totals."""
    rows = spark.read.orc(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = materialize(totals.select(F.col("part").alias("_part"), (
        F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("_before")), "part_starts")
    before = F.broadcast(before) if small(before, limit) else before
    return rows.join(before, F.col("part") == F.col("_part")).select(
        "doc_id", (F.col("part_start") + F.col("_before")).alias("start"), "n_tokens", "ids")


def lookup(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """Documents by id: the filter is pushed to the row indexes and Bloom filters."""
    return spark.read.orc(path).where(F.col("doc_id").isin(ids)).select("doc_id", "n_tokens", "ids")


def digests(read: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) computed from the ids read."""
    ship_package(read.sparkSession)

    def run(batches):
        for batch in batches:
            lists = batch.column("ids")
            edges = lists.offsets.to_numpy()
            ids = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<u4"))
            raw = memoryview(ids).cast("B")
            crc = [zlib.crc32(raw[4 * a: 4 * b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(edges).astype(np.int64)), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read.mapInArrow(released(run, encodes=True), "doc_id long, start long, n_tokens long, ids_crc32 long")
