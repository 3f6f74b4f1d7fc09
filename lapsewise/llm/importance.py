"""Importance resampling towards a target distribution, with Arrow kernels.

Texts are lower-cased, split and flattened by Arrow (``ascii_lower``,
``split_pattern_regex``, ``list_flatten``) and the words dictionary-encoded.  N-grams
are formed from shifted dictionary indices: equal runs of indices are one entry, so
CRC-32 is computed once for each distinct n-gram of a batch and ``take`` spreads its
bucket, or the bucket's gain, over all places; a segment sum gives a document's total.

Two passes over the texts: bucket counts (partial sums leave a task as one row a
bucket), then gains.  A table of gains has one entry a bucket, a size fixed by a
parameter.  Draws are Gumbel-perturbed weights; the highest are found by a histogram of
scores and only rows at or above its cut are ordered.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.common import map_text, materialize, slices
from lapsewise.operators.keys import dense_index
from lapsewise.session import ship_package

#: What separates words once A-Z are lower-cased: ASCII but letters and digits.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000


def words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of a column of texts, flattened, and each row's number of words."""
    # a copy: ascii_lower reads sliced columns of large strings at wrong offsets
    whole = pc.fill_null(column.take(pa.array(np.arange(len(column)))), "").cast(pa.large_string())
    lists = pc.split_pattern_regex(pc.ascii_lower(whole), pattern=SEPARATORS)
    rows = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(lists)
    # a separator at either end of a text leaves an empty string there
    full = pc.greater(pc.binary_length(flat), 0)
    rows = rows[full.to_numpy(zero_copy_only=False)]
    return flat.filter(full), np.bincount(rows, minlength=len(column)).astype(np.int64)


def _crc(parts: list[bytes], before: np.ndarray | None = None, link: np.ndarray | None = None) -> np.ndarray:
    if before is None:
        return np.fromiter((zlib.crc32(p) for p in parts), np.uint32, len(parts))
    return np.fromiter((zlib.crc32(parts[w], zlib.crc32(b" ", int(c))) for c, w in zip(before, link)), np.uint32, len(link))


def ngram_buckets(column: pa.Array, longest: int = 1, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, row) of every run of 1 to ``longest`` words, and words a row."""
    flat, counts = words(column)
    encoded = flat.dictionary_encode()
    spelled = [v.as_buffer().to_pybytes() for v in encoded.dictionary.cast(pa.large_binary())]
    index = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(column)), counts)
    crc, code, at = _crc(spelled), index, np.arange(len(index))
    found = [(pa.array(crc % np.uint32(buckets)).take(pa.array(code)).to_numpy(), row)]
    for n in range(2, longest + 1):
        # runs that go on by one word inside their row; equal (run, word) pairs are one
        goes = at + n - 1 < len(index)
        goes[goes] &= row[at[goes]] == row[at[goes] + n - 1]
        at, code = at[goes], code[goes]
        pairs, code = np.unique(code * max(1, len(spelled)) + index[at + n - 1], return_inverse=True)
        crc = _crc(spelled, crc[pairs // max(1, len(spelled))], pairs % max(1, len(spelled)))
        found.append((pa.array(crc % np.uint32(buckets)).take(pa.array(code)).to_numpy(), row[at]))
    return np.concatenate([b for b, _ in found]), np.concatenate([r for _, r in found]), counts


def bucket_counts(df: DataFrame, text_col: str = "text", longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts by bucket; at most ``buckets`` rows."""

    ship_package(df.sparkSession)

    def count(batches):
        n = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in slices(batch):
                n += np.bincount(ngram_buckets(part.column("text"), longest, buckets)[0], minlength=buckets)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(held, pa.int32()), "n": pa.array(n[held])})

    texts = df.select(F.col(text_col).alias("text")).where("text IS NOT NULL")
    return texts.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text_col: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """A bucket's gain: 1000 times the log ratio of its smoothed shares, floored."""
    n = np.zeros((2, buckets), dtype=np.int64)
    for own, df in enumerate((docs, target)):
        for r in bucket_counts(df, text_col, longest, buckets).collect():  # one row a bucket
            n[own, r["bucket"]] = r["n"]
    total, goal = (int(x) for x in n.sum(axis=1))
    return np.array([
        math.floor(1000 * math.log((int(t) + 1) * (total + buckets) / ((int(s) + 1) * (goal + buckets))))
        for s, t in zip(n[0], n[1])], dtype=np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, longest: int = 1, id_col: str = "doc_id", text_col: str = "text",
          seed: int = 2024) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row."""

    def kernel(batch):
        bucket, row, counts = ngram_buckets(batch.column("text"), longest, len(gain))
        got = pa.array(gain).take(pa.array(bucket)).to_numpy()
        n = np.bincount(row, minlength=batch.num_rows).astype(np.int64)
        # whole numbers far below 2**53: exact in doubles
        sums = np.bincount(row, weights=got, minlength=batch.num_rows).astype(np.int64)
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n_words": pa.array(counts), "n_features": pa.array(n),
            "weight": pa.array(sums // np.maximum(n, 1))})

    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    out = map_text(rows, kernel, f"doc_id {id_type}, n_words long, n_features long, weight long")
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return out.withColumn("score", F.col("weight") + noise)


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = BUCKETS, percent: int = 10, least: int = 20,
             seed: int = 2024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank for every row of ``docs``.

    ``percent`` of the rows with at least ``least`` words are drawn without replacement,
    in proportion to their likeness to ``target``: those of the highest scores, ties to
    the smaller doc_id; ``rank`` counts them from 1 and is null for all others.

    Null and texts without a word have no features and weight 0.  A null doc_id is spelled
    as nothing in the hash and comes last in a tie.  Rows that repeat an id are rows of their
    own; those alike in every column share consecutive ranks.  Empty tables give no
    rows (docs) or equal target shares (target); extra columns are ignored.
    """
    gain = gains(docs, target, text_col, longest, buckets)
    scored = materialize(weigh(docs, gain, longest, id_col, text_col, seed), "importance_scores")
    fit = scored.where(F.col("n_words") >= least)
    draws = percent * fit.count() // 100
    out = ["doc_id", "n_features", "weight", "score"]
    null = F.lit(None).cast("long")
    if not draws:
        return scored.select(*out, null.alias("rank"))
    cut = _cut(fit, draws)
    above = F.coalesce((F.col("n_words") >= least) & (F.col("score") >= cut), F.lit(False))
    # rows that agree in doc_id and score are dealt over the ranges by a number of their own
    near = scored.where(above).withColumn("spread", F.xxhash64(F.monotonically_increasing_id()))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight"), F.col("spread")]
    ranked = dense_index(near, order, "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draws, F.col("rank")))
    return ranked.select(*out, "rank").unionByName(scored.where(~above).select(*out, null.alias("rank")))


def _cut(fit: DataFrame, draws: int) -> int:
    """The largest score that at least ``draws`` rows reach.  Halving an interval of whole
    numbers in 256 parts: each step counts by part, so the driver gets 256 rows."""
    ends = fit.agg(F.min("score").alias("low"), F.max("score").alias("high")).first()
    low, high, over = ends["low"], ends["high"], 0
    while low < high:
        step = (high - low) // 256 + 1
        parts = fit.where(F.col("score").between(low, high)).groupBy(
            F.floor((F.col("score") - low) / F.lit(step)).alias("part")).count().collect()
        for part, n in sorted(((r["part"], r["count"]) for r in parts), reverse=True):
            if over + n >= draws:
                break
            over += n
        low, high = low + part * step, min(high, low + (part + 1) * step - 1)
    return low


__all__ = ["bucket_counts", "gains", "ngram_buckets", "resample", "weigh", "words"]
