"""Quality classifier with hierarchical empirical Bayes.

A document's own evidence comes from two logistic models (quality, toxicity)
over hashed words and word beginnings (root of their rate) and a few style rates, fitted by
follow-the-regularised-leader on a bounded sample of labelled documents.  All
documents are scored; their probabilities are summed per host and per path by
grouped aggregation.  Host rates shrink toward the global rate and path rates
toward their host's, by prior weights estimated from the spread of the rates
(method of moments): a sparse site keeps close to its parent.  The posterior
log odds of a document are its own plus what its path adds to the global prior.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.session import ship_package
from lapsewise.llm.common import attach, map_text, materialize, small
from lapsewise.llm.language_id import _softmax, _weights, ftrl_pass
from lapsewise.llm.words import U64, RangeHash, WordBatch, mix

#: Labelled documents that the models are fitted on, about.
TRAIN_DOCS = 8000
BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
BEGINNINGS = (4, 6, 8)  # bytes of a word's beginning
STYLE = 6
SCALE = 5.0
EPOCHS = 4
FTRL = {"alpha": 0.5, "l1": 0.3, "l2": 0.05}
TARGETS = ("quality", "toxic")
#: Documents of this toxicity or more do not stay.
TOXIC_MOST = 0.2
_UPPER = np.zeros(256, dtype=bool)
_UPPER[0x41:0x5B] = True
_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#$%&*|<>{}[]=+^~\\@_!", dtype=np.uint8))
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True


class Features:
    """Buckets of every word of a batch and the style rates of every row."""

    def __init__(self, column):
        words = WordBatch(column, lower=True)
        raw = WordBatch(column, hashed=False)
        self.words = words
        size = words.ends - words.starts
        spelled = RangeHash(words.data.astype(U64), 0)
        self.buckets = [(mix(words.hashes, 51) >> U64(64 - BUCKET_BITS)).astype(np.int64)]
        for n in BEGINNINGS:
            begun = spelled(words.starts, words.starts + np.minimum(size, n))
            self.buckets.append(np.where(size >= n, (mix(begun, 51 + n) >> U64(64 - BUCKET_BITS)).astype(np.int64), -1))
        counts = words.counts()
        self.counts = counts
        n_bytes = np.maximum(np.diff(words.offsets), 1)
        row = words.rows_of_words()
        again = np.zeros(len(row), dtype=bool)
        again[1:] = (words.hashes[1:] == words.hashes[:-1]) & (row[1:] == row[:-1])
        marked = _SYMBOL[raw.data[raw.ends - 1]] if len(row) else again
        shouted = np.zeros(len(row), dtype=bool)
        if len(row):
            upper = np.r_[0, np.cumsum(_UPPER[raw.data])]
            shouted = (upper[raw.ends] - upper[raw.starts]) >= np.maximum(2, size // 2)

        def per_word(flag):
            total = np.r_[0, np.cumsum(flag)]
            return (total[words.first[1:]] - total[words.first[:-1]]) / np.maximum(counts, 1)

        def per_byte(flag):
            total = np.r_[0, np.cumsum(flag)]
            return (total[words.offsets[1:]] - total[words.offsets[:-1]]) / n_bytes

        self.style = np.stack([
            per_word(again), per_word(marked), per_word(shouted), per_byte(_SYMBOL[raw.data]), per_byte(_DIGIT[raw.data]),
            np.minimum(np.log1p(counts) / 10, 1)], axis=1) * 3.0


def _strength(times: np.ndarray, words) -> np.ndarray:
    return np.minimum(1.0, SCALE * np.sqrt(times / np.maximum(1, words)))


def _fit(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """(BUCKETS + STYLE + 1, targets) weights of the log odds; zeros without labels."""
    labels = labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)")
    every = max(1, labels.count() // TRAIN_DOCS)
    chosen = materialize(labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
                         .groupBy("doc_id").agg(*[F.max(t).cast("int").alias(t) for t in TARGETS]), "labelled_sample")
    rows = docs.join(F.broadcast(chosen) if small(chosen) else chosen, "doc_id").select("text", *TARGETS, F.xxhash64("doc_id").alias("draw"))

    def kernel(batch):
        f = Features(batch.column("text"))
        index, value = [], []
        for i in range(len(f.words)):
            a, b = f.words.first[i], f.words.first[i + 1]
            own = np.concatenate([x[a:b] for x in f.buckets])
            own, times = np.unique(own[own >= 0], return_counts=True)
            index.append(np.r_[own, BUCKETS + np.arange(STYLE)].astype(np.int32))
            value.append(np.r_[_strength(times, b - a), f.style[i]].astype(np.float32))
        return pa.RecordBatch.from_pydict({
            **{t: batch.column(t) for t in TARGETS}, "draw": batch.column("draw"),
            "index": pa.array(index, pa.list_(pa.int32())), "value": pa.array(value, pa.list_(pa.float32()))})

    examples = materialize(map_text(rows, kernel, "quality int, toxic int, draw long, index array<int>, value array<float>"), "labelled")
    # one shard a target and quarter of the sample; the quarters' states are averaged
    shards = examples.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("target"), F.pmod("draw", F.lit(4)).cast("int").alias("shard"))

    def train(key, batches):
        z, n = np.zeros((BUCKETS + STYLE + 1, 2)), np.zeros((BUCKETS + STYLE + 1, 2))
        seen = 0
        table = pa.Table.from_batches(list(batches)) if not isinstance(batches, pa.Table) else batches
        table = table.sort_by("draw")
        target = key[0].as_py()
        label = table.column(TARGETS[target]).to_pylist()
        index = [np.asarray(x) for x in table.column("index").to_pylist()]
        value = [np.asarray(x, dtype=np.float64) for x in table.column("value").to_pylist()]
        bias = BUCKETS + STYLE
        for _ in range(EPOCHS):
            ftrl_pass(z, n, ((np.r_[i, bias], np.r_[v, 1.0], y) for i, v, y in zip(index, value, label) if y is not None), **FTRL)
        seen = sum(y is not None for y in label)
        w = _weights(z, n, **FTRL)
        w = w[:, 1] - w[:, 0]
        at = np.flatnonzero(w)
        return pa.table({"target": pa.array(np.full(len(at), target, dtype=np.int32)), "at": pa.array(at),
                         "w": pa.array(w[at] * seen), "seen": pa.array(np.full(len(at), seen, dtype=np.int64)),
                         "shard": pa.array(np.full(len(at), key[1].as_py(), dtype=np.int32))})

    ship_package(shards.sparkSession)
    got = shards.groupBy("target", "shard").applyInArrow(train, "target int, at long, w double, seen long, shard int").toArrow()
    out = np.zeros((BUCKETS + STYLE + 1, len(TARGETS)))
    target, at, w, seen, shard = (got.column(c).to_numpy() for c in ("target", "at", "w", "seen", "shard"))
    np.add.at(out, (at, target), w)
    for t in range(len(TARGETS)):
        total = sum({int(s): int(n) for s, n in zip(shard[target == t], seen[target == t])}.values())
        out[:, t] /= max(1, total)
    return out


def _evidence(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, h, host, path, quality, toxic): log odds by the text alone."""
    held = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float64))

    def kernel(batch):
        w = held.value
        useful = w[:BUCKETS].any(axis=1)
        f = Features(batch.column("text"))
        # few buckets have a weight: only their words are counted
        row = f.words.rows_of_words()
        found = []
        for b in f.buckets:
            hit = (b >= 0) & useful[b]
            found.append(row[hit] * BUCKETS + b[hit])
        cell, times = np.unique(np.concatenate(found), return_counts=True)
        at, bucket = cell // BUCKETS, cell % BUCKETS
        strength = _strength(times, f.counts[at])
        total = np.stack([np.bincount(at, strength * w[bucket, t], minlength=len(f.words)) for t in range(w.shape[1])], axis=1)
        logit = total + f.style @ w[BUCKETS:-1] + w[-1]
        return pa.RecordBatch.from_pydict({
            **{c: batch.column(c) for c in ("doc_id", "h", "host", "path")},
            **{t: pa.array(logit[:, i]) for i, t in enumerate(TARGETS)}})

    return map_text(docs, kernel, "doc_id long, h long, host string, path string, quality double, toxic double")


def _probability(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def _log_odds(p: Column) -> Column:
    return F.log(p) - F.log(F.lit(1.0) - p)


def _prior_weight(spread: float, noise: float, rate: float) -> float:
    """Documents that a parent's rate counts for: large if the sites hardly differ."""
    between = max(spread - noise, 1e-9)
    return float(min(max(rate * (1 - rate) / between - 1.0, 1.0), 1e7))


def site_posteriors(scored: DataFrame) -> DataFrame:
    """(host, path, <target>_shift): what the path's posterior adds to the log odds."""
    sums = [F.sum(_probability(F.col(t))).alias(f"{t}_s") for t in TARGETS]
    paths = materialize(scored.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), *sums), "path_sums")
    hosts = materialize(paths.groupBy("host").agg(F.sum("n").alias("n"), *[F.sum(f"{t}_s").alias(f"{t}_s") for t in TARGETS]), "host_sums")
    few = small(hosts)
    whole = hosts.agg(F.sum("n").alias("n"), *[F.sum(f"{t}_s").alias(f"{t}_s") for t in TARGETS]).first()
    total = whole["n"] or 0
    for t in TARGETS:
        rate = min(max((whole[f"{t}_s"] or 0.0) / total if total else 0.5, 1e-6), 1 - 1e-6)
        own = F.col(f"{t}_s") / F.col("n")

        def weight(table: DataFrame, parent: Column) -> float:
            m = table.agg(F.sum(F.col("n") * (own - parent) ** 2).alias("spread"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("sites")).first()
            n = m["n"] or 1
            return _prior_weight((m["spread"] or 0.0) / n, rate * (1 - rate) * m["sites"] / n, rate)

        k = weight(hosts, F.lit(rate))
        hosts = hosts.withColumn(f"{t}_rate", (F.col(f"{t}_s") + F.lit(k * rate)) / (F.col("n") + F.lit(k)))
        parents = hosts.select(F.col("host").alias("_host"), F.col(f"{t}_rate").alias("_rate"))
        parents = F.broadcast(parents) if few else parents
        paths = paths.join(parents, F.col("host").eqNullSafe(F.col("_host")))
        k = weight(paths, F.col("_rate"))
        rate_of_path = (F.col(f"{t}_s") + F.lit(k) * F.col("_rate")) / (F.col("n") + F.lit(k))
        paths = paths.withColumn(f"{t}_shift", _log_odds(rate_of_path) - F.lit(float(np.log(rate / (1 - rate))))).drop("_host", "_rate")
    return paths.select("host", "path", *[f"{t}_shift" for t in TARGETS])


def classify(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id",
             text_col: str = "text", toxic_most: float = TOXIC_MOST, limit: int | None = None) -> DataFrame:
    """Quality and toxicity of every row of ``docs``; ``keep`` asks for a quality of
    one half or more and a toxicity below ``toxic_most`` (toxic labels are rare, so
    the border is under one half).

    ``labels`` has doc_id, quality and toxic (0, 1 or null).  Returns doc_id, quality
    and toxic (posterior probabilities), text_quality and text_toxic (by the text
    alone) and keep.  Null and empty texts have no
    words and are judged by style and site; null hosts and paths are sites of their
    own; null and repeated ids are kept, each row judged for itself; without labels
    all probabilities are one half; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("h"), host.cast("string").alias("host"),
                       path.cast("string").alias("path"), F.col(text_col).alias("text"))
    weights = _fit(rows, labels.select("doc_id", *TARGETS))
    scored = materialize(_evidence(rows, weights), "evidence")
    sites = materialize(site_posteriors(scored), "sites")
    joined = attach(scored, sites, ["host", "path"], "left", limit)
    posterior = {t: _probability(F.col(t) + F.coalesce(F.col(f"{t}_shift"), F.lit(0.0))) for t in TARGETS}
    return joined.select(
        "doc_id", *[posterior[t].alias(t) for t in TARGETS], *[_probability(F.col(t)).alias(f"text_{t}") for t in TARGETS],
        ((posterior["quality"] >= 0.5) & (posterior["toxic"] < toxic_most)).alias("keep"))
