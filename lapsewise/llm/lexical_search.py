"""Ranked lexical search by posting lists in blocks of similar documents.

Documents become sparse vectors over the terms that the queries use (one pass over
the texts, written once), from which Spark counts documents, lengths and document
frequencies over the whole corpus.  Tasks then hold the vectors by shards of bounded
size.  A shard keeps a posting list per term; a list is cut into blocks of documents
that lie near the same pivot (cosine of their vectors), and a block's summary is the
coordinatewise maximum of its documents' impacts, over the coordinates that the
list's queries have.  As all impacts are whole numbers that are at least 0, a query's
sum over a summary bounds the score of every document in the block exactly.

A list is skipped when it and all weaker lists of the query cannot reach the threshold
together, a block when its bound is under it.  The first pass scores the best block of each
query's strongest list in every shard; the k-th score found is the threshold of the second
pass, which opens every block that may hold a result.  Each task hands on k rows a query, so no
link between queries and documents is ever shuffled.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapsewise.llm.common import map_text, materialize
from lapsewise.llm.importance import words
from lapsewise.session import ship_package

#: Text of the queries that are searched together; more queries take more rounds.
QUERY_BYTES = 4 << 20
#: Bytes of a shard's impacts in a task (rows x terms of the queries).
SHARD_BYTES = 48 << 20
#: Documents of a block, about.
BLOCK = 64
_LAST = np.iinfo(np.int64).max


class Queries:
    """Terms of a bounded set of queries as columns: query i has ``cols[i]`` with ``times[i]``."""

    def __init__(self, texts: list[str]):
        flat, counts = words(pa.array(texts, pa.large_string()))
        spelled, ends = flat.to_pylist(), np.cumsum(counts)
        held = [Counter(spelled[e - n: e]) for e, n in zip(ends, counts)]
        self.terms = sorted(set(spelled))
        place = {t: i for i, t in enumerate(self.terms)}
        self.cols = [np.array(sorted(place[t] for t in h), dtype=np.int64) for h in held]
        self.times = [np.array([h[self.terms[c]] for c in own], dtype=np.int64) for h, own in zip(held, self.cols)]

    def __len__(self) -> int:
        return len(self.cols)


def vectors(docs: DataFrame, terms: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, terms, tfs): all terms of a text counted in n, those of ``terms`` listed."""
    width = max(1, len(terms))
    known = pa.array(terms, pa.large_string())

    def kernel(batch):
        flat, counts = words(batch.column("text"))
        at = pc.index_in(flat, value_set=known)
        row = np.repeat(np.arange(batch.num_rows), counts)
        held = at.is_valid().to_numpy(zero_copy_only=False)
        pair, tf = np.unique(row[held] * width + at.drop_null().to_numpy(), return_counts=True)
        ends = np.searchsorted(pair, np.arange(batch.num_rows + 1) * width).astype(np.int32)
        lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (pair % width, tf)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(counts), *lists], names=["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return map_text(rows, kernel, "doc_id long, n long, terms array<int>, tfs array<int>")


class Shard:
    """Impacts of some documents, with posting lists in blocks."""

    def __init__(self, table: pa.Table, weights: np.ndarray, n_docs: int, n_terms: int):
        table = table.combine_chunks()
        ids = table.column("doc_id")
        self.null = ids.is_null().to_numpy()
        self.ids = ids.fill_null(_LAST).to_numpy()
        lists = [table.column(c).combine_chunks() for c in ("terms", "tfs")]
        row = pc.list_parent_indices(lists[0]).to_numpy()
        term, tf = (pc.list_flatten(x).to_numpy().astype(np.int64) for x in lists)
        m = 25 + (75 * table.column("n").to_numpy() * n_docs) // n_terms
        self.x = np.zeros((len(self.ids), len(weights)), dtype=np.int64)
        self.x[row, term] = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
        self.most = self.x.max(axis=0)
        by_term = np.argsort(term, kind="stable")
        self.rows = row[by_term]
        self.first = np.searchsorted(term[by_term], np.arange(len(weights) + 1))
        self._unit = None

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """The list's rows dealt to their nearest pivot, and where each block begins."""
        rows = self.rows[self.first[term]: self.first[term + 1]]
        count = -(-len(rows) // BLOCK)
        if count <= 1:
            return rows, np.zeros(min(1, len(rows)), dtype=np.int64)
        if self._unit is None:
            self._unit = self.x.astype(np.float32)
            self._unit /= np.maximum(np.sqrt(np.einsum("ij,ij->i", self._unit, self._unit)), 1)[:, None]
        pivots = rows[np.arange(count) * len(rows) // count]
        home = np.argmax(self._unit[rows] @ self._unit[pivots].T, axis=1)
        order = np.argsort(home, kind="stable")
        return rows[order], np.flatnonzero(np.r_[True, np.diff(home[order]) > 0])

    def strong_lists(self, cols: np.ndarray, times: np.ndarray, least: int) -> np.ndarray:
        """Terms whose lists must be read: all others together stay under ``least``."""
        top = self.most[cols] * times
        order = np.argsort(top, kind="stable")
        return cols[order][np.cumsum(top[order]) >= least]

    def candidates(self, asked: Queries, least: np.ndarray, seeds: bool) -> dict[int, np.ndarray]:
        """Rows of the blocks that may hold a result, by query.  ``seeds``: only the best
        block of the strongest list."""
        by_term: dict[int, list[int]] = {}
        for q, (cols, times) in enumerate(zip(asked.cols, asked.times)):
            if not len(cols) or int((self.most[cols] * times).sum()) < least[q]:
                continue
            strong = self.strong_lists(cols, times, least[q])
            for t in strong[-1:] if seeds else strong:
                by_term.setdefault(int(t), []).append(q)
        found: dict[int, list[np.ndarray]] = {}
        for t, own in by_term.items():
            rows, begin = self.blocks(t)
            if not len(rows):
                continue
            cols = np.unique(np.concatenate([asked.cols[q] for q in own]))
            factor = np.zeros((len(cols), len(own)), dtype=np.int64)
            for j, q in enumerate(own):
                factor[np.searchsorted(cols, asked.cols[q]), j] = asked.times[q]
            summary = np.maximum.reduceat(self.x[np.ix_(rows, cols)], begin, axis=0)
            bound = summary @ factor
            ends = np.r_[begin[1:], len(rows)]
            for j, q in enumerate(own):
                opened = [int(np.argmax(bound[:, j]))] if seeds else np.flatnonzero(bound[:, j] >= least[q])
                found.setdefault(q, []).extend(rows[begin[b]: ends[b]] for b in opened)
        return {q: np.unique(np.concatenate(r)) for q, r in found.items() if r}


class Best:
    """The k highest (score, smallest id) rows of every query that a task has seen."""

    def __init__(self, asked: Queries, k: int, least: np.ndarray):
        self.asked, self.k, self.least = asked, k, least.copy()
        self.held = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)) for _ in range(len(asked))]

    def add(self, shard: Shard, seeds: bool) -> None:
        for q, rows in shard.candidates(self.asked, self.least, seeds).items():
            score = shard.x[np.ix_(rows, self.asked.cols[q])] @ self.asked.times[q]
            good = score >= self.least[q]
            score, ids, null = (np.concatenate([a, b]) for a, b in zip(
                self.held[q], (score[good], shard.ids[rows[good]], shard.null[rows[good]])))
            pick = np.lexsort((null, ids, -score))[: self.k]
            self.held[q] = score[pick], ids[pick], null[pick]
            if len(pick) == self.k:
                self.least[q] = max(self.least[q], int(score[pick[-1]]))

    def rows(self) -> pa.RecordBatch:
        n = [len(s) for s, _, _ in self.held]
        score, ids, null = (np.concatenate([h[i] for h in self.held]) for i in range(3))
        return pa.RecordBatch.from_pydict({
            "q": pa.array(np.repeat(np.arange(len(n), dtype=np.int32), n)), "doc_id": pa.array(ids, mask=null), "score": pa.array(score)})


def _scan(table: DataFrame, asked: Queries, weights: np.ndarray, n_docs: int, n_terms: int, k: int, least: np.ndarray,
          seeds: bool, shard_rows: int) -> DataFrame:
    ship_package(table.sparkSession)

    def run(batches):
        best, waiting, n = Best(asked, k, least), [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, shard_rows - n)
                batch = batch.slice(part.num_rows)
                waiting.append(part)
                n += part.num_rows
                if n == shard_rows:
                    best.add(Shard(pa.Table.from_batches(waiting), weights, n_docs, n_terms), seeds)
                    waiting, n = [], 0
        if n:
            best.add(Shard(pa.Table.from_batches(waiting), weights, n_docs, n_terms), seeds)
        if len(asked):
            yield best.rows()

    return table.where(F.size("terms") > 0).mapInArrow(run, "q int, doc_id long, score long")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _round(docs: DataFrame, texts: list[str], k: int, shard_rows: int | None, id_col: str, text_col: str) -> DataFrame | None:
    """(q, rank, doc_id, score) of the queries ``texts``, numbered from 0."""
    asked = Queries(texts)
    table = materialize(vectors(docs, asked.terms, id_col, text_col), "lexical_vectors")
    totals = table.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = int(totals["docs"]), int(totals["terms"] or 0)
    if not n_docs or not asked.terms:
        return None
    df = np.zeros(len(asked.terms), dtype=np.int64)
    # one row a term of this round's queries
    for r in table.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[r["term"]] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)
    rows = shard_rows or max(64, SHARD_BYTES // (8 * len(asked.terms)))
    least = np.ones(len(asked), dtype=np.int64)
    seeds = _top(_scan(table, asked, weights, n_docs, n_terms, k, least, True, rows), k)
    for r in seeds.where(F.col("rank") == k).collect():  # one row a query
        least[r["q"]] = max(1, r["score"])
    return _top(_scan(table, asked, weights, n_docs, n_terms, k, least, False, rows), k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, shard_rows: int | None = None, query_bytes: int = QUERY_BYTES,
           id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: each item's k rows of ``docs`` with the highest
    score above 0, ties to the smaller doc_id.

    Every row of ``docs`` is ranked on its own, repeated ids included; a null doc_id comes
    last in a tie.  Null and term-less texts match nothing, and count for no statistic.
    Items that repeat both item_id and text are one; items that share an id but not
    the text are ranked each on its own.  Empty tables give no rows; extra columns are ignored.
    """
    spark = docs.sparkSession
    asked = materialize(items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
                        .where(F.length("text") > 0).distinct(), "lexical_items")
    rounds = max(1, -(-asked.counted_bytes // query_bytes))
    id_type = asked.schema["item_id"].dataType.simpleString()
    out = None
    for number in range(rounds):
        own = asked.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == number).collect()  # bounded by query_bytes
        found = _round(docs, [r["text"] for r in own], k, shard_rows, id_col, text_col) if own else None
        if found is None:
            continue
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(own)], f"q int, item_id {id_type}")
        part = found.join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
    return out


__all__ = ["Queries", "Shard", "search", "vectors"]
