"""Substring deduplication by seed and extend.

Seeds are winnowed anchors: of every ``window`` consecutive words the
``seed``-word sequence with the smallest hash (rightmost on ties) is an
anchor, so equal windows choose the same anchor at the same place.  Documents
are joined on their anchors; an anchor that occurs once leads nowhere.  A
shared anchor is extended to the left and right over the *run* of windows
that chose it:

* if all occurrences of the anchor agree in the run's whole context, every
  window of the run repeats and nothing more has to be compared;
* else each window of the run, i.e. each extension of the anchor by i words to
  the left and j to the right with i + seed + j = window, is matched by a
  128-bit hash over all documents.

Repeated windows of a document that touch are merged to its maximal repeats
(each at least ``window`` words).  No group of occurrences is ever gathered
or paired: anchors and windows are counted with partial aggregation, so a
passage of a third of all documents costs as little as any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.common import LONGS_BYTES, attach, keyed, longs, map_text, materialize, member, small
from lapsewise.llm.words import U64, RangeHash, WordBatch, chosen_by_window, sequence_hashes

WINDOW_WORDS = 35
SEED_WORDS = 8


def _i64(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


class Runs:
    """Runs of windows of one batch: equal row, consecutive starts, one anchor."""

    def __init__(self, words: WordBatch, window: int, seed: int):
        self.words = words
        h = words.hashes
        row = words.rows_of_words()
        n = len(h) - window + 1
        if n <= 0:
            self.lo = self.hi = self.anchor = self.row = np.empty(0, dtype=np.int64)
            self.seeds = np.empty(0, dtype=U64)
            return
        seeds = sequence_hashes(h, seed)
        chosen = chosen_by_window(seeds, window - seed + 1)[:n]
        inside = np.flatnonzero(row[:n] == row[window - 1:])
        if not len(inside):
            self.lo = self.hi = self.anchor = self.row = np.empty(0, dtype=np.int64)
            self.seeds = np.empty(0, dtype=U64)
            return
        at = chosen[inside]
        new = np.r_[True, (at[1:] != at[:-1]) | (inside[1:] != inside[:-1] + 1)
                    | (row[inside[1:]] != row[inside[:-1]])]
        begin = np.flatnonzero(new)
        self.lo = inside[begin]
        self.hi = inside[np.r_[begin[1:], len(inside)] - 1]
        self.anchor = at[begin]
        self.row = row[self.lo]
        self.seeds = seeds[self.anchor]

    def contexts(self, window: int) -> np.ndarray:
        place = ((self.hi - self.lo) * 4096 + (self.anchor - self.lo)).astype(U64)
        return RangeHash(self.words.hashes, 1)(self.lo, self.hi + window, place)


def anchors(rows: DataFrame, window: int, seed: int, ids: bool = False) -> DataFrame:
    """(seed, ctx) of every run of windows; with the row's key if ``ids``."""

    def kernel(batch):
        runs = Runs(WordBatch(batch.column("text")), window, seed)
        if not len(runs.lo):
            return None
        cols = {"seed": _i64(runs.seeds), "ctx": _i64(runs.contexts(window))}
        if ids:
            at = pa.array(runs.row)
            cols |= {"doc_id": batch.column("doc_id").take(at), "h": batch.column("h").take(at)}
        return pa.RecordBatch.from_pydict(cols)

    return map_text(rows, kernel, "seed long, ctx long" + (", doc_id long, h long" if ids else ""))


def _extended(rows: DataFrame, window: int, seed: int, whole, mixed) -> DataFrame:
    """Spans (w1 null) that repeat as a whole, and windows (w1, w2) of the
    other shared anchors.  ``whole``/``mixed`` hold the shared anchors, or are
    None when each row carries those of its own in columns of these names."""

    def kernel(batch):
        words = WordBatch(batch.column("text"))
        runs = Runs(words, window, seed)
        if not len(runs.lo):
            return None
        known = []
        for name, held in (("whole", whole), ("mixed", mixed)):
            if held is None:  # being shared is a property of the anchor, whichever row tells
                lists = batch.column(name)
                held = np.unique(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(U64))
            else:
                held = held.value
            known.append(member(runs.seeds, held))
        first = words.first[runs.row]
        is_whole, is_mixed = known
        lo, hi, row = runs.lo[is_whole], runs.hi[is_whole], runs.row[is_whole]
        if len(lo):  # runs that touch become one span
            new = np.r_[True, (lo[1:] != hi[:-1] + 1) | (row[1:] != row[:-1])]
            begin = np.flatnonzero(new)
            hi = hi[np.r_[begin[1:], len(lo)] - 1]
            lo, row = lo[begin], row[begin]
        size = (runs.hi - runs.lo + 1)[is_mixed]
        run = np.repeat(np.flatnonzero(is_mixed), size)
        start = runs.lo[run] + np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size)
        h = words.hashes
        w1 = RangeHash(h, 0)(start, start + window)
        w2 = RangeHash(h, 1)(start, start + window)
        at = pa.array(np.r_[row, runs.row[run]])
        base = words.first[np.r_[row, runs.row[run]]]
        none = np.zeros(len(lo), dtype=bool)
        is_window = pa.array(np.r_[none, np.ones(len(start), dtype=bool)])
        pad = np.zeros(len(lo), dtype=U64)
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id").take(at), "h": batch.column("h").take(at),
            "lo": pa.array((np.r_[lo, start] - base).astype(np.int32)),
            "hi": pa.array((np.r_[hi, start] - base).astype(np.int32)),
            "is_window": is_window,
            "w1": _i64(np.r_[pad, w1]), "w2": _i64(np.r_[pad, w2]),
        }) if len(at) and len(first) else None

    return map_text(rows, kernel, "doc_id long, h long, lo int, hi int, is_window boolean, w1 long, w2 long")


def repeated_spans(docs: DataFrame, window: int = WINDOW_WORDS, seed: int = SEED_WORDS,
                   id_col: str = "doc_id", text_col: str = "text", limit: int | None = None) -> DataFrame:
    """Per row of ``docs`` with repeats: (doc_id, h, spans), its maximal repeats
    as start, end, start, end, ... in words, ascending and apart."""
    if not 0 < seed <= window:
        raise ValueError("the seed must not be longer than the window")
    rows = keyed(docs, id_col, text_col)
    shared = materialize(
        anchors(rows, window, seed).groupBy("seed")
        .agg(F.count(F.lit(1)).alias("n"), F.min("ctx").alias("a"), F.max("ctx").alias("b"))
        .where("n > 1").select("seed", (F.col("a") == F.col("b")).alias("whole")), "shared_anchors")
    if small(shared, LONGS_BYTES if limit is None else limit, row_bytes=8):
        sc = docs.sparkSession.sparkContext
        held = [sc.broadcast(longs(shared.where(F.col("whole") == w), "seed")) for w in (True, False)]
        found = _extended(rows, window, seed, *held)
    else:
        own = (anchors(rows, window, seed, ids=True).join(shared, "seed").groupBy("doc_id", "h")
               .agg(F.collect_set(F.when(F.col("whole"), F.col("seed"))).alias("whole"),
                    F.collect_set(F.when(~F.col("whole"), F.col("seed"))).alias("mixed")))
        joined = rows.alias("r").join(
            own.alias("o"), F.expr("r.doc_id <=> o.doc_id AND r.h = o.h")
        ).select("r.doc_id", "r.h", "r.text", "o.whole", "o.mixed")
        found = _extended(joined, window, seed, None, None)
    found = materialize(found, "extended_anchors")
    windows = found.where("is_window").select("w1", "w2", "doc_id", "h", "lo")
    # written first: a join of two shuffled tables, whose skewed partitions Spark splits
    twice = materialize(windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("w1", "w2"), "twice")
    spans = found.where("NOT is_window").select("doc_id", "h", "lo", "hi").unionByName(
        windows.join(twice, ["w1", "w2"], "left_semi").select("doc_id", "h", "lo", F.col("lo").alias("hi")))
    spans = spans.groupBy("doc_id", "h").agg(F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("spans"))

    def merged(batches):
        for batch in batches:
            out = []
            for own in batch.column("spans").to_pylist():
                flat: list[int] = []
                for s in own:
                    if flat and s["lo"] <= flat[-1]:
                        flat[-1] = max(flat[-1], s["hi"] + window)
                    else:
                        flat += [s["lo"], s["hi"] + window]
                out.append(flat)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("h"), pa.array(out, pa.list_(pa.int32()))], names=["doc_id", "h", "spans"])

    return spans.mapInArrow(merged, "doc_id long, h long, spans array<int>")


def remove_repeats(docs: DataFrame, window: int = WINDOW_WORDS, seed: int = SEED_WORDS,
                   id_col: str = "doc_id", text_col: str = "text", limit: int | None = None) -> DataFrame:
    """Every row of ``docs`` without the words that a repeated window covers.

    Returns doc_id, n_words, n_removed, kept_text (kept words joined by one
    space) and repeats, the document's maximal repeats as (start, length) in
    words.  A window counts as repeated if its words also start anywhere else, in
    the same document too; all its occurrences go.  Null text: no words, empty
    kept_text.  Null or repeated ids: every row is a document of its own, so
    a repeated row repeats its windows.  Empty table: no rows.  Other columns of
    ``docs`` are not read.
    """
    spans = materialize(repeated_spans(docs, window, seed, id_col, text_col, limit), "repeats")
    rows = attach(keyed(docs, id_col, text_col), spans, ["doc_id", "h"], limit=limit)

    def kernel(batch):
        texts, found = batch.column("text"), batch.column("spans")
        n_words, n_removed, kept, repeats = [], [], [], []
        for text, own in zip(texts, found):
            words = text.as_buffer().to_pybytes().split() if text.is_valid else []
            flat = own.as_py() or []
            gone = list(zip(flat[::2], flat[1::2]))
            n_words.append(len(words))
            n_removed.append(sum(b - a for a, b in gone))
            for a, b in reversed(gone):
                del words[a:b]
            kept.append(b" ".join(words).decode("utf-8"))
            repeats.append([{"start": a, "length": b - a} for a, b in gone])
        return pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
            pa.array(kept, pa.string()),
            pa.array(repeats, pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32())])))],
            names=["doc_id", "n_words", "n_removed", "kept_text", "repeats"])

    return map_text(rows, kernel, "doc_id long, n_words long, n_removed long, kept_text string, "
                                  "repeats array<struct<start:int,length:int>>")


