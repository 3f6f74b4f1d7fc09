"""Deduplication by a sparse suffix array.

Suffixes are retained at minimiser positions only: of every ``passage`` consecutive
words the ``seed``-word sequence with the smallest hash is selected by content, so
equal passages select the same place.  A minimiser that occurs once cannot lie in a
repeated passage and is dropped.

A retained suffix is written as the hashes of its words, one after the other, as far as
the passages that selected it reach; the words before it that they reach go along.  Where all
occurrences of a minimiser agree in that whole stretch (one hash tells), two hashes stand for it.
The array is sorted by these words over range partitions, then by document and
position, so a passage that a third of all documents share spreads over as many
partitions as it needs.

In the sorted array the common prefix of neighbours is measured in words.  A passage that
begins ``i`` words before a suffix repeats if another suffix shares the
``passage - i`` words after it and the ``i`` words before it: the first are
neighbours with a common prefix of that length, and to the left they are extended word by word
(a hash of one word more each time), all suffixes of a stretch at once.  No group is paired.
Passages that repeat leave a task as spans, mostly one a suffix; only stretches of neighbours that
reach over the end of a partition, or are longer than a chunk of ``CHUNK`` suffixes, leave the first
place of each of their passages undecided, and a grouped comparison of these first places settles them.

Spans that touch merge into the maximal repeats of a document.
The first occurrence of a passage stays, later ones go.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapsewise.llm.common import (
    LONGS_BYTES, attach, keyed, longs, materialize, member, released, slices, small,
)
from lapsewise.llm.substring_dedup import Runs, _i64, anchors
from lapsewise.llm.words import U64, WordBatch, mix
from lapsewise.session import ship_package

PASSAGE_WORDS = 50
SEED_WORDS = 10
#: Suffixes that are compared at once in a task.
CHUNK = 8192
_STEP = U64(0xD6E8FEB86659FD93)


def _word_lists(hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """hashes[begin:end] of every pair as bytes, most significant first: bytes sort as the words do."""
    size = end - begin
    stop = np.cumsum(size)
    at = np.repeat(begin - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)
    offsets = np.r_[0, stop * 8].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [
        None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(hashes[at].astype(">u8").tobytes())])


def _suffixes(rows: DataFrame, passage: int, seed: int, whole, mixed) -> DataFrame:
    """(after, before, whole, doc_id, h, at, lo, hi): the retained suffixes.  ``after`` and ``before``
    are the words from ``at`` on and before it; lo..hi are the starts of the passages that selected it."""

    def suffixes(batch):
        words = WordBatch(batch.column("text"))
        runs = Runs(words, passage, seed)
        if not len(runs.lo):
            return
        contexts = runs.contexts(passage)
        for name, held in (("whole", whole), ("mixed", mixed)):
            if held is None:
                lists = batch.column(name)
                held = np.unique(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(U64))
            else:
                held = held.value
            known = np.flatnonzero(member(runs.seeds, held))
            for some in np.array_split(known, 1 + len(known) // CHUNK) if len(known) else ():
                if name == "whole":
                    two = 2 * np.arange(len(some))
                    after = _word_lists(np.c_[runs.seeds[some], contexts[some]].ravel(), two, two + 2)
                    before = _word_lists(words.hashes, two, two)
                else:
                    after = _word_lists(words.hashes, runs.anchor[some], runs.hi[some] + passage)
                    before = _word_lists(words.hashes, runs.lo[some], runs.anchor[some])
                row = runs.row[some]
                base, of = words.first[row], pa.array(row)
                yield pa.RecordBatch.from_pydict({
                    "after": after, "before": before, "whole": pa.array(np.full(len(some), name == "whole")),
                    "doc_id": batch.column("doc_id").take(of), "h": batch.column("h").take(of),
                    **{c: pa.array((place[some] - base).astype(np.int32))
                       for c, place in (("at", runs.anchor), ("lo", runs.lo), ("hi", runs.hi))}})

    ship_package(rows.sparkSession)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                yield from suffixes(part)

    return rows.mapInArrow(released(run), "after binary, before binary, whole boolean, doc_id long, h long, at int, lo int, hi int")


def _matrix(lists: pa.Array, width: int, backwards: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Word lists as rows of ``width`` words (zeros behind the last one) and their lengths."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    offsets = np.frombuffer(lists.buffers()[1], dtype=np.int32)[lists.offset: lists.offset + len(lists) + 1] // 8
    size = np.diff(offsets)
    raw = lists.buffers()[2]
    flat = (np.frombuffer(raw, dtype=np.uint8)[offsets[0] * 8: offsets[-1] * 8].view(U64)
            if raw is not None and offsets[-1] > offsets[0] else np.empty(0, dtype=U64))
    out = np.zeros((len(size), width), dtype=U64)
    row = np.repeat(np.arange(len(size)), size)
    column = np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], size)
    out[row, size[row] - 1 - column if backwards else column] = flat
    return out, size


class _Chunk:
    """Neighbouring suffixes of the sorted array."""

    def __init__(self, table: pa.Table, passage: int, seed: int):
        self.table, self.passage, self.seed = table, passage, seed
        self.whole = table.column("whole").to_numpy()
        self.words, size = _matrix(table.column("after"), max(passage, 2))
        differ = self.words[1:] != self.words[:-1]
        shorter = np.minimum(size[1:], size[:-1])
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), self.words.shape[1])
        #: words that a suffix has in common with the next one
        self.common = np.where(self.whole[1:] == self.whole[:-1], np.minimum(common, shorter), 0)
        #: whether the two may share a passage
        self.linked = self.common >= np.where(self.whole[1:], 2, seed)

    def head(self, n: int) -> _Chunk:
        self.table, self.whole, self.words = self.table.slice(0, n), self.whole[:n], self.words[:n]
        self.common, self.linked = self.common[:n - 1], self.linked[:n - 1]
        return self

    def settle(self, open_start: bool, open_end: bool):
        """Spans of repeated passages, and the passages that other suffixes decide."""
        table, passage = self.table, self.passage
        n = table.num_rows
        at, lo, hi, h = (table.column(c).to_numpy() for c in ("at", "lo", "hi", "h"))
        null = table.column("doc_id").is_null().to_numpy()
        ids = table.column("doc_id").fill_null(0).to_numpy()
        # rows that repeat id and text are one document: their suffixes have one rank
        order = np.lexsort((at, h, ids, null))
        new = np.r_[False, np.any([c[order][1:] != c[order][:-1] for c in (at, h, ids, null)], axis=0)]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(new)

        def reach(linked):
            """Stretches of linked suffixes, and whether they reach beyond the chunk."""
            stretch = np.cumsum(np.r_[0, ~linked])
            return stretch, (open_start & (stretch == 0)) | (open_end & (stretch == stretch[-1]))

        def judged(of, key, outside):
            """0 for a key met in one place, 1 for the first of several, 2 for later ones; and
            the first of each key that other chunks may have too."""
            by = np.argsort(key, kind="stable")
            begin = np.flatnonzero(np.r_[True, key[by][1:] != key[by][:-1]])
            group = np.repeat(np.arange(len(begin)), np.diff(np.r_[begin, len(by)]))
            own = rank[of][by]
            first = np.minimum.reduceat(own, begin)
            several = np.maximum.reduceat(own, begin) != first
            out = np.zeros(len(by), dtype=np.int8)
            out[by] = several[group] * (1 + (own > first[group]))
            undecided = np.flatnonzero(outside[of] & (out < 2))
            return out, undecided[np.unique(key[undecided], return_index=True)[1]]

        spans, border = [], []

        def decide(of, key, outside, lo, hi, k1, k2, i):
            """Codes of the passages ``of`` (0 where undecided); those that stay undecided go to ``border``."""
            code, first = judged(of, key, outside)
            if len(first):
                at = of[first]
                border.append((at, lo[at], hi[at], k1[at], k2[at], np.full(len(at), i), code[first] == 1))
            code[outside[of] & (code < 2)] = 0
            return code

        stretch, outside = reach(self.linked)
        mine = np.flatnonzero(self.whole)
        if len(mine):
            code = decide(mine, stretch[mine], outside, lo, hi, self.words[:, 0], self.words[:, 1], -1)
            for value in (1, 2):
                of = mine[code == value]
                spans.append((of, lo[of], hi[of], np.full(len(of), value == 2)))
        if not self.whole.all():
            before, _ = _matrix(table.column("before"), max(passage, 1), backwards=True)
            near = np.maximum(np.r_[0, self.common], np.r_[self.common, 0])
            after = np.zeros((passage + 1, n), dtype=U64)
            if (~self.whole & outside).any():
                for j in range(passage):
                    after[j + 1] = mix(after[j] * _STEP + self.words[:, j])
            left = np.zeros(n, dtype=U64)
            code = np.zeros((n, passage - self.seed + 3), dtype=np.int8)
            for i in range(passage - self.seed + 1):
                if i:
                    left = mix(left * _STEP + before[:, i - 1])
                stretch, outside = reach(self.common >= passage - i)
                mine = np.flatnonzero(~self.whole & (at - hi <= i) & (i <= at - lo) & (outside | (near >= passage - i)))
                if len(mine):
                    key = mix(stretch[mine].astype(U64)) ^ left[mine]
                    code[mine, i + 1] = decide(mine, key, outside, at - i, at - i, after[passage - i], left, i)
            for value in (1, 2):
                step = np.diff((code == value).astype(np.int8), axis=1)
                row, begin = np.nonzero(step == 1)
                end = np.nonzero(step == -1)[1]
                # i counts to the left: the largest one is the first start
                spans.append((row, at[row] - end + 1, at[row] - begin, np.full(len(row), value == 2)))

        def columns(of, lo, hi):
            of = pa.array(of)
            return {"doc_id": table.column("doc_id").take(of).combine_chunks(), "h": table.column("h").take(of).combine_chunks(),
                    "lo": pa.array(lo.astype(np.int32)), "hi": pa.array(hi.astype(np.int32))}

        for of, a, b, later in spans:
            if len(of):
                none = pa.nulls(len(of), pa.int64())
                yield pa.RecordBatch.from_pydict({
                    **columns(of, a, b), "later": pa.array(later), "k1": none, "k2": none,
                    "i": pa.nulls(len(of), pa.int32()), "several": pa.nulls(len(of), pa.bool_())})
        for of, a, b, k1, k2, i, several in border:
            yield pa.RecordBatch.from_pydict({
                **columns(of, a, b), "later": pa.nulls(len(of), pa.bool_()), "k1": _i64(k1), "k2": _i64(k2),
                "i": pa.array(i.astype(np.int32)), "several": pa.array(several)})


def _compare_neighbours(suffixes: DataFrame, passage: int, seed: int, chunk_rows: int) -> DataFrame:
    """(doc_id, h, lo, hi, later): starts of passages that repeat; ``later`` unless they
    are the first of their equals."""
    order = ["after", F.asc_nulls_last("doc_id"), "h", "at"]
    array = suffixes.repartitionByRange(*order).sortWithinPartitions(*order)
    ship_package(suffixes.sparkSession)

    def run(batches):
        held, rows, open_start = [], 0, True
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < chunk_rows:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            chunk = _Chunk(table, passage, seed)
            apart = np.flatnonzero(~chunk.linked)
            # suffixes after the last gap wait for the next ones; without a gap all are one stretch
            cut = int(apart[-1]) + 1 if len(apart) else rows
            yield from chunk.head(cut).settle(open_start, not len(apart))
            open_start = not len(apart)
            rest = table.slice(cut)
            held, rows = rest.to_batches(), rest.num_rows
        if rows:
            yield from _Chunk(pa.Table.from_batches(held).combine_chunks(), passage, seed).settle(open_start, True)

    found = materialize(array.mapInArrow(
        released(run), "doc_id long, h long, lo int, hi int, later boolean, k1 long, k2 long, i int, several boolean"), "neighbours")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "h", "lo")
    over = found.where("k1 IS NOT NULL").withColumn("place", place)
    keys = ["k1", "k2", "i"]
    told = materialize(
        over.groupBy(*keys).agg(F.min("place").alias("first"), F.max("place").alias("last"), F.max("several").alias("several"))
        .where("first <> last OR several").select(*keys, "first"), "stretches")
    over = over.join(F.broadcast(told) if small(told) else told, keys)
    return found.where("k1 IS NULL").select("doc_id", "h", "lo", "hi", "later").unionByName(
        over.select("doc_id", "h", "lo", "hi", (F.col("place") != F.col("first")).alias("later")))


def _merged(batches, passage: int):
    for batch in batches:
        columns = {"doc_id": batch.column("doc_id"), "h": batch.column("h")}
        for name in ("repeated", "removed"):
            out = []
            for own in batch.column(name).to_pylist():
                flat: list[int] = []
                for s in own:
                    if flat and s["lo"] <= flat[-1]:
                        flat[-1] = max(flat[-1], s["hi"] + passage)
                    else:
                        flat += [s["lo"], s["hi"] + passage]
                out.append(flat)
            columns[name] = pa.array(out, pa.list_(pa.int32()))
        yield pa.RecordBatch.from_pydict(columns)


def repeats(docs: DataFrame, passage: int = PASSAGE_WORDS, seed: int = SEED_WORDS, id_col: str = "doc_id",
            text_col: str = "text", limit: int | None = None, chunk_rows: int = CHUNK) -> DataFrame:
    """Documents that hold a passage of ``passage`` words which also starts elsewhere.

    Returns per (doc_id, h), h being a digest of the text: repeated and removed,
    the maximal ranges of words (start, end, start, end, ...) that repeat, and of
    those that repeat an earlier occurrence (smaller doc_id, then position).  Rows that
    repeat both id and text are one document here; null ids come last in the order;
    null and empty texts and those shorter than a passage hold none; other columns are
    not read; an empty table gives no rows.  ``chunk_rows`` suffixes are compared at once; no
    result depends on it.
    """
    if not 0 < seed <= passage:
        raise ValueError("the seed must not be longer than the passage")
    rows = keyed(docs, id_col, text_col)
    shared = materialize(
        anchors(rows, passage, seed).groupBy("seed")
        .agg(F.count(F.lit(1)).alias("n"), F.min("ctx").alias("a"), F.max("ctx").alias("b"))
        .where("n > 1").select("seed", (F.col("a") == F.col("b")).alias("whole")), "shared_minimisers")
    if small(shared, LONGS_BYTES if limit is None else limit, row_bytes=8):
        sc = docs.sparkSession.sparkContext
        held = [sc.broadcast(longs(shared.where(F.col("whole") == w), "seed")) for w in (True, False)]
        suffixes = _suffixes(rows, passage, seed, *held)
    else:
        own = (anchors(rows, passage, seed, ids=True).join(shared, "seed").groupBy("doc_id", "h")
               .agg(F.collect_set(F.when(F.col("whole"), F.col("seed"))).alias("whole"),
                    F.collect_set(F.when(~F.col("whole"), F.col("seed"))).alias("mixed")))
        suffixes = _suffixes(rows.alias("r").join(own.alias("o"), F.expr("r.doc_id <=> o.doc_id AND r.h = o.h")).select(
            "r.doc_id", "r.h", "r.text", "o.whole", "o.mixed"), passage, seed, None, None)
    equal = _compare_neighbours(materialize(suffixes, "suffixes"), passage, seed, chunk_rows)
    span = F.struct("lo", "hi")
    grouped = equal.groupBy("doc_id", "h").agg(
        F.sort_array(F.collect_set(span)).alias("repeated"),
        F.sort_array(F.collect_set(F.when(F.col("later"), span))).alias("removed"))
    return grouped.mapInArrow(released(lambda batches: _merged(batches, passage)),
                              "doc_id long, h long, repeated array<int>, removed array<int>")


def cut(docs: DataFrame, passage: int = PASSAGE_WORDS, seed: int = SEED_WORDS, id_col: str = "doc_id",
        text_col: str = "text", size_col: str | None = "n_chars", limit: int | None = None) -> DataFrame:
    """``docs`` (all their columns) without the passages that repeat an earlier one.

    The rest of a text keeps its spelling and white space; documents of which
    nothing is left go.  ``size_col``, if there, is set to the new length of a cut text.
    """
    found = materialize(repeats(docs, passage, seed, id_col, text_col, limit).where("size(removed) > 0")
                        .select("doc_id", "h", "removed"), "cuts")
    names = docs.columns
    rows = docs.select(F.struct(*names).alias("row"), F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("h"))
    rows = attach(rows, found, ["doc_id", "h"], "left", limit).select("row.*", F.col("removed").alias("__cut"))
    schema = T.StructType([f for f in docs.schema])
    sizes = size_col if size_col in names else None
    ship_package(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text_col):
                part = pa.RecordBatch.from_arrays(part.columns, names=[*names, "__cut"])
                touched = [i for i, c in enumerate(part.column("__cut").to_pylist()) if c]
                out = part.select(names)
                if touched:
                    texts = part.column(text_col).to_pylist()
                    lengths = part.column(sizes).to_pylist() if sizes else None
                    words = WordBatch(part.column(text_col), hashed=False)
                    for i in touched:
                        own = part.column("__cut")[i].as_py()
                        raw, base = texts[i].encode("utf-8"), words.offsets[i]
                        begins = np.r_[words.starts[words.first[i]: words.first[i + 1]] - base, len(raw)]
                        pieces, at = [], 0
                        for a, b in zip(own[::2], own[1::2]):
                            pieces.append(raw[at: begins[a]])
                            at = int(begins[b])
                        texts[i] = b"".join([*pieces, raw[at:]]).decode("utf-8")
                        if lengths is not None:
                            lengths[i] = len(texts[i])
                    out = out.set_column(names.index(text_col), text_col, pa.array(texts, out.schema.field(text_col).type))
                    if sizes:
                        out = out.set_column(names.index(sizes), sizes, pa.array(lengths, out.schema.field(sizes).type))
                    gone = np.zeros(out.num_rows, dtype=bool)
                    gone[[i for i in touched if not texts[i].strip()]] = True
                    out = out.filter(pa.array(~gone))
                yield out

    return rows.mapInArrow(released(run), schema)
