"""Best-fit packing of token sequences by a linear grouping scheme.

Lengths are at most the capacity, so the whole corpus is described by one
count per length; the plan is made from that table alone and its size does
not depend on the number of documents.

1. Large lengths are sorted and cut into groups of equal cardinality; each
   is rounded up to the largest of its group.
2. For these few sizes configurations are chosen by a bounded knapsack: the
   fullest one that holds the largest size left, as often as the counts allow,
   then the next.
3. The actual pieces take the places of their group, longest first, which turns
   each configuration into runs of sequences with known gaps.
4. Small pieces go, longest first, into the tightest gap that holds them.

Pieces find their place by their rank among the pieces of their length: ranks are
local counters of the encoding tasks plus offsets of the tasks, so no piece is
sorted or gathered.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapsewise.llm.common import materialize, released, slices, small
from lapsewise.llm.tokens import append_id, default_path, encoder
from lapsewise.session import ship_package

CAPACITY = 1024
END_ID = 2
GROUPS = 400


def encode_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer_path: str | None = None,
                  id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, task, rank): only documents longer
    than the capacity are cut, into full pieces after a first one that may be shorter."""
    path = tokenizer_path or default_path()
    ship_package(docs.sparkSession)

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        encode = encoder(path).encode
        for batch in batches:
            for part in slices(batch):
                ids, borders = append_id(*encode(part.column("text")), end_id)
                total = np.diff(borders)
                count = -(-total // capacity)
                row = np.repeat(np.arange(len(total)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                short = total - (count - 1) * capacity
                start = np.where(piece == 0, 0, short[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, short[row], capacity)
                begin = borders[row] + start
                rank = np.empty(len(row), dtype=np.int64)
                order = np.argsort(length, kind="stable")
                by = length[order]
                new = np.flatnonzero(np.r_[True, by[1:] != by[:-1]]) if len(by) else np.empty(0, np.int64)
                size = np.diff(np.r_[new, len(by)])
                rank[order] = np.arange(len(by)) - np.repeat(new, size) + seen[by]
                seen[by[new]] += size
                raw = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
                crc = [zlib.crc32(raw[4 * a: 4 * (a + n)]) for a, n in zip(begin.tolist(), length.tolist())]
                out = {
                    "doc_id": part.column("doc_id").take(pa.array(row)), "piece": pa.array(piece.astype(np.int32)),
                    "start": pa.array(start), "length": pa.array(length), "ids_crc32": pa.array(crc, pa.int64()),
                    "task": pa.array(np.full(len(row), task, dtype=np.int32)), "rank": pa.array(rank)}
                if with_ids:  # pieces follow each other, so their ids do too
                    out["ids"] = pa.ListArray.from_arrays(
                        pa.array(np.r_[0, np.cumsum(length)].astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        released(run, encodes=True), schema + (", ids array<int>" if with_ids else ""))


def _fullest(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> np.ndarray:
    """Bounded knapsack: how often each size is used in the fullest configuration."""
    reach = np.full(capacity + 1, -1, dtype=np.int32)  # last size used to reach a fill
    times = np.zeros(capacity + 1, dtype=np.int32)
    reach[0] = len(sizes)
    best = 0
    for g in range(len(sizes)):
        w, c = int(sizes[g]), int(counts[g])
        if not c:
            continue
        for t in range(1, min(c, capacity // w) + 1):
            # fills reached without g or with t-1 of it
            src = np.flatnonzero((reach[: capacity + 1 - w] >= 0) & (reach[w:] < 0))
            ok = src[np.where(reach[src] == g, times[src], 0) == t - 1]
            if not len(ok):
                break
            reach[ok + w], times[ok + w] = g, t
        if reach[capacity] >= 0:
            break
    best = int(np.flatnonzero(reach >= 0)[-1])
    use = np.zeros(len(sizes), dtype=np.int64)
    while best:
        g, t = int(reach[best]), int(times[best])
        use[g] += t
        best -= t * int(sizes[g])
    return use


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS,
         small_length: int = CAPACITY // 4) -> list[tuple[int, int, list[int]]]:
    """Runs (first sequence, sequences, lengths in each) that hold ``histogram``."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        left[length] += n
    large = np.flatnonzero(left)
    large = large[large > small_length][::-1]
    total = int(left[large].sum())
    # equal-cardinality groups of the sorted large lengths; a length may span groups
    runs: list[list] = []  # [count, lengths, gap]
    group_of, sizes, counts = [], [], []
    if total:
        quota = max(1, -(-total // groups))
        room = 0
        for length in large.tolist():
            n = int(left[length])
            while n:
                if not room:
                    sizes.append(length)
                    counts.append(0)
                    group_of.append([])
                    room = quota
                take = min(n, room)
                group_of[-1].append([length, take])
                counts[-1] += take
                room -= take
                n -= take
    sizes_a, left_in = np.array(sizes, dtype=np.int64), np.array(counts, dtype=np.int64)
    while left_in.sum():
        top = int(np.flatnonzero(left_in)[0])  # the largest size left leads the configuration
        rest = left_in.copy()
        rest[top] -= 1
        use = _fullest(sizes_a, rest, capacity - int(sizes_a[top]))
        use[top] += 1
        used = np.flatnonzero(use)
        often = int((left_in[used] // use[used]).min())
        left_in[used] -= often * use[used]
        slots = [g for g in used for _ in range(int(use[g]))]
        while often:  # actual lengths take the places, longest first
            need: dict[int, int] = {}
            lengths = []
            for g in slots:
                have, skip = group_of[g], need.get(g, 0)
                k = 0
                while have[k][1] <= skip and k + 1 < len(have):
                    skip -= have[k][1]
                    k += 1
                lengths.append(have[k][0])
                need[g] = need.get(g, 0) + 1
            per = {}
            for length, g in zip(lengths, slots):
                per[(g, length)] = per.get((g, length), 0) + 1
            step = often
            for (g, length), times in per.items():
                step = min(step, max(1, next(e[1] for e in group_of[g] if e[0] == length) // times))
            for (g, length), times in per.items():
                entry = next(e for e in group_of[g] if e[0] == length)
                entry[1] -= step * times
            for g in set(slots):
                group_of[g] = [e for e in group_of[g] if e[1]] or [[0, 0]]
            runs.append([step, lengths, capacity - sum(lengths)])
            often -= step
    # small pieces: the tightest gap that holds them
    by_gap = sorted((gap, i) for i, (_, _, gap) in enumerate(runs) if gap)
    for length in range(small_length, 0, -1):
        n = int(left[length])
        while n:
            at = bisect_left(by_gap, (length, -1))
            if at == len(by_gap):
                runs.append([-(-n * length // capacity), [], capacity])
                insort(by_gap, (capacity, len(runs) - 1))
                continue
            gap, i = by_gap.pop(at)
            count, lengths, _ = runs[i]
            if count > n:
                runs.append([count - n, list(lengths), gap])
                insort(by_gap, (gap, len(runs) - 1))
                count = n
            runs[i] = [count, lengths + [length], gap - length]
            n -= count
            if gap - length:
                insort(by_gap, (gap - length, i))
    out, first = [], 0
    for count, lengths, _ in runs:
        if lengths:
            out.append((first, count, lengths))
            first += count
    return out


def best_plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> list[tuple[int, int, list[int]]]:
    """The plan with the fewest sequences over several borders of "small"."""
    return min((plan(histogram, capacity, groups, capacity * part // 8) for part in (1, 2, 3, 4)),
               key=lambda runs: sum(count for _, count, _ in runs))


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer_path: str | None = None,
         id_col: str = "doc_id", text_col: str = "text", groups: int = GROUPS, with_ids: bool = False,
         limit: int | None = None) -> DataFrame:
    """Pack every document into sequences of at most ``capacity`` ids.

    Returns per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset (and ids if asked for).  Null and empty texts are the end id alone; a null
    or repeated doc_id is kept as it is, each row being a document.  Empty table: no rows.
    """
    pieces = materialize(encode_pieces(docs, capacity, end_id, tokenizer_path, id_col, text_col, with_ids), "pieces")
    per_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {int(r["length"]): int(r["n"]) for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots: dict[int, list[tuple[int, int, int]]] = {}
    taken = dict.fromkeys(histogram, 0)
    for first, count, lengths in best_plan(histogram, capacity, groups):
        at = 0
        for length in lengths:
            slots.setdefault(length, []).append((taken[length], first, at))
            taken[length] += count
            at += length
    if taken != histogram:
        raise AssertionError("the plan does not hold the pieces")
    held = docs.sparkSession.sparkContext.broadcast({k: np.array(v, dtype=np.int64) for k, v in slots.items()})
    before = materialize(per_task.select(
        F.col("task").alias("_task"), F.col("length").alias("_length"),
        (F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")).alias("before")), "ranks")
    before = F.broadcast(before) if small(before, limit) else before
    ranked = pieces.join(before, (F.col("task") == F.col("_task")) & (F.col("length") == F.col("_length"))).withColumn(
        "rank", F.col("rank") + F.col("before")).drop("_task", "_length", "before", "task")
    names = [c for c in ranked.columns if c != "rank"]

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.empty(len(rank), dtype=np.int64), np.empty(len(rank), dtype=np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[order])) + 1
            for own in np.split(order, cuts) if len(order) else []:
                table = held.value[int(length[own[0]])]
                at = np.searchsorted(table[:, 0], rank[own], side="right") - 1
                sequence[own] = table[at, 1] + rank[own] - table[at, 0]
                offset[own] = table[at, 2]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in names] + [pa.array(sequence), pa.array(offset)], names=names + ["sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(released(place, encodes=True), schema + ", sequence_id long, offset long")
