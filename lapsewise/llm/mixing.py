"""Mixing sources to target weights by hash thresholds.

Every document has a place on a line of hashes.  A source takes all its documents
as often as its target holds them whole, and once more those below a threshold of
their place.  The threshold comes from histograms: words are summed by source and
by the first bits of the place, running sums find the cell in which the budget ends,
and only that cell is divided again by the next bits, until it holds one document.
What is left of the budget (less than that document) goes to the documents that
follow and fit, by a nested threshold of its own, and so on down to the tolerance.
Rows are filtered by their source's thresholds; no source is sorted or gathered.

Only DataFrame functions run on the executors.  Tables by source are broadcast
after their bytes are counted, and joined by a shuffle beyond the limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapsewise.llm.common import attach, materialize
from lapsewise.operators.keys import dense_index

#: Words are the runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of a place that one histogram resolves: a source has at most 2**BITS cells.
BITS = 12
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1
#: A place is the hash of the document, then a number that divides equal rows.
_LEVELS = [(c, max(0, 64 - BITS * i)) for c in ("h", "t") for i in range(1, -(-64 // BITS) + 1)]


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, h, t), written once: the only pass over the texts."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    return materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"),
        F.xxhash64(F.lit("mix"), F.col(id_col), F.col(source_col), F.col(text_col)).alias("h"),
        F.xxhash64(F.lit("tie"), F.monotonically_increasing_id()).alias("t")), "mix_sizes")


def targets(rows: DataFrame, share: float = 1.5, weights: Sequence[float] = (5, 2, 1), most: int = 2) -> DataFrame:
    """(source, source_size, target): ``share`` of all words dealt by weight, no
    source above ``most`` times its own words, the excess dealt again by weight."""
    sums = materialize(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix_sources")
    numbered = dense_index(sums, [F.col("source").asc_nulls_last()], "place", start=0)
    turn = F.array(*[F.lit(float(w)) for w in weights])
    numbered = materialize(numbered.withColumn(
        "weight", F.get(turn, F.pmod("place", F.lit(len(weights))).cast("int"))), "mix_weights")
    ceiling = F.lit(float(most)) * F.col("source_size")
    budget = share * float(numbered.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        # the level only rises, so a source that is full stays full
        above = F.lit(level) * F.col("weight") > ceiling
        got = numbered.agg(
            F.count(F.when(above, 1)).alias("full"),
            F.coalesce(F.sum(F.when(above, ceiling)), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("weight")).first()
        if got["full"] == full:
            break
        full = got["full"]
        level = (budget - got["held"]) / got["weight"] if got["weight"] else level
    return materialize(numbered.select(
        "source", "source_size", F.least(ceiling, F.lit(level) * F.col("weight")).alias("target")), "mix_targets")


def _before(h, t, than_h, than_t):
    return (h < than_h) | ((h == than_h) & (t < than_t))


def _end_of_budget(rows: DataFrame, state: DataFrame) -> DataFrame:
    """One threshold a source of ``state`` (source, left, lo_h, lo_t, cap).

    Adds hi_h, hi_t and lowers ``left`` by the words of all rows from ``lo`` up to
    ``hi`` whose size is within ``cap``.  Without an end all rows fit and hi is null.
    """
    low, high = F.lit(_LOW).cast("long"), F.lit(_HIGH).cast("long")
    cells = state.select("*", low.alias("h_from"), high.alias("h_to"), low.alias("t_from"), high.alias("t_to"),
                         F.lit(None).cast("long").alias("n"))
    cells = materialize(cells, "mix_cells")
    done = []
    for column, shift in _LEVELS:
        live = attach(rows, cells, ["source"], "inner").where(
            F.col("h").between(F.col("h_from"), F.col("h_to")) & F.col("t").between(F.col("t_from"), F.col("t_to"))
            & ~_before(F.col("h"), F.col("t"), F.col("lo_h"), F.col("lo_t"))
            & (F.col("size") > 0) & (F.col("size") <= F.col("cap")))
        sums = live.groupBy("source", F.shiftright(column, shift).alias("cell")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"))
        # at most 2**BITS cells of a source
        along = Window.partitionBy("source").orderBy("cell")
        running = sums.withColumn("upto", F.sum("words").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        running = running.withColumn("of_all", F.sum("words").over(Window.partitionBy("source")))
        # the cell where the budget ends, else the last one (everything fits)
        last = F.col("upto") == F.col("of_all")
        running = attach(running, cells, ["source"], "inner")
        ends = F.col("upto") > F.col("left")
        found = running.where((ends | last) & (F.col("upto") - F.col("words") <= F.col("left")))
        start = F.shiftleft("cell", shift)
        found = found.select(
            "source", F.when(ends, F.col("left") - (F.col("upto") - F.col("words"))).otherwise(F.col("left") - F.col("upto")).alias("left"),
            "lo_h", "lo_t", "cap",
            *[c for x in ("h", "t") for c in ((
                start.alias(f"{x}_from"), (start + F.lit((1 << shift) - 1)).alias(f"{x}_to")) if x == column else (f"{x}_from", f"{x}_to"))],
            F.when(ends, F.col("rows")).alias("n"))
        found = materialize(found, "mix_cells")
        done.append(found.where("n IS NULL OR n = 1"))
        cells = materialize(found.where("n > 1"), "mix_cells")
        if not cells.counted_rows:
            break
    else:
        done.append(cells)  # rows alike in all 128 bits
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    out = out.select("source", F.col("left").alias("new_left"), F.when(F.col("n").isNotNull(), F.col("h_from")).alias("hi_h"),
                     F.when(F.col("n").isNotNull(), F.col("t_from")).alias("hi_t"))
    out = materialize(out, "mix_ends")
    # sources without a fitting row have no cell: nothing changes, and they end
    joined = attach(state, out, ["source"], "left")
    return joined.select(
        "source", F.coalesce("new_left", "left").alias("left"), "lo_h", "lo_t", "cap", "hi_h", "hi_t")


def mix(docs: DataFrame, share: float = 1.5, weights: Sequence[float] = (5, 2, 1), most: int = 2, tolerance: float = 1e-3,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row of ``docs``.

    ``size`` counts a text's words, ``taken`` those that the mix takes, whole
    documents only: 0, size, ... up to ``most`` times size.  A source's taken words
    miss its target by no more than ``tolerance`` of it, or else by less than half of the
    smallest document that could still be added.  Sources weigh ``weights`` in turn,
    in order of their code points, a null source last.

    Null and empty texts have size 0 and nothing taken; a null doc_id is a value like
    any other; rows that repeat doc_id, source and text are rows of their own, of which
    as many are taken as the budget asks for, whichever they are.  An empty table gives
    no rows, extra columns are ignored whatever their names.
    """
    rows = sized(docs, id_col, text_col, source_col)
    goal = targets(rows, share, weights, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    goal = goal.withColumn("whole", F.least(whole, F.lit(most).cast("long"))).withColumn(
        "left", F.when(F.col("whole") >= most, F.lit(0.0)).otherwise(F.col("target") - F.col("whole") * F.col("source_size")))
    slack = F.lit(tolerance) * F.col("target")
    goal = materialize(goal.withColumn("slack", slack), "mix_goals")

    low = F.lit(_LOW).cast("long")
    state = materialize(goal.where("left > 0").select(
        "source", "left", low.alias("lo_h"), low.alias("lo_t"), F.lit(float("inf")).alias("cap")), "mix_state")
    rounds, closed = [], []
    while state.counted_rows:
        cut = materialize(_end_of_budget(rows, state), "mix_round")
        rounds.append(cut)
        slacks = materialize(goal.select("source", "slack"), "mix_slack") if len(rounds) == 1 else slacks
        known = attach(cut, slacks, ["source"], "inner")
        more = F.col("hi_h").isNotNull() & (F.col("left") > F.col("slack")) & (F.col("left") >= 1)
        closed.append(known.where(~more).select("source", "left"))
        state = materialize(known.where(more).select(
            "source", "left", F.col("hi_h").alias("lo_h"), F.col("hi_t").alias("lo_t"), F.col("left").alias("cap")), "mix_state")
    return _take(rows, goal, rounds, closed)


def _take(rows: DataFrame, goal: DataFrame, rounds: list[DataFrame], closed: list[DataFrame]) -> DataFrame:
    base = ["doc_id", "source", "size", "source_size", "target"]
    if not rounds:
        return attach(rows, materialize(goal, "mix_goals"), ["source"], "inner").select(
            *base, (F.col("size") * F.col("whole")).alias("taken"))
    high = F.lit(_HIGH).cast("long")
    spans, ends = rounds[0], closed[0]
    for r in rounds[1:]:
        spans = spans.unionByName(r)
    for c in closed[1:]:
        ends = ends.unionByName(c)
    # as many entries a source as there were rounds
    per = spans.groupBy("source").agg(F.collect_list(F.struct(
        "lo_h", "lo_t", F.coalesce("hi_h", high).alias("hi_h"), F.coalesce("hi_t", high).alias("hi_t"),
        F.col("hi_h").isNull().alias("all"), "cap")).alias("spans"))
    per = materialize(per, "mix_spans")
    plan = attach(attach(goal.drop("left"), per, ["source"], "left"), materialize(ends, "mix_left"), ["source"], "left")
    plan = materialize(plan, "mix_plan")

    def chosen(s):
        below = s["all"] | _before(F.col("h"), F.col("t"), s["hi_h"], s["hi_t"])
        return ~_before(F.col("h"), F.col("t"), s["lo_h"], s["lo_t"]) & below & (F.col("size") <= s["cap"])

    taken_once = F.coalesce(F.exists("spans", chosen), F.lit(False))
    placed = attach(rows, plan, ["source"], "inner").withColumn("once", taken_once)
    # one document more where that comes nearer to the target
    spare = placed.where(~F.col("once") & (F.col("size") > 0) & (F.col("size") < 2 * F.col("left"))).groupBy("source").agg(
        F.min(F.struct("size", "h", "t")).alias("spare"))
    spare = materialize(spare.select("source", F.col("spare.h").alias("spare_h"), F.col("spare.t").alias("spare_t")), "mix_spare")
    final = attach(placed, spare, ["source"], "left")
    extra = F.coalesce((F.col("h") == F.col("spare_h")) & (F.col("t") == F.col("spare_t")), F.lit(False))
    times = F.col("whole") + (F.col("once") | extra).cast("long")
    return final.select(*base, (F.col("size") * times).alias("taken"))


__all__ = ["mix", "sized", "targets"]
