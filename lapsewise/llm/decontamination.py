"""Benchmark decontamination by template windows.

A text is read as tokens; numbers, names and units become typed placeholders
(slots), everything else is folded to lower case.  Windows of consecutive
template tokens of documents and benchmark items are joined on their hashes.
A document is contaminated by an item if along one alignment it holds most of the
item's windows and its slots are consistent: every slot value of the item stands for
one value of the document.  An alignment is one shift between the two, or a band of
shifts as wide as the item, which allows for words put in or left out.  Equal values are a
verbatim copy, others a re-parameterised question.

A capitalised word inside a sentence is a name.  One that opens a text, line or
sentence is a name unless the corpus spells it in lower case (see ``NAME_SHARE``);
this is counted over all documents and items, for the words of the items.  A run of
names is one placeholder, so that "Tom" may become "Mary Ann".

A window that is dense in placeholders grows until it holds enough literals.  Items
that are not covered by windows from each of their tokens on (short ones, ones with
few literals or a tail of numbers) are also sought in two other ways: up to
``WHOLE_TOKENS`` tokens as one window, the whole template, with the same check of
slots; and verbatim: their folded words are cut into pieces that must all stand in
the document at their places.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lapsewise.llm.common import LONGS_BYTES, attach, keyed, longs, map_text, materialize, member, released, slices, small
from lapsewise.llm.words import U64, RangeHash, WordBatch
from lapsewise.session import ship_package

WINDOW_TOKENS = 5
#: Tokens of a window that are no placeholders; a window with fewer grows.
LITERAL_TOKENS = 3
#: Words of a piece of an item that is sought verbatim; a shorter item is one piece.
PIECE_WORDS = 8
#: Fewest words of an item that is sought verbatim inside a longer text: a single word
#: is ordinary language, and so are few numbers, units or names without another word.
EXACT_WORDS, SLOT_WORDS = 2, 4
#: Most template tokens of an item that is sought as a whole, and fewest literals among them;
#: with WINDOW_TOKENS tokens or more one is enough.
WHOLE_TOKENS, WHOLE_LITERALS = 16, 2
COVERAGE = 0.8
#: Least width of a band of shifts, in template tokens.
BAND_TOKENS = 16
#: A word that opens a sentence is a name if inside sentences it has a capital this
#: many times as often as not, or never stands there in lower case at all.
NAME_SHARE = 0.25

#: Number words and units that follow a number.
NUMBER_WORDS = ("zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen "
                "seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand "
                "million billion dozen half").split()
UNIT_WORDS = ("mm cm m km in inch inches ft foot feet yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs "
              "pound pounds oz ounce ounces ton tons ml l litre litres liter liters gallon gallons s sec second seconds "
              "min minute minutes h hr hrs hour hours day days week weeks month months year years c f k degree degrees "
              "percent dollar dollars cent cents euro euros usd eur gbp mph kmh kph w kw v a hz khz mhz ghz b kb mb gb tb").split()
NUMBER, NAME, UNIT = U64(1), U64(2), U64(3)

_TOKEN = np.zeros(256, dtype=bool)
for _r in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _TOKEN[_r[0]: _r[1]] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[0x30:0x3A] = True


def _folded(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the Latin-1 capitals (C3 80 .. C3 9E) in lower case."""
    out = data.copy()
    out[(data >= 0x41) & (data <= 0x5A)] += 32
    second = np.zeros(len(data), dtype=bool)
    second[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[second] += 32
    return out


def _inside_token(data: np.ndarray) -> np.ndarray:
    """Letters, digits, marks of other scripts; a point or comma between digits."""
    inside = _TOKEN[data]
    if len(data) > 2:
        # general punctuation (E2 80/81 xx) and the no-break space (C2 A0 .. BF) separate
        lead = (data[:-2] == 0xE2) & ((data[1:-1] == 0x80) | (data[1:-1] == 0x81))
        for i in range(3):
            inside[i: len(data) - 2 + i] &= ~lead
        sign = np.zeros(len(data), dtype=bool)
        sign[:-1] = (data[:-1] == 0xC2) & (data[1:] >= 0xA0) & (data[1:] <= 0xBF)
        inside &= ~sign
        inside[1:] &= ~sign[:-1]
        digit = _DIGIT[data]
        inside[1:-1] |= ((data[1:-1] == 0x2E) | (data[1:-1] == 0x2C)) & digit[:-2] & digit[2:]
    return inside


def _capitals(words: WordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Whether a token starts with a capital, and whether it opens a text, line or sentence."""
    data, starts = words.data, words.starts
    if not len(starts):
        return np.empty(0, dtype=bool), np.empty(0, dtype=bool)
    first, second = data[starts], data[np.minimum(starts + 1, len(data) - 1)]
    capital = ((first >= 0x41) & (first <= 0x5A)) | (
        (first == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97))
    opens = np.ones(len(starts), dtype=bool)
    row = words.rows_of_words()
    stops = np.r_[0, np.cumsum(np.isin(data, np.frombuffer(b".!?:;\n\"'()*#|-", dtype=np.uint8)))]
    opens[1:] = (stops[starts[1:]] > stops[words.ends[:-1]]) | (row[1:] != row[:-1])
    return capital, opens


class Templates:
    """Template tokens of a text column: ``tokens`` with placeholders, ``slot`` marks,
    the words ``at[i]:at[i + 1]`` of each with their folded ``values``; the tokens of
    row r are ``first[r]:first[r + 1]``.  ``common``: the words (sorted hashes) that
    are no names for opening a sentence."""

    def __init__(self, column, common: np.ndarray):
        words = WordBatch(column, fold=_folded, inside=_inside_token)
        data, starts = words.data, words.starts
        self.words, self.values = words, words.hashes
        initial = data[starts] if len(starts) else np.empty(0, np.uint8)
        number = _DIGIT[initial] | np.isin(self.values, _lexicon(NUMBER_WORDS))
        after_number = np.zeros(len(starts), dtype=bool)
        row = words.rows_of_words()
        after_number[1:] = number[:-1] & (row[1:] == row[:-1])
        unit = after_number & ~number & np.isin(self.values, _lexicon(UNIT_WORDS))
        capital, opens = _capitals(words)
        name = capital & ~number & ~unit
        name[name & opens] = ~member(self.values[name & opens], common)
        # names with only blanks, or one hyphen or apostrophe, between them are one
        more = np.zeros(len(starts), dtype=bool)
        if len(starts) > 1:
            blank = np.r_[0, np.cumsum(data == 0x20)]
            gap = starts[1:] - words.ends[:-1]
            joint = (blank[starts[1:]] - blank[words.ends[:-1]] == gap) | (
                (gap == 1) & np.isin(data[words.ends[:-1]], np.frombuffer(b"-'", dtype=np.uint8)))
            more[1:] = name[1:] & name[:-1] & joint & (row[1:] == row[:-1])
        heads = np.flatnonzero(~more)
        self.at = np.r_[heads, len(starts)]
        self.first = np.searchsorted(heads, words.first)
        self.slot = (number | unit | name)[heads]
        self.tokens = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, NAME, self.values)))[heads]

    def slots(self, start: int, length: int) -> list[list[int]]:
        """The words of each slot of a window."""
        return [self.values[self.at[i]: self.at[i + 1]].view(np.int64).tolist()
                for i in range(start, start + length) if self.slot[i]]

    def windows(self, width: int, literals: int, longest: int | None = None):
        """(row, first token, length, hash) of the windows: from each token on ``width``
        tokens, and more up to ``literals`` literals.  A text with fewer tokens than
        ``width`` is one window; ``longest`` leaves out longer ones."""
        counts = np.diff(self.first)
        row = np.repeat(np.arange(len(counts)), counts)
        start = np.arange(len(row))
        end = self.first[row + 1]
        literal = np.r_[np.flatnonzero(~self.slot), np.full(literals, len(row) + 1)]
        before = np.r_[0, np.cumsum(~self.slot)][:-1]  # literals before each token
        stop = np.maximum(start + width, literal[before + literals - 1] + 1)
        short = (counts < width)[row]
        plain = np.r_[0, np.cumsum(~self.slot)]
        stop = np.where(short, end, stop)
        usable = (stop <= end) & ~(short & (start > self.first[row]))
        usable[short] &= (plain[end] - plain[start] >= np.minimum(literals, end - start))[short]
        if longest is not None:
            usable &= stop - start <= longest
        start, length, row = start[usable], (stop - start)[usable], row[usable]
        return row, start, length, RangeHash(self.tokens, 0)(start, start + length, length.astype(U64))

    def wholes(self, sizes):
        """(row, first token, length, hash) of all windows of ``sizes`` tokens."""
        counts = np.diff(self.first)
        row = np.repeat(np.arange(len(counts)), counts)
        start = np.arange(len(row))
        hasher = RangeHash(self.tokens, 0)
        for size in sizes:
            at = start[start + size <= self.first[row + 1]]
            length = np.full(len(at), size)
            yield row[at], at, length, hasher(at, at + size, length.astype(U64))

    def pieces(self, sizes):
        """(row, first word, length, hash) of all pieces of ``sizes`` words."""
        counts = self.words.counts()
        row = np.repeat(np.arange(len(counts)), counts)
        start = np.arange(len(row))
        hasher = RangeHash(self.values, 1)
        for size in sizes:
            fits = start + size <= self.words.first[row + 1]
            at = start[fits]
            yield row[fits], at, size, hasher(at, at + size, np.full(len(at), size, dtype=U64))


_LEXICONS: dict[tuple, np.ndarray] = {}


def _lexicon(words: list[str]) -> np.ndarray:
    key = (words[0], len(words))
    if key not in _LEXICONS:
        _LEXICONS[key] = WordBatch(pa.array(words)).hashes
    return _LEXICONS[key]


def common_words(rows: DataFrame, item_rows: DataFrame) -> np.ndarray:
    """The words of the items that are no names for opening a sentence (sorted hashes),
    by how all rows and items spell them elsewhere.  As large as the items' vocabulary;
    a word that no item holds can match none as a literal."""

    def vocabulary(batch):
        return pa.RecordBatch.from_pydict({"w": pa.array(
            np.unique(WordBatch(batch.column("text"), fold=_folded, inside=_inside_token).hashes).view(np.int64))})

    known = longs(map_text(item_rows, vocabulary, "w long").distinct(), "w")
    held = rows.sparkSession.sparkContext.broadcast(known)

    def count(batches):
        known = held.value
        lower, upper = np.zeros(len(known), dtype=np.int64), np.zeros(len(known), dtype=np.int64)
        for batch in batches:
            for part in slices(batch):
                words = WordBatch(part.column("text"), fold=_folded, inside=_inside_token)
                capital, opens = _capitals(words)
                for total, chosen in ((lower, ~capital), (upper, capital & ~opens)):
                    values = words.hashes[chosen]
                    values = values[member(values, known)]
                    total += np.bincount(np.searchsorted(known, values), minlength=len(known))
        some = np.flatnonzero(lower | upper)
        yield pa.RecordBatch.from_pydict({"w": pa.array(known[some].view(np.int64)), "lower": pa.array(lower[some]),
                                          "upper": pa.array(upper[some])})

    ship_package(rows.sparkSession)
    counts = rows.select("text").unionAll(item_rows.select("text")).mapInArrow(released(count), "w long, lower long, upper long")
    return longs(counts.groupBy("w").agg(F.sum("lower").alias("lower"), F.sum("upper").alias("upper")).where(
        F.col("upper") < NAME_SHARE * F.col("lower")), "w")


_FOUND = "doc_id long, h long, pos int, at int, size int, exact boolean, w long, slots array<array<long>>"


def _found(batch, t: Templates, row, start, length, w) -> pa.RecordBatch:
    """Rows of windows."""
    rows_at = pa.array(row)
    return pa.RecordBatch.from_pydict({
        "doc_id": batch.column("doc_id").take(rows_at), "h": batch.column("h").take(rows_at),
        "pos": pa.array((start - t.first[row]).astype(np.int32)),
        "at": pa.array((t.at[start] - t.words.first[row]).astype(np.int32)),
        "size": pa.array(length.astype(np.int32)), "exact": pa.array(np.zeros(len(row), dtype=bool)),
        "w": pa.array(w.view(np.int64)),
        "slots": pa.array([t.slots(s, n) for s, n in zip(start.tolist(), length.tolist())], pa.list_(pa.list_(pa.int64())))})


def _found_pieces(batch, t: Templates, row, start, size, w) -> pa.RecordBatch:
    """Rows of pieces; ``pos`` and ``at`` both count words."""
    rows_at = pa.array(row)
    at = pa.array((start - t.words.first[row]).astype(np.int32))
    return pa.RecordBatch.from_pydict({
        "doc_id": batch.column("doc_id").take(rows_at), "h": batch.column("h").take(rows_at), "pos": at, "at": at,
        "size": pa.array(np.full(len(row), size, dtype=np.int32)), "exact": pa.array(np.ones(len(row), dtype=bool)),
        "w": pa.array(w.view(np.int64)), "slots": pa.nulls(len(row), pa.list_(pa.list_(pa.int64())))})


def _item_windows(items: DataFrame, width: int, literals: int, common) -> DataFrame:
    """Windows of the items; the whole template and the pieces of those that need them."""

    def marked(found, whole):
        return found.append_column("whole", pa.array(np.full(found.num_rows, whole)))

    def kernel(batch):
        t = Templates(batch.column("text"), common.value)
        row, start, length, w = t.windows(width, literals)
        out = [marked(_found(batch, t, row, start, length, w), False)]
        tokens = np.diff(t.first)
        plain = np.r_[0, np.cumsum(~t.slot)]
        words = t.words.counts()
        # windows from each token on that leave room for one
        whole = (tokens >= width) & (np.bincount(row, minlength=len(tokens)) == tokens - width + 1)
        literal = plain[t.first[1:]] - plain[t.first[:-1]]
        alone = np.flatnonzero(~whole & (tokens > 1) & (tokens <= WHOLE_TOKENS) & (
            literal >= np.where(tokens < width, WHOLE_LITERALS, 1)))
        if len(alone):
            start, length = t.first[alone], tokens[alone]
            w = RangeHash(t.tokens, 0)(start, start + length, length.astype(U64))
            out.append(marked(_found(batch, t, alone, start, length, w), True))
        sought = ~whole & (words >= np.where(literal > 0, EXACT_WORDS, SLOT_WORDS))
        hasher = RangeHash(t.values, 1)
        for r in np.flatnonzero(sought).tolist():
            n, first = int(words[r]), int(t.words.first[r])
            size = min(n, PIECE_WORDS)
            at = first + np.unique(np.r_[np.arange(0, n - size + 1, size), n - size])
            w = hasher(at, at + size, np.full(len(at), size, dtype=U64))
            out.append(marked(_found_pieces(batch, t, np.full(len(at), r), at, size, w), False))
        return pa.Table.from_batches(out).combine_chunks().to_batches()[0] if sum(b.num_rows for b in out) else None

    return map_text(items, kernel, _FOUND + ", whole boolean")


def _windows(rows: DataFrame, width: int, literals: int, common, longest: int, sizes: list[int], wholes: list[int],
             known=None) -> DataFrame:
    """Windows up to ``longest`` tokens, those of ``wholes`` tokens and pieces of ``sizes`` words (the
    ``known`` ones) by template token and word, with the words of their slots."""

    def kernel(batch):
        t = Templates(batch.column("text"), common.value)
        row, start, length, w = t.windows(width, literals, longest)
        keep = np.ones(len(row), dtype=bool) if known is None else member(w, known.value)
        out = [_found(batch, t, row[keep], start[keep], length[keep], w[keep])]
        for row, start, length, w in t.wholes(wholes):
            keep = np.ones(len(row), dtype=bool) if known is None else member(w, known.value)
            out.append(_found(batch, t, row[keep], start[keep], length[keep], w[keep]))
        for row, start, size, w in t.pieces(sizes):
            keep = np.ones(len(row), dtype=bool) if known is None else member(w, known.value)
            out.append(_found_pieces(batch, t, row[keep], start[keep], size, w[keep]))
        return pa.Table.from_batches(out).combine_chunks().to_batches()[0] if sum(b.num_rows for b in out) else None

    return map_text(rows, kernel, _FOUND)


def _slot_pairs(theirs: str, ours: str):
    """(a, b) of an item's slots and a document's: word by word, or as a whole where a
    name has another number of words."""
    return F.flatten(F.transform(F.arrays_zip(F.col(theirs).alias("a"), F.col(ours).alias("b")), lambda s: F.when(
        F.size(s["a"]) == F.size(s["b"]), F.arrays_zip(s["a"].alias("a"), s["b"].alias("b"))).otherwise(
        F.array(F.struct(F.xxhash64(s["a"]).alias("a"), F.xxhash64(s["b"]).alias("b"))))))


def contaminated(docs: DataFrame, items: DataFrame, width: int = WINDOW_TOKENS, literals: int = LITERAL_TOKENS,
                 coverage: float = COVERAGE, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", limit: int | None = None) -> DataFrame:
    """Pairs of documents and benchmark items they contain.

    Returns doc_id, h (digest of the text), item_id, n_matched and n_windows
    (distinct windows of the item, in its best alignment and in all; its pieces if it is found by these alone), verbatim (all
    slots of its windows equal, or all words found), start (word of the document at which the item's first one stands in the
    best alignment).  A pair is returned if at least ``coverage`` of
    the item's windows occur in one alignment and its slots are consistent, or if
    the whole template (with consistent slots) or all words of an item without a full set
    of windows do.  Null or empty texts have no windows.  Items of one word are found only as
    a whole text, items of slots alone only verbatim and from SLOT_WORDS words on, items without
    a word never; null ids are kept; rows that repeat id and text give one pair; either
    table may be empty; extra columns are not read, whatever they are called.
    """
    item_rows = keyed(items, item_col, item_text_col)
    rows = keyed(docs, id_col, text_col)
    common = docs.sparkSession.sparkContext.broadcast(common_words(rows, item_rows))
    wanted = materialize(_item_windows(item_rows, width, literals, common).select(
        F.col("doc_id").alias("item_id"), F.col("h").alias("item_h"), F.col("pos").alias("item_pos"),
        F.col("at").alias("item_at"), "size", "exact", "whole", "w", F.col("slots").alias("item_slots")).distinct(), "item_windows")
    sizes = materialize(wanted.groupBy("item_id", "item_h", "exact", "whole").agg(F.countDistinct("w").alias("n_windows"),
                                                                         F.count(F.lit(1)).alias("n_places")), "item_sizes")
    longest = wanted.where("NOT exact AND NOT whole").agg(F.max("size")).first()[0] or 0
    wholes = sorted(r[0] for r in wanted.where("whole").select("size").distinct().collect())  # WHOLE_TOKENS at most
    lengths = sorted(r[0] for r in wanted.where("exact").select("size").distinct().collect())  # PIECE_WORDS at most
    hashes = materialize(wanted.select("w").distinct(), "item_hashes")
    if small(hashes, LONGS_BYTES if limit is None else limit, row_bytes=8):
        known = docs.sparkSession.sparkContext.broadcast(longs(hashes, "w"))
        found = _windows(rows, width, literals, common, longest, lengths, wholes, known)
    else:
        found = _windows(rows, width, literals, common, longest, lengths, wholes).join(hashes, "w", "left_semi")
    found = materialize(found.drop("size"), "found_windows")
    wanted_side = wanted.drop("size")
    side = F.broadcast(wanted_side) if small(wanted, limit) else wanted_side
    both = found.join(side, ["w", "exact"])
    sized = lambda pairs, exact: pairs.alias("p").join(
        (F.broadcast(sizes) if small(sizes, limit) else sizes).where(F.col("exact") == F.lit(exact)).alias("s"),
        F.expr("p.item_id <=> s.item_id AND p.item_h = s.item_h AND p.whole = s.whole")).select("p.*", "s.n_windows", "s.n_places")
    pairs = both.where("NOT exact").drop("exact")
    # an item's windows and its whole template are judged apart
    item = ["doc_id", "h", "item_id", "item_h", "whole"]
    held = pairs.groupBy(*item).agg(F.countDistinct("w").alias("n_matched"))
    held = sized(held, False).drop("n_places").where(F.col("n_matched") >= F.lit(coverage) * F.col("n_windows"))
    held = materialize(held, "covered")
    # the covered pairs by alignment: each shift, and bands of shifts that overlap by half
    cond = " AND ".join(f"p.{c} <=> c.{c}" for c in item)
    near = pairs.alias("p").join(
        (F.broadcast(held) if small(held, limit) else held).alias("c"), F.expr(cond)).select(
        "p.*", "c.n_windows", (F.col("p.pos") - F.col("p.item_pos")).alias("shift"))
    near = near.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(*item, "shift")))
    extent = wanted.where("NOT exact").groupBy("item_id", "item_h", "whole").agg(
        F.greatest(F.lit(BAND_TOKENS), F.max(F.col("item_pos") + F.col("size"))).alias("band"))
    extent = materialize(extent, "item_extents")
    near = near.alias("p").join((F.broadcast(extent) if small(extent, limit) else extent).alias("e"), F.expr(
        "p.item_id <=> e.item_id AND p.item_h = e.item_h AND p.whole = e.whole")).select("p.*", F.explode(F.expr(
            "array(named_struct('kind', 0, 'n', shift), named_struct('kind', 1, 'n', CAST(floor(shift / band) AS INT)),"
            " named_struct('kind', 2, 'n', CAST(floor((shift + band div 2) / band) AS INT)))")).alias("along"))
    by = item + ["along"]
    # a place of the item is held once in a band, on the shift with most windows
    close = near.groupBy(*by, "item_pos").agg(F.max(F.struct(
        "n", (-F.col("shift")).alias("back"), "w", "at", "item_at", "item_slots", "slots", "n_windows")).alias("x")).select(
        *by, "item_pos", "x.*")
    best = close.groupBy(*by).agg(
        F.countDistinct("w").alias("n_matched"), F.max("n_windows").alias("n_windows"),
        F.greatest(F.lit(0), F.min_by(F.col("at") - F.col("item_at"), "item_pos")).alias("start")).where(
        F.col("n_matched") >= F.lit(coverage) * F.col("n_windows"))
    slots = close.where("size(slots) > 0").select(*by, F.explode(_slot_pairs("item_slots", "slots")).alias("s")).select(
        *by, "s.a", "s.b")
    judged = slots.groupBy(*by, "a").agg(F.min("b").alias("lo"), F.max("b").alias("hi")).groupBy(*by).agg(
        F.bool_and(F.col("lo") == F.col("hi")).alias("consistent"),
        F.bool_and((F.col("lo") == F.col("a")) & (F.col("hi") == F.col("a"))).alias("same"))
    same_key = " AND ".join(f"b.{c} <=> j.{c}" for c in by)
    out = best.alias("b").join(judged.alias("j"), F.expr(same_key), "left").where(
        F.coalesce("j.consistent", F.lit(True))).select(
        *[f"b.{c}" for c in item], "b.n_matched", "b.n_windows", F.coalesce("j.same", F.lit(True)).alias("verbatim"), "b.start")
    # items whose pieces all stand at their places
    whole = both.where("exact").groupBy(*item, (F.col("at") - F.col("item_at")).alias("start")).agg(
        F.countDistinct("item_at").alias("n"))
    whole = sized(whole, True).where("n = n_places").groupBy(*item).agg(F.min("start").alias("start"), F.max("n_windows").alias("n_windows"))
    whole = whole.select(*item, F.col("n_windows").alias("n_matched"), "n_windows", F.lit(True).alias("verbatim"), "start")
    # the best alignment: verbatim, then with most windows, then the first one
    return out.withColumn("by_windows", F.lit(True)).unionByName(whole.withColumn("by_windows", F.lit(False))).groupBy(
        *(c for c in item if c != "whole")).agg(
        F.max(F.struct("verbatim", "by_windows", "n_matched", "n_windows", (-F.col("start")).alias("back"))).alias("x")).select(
        "doc_id", "h", "item_id", "x.n_matched", "x.n_windows", "x.verbatim", (-F.col("x.back")).alias("start"))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          limit: int | None = None, **options) -> DataFrame:
    """The rows of ``docs`` (all their columns) that hold no benchmark item."""
    bad = materialize(contaminated(docs, items, id_col=id_col, text_col=text_col, limit=limit, **options)
                      .select("doc_id", "h").distinct(), "contaminated")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("h"))
    return attach(rows, bad, ["doc_id", "h"], "left_anti", limit).select("row.*")
