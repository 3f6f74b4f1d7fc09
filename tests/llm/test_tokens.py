"""Packing and ORC output against the tokenizers library itself."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from lapsewise.llm import orc_output, packing
from lapsewise.llm.tokens import Encoder, default_path
from lapsewise.session import scratch_path


@pytest.fixture(scope="module")
def encoder():
    return Encoder(default_path())


def ids_of(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


ODD = ["a  b", "\n a", "it's  \n\n x y z", "a \nb", "  ", " ", "x y\nz 12ab", "\n", "a\n", "a\tb c", "é　ü a", "a\x85b c",
       "don't we'll I'm", "x, y; z!? 1,234.5 %", "<|endoftext|> in a text", "日本 語 text", None, "", "a\x1cb c d"]


def test_pieces_encode_like_whole_texts(encoder):
    ids, borders = encoder.encode(ODD)
    assert [ids[a:b].tolist() for a, b in zip(borders[:-1], borders[1:])] == [ids_of(encoder, t) for t in ODD]


def test_added_tokens_in_a_text(encoder):
    """The ids of the file alone, by a tokenizer that no encoder has touched."""
    plain = Tokenizer.from_file(default_path())
    texts = [*ODD, "first document.<|endoftext|>second one", "<|endoftext|>", "a <|endoftext|>\nb <|endoftext|> c", "<|endoftext |> a"]
    ids, borders = encoder.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(borders[:-1], borders[1:])] == [
        plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert encoder.encode(["first document.<|endoftext|>second one"])[0].tolist() == [11085, 3188, 13, 50256, 12227, 530]


def test_cache_starts_over(encoder, monkeypatch):
    import lapsewise.llm.tokens as tokens

    monkeypatch.setattr(tokens, "CACHE_PIECES", 10)
    fresh = Encoder(default_path())
    for _ in range(3):
        for t in ODD + ["one two three four five six seven eight nine ten eleven twelve"]:
            assert fresh.encode([t])[0].tolist() == ids_of(encoder, t)


PARTS = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "a", "word", "'s", "'ll", "don't", ",", "!!", "12", "3a", "é", "école", "ñ,", "Ж.", "日本", "\u3000",
         "\xa0", "\x85", "—", "“x”", "\x1c", "×", "a÷", "а\u0482", "सि", "😀", "\u180e", "\u0301", "'", "\x7f", "<|endoftext"]


def test_pieces_met_again_stay_when_there_is_no_more_room(encoder, monkeypatch):
    from lapsewise.llm import tokens

    fresh = Encoder(default_path(), most=300)
    given = []
    monkeypatch.setattr(tokens, "GIVE_BACK_PIECES", 100, raising=False)
    monkeypatch.setattr(tokens, "give_back", lambda: given.append(len(fresh.index)), raising=False)
    learn, got = fresh._learn, []
    monkeypatch.setattr(fresh, "_learn", lambda pieces: (got.extend(pieces), learn(pieces)))
    texts = [" ".join(["again and again", *(f"word{chr(97 + i)}{'abcdefghij'[j // 10]}{'abcdefghij'[j % 10]}" for j in range(60))])
             for i in range(20)]
    for text in texts:
        assert fresh.encode([text])[0].tolist() == ids_of(encoder, text)
        assert len(fresh.index) <= 300
    assert len(got) > 900 and {p: got.count(p) for p in ("again", " and", " again")} == {"again": 1, " and": 1, " again": 1}
    assert len(given) >= 9 and len(set(got)) == len(got)


def test_every_cut_is_one_of_the_library(encoder):
    """Pieces of any characters, next to each other in any order, as slices of an Arrow column."""
    import random

    import pyarrow as pa

    some = random.Random(7)
    texts = ["".join(some.choices(PARTS, k=some.randrange(12))) for _ in range(4000)] + [None, "x<|endoftext|> y."]
    column = pa.array(texts, pa.string())
    for at in range(0, len(texts), 500):
        part = column.slice(at, 500)
        ids, borders = encoder.encode(part)
        assert [ids[a:b].tolist() for a, b in zip(borders[:-1], borders[1:])] == [ids_of(encoder, t) for t in part.to_pylist()]


def test_library_gets_a_word_once(monkeypatch):
    """A word is no new piece because of the mark after it or the line break before it."""
    fresh = Encoder(default_path())
    given = []
    batch = fresh._batch
    fresh._batch = lambda texts, **k: (given.extend(p for t in texts for p in t.split("\n")), batch(texts, **k))[1]
    fresh.encode(["one zürich, one zürich. one zürich; one\nzürich: one zürich"])
    assert sorted(given) == sorted(["one", " one", " zürich", "zürich", ",", ".", ";", ":"])
    assert set(fresh.index) == {*given, "\n"}


def check_packing(rows, got, encoder, capacity):
    by_sequence = defaultdict(list)
    for r in got:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    want = []
    for doc_id, text in rows:
        ids = ids_of(encoder, text) + [2]
        first = len(ids) % capacity or capacity
        borders = [0, *range(first, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(borders[:-1], borders[1:])):
            want.append((doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())))
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    return len(by_sequence)


@pytest.mark.parametrize("capacity, limit", [(1024, None), (64, 0)])
def test_packing(make_docs, corpus, encoder, capacity, limit):
    rows = corpus + [(900 + i, t) for i, t in enumerate(ODD)]
    got = packing.pack(make_docs(rows), capacity=capacity, limit=limit).collect()
    used = check_packing(rows, got, encoder, capacity)
    total = sum(r.length for r in got)
    assert used <= 1.08 * -(-total // capacity) + 1


def test_packed_ids_and_empty_table(make_docs, encoder):
    got = packing.pack(make_docs([(1, "one two three"), (2, None)]), with_ids=True).collect()
    assert {r.doc_id: r.ids for r in got} == {1: ids_of(encoder, "one two three") + [2], 2: [2]}
    assert len({r.sequence_id for r in got}) == 1
    assert packing.pack(make_docs([])).collect() == []


@pytest.mark.parametrize("histogram", [{5: 3}, {1024: 4}, {1023: 2, 1: 2}, {600: 5, 300: 5, 100: 6}, {i: 1 + i % 7 for i in range(1, 1025)}])
def test_plans_hold_the_histogram(histogram):
    for groups in (1, 8, 400):
        runs = packing.best_plan(histogram, groups=groups)
        held = defaultdict(int)
        for first, count, lengths in runs:
            assert sum(lengths) <= 1024 and count > 0
            for length in lengths:
                held[length] += count
        assert held == histogram
        firsts = [f for f, _, _ in runs]
        assert firsts == list(np.cumsum([0] + [c for _, c, _ in runs])[:-1])


def test_orc_round_trip(spark, make_docs, corpus, encoder):
    path = scratch_path(spark, "ids.orc")
    orc_output.write_ids(make_docs(corpus), path)
    got = orc_output.digests(orc_output.read_ids(spark, path, limit=0)).collect()
    want = defaultdict(list)
    for doc_id, text in corpus:
        want[doc_id].append(ids_of(encoder, text) + [0])
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
        assert r.ids_crc32 in {zlib.crc32(np.array(i, dtype="<u4").tobytes()) for i in want[r.doc_id] if len(i) == r.n_tokens}
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0)) and len(order) == len(corpus)
    assert [r.ids for r in orc_output.lookup(spark, path, [407]).collect()] == want[407]
    plan = orc_output.lookup(spark, path, [407])._jdf.queryExecution().toString()
    assert "PushedFilters: [In(doc_id" in plan or "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id,407)" in plan


def test_orc_of_nothing(spark, make_docs):
    path = scratch_path(spark, "none.orc")
    orc_output.write_ids(make_docs([]), path)
    assert orc_output.digests(orc_output.read_ids(spark, path)).collect() == []
