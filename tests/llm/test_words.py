import numpy as np
import pyarrow as pa

from lapsewise.llm.words import RangeHash, WordBatch, chosen_by_window, sequence_hashes
from tests.llm.conftest import words_of


def test_words_equal_the_pattern(corpus):
    column = pa.array([t for _, t in corpus])
    batch = WordBatch(column)
    raw = batch.data.tobytes()
    for i, (_, text) in enumerate(corpus):
        own = [raw[a:b].decode() for a, b in zip(batch.starts[batch.first[i]:batch.first[i + 1]], batch.ends[batch.first[i]:batch.first[i + 1]])]
        assert own == words_of(text)


def test_slices_of_a_column_and_empty_columns():
    column = pa.array(["a b", "c", None, "d e f"]).slice(1)
    assert WordBatch(column).counts().tolist() == [1, 0, 3]
    assert len(WordBatch(pa.array([], pa.string()))) == 0
    assert WordBatch(pa.array([None, ""], pa.string())).counts().tolist() == [0, 0]


def test_equal_words_and_only_they_hash_alike(corpus):
    batch = WordBatch(pa.array([t for _, t in corpus]))
    words = [w for _, t in corpus for w in words_of(t)]
    seen = {}
    for word, h in zip(words, batch.hashes.tolist()):
        assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen)


def test_lower_case_is_ascii_only():
    a, b = WordBatch(pa.array(["ÄB aB", "Äb AB"]), lower=True), WordBatch(pa.array(["äb ab"]), lower=True)
    assert (a.row(0) == a.row(1)).all() and a.row(0)[1] == b.row(0)[1] and a.row(0)[0] != b.row(0)[0]


def test_equal_windows_choose_the_same_place():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 5, 400).astype(np.uint64)
    for width in (1, 2, 7, 28):
        chosen = chosen_by_window(values, width)
        for i, c in enumerate(chosen.tolist()):
            own = values[i:i + width]
            assert c == i + max(j for j in range(width) if own[j] == own.min())


def test_range_and_sequence_hashes():
    items = np.array([1, 2, 3, 1, 2, 3, 4], dtype=np.uint64)
    rolled = sequence_hashes(items, 3)
    assert rolled[0] == rolled[3] and len(set(rolled.tolist())) == 4
    h = RangeHash(items)
    assert h(np.array([0]), np.array([3])) == h(np.array([3]), np.array([6]))
    assert h(np.array([0]), np.array([2])) != h(np.array([0]), np.array([3]))
    assert len(sequence_hashes(items, 9)) == 0
