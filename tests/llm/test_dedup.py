"""Substring dedup, n-gram Jaccard join and suffix-array dedup against brute force."""

from collections import Counter, defaultdict

import pytest

from lapsewise.llm import ngram_jaccard, substring_dedup, suffix_dedup
from tests.llm.conftest import words_of


def brute_substrings(rows, window):
    starts = Counter()
    for _, text in rows:
        w = words_of(text)
        starts.update(tuple(w[i:i + window]) for i in range(len(w) - window + 1))
    out = []
    for doc_id, text in rows:
        w = words_of(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window, seed, limit", [(35, 8, None), (12, 4, 0), (1, 1, None)])
def test_substring_dedup(make_docs, corpus, window, seed, limit):
    got = substring_dedup.remove_repeats(make_docs(corpus), window=window, seed=seed, limit=limit)
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()), key=repr)
    assert got == brute_substrings(corpus, window)


def test_substring_dedup_of_nothing(make_docs):
    assert substring_dedup.remove_repeats(make_docs([])).collect() == []
    with pytest.raises(ValueError):
        substring_dedup.repeated_spans(make_docs([(1, "a")]), window=3, seed=4)


def brute_components(rows, k, num, den):
    sets = []
    for _, text in rows:
        w = words_of(text, lower=True)
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)].append(doc_id)
    return sorted(((doc_id, len(sets[i]), min(least[find(i)], default=None)) for i, (doc_id, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("k, num, limit", [(3, 90, None), (5, 80, 0), (2, 50, None)])
def test_ngram_jaccard(make_docs, corpus, k, num, limit):
    got = ngram_jaccard.similarity_components(make_docs(corpus), k=k, num=num, den=100, limit=limit).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_components(corpus, k, num, 100)


def test_ngram_jaccard_of_large_blocks(make_docs, monkeypatch):
    """Blocks dealt in chunks lose no link."""
    import random

    rng = random.Random(2)
    base = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(40)] = f"x{rng.randrange(30)}"
        rows.append((i, " ".join(words)))
    monkeypatch.setattr(ngram_jaccard, "BLOCK_MEMBERS", 7)
    got = ngram_jaccard.similarity_components(make_docs(rows), k=3, num=70, den=100).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_components(rows, 3, 70, 100)


@pytest.mark.parametrize("caps", [(None,), (1, None)])
def test_ngram_jaccard_rounds(make_docs, corpus, monkeypatch, caps):
    """Whatever the rounds, the last one leaves no pair."""
    monkeypatch.setattr(ngram_jaccard, "CAPS", caps)
    rows = [r for r in corpus if r[0] is not None and (r[0] < 20 or 200 <= r[0] < 230)]
    got = ngram_jaccard.similarity_components(make_docs(rows), k=2, num=60, den=100).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_components(rows, 2, 60, 100)


def test_ngram_jaccard_group_just_below(make_docs, monkeypatch):
    """A group of near copies names no more rows than its blocks have members, though most of its
    pairs may be similar by their signatures; two components meet in one link."""
    import random

    rng = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(150):
        words = list(base)
        for at in rng.sample(range(300), 16):
            words[at] = f"x{rng.randrange(30)}"
        rows.append((i, " ".join(words)))
    seen = {}

    def counted(df, name="materialized", write=ngram_jaccard.materialize):
        table = write(df, name)
        seen.setdefault(name, []).append(table.counted_rows)
        return table

    monkeypatch.setattr(ngram_jaccard, "materialize", counted)
    got = ngram_jaccard.similarity_components(make_docs(rows), k=3, num=75, den=100).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == brute_components(rows, 3, 75, 100)
    members = seen["blocks"][0] + sum(seen.get("open_blocks", []))
    assert len(seen["open_pairs"]) > 1  # the first round leaves some
    assert sum(seen["open_pairs"]) <= members + len(seen["open_pairs"]) * members / 2
    assert max(seen["open_pairs"][1:]) <= seen["open_blocks"][0]


def test_keep_one_of_each_group(make_docs, corpus):
    docs = make_docs(corpus)
    kept = ngram_jaccard.keep_one(docs, k=5, num=80, den=100)
    assert kept.columns == docs.columns
    components = brute_components(corpus, 5, 80, 100)
    expected = {c for d, n, c in components if n and c is not None}
    got = [r.doc_id for r in kept.collect()]
    assert expected <= set(got) and got.count(500) <= 1
    assert {d for d, n, _ in components if not n and d is not None} <= set(got)
    assert ngram_jaccard.keep_one(make_docs([])).collect() == []


def brute_suffixes(rows, passage):
    first, count = {}, Counter()
    unique = sorted({r for r in rows}, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    for doc_id, text in unique:
        w = words_of(text)
        for i in range(len(w) - passage + 1):
            key = tuple(w[i:i + passage])
            first.setdefault(key, (doc_id, text, i))
            count[key] += 1
    out = {}
    for doc_id, text in unique:
        w = words_of(text)
        repeated, removed = set(), set()
        for i in range(len(w) - passage + 1):
            key = tuple(w[i:i + passage])
            if count[key] > 1:
                repeated.update(range(i, i + passage))
                if first[key] != (doc_id, text, i):
                    removed.update(range(i, i + passage))
        if repeated:
            out[(doc_id, text)] = (repeated, removed)
    return out


def covered(flat):
    return {w for a, b in zip(flat[::2], flat[1::2]) for w in range(a, b)}


def suffix_repeats(make_docs, rows, **how):
    from pyspark.sql import functions as F

    digest = {(r.doc_id, r.h): r.text for r in make_docs(rows, False).select("doc_id", F.xxhash64("text").alias("h"), "text").collect()}
    return {(r.doc_id, digest[(r.doc_id, r.h)]): (covered(r.repeated), covered(r.removed))
            for r in suffix_dedup.repeats(make_docs(rows), **how).collect()}


@pytest.mark.parametrize("passage, seed, limit", [(50, 10, None), (12, 5, 0), (3, 3, None)])
def test_suffix_repeats(make_docs, corpus, passage, seed, limit):
    assert suffix_repeats(make_docs, corpus, passage=passage, seed=seed, limit=limit) == brute_suffixes(corpus, passage)


def test_suffix_repeats_extend_to_both_sides(make_docs):
    """Neighbours that share most to the right are not those that share most to the left."""
    import random

    rng = random.Random(11)
    core = [f"c{i}" for i in range(5)]
    left = [[f"l{s}x{i}" for i in range(30)] for s in range(3)]
    right = [[f"r{s}x{i}" for i in range(30)] for s in range(3)]
    rows = []
    for i in range(240):
        a, b = rng.randint(0, 25), rng.randint(0, 25)
        own = [f"u{i}"]
        rows.append((i, " ".join(own + rng.choice(left)[30 - a:] + core + rng.choice(right)[:b] + own)))
    for chunk_rows in (1, 7, 8192):
        assert suffix_repeats(make_docs, rows, passage=14, seed=4, chunk_rows=chunk_rows) == brute_suffixes(rows, 14)


def test_suffix_repeats_of_one_passage_everywhere(make_docs, corpus):
    """A passage in most documents fills chunks and partitions; its copies are told apart all the same."""
    passage = " ".join(f"p{i % 61}" for i in range(80))
    rows = corpus + [(1000 + i, f"a{i} {passage} b{i % 7} " + f"c{i} d{i}" * (i % 5)) for i in range(400)]
    rows += [(None, passage), (3000, passage + " x " + passage)]
    assert suffix_repeats(make_docs, rows, passage=20, seed=6, chunk_rows=16) == brute_suffixes(rows, 20)


def test_cut_keeps_the_rest_as_it_is(make_docs, corpus):
    docs = make_docs(corpus)
    out = suffix_dedup.cut(docs, passage=50)
    assert out.columns == docs.columns
    expected = brute_suffixes(corpus, 50)
    texts = Counter((r.doc_id, r.text) for r in out.collect())
    want = Counter()
    for doc_id, text in corpus:
        removed = expected.get((doc_id, text), (None, set()))[1]
        if not removed:
            want[(doc_id, text)] += 1
    assert not want - texts
    for r in out.collect():
        assert r.n_chars == (None if r.text is None else len(r.text)) and r["spans"] == "s"
    assert suffix_dedup.cut(make_docs([])).collect() == []
    assert suffix_dedup.repeats(make_docs([(1, None), (None, "a")])).collect() == []


def test_shingles_of_one_set_are_left_out_before_the_shuffle(spark):
    """Of the rows whose shingle is shared none is lost, of the others few reach the semi join."""
    from pyspark.sql import functions as F

    spread = spark.range(200_000).select(F.xxhash64("id").alias("token"), F.lit(1).alias("n"))
    shared = spark.range(0, 200_000, 100).select(F.xxhash64("id").alias("token"))
    likely = ngram_jaccard._likely(spread, shared)
    assert likely.join(shared, "token", "left_semi").count() == 2000
    assert likely.count() < 2000 + 200
    plan = likely.join(shared.hint("merge"), "token", "left_semi")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("SortMergeJoin") < plan.index("BroadcastHashJoin")  # the bitmap first, below the other join
