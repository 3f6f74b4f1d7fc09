import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lapsewise.llm import importance, lexical_search, mixing
from lapsewise.llm.common import attach

from .conftest import words_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


@pytest.fixture(scope="module")
def items(spark, corpus):
    """Benchmark items: parts of the corpus, odd ones, a repeated row, one id with two texts."""
    rows = [(i, " ".join((corpus[i][1] or "").split()[:12])) for i in range(0, 30, 3)]
    rows += [(90, None), (91, ""), (92, "zzz unseen"), (93, "A b, a-b c"), (93, "d e d e"), (0, rows[0][1]), (94, "Äpfel ÖL"), (95, "la")]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "item_id int, text string, q int, doc_id string"), rows


def wanted_sample(rows, target, longest, buckets, percent, least):
    def features(text):
        ws = terms_of(text)
        return [" ".join(ws[i:i + n]) for n in range(1, longest + 1) for i in range(len(ws) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in features(t))
    g = Counter(bucket(f) for t in target for f in features(t))
    S, T = sum(s.values()), sum(g.values())
    out = []
    for doc_id, text in rows:
        fs = features(text)
        total = sum(math.floor(1000 * math.log((g[bucket(f)] + 1) * (S + buckets) / ((s[bucket(f)] + 1) * (T + buckets)))) for f in fs)
        weight = total // len(fs) if fs else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc_id, len(fs), weight, score, len(terms_of(text))))
    fit = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = fit[: percent * len(fit) // 100]
    ranks = defaultdict(list)
    for i, r in enumerate(drawn):
        ranks[r].append(i + 1)
    return [(*r[:4], ranks[r].pop() if ranks[r] else None) for r in out], len(drawn)


def nulls_last(rows):
    return sorted(rows, key=lambda r: [(x is None, x or 0) for x in r])


@pytest.mark.parametrize("longest,percent", [(1, 10), (1, 100), (3, 35)])
def test_resampling_by_brute_force(make_docs, corpus, items, longest, percent):
    rows = [(i, t) for i, t, *_ in corpus] + [(600 + i, "Same words, many times. " * 9) for i in range(30)] + [(700, "same row " * 12)] * 40
    got = importance.resample(make_docs(rows), items[0], longest=longest, percent=percent).collect()
    out = nulls_last(tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in got)
    want, drawn = wanted_sample(rows, [t for _, t in items[1]], longest, 10_000, percent, 20)
    assert out == nulls_last(want)
    assert sorted(r[4] for r in out if r[4]) == list(range(1, drawn + 1))


def test_resampling_of_empty_tables(spark, make_docs, items):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert importance.resample(empty, items[0]).collect() == []
    got = importance.resample(make_docs([(i, "a b c d " * 6) for i in range(20)]), items[0].limit(0)).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2] and len(got) == 20


def test_words_of_sliced_columns():
    texts = ["Ünë B c", None, "", "é ÉÉ x1", "--", "yy ZZZ\x00q"] * 40
    for column in (pa.array(texts), pa.array(texts, pa.large_string())):
        flat, counts = importance.words(column.slice(7, 100))
        want = [terms_of(t) for t in texts[7:107]]
        assert flat.to_pylist() == [w for ws in want for w in ws] and counts.tolist() == [len(w) for w in want]


def wanted_ranking(rows, items, k):
    docs = [(i, terms_of(t)) for i, t in rows]
    N, L = sum(1 for _, w in docs if w), sum(len(w) for _, w in docs)
    df = Counter(w for _, ws in docs for w in set(ws))
    out = []
    for item, text in sorted({(i, t) for i, t in items if t}, key=str):
        scored = []
        for doc_id, ws in docs:
            tf = Counter(ws)
            m = 25 + (75 * len(ws) * N) // L
            score = sum(c * math.floor(1000 * math.log((2 * N + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 8 * m))
                        for w, c in Counter(terms_of(text)).items() if tf[w])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item, r + 1, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k])]
    return nulls_last(out)


@pytest.mark.parametrize("shard_rows,query_bytes", [(None, 4 << 20), (64, 4 << 20), (7, 300)])
def test_search_by_brute_force(make_docs, corpus, items, shard_rows, query_bytes, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK", 5)
    rows = [(i, t) for i, t, *_ in corpus] + [(600 + i, corpus[3][1] + " x") for i in range(40)]
    got = lexical_search.search(make_docs(rows).repartition(3), items[0], shard_rows=shard_rows, query_bytes=query_bytes).collect()
    assert nulls_last((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in got) == wanted_ranking(rows, items[1], 10)


def test_blocks_are_skipped_by_their_bounds():
    rng = np.random.default_rng(1)
    near = [f"topic{g} " + " ".join(rng.choice([f"w{g}{i}" for i in range(30)], 20)) + " common" for g in range(20) for _ in range(40)]
    table = pa.table({"text": pa.array(near)})
    asked = lexical_search.Queries([" ".join(near[5].split()[:6]) + " common"])
    flat, counts = importance.words(table.column("text").combine_chunks())
    place = {t: i for i, t in enumerate(asked.terms)}
    own = [[place[w] for w in t.split() if w in place] for t in near]
    table = pa.table({"doc_id": pa.array(range(len(near))), "n": pa.array(counts),
                      "terms": pa.array([sorted(set(o)) for o in own], pa.list_(pa.int32())),
                      "tfs": pa.array([[o.count(x) for x in sorted(set(o))] for o in own], pa.list_(pa.int32()))})
    shard = lexical_search.Shard(table, np.array([3000 if t != "common" else 1 for t in asked.terms]), len(near), int(counts.sum()))
    scores = shard.x[:, asked.cols[0]] @ asked.times[0]
    least = np.array([np.sort(scores)[-10]])
    opened = shard.candidates(asked, least, False)[0]
    assert set(np.flatnonzero(scores >= least[0])) <= set(opened) and len(opened) < len(near) / 4


def test_search_of_empty_tables(spark, make_docs, items):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lexical_search.search(empty, items[0]).collect() == []
    assert lexical_search.search(make_docs([(1, None), (2, "--")]), items[0]).collect() == []
    assert lexical_search.search(make_docs([(1, "a b")]), items[0].limit(0)).collect() == []


def wanted_targets(sizes, share, weights, most):
    """By bisection of the common level."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    low, high = 0.0, 1e9
    for _ in range(200):
        mid = (low + high) / 2
        if sum(min(most * sizes[s], mid * w[s]) for s in sizes) < share * sum(sizes.values()):
            low = mid
        else:
            high = mid
    return {s: min(most * sizes[s], high * w[s]) for s in sizes}


def mixed(docs, **how):
    return [(r.doc_id, r.source, r.size, r.source_size, r.target, r.taken) for r in mixing.mix(docs, **how).collect()]


def test_mixing(make_docs, corpus):
    rng = np.random.default_rng(2)
    sources = ["hot"] * 6 + ["b", "Z", "é", "zz", None, "one"]
    rows = [(i, t, "en", sources[int(rng.integers(len(sources) - 1))]) for i, t, *_ in corpus * 3]
    rows += [(9000, "single big " * 500, "en", "one"), (9001, None, "en", "none"), (9002, "", "en", "none")]
    rows += [(9100, "w " * 11, "en", "same")] * 200                                   # rows alike in every column
    docs = make_docs(rows)
    got = mixed(docs)
    again = mixed(docs.repartition(5))
    assert sorted(got, key=str) == sorted(again, key=str) and len(got) == len(rows)
    assert sorted(((i, s, len(words_of(t))) for i, t, _, s in rows), key=str) == sorted((r[:3] for r in got), key=str)
    sizes, taken, target = Counter(), Counter(), {}
    for _, s, size, total, goal, words in got:
        sizes[s] += size
        taken[s] += words
        target[s] = goal
        assert words in (0, size, 2 * size)
    assert all(r[3] == sizes[r[1]] for r in got)
    want = wanted_targets(sizes, 1.5, (5, 2, 1), 2)
    for s in sizes:
        assert target[s] == pytest.approx(want[s], rel=1e-9)
        smallest = min((r[2] for r in got if r[1] == s and r[2]), default=0)
        assert abs(taken[s] - target[s]) <= max(1e-3 * target[s], smallest, 1)


def test_mixing_follows_thresholds_of_the_hash(spark, make_docs):
    """Whole thresholds by hand: the first documents in order of their places."""
    rows = [(i, "w " * (1 + i % 50), "en", "ab"[i % 2]) for i in range(400)]
    docs = make_docs(rows)
    got = {r[0]: r for r in mixed(docs, share=0.6, weights=(3, 1), most=1)}
    places = {r.doc_id: r.h for r in mixing.sized(docs).collect()}
    for s in "ab":
        own = sorted((i for i in got if got[i][1] == s), key=lambda i: places[i])
        left, cap, low, want = got[own[0]][4], math.inf, -1, set()
        slack = 1e-3 * left
        while True:
            for n, i in enumerate(own):
                if n > low and got[i][2] <= cap:
                    if got[i][2] > left:
                        break
                    left -= got[i][2]
                    want.add(i)
            else:
                break
            low, cap = n - 1, left
            if left <= slack or left < 1:
                break
        spare = sorted((got[i][2], places[i], i) for i in own if i not in want and 0 < got[i][2] < 2 * left)
        want |= {spare[0][2]} if spare else set()
        assert {i for i in own if got[i][5]} == want


def test_mixing_of_empty_and_wordless_tables(spark, make_docs):
    assert mixed(spark.createDataFrame([], "doc_id long, text string, source string")) == []
    assert mixed(make_docs([(1, None), (2, " ")])) == [(1, "s0", 0, 0, 0.0, 0), (2, "s0", 0, 0, 0.0, 0)]


def test_mixing_takes_shuffle_joins_beyond_the_limit(make_docs, corpus, monkeypatch):
    docs = make_docs([(i, t, "en", "ab"[n % 2]) for n, (i, t, *_) in enumerate(corpus)])
    want = sorted(mixed(docs), key=str)
    monkeypatch.setattr(mixing, "attach", lambda left, right, keys, how="left": attach(left, right, keys, how, limit=0))
    assert sorted(mixed(docs), key=str) == want


def test_mixing_plan_is_native(make_docs, corpus):
    plan = mixing.mix(make_docs([(i, t, "en", "s") for i, t, *_ in corpus]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
