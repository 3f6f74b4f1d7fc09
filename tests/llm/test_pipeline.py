import corpus_pipeline
from lapsewise.llm import language_id
from lapsewise.llm.queries import QUERIES
from tests.llm.conftest import words_of
from tests.llm.test_dedup import brute_components, brute_suffixes


def test_every_operator_has_a_query():
    assert sorted(int(q.split("_")[0][2:]) for q in QUERIES) == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "ngram_jaccard", "suffix_array_dedup", "decontamination", "packing"]


def test_stages_against_brute_force(spark, make_docs, tmp_path):
    from tests.llm.test_text import ITEM, language_rows

    rows = language_rows(150)
    long = [(1000 + i, " ".join(f"thw{(i * 37 + j) % 9973} er" for j in range(90)), "en", "s1") for i in range(6)]
    passage = " ".join(f"ing{j} on" for j in range(40))
    rows += long + [(2000 + i, long[i % 3][1] + " thend", "en", "s1") for i in range(9)]
    rows += [(3000 + i, " ".join(f"wher{(i + 1) * 1000 + j}" for j in range(120)) + " " + passage, "en", "s2") for i in range(4)]
    rows += [(4000, " ".join(f"thon{j}" for j in range(40)) + " " + ITEM, "en", "s2"), (4001, "12 34 !!", "en", "s"), (4002, None, None, None)]
    docs = make_docs(rows, clashing=False)
    sf_dir = str(tmp_path)
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{sf_dir}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)

    found = stages["language_id"](spark, docs, sf_dir)
    assert found.columns == docs.columns
    kept = [tuple(r)[:2] for r in found.collect()]
    letters = {r[0] for r in rows if r[1] and any(c.isalpha() for c in r[1])}
    assert {d for d, _ in kept} <= letters and len(kept) >= 0.97 * len(letters)

    found = stages["ngram_jaccard"](spark, make_docs(kept, clashing=False), sf_dir)
    want = {c for _, _, c in brute_components(kept, 5, 80, 100)}
    assert {r.doc_id for r in found.collect()} == want
    unique = [tuple(r)[:2] for r in found.collect()]

    found = stages["suffix_array_dedup"](spark, make_docs(unique, clashing=False), sf_dir)
    removed = brute_suffixes(unique, 50)
    got = {r.doc_id: r.text for r in found.collect()}
    for doc_id, text in unique:
        gone = removed.get((doc_id, text), (set(), set()))[1]
        assert words_of(got.get(doc_id)) == [w for i, w in enumerate(words_of(text)) if i not in gone]
        assert gone or got[doc_id] == text
    assert sum(passage in t for t in got.values()) == 1

    found = stages["decontamination"](spark, found, sf_dir)
    assert {r.doc_id for r in found.collect()} == set(got) - {4000}

    packed = stages["packing"](spark, found, sf_dir).collect()
    assert {r.doc_id for r in packed} == set(got) - {4000}
    assert max(r.offset + r.length for r in packed) <= 1024
    assert language_id.UNKNOWN == "und"


def test_workers_give_encoders_back_to_other_stages(spark):
    """A task that does not encode drops the encoder that packing left in its Python worker."""
    import pyarrow as pa

    from lapsewise.llm import packing
    from lapsewise.llm.common import released
    from lapsewise.session import ship_package

    ship_package(spark)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string").repartition(8)

    def held(batches):
        from lapsewise.llm import tokens

        rows = sum(b.num_rows for b in batches)
        yield pa.RecordBatch.from_pydict({"n": pa.array([len(tokens._ENCODERS)]), "rows": pa.array([rows])})

    assert packing.pack(docs, capacity=16, end_id=2).count() == 40
    kept = docs.mapInArrow(held, "n long, rows long").collect()
    assert any(r.n for r in kept)
    freed = docs.mapInArrow(released(held), "n long, rows long").collect()
    assert sum(r.rows for r in freed) == 40 and not any(r.n for r in freed)
