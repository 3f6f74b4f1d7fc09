"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.llm import (
    decontamination, html_extract, importance, language_id, lexical_search, mixing, ngram_jaccard, orc_output, packing,
    quality_bayes, substring_dedup, suffix_dedup, vp_search,
)
from lapsewise.llm.common import table
from lapsewise.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle.strip()
        return fn

    return wrap


@register("op8_substring_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words that windows of 35 repeated words cover."""
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op7_ngram_jaccard")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingles overlap by 90 %."""
    out = ngram_jaccard.similarity_components(table(spark, sf_dir, "documents"), k=3, num=90, den=100)
    return out.select("doc_id", "n_shingles", "component_id")


@register("op4_best_fit_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of 1024 ids."""
    return packing.pack(table(spark, sf_dir, "documents"), capacity=1024, end_id=2).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@register("op5_token_ids_orc")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents written to ORC and read back."""
    path = scratch_path(spark, "token_ids.orc")
    orc_output.write_ids(table(spark, sf_dir, "documents"), path, end_id=0)
    return orc_output.digests(orc_output.read_ids(spark, path))


@register("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those not held out."""
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(~language_id.held_out()))
    return language_id.predict(docs, model).select(
        "doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


@register("op1_html_extraction")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page by its host's consensus path."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


@register("op6_vp_tree_search")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest rows of every 50th vector, by exact vantage-point search."""
    vectors = table(spark, sf_dir, "embeddings")
    return vp_search.search(vectors, vectors.where("vec_id % 50 = 0"), k=5, factor=1.0)


@register("op3_benchmark_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, verbatim or re-parameterised."""
    return decontamination.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "n_matched", "n_windows", "verbatim", "start")


@register("op2_suffix_array_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages of 50 words or more that repeat, and where."""
    found = suffix_dedup.repeats(table(spark, sf_dir, "documents"), passage=50)
    pairs = lambda c: F.transform(F.sequence(F.lit(0), (F.size(c) / 2).cast("int") - 1), lambda i: F.struct(
        F.get(c, (2 * i).cast("int")).alias("start"), F.get(c, (2 * i + 1).cast("int")).alias("end")))
    empty = F.array().cast("array<struct<start:int,end:int>>")
    return found.select(
        "doc_id", pairs(F.col("repeated")).alias("repeats"),
        F.when(F.size("removed") > 0, pairs(F.col("removed"))).otherwise(empty).alias("removed"))


@register("op9_quality_bayes")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and toxicity of every document, by text, source and language section."""
    return quality_bayes.classify(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), host=F.col("source"),
        path=F.concat_ws("/", "source", "lang"))


# CRC-32 of a word's UTF-8 bytes: a table of 256 remainders by the reflected polynomial
# 0xEDB88320, then one step a byte.
_CRC_ROWS = """
crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::BIGINT] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) r(i))),
crcs AS (
  SELECT w, xor(list_reduce([4294967295::BIGINT] || list_transform(range(octet_length(encode(w))),
      lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT),
      lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 10000 AS bucket
  FROM spelled, crc_table)
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _terms(column: str) -> str:
    return _TERMS.format(_LOWER.format(f"coalesce({column}, '')"))


@register("op11_importance_resampling", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms('text')} AS ws FROM documents),
words AS (SELECT r, unnest(ws) AS w FROM d),
goal AS (SELECT unnest({_terms('text')}) AS w FROM benchmark),
spelled AS (SELECT w FROM words UNION SELECT w FROM goal),
{_CRC_ROWS},
src AS (SELECT bucket, count(*) AS s FROM words JOIN crcs USING (w) GROUP BY bucket),
tgt AS (SELECT bucket, count(*) AS t FROM goal JOIN crcs USING (w) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM words) AS all_s, (SELECT count(*) FROM goal) AS all_t),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (all_s + 10000) / ((coalesce(s, 0) + 1)::DOUBLE * (all_t + 10000))))::BIGINT AS g
  FROM src FULL JOIN tgt USING (bucket), totals),
sums AS (SELECT r, sum(g)::BIGINT AS g, count(*) AS n FROM words JOIN crcs USING (w) JOIN gain USING (bucket) GROUP BY r),
scored AS (
  SELECT d.r, doc_id, len(ws) AS n_features, coalesce(floor(g::DOUBLE / n), 0)::BIGINT AS weight,
    ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM d LEFT JOIN sums ON d.r = sums.r),
final AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM scored),
ranked AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS rank
  FROM final WHERE n_features >= 20)
SELECT doc_id, n_features::BIGINT AS n_features, weight, score,
  CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM ranked) THEN rank END AS rank
FROM final LEFT JOIN ranked ON final.r = ranked.r
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn by their likeness to the benchmark's words."""
    return importance.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), longest=1, buckets=10_000, percent=10, least=20, seed=2024)


@register("op12_lexical_search", f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_terms('text')} AS ws FROM documents),
items AS (SELECT row_number() OVER () AS i, item_id, {_terms('text')} AS ws FROM (SELECT DISTINCT item_id, text FROM benchmark)),
totals AS (SELECT count(*) AS N, sum(len(ws))::BIGINT AS L FROM d WHERE len(ws) > 0),
asked AS (SELECT i, w, count(*) AS times FROM (SELECT i, unnest(ws) AS w FROM items) GROUP BY ALL),
postings AS (
  SELECT r, w, count(*) AS tf FROM (SELECT r, unnest(ws) AS w FROM d) WHERE w IN (SELECT w FROM asked) GROUP BY ALL),
weights AS (
  SELECT w, floor(1000 * ln((2 * N + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS weight
  FROM (SELECT w, count(*) AS df FROM postings GROUP BY w), totals),
scores AS (
  SELECT i, r, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(ws)::BIGINT * N) // L))))::BIGINT AS score
  FROM asked JOIN postings USING (w) JOIN weights USING (w) JOIN d USING (r), totals GROUP BY i, r),
ranked AS (
  SELECT i, r, score, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scores JOIN d USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM ranked JOIN items USING (i) JOIN d USING (r) WHERE rank <= 10
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten documents that rank highest for every benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10).select(
        "item_id", "rank", "doc_id", "score")


@register("op13_source_mixing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by source to weights of 5, 2 and 1, at 150 % of their words."""
    return mixing.mix(table(spark, sf_dir, "documents"), share=1.5, weights=(5, 2, 1), most=2).select(
        "doc_id", "size", "source_size", "target", "taken")
