"""The corpus pipeline: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept.  ``run`` writes what a stage returns as Parquet in the shared folder and
reads it again as the next one's documents.

Null and empty texts have no letters, so the language stage drops them (a corpus without any
label teaches no language, and all rows stay).  Of rows that repeat doc_id and text one stays
(n-gram join); a null doc_id is a value like any other.  Extra columns are carried through
to the last stage, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lapsewise.llm import decontamination, language_id, ngram_jaccard, packing, suffix_dedup
from lapsewise.llm.common import materialize, small_batches, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus teaches; not those whose language stays open."""
    return language_id.keep_identified(docs, language_id.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at a similarity of 0.8."""
    return ngram_jaccard.keep_one(docs, k=5, num=80, den=100)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words or more that an earlier document has."""
    return suffix_dedup.cut(docs, passage=50)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 ids."""
    return packing.pack(docs, capacity=1024, end_id=2)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("decontamination", decontaminate),
    ("packing", pack_sequences),
]

#: No stage can be stated in SQL; tests/llm compares each with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with small_batches(spark):
        for name, stage in STAGES:
            docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
