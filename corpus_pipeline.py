"""A training corpus from ``documents``: toxicity, near duplicates, repeated passages, secrets, packing.

Each stage works on all that its predecessor kept; all but the last return the columns of their input, whatever their names.

Defined results: a null or empty text is kept by all stages and packed as its end id alone; rows with a null id, equal ids or equal rows
are judged row by row, but of rows of one id and text that has words one stays; an empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortry.llm import ngram_join, packing, queries, secret_scan, substring, toxicity
from cohortry.llm.common import saved, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score is under 0.3; the model is fitted on the labelled rows among ``docs``."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles at 0.8 the first row by doc_id (null last) and text hash, and every other row without words."""
    return ngram_join.first_rows(docs, k=5, percent=80)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without words of 50-word windows that a document with a smaller doc_id holds."""
    return substring.remove_repeats(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with a mark in place of each secret."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens."""
    return packing.pack(docs, queries.vocabulary_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, name)
    return docs
