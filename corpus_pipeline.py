"""From raw documents to token ids: language, near-duplicates, benchmark leaks, personal data, encoding.

Every stage takes all rows its predecessor kept and returns the columns of ``documents``, but for the last,
which returns ids. Null ids and texts, repeated rows, empty tables and further columns go through; each
operator's docstring says what becomes of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paygrain.llm import byte_bpe, decontaminate, language_id, pii, simhash_dedup
from paygrain.llm.common import table, written


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts that no learned language codes in fewer bits than they have.

    Where no document outside the held-out fifth has a ``lang``, no language is learned and all texts with a letter stay.
    """
    return language_id.keep_languages(docs, language_id.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: three-word shingles, at most three differing bits."""
    return simhash_dedup.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain benchmark items, re-parameterised ones included."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; no document is dropped."""
    return pii.redact_docs(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of tokens, packed ids, and the digest of the text that the ids decode to."""
    both = byte_bpe.round_trip(docs)
    return both.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", languages),
    ("simhash_dedup", near_duplicates),
    ("decontaminate", benchmark_leaks),
    ("pii", personal_data),
    ("byte_bpe", token_ids),
]

#: SQL can express neither code lengths, XXH64 fingerprints nor merges; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
