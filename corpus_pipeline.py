"""Corpus pipeline: documents -> quality rules -> near-duplicate removal -> mixing -> token ids.

Each stage works on all rows that its predecessor wrote, and all but the last return the columns of documents.

Defined results: null texts have no words and go in the first stage, as do texts of fewer than 10 words; null doc_id, lang and source are values like
any other (ids: last of a group, so a known one stays; sources: last in order); of rows equal in all columns one stays in the second stage; an
empty table gives empty tables; extra columns pass by, whatever their names, up to the last stage. Very long texts are worked on whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tilewright.llm import mixing, quality, queries, simhash, word_bpe
from tilewright.session import materialize, spread, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or their group's thresholds go."""
    return quality.keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.drop_near_duplicates(docs)


def pareto_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it."""
    return mixing.repeat_documents(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row."""
    return word_bpe.encode_decode(docs, queries.WORD_BPE, digest=True)


STAGES = [("quality_rules", quality_rules), ("simhash_near_dedup", simhash_near_dedup), ("pareto_mixing", pareto_mixing), ("bpe_encoding", bpe_encoding)]

#: Fingerprints and merges are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
