"""The queries of this subpackage, with production parameters over whole tables: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm import bit_slices, divergence, hash_tree, html_main, mixing, quality, simhash, token_counts, token_files, toxicity, url_filters, vector_codes, word_bpe
from tilewright.session import spread, table

#: Fixed values of the contract: explicit rules of op1 and the number of shards of op4.
URL_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]
SHARDS = 8
#: The public vocabulary files; operators take a path.
BYTE_BPE, WORD_BPE = map(public_tokenizers.path, ("byte_bpe_50k.json", "word_bpe_49k.json"))


def _rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole table; one that is a single file or few is dealt out over the cores."""
    return spread(table(spark, sf_dir, name))


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are made from documents: the number in a page's path names the document whose labels are the page's outcome (bad: low quality or toxic)."""
    pages, labels = _rows(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").alias("key"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int").alias("bad"))
    number = F.expr("try_cast(nullif(regexp_extract(path, '^/[^/]+/([0-9]+)', 1), '') as bigint)")
    return url_filters.judge_urls(pages, outcomes, URL_RULES, number)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write_token_files(_rows(spark, sf_dir, "documents"), BYTE_BPE)
    return token_files.read_token_files(files, spark)


def op3_simhash_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_rows(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex(F.col("bands")[0]), 16, "0")).alias("fingerprint"), "component_id")


def op4_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.shard_documents(_rows(spark, sf_dir, "documents"), hash_tree.HashTree.uniform(SHARDS))


def op5_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(_rows(spark, sf_dir, "documents"))


def op6_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_slices.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.length_histogram(token_counts.encoded_lengths(_rows(spark, sf_dir, "documents"), BYTE_BPE))


def op8_bpe_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.encode_decode(_rows(spark, sf_dir, "documents"), WORD_BPE, digest=True)


def op9_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.main_text(_rows(spark, sf_dir, "pages"))


def op10_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_rows(spark, sf_dir, "documents"))


def op11_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_rows(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_delta_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_report(_rows(spark, sf_dir, "embeddings"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_rows(spark, sf_dir, "documents"))


def queries() -> dict:
    return {name: f for name, f in globals().items() if name.startswith("op")}
