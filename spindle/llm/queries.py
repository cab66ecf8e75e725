"""The registered queries of the text operators: thin forms over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spindle.llm import bpe, cws, katz, langid, licenses, mixing, packed, pii, prefixtree, quality, sharding, simhash, treap
from spindle.llm.common import documents
from spindle.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES", "tokenizer_path"]

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(documents(spark, sf_dir))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=3, radius=3)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicate(documents(spark, sf_dir))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_texts(documents(spark, sf_dir))


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cws.next_likeness(documents(spark, sf_dir))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(documents(spark, sf_dir)).drop("key")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir), tokenizer_path())


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treap.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtree.join(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_license_scans, op2_language_id, op3_simhash_near_dedup, op4_source_mixing, op5_lm_scoring,
        op6_document_fingerprints, op7_quality_rules, op8_pii, op9_sharding, op10_bpe,
        op11_ranked_search, op12_hard_negatives, op13_ngram_jaccard_join)
}
