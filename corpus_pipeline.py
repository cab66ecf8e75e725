"""Training-corpus pipeline: each stage reads what its predecessor kept.

Quality rules drop documents, SimHash near-dedup keeps one document of each
component, personal data is redacted, sources are mixed to their target
weights, and the texts are encoded. ``run`` writes each stage's result to the
shared scratch folder, so that a lost executor costs tasks and not stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm import bpe, mixing, pii, quality, simhash
from spindle.llm.common import documents, scratch_table
from spindle.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, radius=3)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redact(docs)
    return clean.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else c for c in clean.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    drawn = "copy" + "_" * max(map(len, docs.columns))  # no column of the documents
    return mixing.replicate(docs, copy=drawn).drop(drawn)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tokenizer = tokenizer_path()
    lexicon = bpe.ship(spark, bpe.build_lexicon(docs, tokenizer))
    coded = bpe.encode_texts(docs, tokenizer, lexicon)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("redact_pii", redact_pii),
    ("mix_sources", mix_sources),
    ("encode_bpe", encode_bpe),
]

# Fingerprint links, boosted trees and merges have no SQL form: tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
