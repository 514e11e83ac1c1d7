"""Corpus pipeline: the stages over ``documents``, each written as Parquet and read
again as the next one's input.

A stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of
``documents``; an empty table goes through as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from factkeeper.llm import bm25_wand, bpe_lexicon, lang_backoff, pii_disclosure, simhash_trie
from factkeeper.llm.common import prepare, stored
from factkeeper.session import scratch_path, scratch_scope


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go whose text has no letter, or whose language is less likely than all others together."""
    prepare(spark)
    return lang_backoff.accepted_stage(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of 4-word-shingle fingerprints within 4 bits stays."""
    prepare(spark)
    return simhash_trie.near_dedup_stage(docs, shingle=4, budget=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    prepare(spark)
    return bm25_wand.decontaminate_stage(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes its kind, and terms that disclose it go."""
    prepare(spark)
    return pii_disclosure.sanitise_stage(docs)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and digests of them and of what they decode to."""
    prepare(spark)
    return bpe_lexicon.encode_stage(docs, bpe_lexicon.default_tokenizer())


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", decontamination),
    ("pii", pii),
    ("bpe", bpe),
]

#: SQL has no XXH64, byte-pair merges or fitted model; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. The tables that they write on their way go with the run."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch_scope(spark):
        for name, stage in STAGES:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        path = scratch_path(spark, "llm-pipeline")
        docs.write.parquet(path)
    return spark.read.schema(docs.schema).parquet(path)
