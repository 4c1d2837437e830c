"""From raw documents to packed training sequences: five stages, each written before the next one reads it.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept: documents that fail the
quality rules go; of each group of near duplicates one stays; bytes that repeat elsewhere are cut; sources
are mixed to their weights; what is left is packed into sequences. All but the last return the columns of
``docs``, extra ones included. An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wavelane.llm import mixing, near_dedup, packing, quality_rules, repeats
from wavelane.llm.common import discard, read, store
from wavelane.llm.queries import WEIGHTS, domain_of_source, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules, learned from ``labels``, keep."""
    return quality_rules.keep_good(docs, quality_rules.fit_from_labels(docs, read(spark, sf_dir, "labels")))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.without_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the bytes of 200-byte strings that start elsewhere too."""
    return repeats.without_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Four fifths of the tokens, spread over domains, languages and sources by weight, each document once."""
    return mixing.select_mix(docs, domain_of_source(), WEIGHTS, share=0.8, max_epochs=1)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("quality rules", quality), ("near dedup", dedup), ("suffix dedup", cut_repeats), ("mixing", mix), ("packing", pack)]

# Learned rules, suffix sorting and bin packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, store(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        discard(before)
    return docs
