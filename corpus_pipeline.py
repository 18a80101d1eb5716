"""The corpus pipeline: quality, near copies, personal data, mixing, encoding.

Every stage works on all that the stage before it kept, and all but the last return the columns of
``documents``. Stages are written as tables between one another, so a lost executor repeats one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import mil_quality, mixing, pii, sentencepiece_lattice, simhash_dedup
from tributary.llm.common import stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a score of 0.7 or more stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mil_quality.keep_good(docs, labels)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints at two or fewer differing bits stays."""
    return simhash_dedup.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it are generalised or removed."""
    return pii.sanitise(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as the mix takes them."""
    return mixing.mix(docs)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's ids."""
    encoded = sentencepiece_lattice.encode(docs, group_bytes=4 << 20)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", simhash_near_dedup),
    ("pii", personal_data),
    ("mixing", mixing_sources),
    ("sentencepiece", sentencepiece_encoding),
]
#: Attention weights and lattices are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return last(spark, docs, sf_dir)
