"""The registered queries of the training-data operators: each reads its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import (
    decontaminate,
    merkle,
    mil_quality,
    mixing,
    norm_topk,
    pii,
    quality_rules,
    sentencepiece_lattice,
    sharding,
    simhash_dedup,
    token_counts,
    url_filter,
    vector_codes,
)
from tributary.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the fixed rules and by the hosts with a spam word that the table has."""
    pages = table(spark, sf_dir, "pages")
    entries = url_filter.rule_entries(spark).unionByName(url_filter.listed_hosts(pages))
    return url_filter.judge(pages, entries)


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measures and verdict, its host's failure rate included."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words the mix takes from it."""
    mixed = mixing.copies(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards of equal counts, copies together."""
    return sharding.assign(table(spark, sf_dir, "documents")).drop("community")


@query
def op6_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the component its links put it in."""
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score."""
    return mil_quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data, with the terms that disclose it."""
    return pii.report(table(spark, sf_dir, "documents"))


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's number of pieces."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


@query
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, and whether they decode to its text."""
    encoded = sentencepiece_lattice.encode(table(spark, sf_dir, "documents"), verify=True)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "round_trip")


@query
def op7_norm_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best vectors of every fiftieth."""
    return norm_topk.top_k(table(spark, sf_dir, "embeddings"))


@query
def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words that stand in a benchmark passage, and the items these are of."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's code and its error."""
    return vector_codes.report(table(spark, sf_dir, "embeddings"))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, its proof, and whether the proof holds after some documents were changed."""
    return merkle.report(table(spark, sf_dir, "documents"))
