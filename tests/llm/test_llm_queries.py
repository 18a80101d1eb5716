"""The registered queries of this part: SQL where there is one, and the columns and rows of all."""

import pytest
from compare import duck, duck_bag, spark_bag

import corpus_pipeline
from tributary.llm.oracle import ORACLE_SQL
from tributary.llm.queries import QUERIES

COLUMNS = {
    "op1_url_filter": ["page_id", "host", "path", "rule", "verdict"],
    "op2_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op3_mil_quality": ["doc_id", "held_out", "score", "predicted"],
    "op4_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op5_mixing": ["doc_id", "size", "source_size", "target", "taken"],
    "op6_simhash_dedup": ["doc_id", "fingerprint", "component_id"],
    "op7_norm_topk": ["query_id", "rank", "vec_id", "score"],
    "op8_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op9_sentencepiece": ["doc_id", "n_pieces", "ids", "round_trip"],
    "op10_token_counts": ["doc_id", "n_tokens"],
    "op11_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op12_vector_codes": ["vec_id", "code", "error", "label_error", "codebooks_sha256"],
    "op13_merkle_manifest": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
}


def test_all_are_registered():
    assert QUERIES.keys() == COLUMNS.keys()


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, sf, name):
    assert QUERIES[name](spark, sf).columns == COLUMNS[name]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, sf, name):
    expected, columns, _ = duck_bag(duck(sf), ORACLE_SQL[name])
    df = QUERIES[name](spark, sf)
    assert sorted(df.columns) == sorted(columns)
    assert spark_bag(df) == expected
    assert expected


def test_pipeline(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in docs.select("doc_id").collect()}


def test_stages_keep_the_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60).withColumnRenamed("lang", "doc")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
