"""The pipeline's stages, one after another, on a given table."""

from __future__ import annotations

import corpus_pipeline
from stratum.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns, name
        docs = docs.cache()
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] == counts[3]
    coded = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert coded.count() == counts[-1]
    pairs = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
    assert {(r.doc_id, r.decoded) for r in coded.select("doc_id", "decoded").collect()} == pairs


def test_every_operator_is_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.queries())
    assert numbers == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(queries.queries())


#: Queries without SQL: models, signatures and searches, each tested against a direct version, a round trip or accuracy.
WITHOUT_SQL = {
    "op1_scaled_sketch", "op2_suffix_dedup", "op4_pseudo_likelihood", "op5_language_id", "op6_bpe", "op7_warc",
    "op8_quality_rules", "op10_minhash", "op12_personal_data",
}


def test_queries_without_sql_are_listed():
    assert set(queries.queries()) - set(queries.oracle_sql()) == WITHOUT_SQL and corpus_pipeline.ORACLE_SQL is None
