"""One registered query per operator of this package, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm import bpe, fingerprints, hard_negatives, language_id, minhash, mixture, oracle, personal_data, pseudo_likelihood, quality_rules, resampling, shards, suffix_dedup, warc
from stratum.session import prepare


def tokenizer_path() -> str:
    """The byte-level BPE of the installed tokenizer files."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprinted(_table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.sharded(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return pseudo_likelihood.score(documents, pseudo_likelihood.fit(documents))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(_table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(documents, tokenizer_path(), decoded="decoded").select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.rated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mixed(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts are of base spans; ``spans`` has the added ones too."""
    documents = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal_data.find(documents, personal_data.fit(documents))
    named = lambda rows: F.array_join(F.transform(rows, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = found.withColumn("base", F.filter("spans", lambda s: s["base"]))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in personal_data.KINDS]
    return base.select("doc_id", *counts, F.sha2(named(F.col("base")), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(rows.withColumn("label", moved))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    known = (
        op1_scaled_sketch, op2_suffix_dedup, op3_byte_shards, op4_pseudo_likelihood, op5_language_id, op6_bpe, op7_warc,
        op8_quality_rules, op9_mixture, op10_minhash, op11_resampling,
        op12_personal_data, op13_hard_negatives,
    )
    return {f.__name__: f for f in known}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_byte_shards": oracle.OP3_BYTE_SHARDS, "op9_mixture": oracle.OP9_MIXTURE,
        "op11_resampling": oracle.OP11_RESAMPLING, "op13_hard_negatives": oracle.OP13_HARD_NEGATIVES,
    }
