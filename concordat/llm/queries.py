"""The operators over the test tables, with production parameters; SQL where it gives the same rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, embeddings, licenses, linededup, lm, mixing, packing, passages, pii, quality, sharding, simhash, variants

#: The public vocabulary of the packing contract, as ranks: the same ids as its tokenizer file.
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 16)


def op2_simhash_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.simhash_components(table(spark, sf_dir, "documents"), width=4, bits=4)
    return rows.select("doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op3_poisson_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.poisson_mixture(table(spark, sf_dir, "documents"))


def op4_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op5_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(table(spark, sf_dir, "documents")).drop("host_rate")


def op6_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op7_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op8_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), RANKS, PATTERN)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_deleted")


def op10_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_components(table(spark, sf_dir, "embeddings"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = variants.frequent_words(table(spark, sf_dir, "documents"), least_letters=5, least_count=3, drop_one_in=97)
    return variants.spelling_variants(words, ratio=2)


def op12_passage_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.7, train_rows=4000)


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mined_phrases(table(spark, sf_dir, "documents"), threshold=10, share=50, top=2000)


QUERIES = {
    f.__name__: f
    for f in (
        op1_rendezvous_shards, op2_simhash_bytes, op3_poisson_mixture, op4_license_digests, op5_host_quality,
        op6_crf_pii, op7_masked_lm, op8_window_packing, op9_line_runs, op10_cross_polytope, op11_spelling_variants, op12_passage_attention, op13_phrase_mining,
    )
}
ORACLES = {
    "op3_poisson_mixture": mixing.mixture_sql(columns="doc_id, text, lang, source, n_chars"),
    "op4_license_digests": licenses.licenses_sql(),
    "op5_host_quality": quality.quality_sql(),
    "op9_line_runs": linededup.line_dedup_sql(),
    "op13_phrase_mining": collocations.phrases_sql(),
}
