"""A corpus from raw documents to packed windows: each stage works on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concordat.llm import linededup, mixing, packing, quality, simhash
from concordat.llm.common import stored
from concordat.llm.queries import PATTERN, RANKS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules, of hosts that do."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted; a document whose lines all go stays with an empty text."""
    done = linededup.dedup_lines(docs)
    length = F.when(F.col(done.columns[-1]) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return done.withColumn("n_chars", length).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, which share 0.8 or more of their five-word shingles."""
    return simhash.drop_near_duplicates(docs, width=5, bits=4, similarity=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at equal weights: documents repeated or left out by their Poisson numbers, shuffled."""
    return mixing.poisson_mixture(docs).select(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 1024 tokens, with their ids."""
    return packing.pack_documents(docs, RANKS, PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack_windows", pack_windows),
]

#: Packing by a tokenizer, and near-duplicates by their fingerprints, are beyond SQL; the tests compare them by force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
