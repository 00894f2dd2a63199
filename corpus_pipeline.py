"""Corpus pipeline: documents to packed training sequences.

Each stage takes what its predecessor kept, decides, and its decisions take
effect; between the stages the documents are written as Parquet to the shared
folder and read again.  All stages but the last return the columns of
``documents``; the last returns one row per piece with its place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ashgrid.llm import bagminhash, line_dedup, mixing, packing, quality
from ashgrid.llm.common import materialize, table, text_or_empty, words


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep(docs, "doc_id", "text", "lang")


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in 10 documents or more go everywhere; documents stay, even empty."""
    kept = line_dedup.dedup(docs, "doc_id", "text", min_docs=10)
    return kept.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id."""
    return bagminhash.dedup(docs, "doc_id", "text", similarity=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources weigh 1, 2, 3 in turn; a document is repeated at most 3 times."""
    mixed = mixing.mix(docs, F.col("doc_id"), F.col("source"), F.size(words(text_or_empty())), weights=(1, 2, 3), max_repeat=3)
    return mixing.emit(mixed)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens in as few sequences as the program finds."""
    return packing.pack(materialize(packing.pieces(docs, F.col("doc_id"), F.col("text")), "pieces"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_common_lines),
    ("minhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: near duplicates by signatures and a packing program are beyond SQL; the tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
