"""A training-text pipeline: five stages over ``documents``, each one operator of ``msgledger.llm``.

Every stage takes (spark, docs, sf_dir) and returns rows with the columns of ``documents``; the
last returns token pieces. ``run`` writes each stage's rows as Parquet in the shared folder and
reads them again, so a stage never repeats the work before it.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from msgledger.llm import lines, mixing, near, pieces, quality, simhash
from msgledger.llm.common import documents, stage_table
from msgledger.session import ship_package

ship_package()

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _with_text(docs: DataFrame, text: Column) -> DataFrame:
    """The columns of ``documents`` with another text, and its length."""
    docs = docs.withColumn("text", text)
    return docs.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that pass the base rules and the fences of their (lang, source)."""
    return quality.keep_good(docs).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without the lines that three documents or more share, but for the last of them."""
    return _with_text(lines.dedup_lines(docs.select(*COLUMNS), result="__lines"), F.col("__lines.text"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, the one with the smallest doc_id.

    Fingerprints at four bits or fewer go first; of what is left, texts whose five-word shingles have a
    similarity of 0.8 or more, most of which lie further apart than four bits.
    """
    singles = stage_table(simhash.keep_one(docs.select(*COLUMNS)), "pipeline-singles")
    return near.keep_distinct(singles).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as the mix takes them: repeated, left out, or cut where a source's target ends."""
    return _with_text(mixing.mix(docs.select(*COLUMNS)), F.col("text"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the ids of the best segmentation, the scores of the best four, the ids of the second
    to fourth, and whether decoding each gives the text back; one row per row of the mix."""
    done = pieces.encode(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"), others=True)
    return done.select(
        "doc_id", F.col("encoded.pieces").alias("pieces"), F.size("encoded.pieces").cast("bigint").alias("n_pieces"),
        F.col("encoded.scores").alias("scores"), F.col("encoded.n_best").alias("n_best"),
        ((F.col("encoded.decoded") == F.coalesce("text", F.lit(""))) & F.col("encoded.alike")).alias("round_trip"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode_pieces", encode_pieces),
]

# Fingerprints and segmentations have no SQL; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
