"""Corpus pipeline: each stage applies one operator to what its predecessor kept."""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderlens.llm import exact_dedup, mixing, ngram_join, piece_encoding, quality  # noqa: E402
from orderlens.llm.common import Scratch, table  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the log-likelihood ratio keep; null, empty and short texts go."""
    return quality.keep(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one that a digest index holds after it took the
    documents in batches of falling ids.  Null text equals empty text; of repeated rows one stays."""
    scratch = Scratch(spark, "pipeline-exact")
    index = exact_dedup.DigestIndex(spark, scratch.path("index"))
    _, held = exact_dedup.load_falling(docs, index, scratch)
    held = scratch.write(held, "held")
    index.close()
    return exact_dedup.drop_duplicates(docs, held)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (word 5-gram Jaccard similarity of 0.8 or more); texts without
    a word are no copies of each other."""
    return ngram_join.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes; a null source is a source, a text without words goes."""
    mixed = mixing.mix(docs, F.array("source"), mixing.word_count(F.col("text")),
                       mixing.seeded_key(F.col("doc_id"), text=F.col("text")), docs.columns)
    return mixed.select(*docs.columns, F.explode("copies").alias("copy_source")).select(*docs.columns)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text; null text has none."""
    return piece_encoding.round_trip(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact),
    ("ngram_join", near_copies),
    ("mix_sources", mix_sources),
    ("piece_encoding", encode_pieces),
]

#: SQL has neither the hashes of the ratio and the MinHash bands nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        if before:
            scratch.drop(before)
        before = name
    return docs
