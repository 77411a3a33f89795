"""Corpus pipeline: from raw documents to the training stream in pieces.

STAGES are applied in order.  Each stage takes (spark, docs, sf_dir), works on
every row its predecessor kept, and is written as Parquet and reread before the
next one starts, so a lost executor never costs more than its own stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelkit.llm import curriculum, language_id, pieces, recompression, simhash
from panelkit.llm.common import materialize, release, released, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is recognised."""
    return language_id.keep_known(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: 3-word shingles, 2 bits."""
    return simhash.keep_one(docs, shingle=3, radius=2)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-word passages that an earlier document has."""
    return recompression.remove_repeats(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training stream: sources at their target weights, in curriculum order."""
    return curriculum.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the stream, with the proof of the round trip."""
    return pieces.encode_documents(docs)


STAGES = [
    ("language_id", known_language),
    ("simhash_dedup", distinct_documents),
    ("substring_dedup", without_repeats),
    ("source_mix", mixed),
    ("sentencepiece", encoded),
]

#: Trained models, fingerprints and automata are beyond SQL; tests check the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage.  A stage's own tables, and its input, go when its output is written."""
    docs, written = table(spark, sf_dir, "documents"), False
    for name, stage in STAGES:
        with released() as keep:
            out = materialize(stage(spark, docs, sf_dir), name)
            keep(out)
        if written:
            release(docs)
        docs, written = out, True
    return docs
