"""The training-data pipeline: stages over ``documents``, each written and reread.

``run`` applies the stages in order. Every stage but the last returns the columns
of ``documents``; the last one returns what BPE encoding gives for each kept document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from orderstream.llm import bpe, decontaminate, exact_dedup, near_dedup, quality
from orderstream.llm.common import read_table, written
from orderstream.llm.queries import BPE_FILE


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it learns from labels as operator 1's query does. A document
    without text is judged by its statistics like any other; rows that share an id are judged each."""
    labels = read_table(spark, sf_dir, "labels")
    stats = written(spark, quality.document_statistics(quality.labelled(docs, labels)), "quality-statistics")
    return quality.keep_accepted(docs, quality.fit(stats, labels))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays; null counts as empty, a row without id only stays where no other has one."""
    return exact_dedup.deduplicate(docs, keep="min")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the smallest doc_id stays; texts without words stand alone."""
    return near_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go; without any item none does."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left, a row for each document, repeated ones too."""
    return bpe.encode_digests(docs, public_tokenizers.path(BPE_FILE))


STAGES = [
    ("quality classifier", drop_low_quality),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("BPE encoding and decoding", encode),
]

#: The stages train a model and estimate similarities: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
