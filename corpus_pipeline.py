"""A pipeline over ``documents``: each stage applies one operator to all rows that the stage before it kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skeindex.llm import lines, mixing, packing, quality, simhash
from skeindex.llm.common import session_of
from skeindex.session import shared_dir


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the attention-based classifier scores at least 0.3; it learns from table ``labels``."""
    session_of(spark)
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts the lines that repeated windows of three lines cover; documents stay, if need be without text."""
    session_of(spark)
    return lines.deduplicated(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of SimHash near-duplicates (4-word shingles, at most 4 differing bits)."""
    session_of(spark)
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents by source, weights 1, 2, 3 in turn; a document can be taken up to three times."""
    session_of(spark)
    return mixing.mixed_documents(docs)


def pack_powers(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts the documents into sequences of power-of-two lengths, with their token ids."""
    session_of(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mix_sources", mix_sources),
    ("pack_powers", pack_powers),
]

# The classifier's training is iterative, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written as Parquet and read again."""
    session_of(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline/{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
