"""The corpus pipeline: quality, exact dedup, near dedup, mixing, tokens.

Each stage takes what its predecessor kept, written as Parquet in the shared folder and read again; all but the last
return the columns of `documents`. A mix can take a document several times: it then stands there as often.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from crivo.llm import bpe, exact, mix, near, quality
from crivo.llm.base import table
from crivo.session import checkpoint_folder


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.without_rejected(docs, table(spark, sf_dir, "labels"))


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact.drop_copies(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id. Shingles of five words."""
    return near.first_of_groups(docs, width=5)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of whole texts: doc_id, source, n_tokens, ids_sha256, decoded_sha256."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN, ["doc_id", "source"])


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", no_copies),
    ("near dedup", no_near_copies),
    ("mixing", mixed_sources),
    ("byte bpe", tokens),
]

#: SQL can express neither the classifier nor the tokens; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table documents."""
    docs = table(spark, sf_dir, "documents")
    for step, (_, stage) in enumerate(STAGES):
        out = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}-{step}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
