"""Training-corpus pipeline: toxicity, exact dedup, SimHash near-dedup, mixing
to target weights, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; its result is written as Parquet and read again as the next one's input.
All stages but the last return the columns of ``documents``; the last returns
the token ids' count and digests, and the digest of the decoded text.

Defined cases, in every stage: null and empty texts are documents like any other
(the dedup stages keep one of them); texts of any length are read whole; rows keep
their identity, so rows that share a doc_id, or repeat in all columns, are rows of
their own until a dedup stage finds them equal; ties go to the smallest doc_id (exact
dedup: the longest original first); extra columns, whatever their names, are kept as
they are; an empty table passes through as an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from oxbow.llm import bpe, exact_dedup, mixing, simhash, toxicity
from oxbow.llm.common import documents, table
from oxbow.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; the others stay as they are."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by SimHash one document stays."""
    return simhash.drop_near_copies(docs, shingle=3, radius=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document comes out as often as the mix takes it."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document of the mix, repeats included."""
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: The classifier, SimHash and the cube method are beyond SQL: the tests hold
#: run() against a brute-force version of each stage instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
