"""The corpus pipeline: four stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before kept; its result is written as Parquet and read again.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from potluck.llm import cotraining, packing, simhash, toxicity
from potluck.llm.common import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go (score of 0.5 or more)."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier takes for poor go."""
    return cotraining.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (3-word shingles, 3 bits)."""
    return simhash.keep_one(docs, shingle=3, radius=3)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The layout of what is left in windows of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("near_duplicates", drop_near_copies),
    ("packing", pack_windows),
]

#: The stages learn models and count tokens, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a written table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
