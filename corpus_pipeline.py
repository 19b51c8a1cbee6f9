"""The corpus pipeline: five stages from raw documents to packed training sequences.

Each stage takes what the one before kept. Stages 1 to 4 return the columns of documents;
the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from sedgemill.llm import language, lines, packing, simhash, templates
from sedgemill.session import written


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a language, or with none that takes half of their words, go."""
    return language.keep_identified(docs, language.fit(docs))


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: blocks that an earlier document has leave the later one; ``n_chars`` follows the text."""
    left = lines.without_common_blocks(docs, lines.common_blocks(docs))
    return left.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else left


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: of each class the document of the smallest id stays."""
    return simhash.keep_first_of_class(docs, simhash.near_duplicates(docs, width=3, radius=3))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark item go."""
    return templates.without_contaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: pieces of all documents with their sequence and place in it."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048)


STAGES = [
    ("language", keep_known_language),
    ("lines", drop_common_lines),
    ("near_copies", keep_one_of_near_copies),
    ("benchmark", drop_contaminated),
    ("packing", pack_sequences),
]

#: Models, tokenizers and alignments have no SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
