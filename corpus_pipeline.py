"""From raw documents to token ids, in five stages.

Each stage takes the documents its predecessor kept and returns them, less those it
rejects, with the columns of ``documents``; the last returns their token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, langid, ngram_join, pieces, quality
from tidemark.llm.common import stash
from tidemark.llm.queries import vocabulary

# Models, sketches and components have no like in SQL; tests compare with brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, those in which no language holds the majority, and
    those that no learned language tells well."""
    return langid.keep_known(docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the limits of their groups go."""
    return quality.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8, that with the smallest id stays."""
    return ngram_join.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.drop_leaks(docs, items)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text they decode to."""
    return pieces.coded(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [
    ("language ID", language),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_leaks),
    ("SentencePiece encoding and decoding", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    *filters, (_, last) = STAGES
    for name, stage in filters:
        docs = stash(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return last(spark, docs, sf_dir)
