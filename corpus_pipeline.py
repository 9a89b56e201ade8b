"""The corpus pipeline: raw documents to packed training sequences, in five stages.

Every stage but the last returns the columns of ``documents`` as they are, further columns
too, whatever their names; an empty table gives an empty table.  Rows are judged one by one:
repeated rows and repeated or NULL ids stay apart, except that of near duplicates the rows of
the smallest id stay together.  NULL, empty and blank texts have fewer than 50 words, so the
first stage rejects them; a stage that is called alone keeps them (near duplicates, repeats,
contamination) or packs their end id (packing).  Very long texts are handled whole by one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import decontaminate, jaccard_join, packing, quality_rules, suffix_dedup
from starmart.scratch import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) the document of smallest id."""
    return jaccard_join.keep_one(docs, percent=80, n=5)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that start more than once in the corpus."""
    return suffix_dedup.drop_repeats(docs, length=200, size="n_chars")


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by a benchmark item."""
    return decontaminate.drop_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all texts, each with its sequence and place."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("suffix_dedup", repeats),
    ("decontamination", contamination),
    ("packing", packed),
]

#: SQL cannot express the tokenizer; tests/llm/test_llm_queries.py holds every stage's rows
#: against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between two of them is written once."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{name}")
    return docs
