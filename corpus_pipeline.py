"""A training corpus from raw documents, stage by stage.

Each stage takes the documents that its predecessor kept and returns the
columns of documents (the last returns packed token pieces). Between stages
the rows are written as Parquet and read again, so a lost executor repeats
one stage's tasks at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm import decontaminate, langid, line_dedup, near_duplicates, packing
from meterline.llm.common import table
from meterline.llm.queries import TOKENIZER, VOCABULARY


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised."""
    return langid.identify(docs).filter("accepted").select(docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines of recurring templates; a document that loses its last line goes."""
    got = line_dedup.drop_recurring(docs)
    return got.filter((F.col("dropped") == 0) | (F.trim("text") != "")).select(docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near duplicates."""
    return near_duplicates.first_of_class(docs).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    tests = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.scan(docs, tests).filter("not contaminated").select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the kept documents with their sequence and offset."""
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN,
                                  added=packing.added_tokens(public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination),
    ("packing", best_fit_packing),
]

# Language scores, chosen paths, seeds and the genetic algorithm have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
