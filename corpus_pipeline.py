"""Corpus pipeline: from raw documents to packed training sequences.

STAGES lists (name, function); each function takes (spark, docs, sf_dir), works on all that
the stage before kept and calls one operator of ``mortar.llm``. All but the last return the
columns of documents.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mortar.llm import exact_dedup, pii, quality, simhash
from mortar.llm.common import free_name, table, write_scratch
from mortar.llm.queries import pack_documents


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels, doesn't reject."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    score = free_name(docs, "_score")
    return quality.score_quality(docs, model, score_col=score).where(F.col(score) >= 0.5).drop(score)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: shingles of 3 words, at most 2 differing bits."""
    return simhash.keep_representatives(docs, shingle=3, radius=2)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the text."""
    masked = pii.mask(docs, pii.fit(docs)).withColumn("n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars")))
    return masked.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents in sequences of 1,024, with their ids."""
    return pack_documents(docs, keep_ids=True)


STAGES = [
    ("quality", keep_quality),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("personal data", mask_personal_data),
    ("packing", pack),
]

#: SQL can express neither the classifiers nor the tokenizer; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written once and read by the next."""
    *filters, (_, last) = STAGES
    step = lambda docs, stage: write_scratch(stage[1](spark, docs, sf_dir), "stage")
    return last(spark, functools.reduce(step, filters, table(spark, sf_dir, "documents")), sf_dir)
