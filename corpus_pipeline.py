"""A pipeline over `documents`: toxicity, exact and near duplicates, decontamination, tokens.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns
the rows it keeps with the columns of documents; the last returns the encoded documents.
Rows without an id are kept by every stage that names rows by id, since nothing can be said
about them; rows that share an id are dropped together.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, decontaminate, exact, neardup, toxicity
from tidemark.llm.common import Scratch, table
from tidemark.llm.queries import VOCABULARY, remainder

DROPPED_IDS = 2_000_000
"""Ids of dropped documents that may be sent to every task; more are joined by a shuffle."""

TOXIC = 0.7
"""Score from which a document is rejected."""


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of `docs` whose `doc_id` is not in `dropped`."""
    return docs.join(decontaminate.small(dropped.select("doc_id").distinct(), DROPPED_IDS), "doc_id", "left_anti").select(docs.columns)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 3) != 1)
    model = toxicity.fit(docs, labels, label_col="toxic")
    return toxicity.scored(docs, model, keep=docs.columns).where(F.col("toxicity") < TOXIC).select(docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.radix_groups(docs).where("kept").select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    dropped, _ = Scratch(spark, "dropped").keep(neardup.near_duplicates(docs).where("NOT kept").select("doc_id"))
    return without(docs, dropped)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    leaks, _ = Scratch(spark, "leaks").keep(decontaminate.contained(docs, table(spark, sf_dir, "benchmark")).select("doc_id"))
    return without(docs, leaks)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    return bpe.encoded(docs, path, public_tokenizers.PATTERN, keep=["doc_id"])


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", decontaminated),
    ("tokens", tokens),
]

ORACLE_SQL = None
"""The first stage is a trained model, which SQL cannot express."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each result written and read again."""
    docs, scratch, before = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline"), None
    for _, stage in STAGES[:-1]:
        docs, path = scratch.keep(stage(spark, docs, sf_dir))
        scratch.drop(before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
