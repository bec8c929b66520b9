"""Vectors by content: a text is embedded once, however often and wherever it comes back.

A table holds one vector for each distinct text and model, named by the hash of the text. A load
looks up which hashes are new (an anti-join on hashes alone), sends one copy of each new text
through the provider, and adds the vectors; rows then get theirs by a join on the hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.vectors import Provider, embedded
from tidemark.plans import folders

SCHEMA = "content string, load string, vector array<float>"


def content(text: Column | str) -> Column:
    """The name of a text: lowercase-hex sha256 of its UTF-8 bytes; NULL has none."""
    return F.sha2((F.col(text) if isinstance(text, str) else text).cast("binary"), 256)


class VectorStore:
    """The vectors of one model under `path`. Other models have stores of their own.

    One writer at a time is assumed; a load that failed has added nothing.
    """

    def __init__(self, spark: SparkSession, path: str, model: str, provider: Callable[[], Provider]) -> None:
        self.spark, self.path, self.provider = spark, f"{path}/{model}", provider

    @property
    def vectors(self) -> DataFrame:
        """content, load (in which the text was first seen), vector."""
        reader = self.spark.read.schema(SCHEMA)
        return reader.parquet(self.path) if folders.exists(self.spark, self.path) else self.spark.createDataFrame([], SCHEMA)

    def add(self, texts: DataFrame, column: str, load: str) -> None:
        """Embed the distinct texts of a column that have no vector yet.

        NULL has no vector. Only hashes meet the store; a text moves if it is new, and one copy
        of it is left before it is shuffled to the provider.
        """
        present = texts.where(F.col(column).isNotNull()).select(F.col(column).alias("text"), content(column).alias("content"))
        known = self.vectors.select("content")
        unseen = present.select("content").distinct().join(known, "content", "left_anti")
        fresh = present.join(unseen, "content", "left_semi").groupBy("content").agg(F.any_value("text").alias("text"))
        made = embedded(fresh, {"text": "vector"}, self.provider)
        made.select("content", F.lit(load).alias("load"), "vector").write.mode("append").parquet(self.path)

    def embedded(self, df: DataFrame, columns: dict[str, str], load: str) -> DataFrame:
        """`df` with a vector column for each text column, new texts added first. NULL text gives NULL."""
        for column in columns:
            self.add(df, column, load)
        for column, target in columns.items():
            stored = self.vectors.select(F.col("content").alias(f"_{target}"), F.col("vector").alias(target))
            df = df.join(stored, content(column) == F.col(f"_{target}"), "left").drop(f"_{target}")
        return df
