"""Helpers that the corpus operators share."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.plans import folders
from tidemark.session import apply_settings, fresh_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_settings(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text: Column | str) -> Column:
    """The UTF-8 bytes of a text, none for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def words_pattern() -> str:
    """What separates words: the six ASCII white-space characters."""
    return r"[\x20\x09-\x0D]+"


class Scratch:
    """Tables in the shared folder that cut lineage.

    Each call of `keep` writes a frame and reads it back, so that later stages
    start from files every executor can reach. `drop` removes a table that
    nothing needs any more; the rest stays for the readers of a lazy result.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.root, self.n = spark, fresh_folder(spark, label), 0

    def keep(self, df: DataFrame) -> tuple[DataFrame, str]:
        path = f"{self.root}/{self.n}"
        self.n += 1
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop(self, path: str | None) -> None:
        if path:
            folders.remove(self.spark, path)


def block_count(docs: DataFrame, text: str, block_bytes: int) -> int:
    """Blocks to deal texts into: one per `block_bytes`, and one per shuffle partition at least."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(math.ceil(total / block_bytes), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def least(values: DataFrame, column: str, most: int) -> DataFrame:
    """At most `most` distinct values of a column, those of least hash.

    Values are first cut by a hash bound that lets about twice as many through, so neither
    the sort nor its result grows with the table.
    """
    places = values.select(column).where(F.col(column).isNotNull()).distinct().withColumn("_place", F.pmod(F.xxhash64(column), F.lit(1 << 31)))
    bound = math.ceil((1 << 31) * min(1.0, (2 * most + 100) / max(places.count(), 1)))
    return places.where(F.col("_place") < bound).orderBy("_place", column).limit(most).select(column)


def dealt(rows: DataFrame) -> DataFrame:
    """Rows with a number `block`, packed for the shuffle: `block` and compressed `rows`.

    A task packs the rows of one Arrow batch that go to one block together, which takes
    half the room on disk that single rows take. `undealt` reads them.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            blocks = batch.column("block").to_numpy(zero_copy_only=False)
            order = np.argsort(blocks, kind="stable")
            table, blocks = pa.Table.from_batches([batch]).drop_columns("block").take(order), blocks[order]
            first = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])) if len(blocks) else []
            packed = []
            for a, b in zip(first, [*first[1:], len(blocks)]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema, options=options) as out:
                    out.write_table(table.slice(a, b - a))
                packed.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(blocks[first], pa.int64()), pa.array(packed, pa.binary())], ["block", "rows"])

    return rows.mapInArrow(deal, "block long, rows binary")


def undealt(packed: pd.Series) -> pd.DataFrame:
    """The rows of a block."""
    tables = [pa.ipc.open_stream(value).read_all() for value in packed]
    return pa.concat_tables(tables).to_pandas(integer_object_nulls=True)
