"""File scans. Filters and column choices made on the result reach the scan."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from tidemark.plans import folders


def parquet_glob(spark: SparkSession, folder: str, glob: str = "*.parquet") -> DataFrame:
    """The parquet tables of a folder whose names match: single files, and folders of part files as Spark writes them.

    Partition folders (`column=value`) are no tables: below them single files match.
    """
    if folders.matching_folders(spark, folder, glob):
        return spark.read.parquet(f"{folder}/{glob}")
    return spark.read.option("pathGlobFilter", glob).parquet(folder)


def parquet_tree(
    spark: SparkSession, folder: str, exclude: Sequence[str] = (), limit: int | None = None
) -> DataFrame:
    """All parquet files below a folder, without the named heavy columns."""
    df = spark.read.option("recursiveFileLookup", "true").parquet(folder).drop(*exclude)
    return df if limit is None else df.limit(limit)


def json_pages(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str | None = None,
    glob: str = "*.json",
    page_limit: int | None = None,
    page_pattern: str = r"(\d+)\D*$",
    multi_line: bool = True,
) -> DataFrame:
    """Landed pages of a collection: one file is one page, holding an array or lines of objects.

    `page_limit` keeps pages 1..n by the number in the path that `page_pattern` finds. It is a filter on
    the file name, so no other task has to wait for a global limit. Files whose name has
    no number are no numbered page and are kept.
    """
    reader = spark.read.option("pathGlobFilter", glob).option("multiLine", str(multi_line).lower())
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(folder)
    if page_limit is not None:
        page = F.regexp_extract(F.col("_metadata.file_path"), page_pattern, 1)
        df = df.where(F.coalesce(page.try_cast("bigint") <= page_limit, F.lit(True)))
    return df


def dated(df: DataFrame, column: str, start_date: str, end_date: str) -> DataFrame:
    """Rows between two days, both included, as the start and end parameters of a collection."""
    first = F.lit(start_date).cast("date")
    after = F.date_add(F.lit(end_date).cast("date"), 1)
    kind = df.schema[column].dataType.simpleString()
    return df.where((F.col(column) >= first.cast(kind)) & (F.col(column) < after.cast(kind)))


def batches(df: DataFrame, size: int = 1000) -> Iterator[list[Row]]:
    """Rows in lists of `size`, one partition in memory at a time; for small consumers."""
    batch: list[Row] = []
    for row in df.toLocalIterator(prefetchPartitions=True):
        batch.append(row)
        if len(batch) == size:
            yield batch
            batch = []
    if batch:
        yield batch
