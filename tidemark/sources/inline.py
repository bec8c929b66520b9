"""Rows declared in code, and rows derived from a seed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def inline_rows(
    spark: SparkSession,
    rows: Sequence[Mapping],
    schema: T.StructType | str,
    annotations: Mapping[str, Mapping] | None = None,
) -> DataFrame:
    """A small table from a list of dicts, with declared types and column annotations."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    names = schema.fieldNames()
    df = spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)
    for column, note in (annotations or {}).items():
        df = df.withMetadata(column, dict(note))
    return df


def arrow_rows(spark: SparkSession, table: pa.Table) -> DataFrame:
    return spark.createDataFrame(table)


def seeded_pick(id_column: Column | str, seed: int, salt: str, choices: int) -> Column:
    """A number in 0..choices-1 that depends on the row id only, never on the partitioning."""
    id_column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.pmod(F.xxhash64(id_column, F.lit(seed), F.lit(salt)), F.lit(choices)).cast("bigint")


def seeded_purchases(spark: SparkSession, n: int = 100, seed: int = 42, customers: int = 13, items: int = 6) -> DataFrame:
    """Synthetic purchases: uniform customer, item, quantity 1..5 and one of 14 days."""
    # The first day and the number of days.
    first_day, days = "2018-10-01", 14
    rows = spark.range(1, n + 1)
    return rows.select(
        "id",
        (seeded_pick("id", seed, "customer", customers) + 1).alias("customer_id"),
        (seeded_pick("id", seed, "item", items) + 1).alias("inventory_id"),
        (seeded_pick("id", seed, "quantity", 5) + 1).alias("quantity"),
        F.date_format(
            F.date_add(F.lit(first_day).cast("date"), seeded_pick("id", seed, "day", days).cast("int")), "yyyy-MM-dd"
        ).alias("date"),
    )
