"""Threshold curation of a table, and what it did to the averages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def meets(thresholds: Mapping[str, float]) -> Column:
    """All measures at or above their threshold; a NULL measure does not meet it."""
    return reduce(lambda a, b: a & b, [F.col(c) >= F.lit(v) for c, v in thresholds.items()], F.lit(True))


def curated(df: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    return df.where(meets(thresholds))


def overall_statistics(df: DataFrame, counted: str, means: Mapping[str, str], count_name: str = "total") -> DataFrame:
    """One row: the non-NULL count of `counted` and the mean of each measure (`means`: result name to column)."""
    return df.agg(F.count(counted).alias(count_name), *[F.avg(c).alias(n) for n, c in means.items()])


def category_profile(df: DataFrame, category: str, counted: str, means: Mapping[str, str]) -> DataFrame:
    """Count and means per category, largest first."""
    return (
        df.groupBy(category)
        .agg(F.count(counted).alias("count"), *[F.avg(c).alias(n) for n, c in means.items()])
        .orderBy(F.desc("count"), category)
    )


def _both_sides(df: DataFrame, thresholds: Mapping[str, float], counted: str, means: Mapping[str, str]) -> DataFrame:
    kept = F.coalesce(meets(thresholds), F.lit(False))

    def sides(name: str, value: Column, fold) -> list[Column]:
        return [fold(value).alias(f"b_{name}"), fold(F.when(kept, value)).alias(f"a_{name}")]

    columns = sides("count", F.col(counted), F.count)
    for name, column in means.items():
        columns += sides(name, F.col(column), F.avg)
    return df.agg(*columns)


def before_after(
    df: DataFrame, thresholds: Mapping[str, float], counted: str, means: Mapping[str, str]
) -> DataFrame:
    """metric, before_full, after_filtered: count and means on both sides, in one pass. No rows gives 0.0."""
    one = _both_sides(df, thresholds, counted, means)
    names: Sequence[str] = ["count", *means]
    entries = [
        F.struct(
            F.lit(n).alias("metric"),
            F.coalesce(F.col(f"b_{n}").cast("double"), F.lit(0.0)).alias("before_full"),
            F.coalesce(F.col(f"a_{n}").cast("double"), F.lit(0.0)).alias("after_filtered"),
        )
        for n in names
    ]
    return one.select(F.explode(F.array(*entries)).alias("_m")).select("_m.*")


def kept_share(df: DataFrame, thresholds: Mapping[str, float], counted: str) -> DataFrame:
    """One row: kept, total and the kept percentage (0 for an empty table)."""
    return _both_sides(df, thresholds, counted, {}).select(
        F.col("a_count").alias("kept"),
        F.col("b_count").alias("total"),
        F.coalesce(
            F.round(F.try_divide(F.col("a_count").cast("double"), F.col("b_count").cast("double")) * 100, 1), F.lit(0.0)
        ).alias("kept_pct"),
    )
