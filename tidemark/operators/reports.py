"""The report shapes: key figures, rankings, trends, heat maps and histograms."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import count_true, floor_bin, percentage, truncated, weekday_index, weekday_label


def key_figures(df: DataFrame, figures: Mapping[str, Column]) -> DataFrame:
    """All figures of a strip in one pass and one row."""
    return df.agg(*[value.alias(name) for name, value in figures.items()])


def top_groups(
    df: DataFrame,
    by: str,
    measures: Mapping[str, Column],
    order: str,
    k: int = 15,
    percentages: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """The k largest groups; equal ones are ordered by the group itself.

    `percentages` maps a new column to (part, whole) among the measures.
    """
    top = (
        df.groupBy(by)
        .agg(*[value.alias(name) for name, value in measures.items()])
        .orderBy(F.desc(order), F.asc(by))
        .limit(k)
    )
    return top.withColumns({n: percentage(p, w) for n, (p, w) in percentages.items()}) if percentages else top


def trend(
    df: DataFrame,
    ts: str,
    unit: str,
    counted: str,
    flag: Column | None = None,
    flag_name: str = "flagged",
    rest_name: str = "rest",
    period: str | None = None,
) -> DataFrame:
    """Rows per period and, with a flag, how many carry it and how many do not."""
    period = period or unit
    measures = [F.count(counted).alias("total")]
    if flag is not None:
        measures.append(count_true(flag).alias(flag_name))
    out = df.groupBy(truncated(df, ts, unit).alias(period)).agg(*measures)
    if flag is not None:
        out = out.withColumn(rest_name, F.col("total") - F.col(flag_name))
    return out.orderBy(period)


def distinct_trend(
    df: DataFrame, ts: str, unit: str, column: str, name: str, period: str | None = None, approximate: bool = False
) -> DataFrame:
    """Distinct values per period, exact unless asked otherwise."""
    period = period or unit
    count = F.approx_count_distinct(column) if approximate else F.count_distinct(column)
    return df.groupBy(truncated(df, ts, unit).alias(period)).agg(count.alias(name)).orderBy(period)


def weekday_hours(df: DataFrame, ts: str, counted: str, name: str = "n") -> DataFrame:
    """Count per weekday (Monday = 0) and hour, with the weekday's label."""
    return (
        df.groupBy(weekday_index(ts).alias("day_of_week"), F.hour(ts).alias("hour"))
        .agg(F.count(counted).alias(name))
        .withColumn("day_name", weekday_label("day_of_week"))
        .select("day_of_week", "day_name", "hour", name)
        .orderBy("day_of_week", "hour")
    )


def bin_step(df: DataFrame, value: str, max_bins: int = 50) -> float:
    """The smallest 1, 2 or 5 times a power of ten that needs at most `max_bins` bins.

    Only the smallest and largest value come to the driver.
    """
    low, high = df.agg(F.min(value), F.max(value)).first()
    if low is None or high == low:
        return 1.0
    raw = (float(high) - float(low)) / max_bins
    power = 10.0 ** math.floor(math.log10(raw))
    return next(power * m for m in (1, 2, 5, 10) if power * m >= raw)


def histogram(
    df: DataFrame, value: str, by: Sequence[Column | str] = (), step: float | None = None, max_bins: int = 50
) -> DataFrame:
    """bin_start, the split columns and n. Bins are counted where the rows are."""
    step = step or bin_step(df, value, max_bins)
    return df.groupBy(floor_bin(value, step).alias("bin_start"), *by).agg(F.count(F.lit(1)).alias("n"))


def group_counts(df: DataFrame, by: Sequence[Column | str], counted: str | None = None, name: str = "n") -> DataFrame:
    return df.groupBy(*by).agg(F.count(counted if counted else F.lit(1)).alias(name))


def totals(df: DataFrame, by: str, summed: str, name: str) -> DataFrame:
    """Roll a stored count up. Only sums, minima and maxima may be rolled up, stored means may not."""
    return df.groupBy(by).agg(F.sum(summed).alias(name))
