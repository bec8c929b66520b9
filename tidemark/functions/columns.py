"""Column helpers. All of them return plain Spark expressions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Index 0 is Monday.
WEEKDAY_LABELS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]

# Lower magnitude bound and name, highest first; below all of them is "minor".
SEVERITY_BOUNDS = [(8, "great"), (7, "major"), (6, "strong"), (5, "moderate"), (4, "light")]
SEVERITY_ELSE = "minor"
SEVERITY_ORDER = ["minor", "light", "moderate", "strong", "major", "great"]


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def last_token(text: Column | str, separator: str = ", ", missing: str = "Unknown") -> Column:
    """Text after the last separator; NULL and empty give `missing`."""
    tokens = F.split(as_column(text), re.escape(separator))
    return F.coalesce(F.nullif(F.element_at(tokens, -1), F.lit("")), F.lit(missing))


def banded(value: Column | str, bounds: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First band whose lower bound is reached; NULL falls to `otherwise`."""
    value = as_column(value)
    cases = None
    for bound, label in bounds:
        reached = value >= F.lit(bound)
        cases = F.when(reached, label) if cases is None else cases.when(reached, label)
    return F.lit(otherwise) if cases is None else cases.otherwise(F.lit(otherwise))


def severity(magnitude: Column | str) -> Column:
    return banded(magnitude, SEVERITY_BOUNDS, SEVERITY_ELSE)


def position_in(value: Column | str, order: Sequence[str]) -> Column:
    """0-based place of a category in a display order; NULL when it is not listed."""
    return F.nullif(F.array_position(F.array(*[F.lit(v) for v in order]), as_column(value)), F.lit(0)) - 1


def mapped(value: Column | str, pairs: Mapping) -> Column:
    """Small dictionary lookup; values outside the dictionary give NULL."""
    entries = [F.lit(part) for pair in pairs.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), as_column(value))


def weekday_index(ts: Column | str) -> Column:
    """Monday = 0."""
    return F.weekday(as_column(ts))


def weekday_label(index: Column | str) -> Column:
    return mapped(index, dict(enumerate(WEEKDAY_LABELS)))


def truncated(df: DataFrame, ts: str, unit: str) -> Column:
    """`date_trunc` that keeps the type of the column (with or without time zone)."""
    kind = df.schema[ts].dataType
    return F.date_trunc(unit, F.col(ts)).cast("timestamp_ntz" if isinstance(kind, T.TimestampNTZType) else "timestamp")


def percentage(part: Column | str, whole: Column | str, digits: int = 1) -> Column:
    """part / whole * 100, rounded; NULL when whole is 0."""
    return F.round(F.try_divide(as_column(part).cast("double"), as_column(whole).cast("double")) * 100, digits)


def rounded_mean(value: Column | str, digits: int = 1) -> Column:
    return F.round(F.avg(as_column(value)), digits)


def count_true(flag: Column | str) -> Column:
    """Number of true values; NULL when there is no non-NULL value."""
    return F.sum(as_column(flag).cast("bigint"))


def floor_bin(value: Column | str, step: float) -> Column:
    """Lower edge of the bin of width `step`."""
    value = as_column(value)
    if step < 1 and float(1 / step).is_integer():
        return (F.floor(value * F.lit(1 / step)) / F.lit(1 / step)).cast("double")
    return (F.floor(value / F.lit(float(step))) * F.lit(float(step))).cast("double")


def from_epoch_ms(ms: Column | str) -> Column:
    """Epoch milliseconds to a UTC instant, NULL safe."""
    return F.timestamp_millis(as_column(ms).cast("bigint"))


def local_day_start(ts: Column | str, zone: str) -> Column:
    """UTC instant at which the local calendar day of `ts` begins in `zone`."""
    local = F.from_utc_timestamp(as_column(ts), zone)
    return F.to_utc_timestamp(F.date_trunc("day", local), zone)


def local_day_end(ts: Column | str, zone: str) -> Column:
    """UTC instant at which the next local day begins, so clock-change days are 23 or 25 hours."""
    local = F.from_utc_timestamp(as_column(ts), zone)
    return F.to_utc_timestamp(F.date_trunc("day", local) + F.expr("INTERVAL 1 DAY"), zone)


def remerged(df: DataFrame, column: str, kind: str = "double", default_type: str | None = None) -> Column:
    """Variant value where present, else the base column cast to the wanted type.

    A table that never saw a clash has no variant column; the base column is used alone.
    """
    variant = f"{column}__v_{kind}"
    target = default_type or kind
    base = F.col(column).cast(target)
    return F.coalesce(F.col(variant).cast(target), base) if variant in df.columns else base
