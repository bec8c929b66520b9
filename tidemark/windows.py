"""Time windows and cursors: bounds that become pushed-down scan predicates."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T


def as_utc(moment: datetime | str) -> datetime:
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment.astimezone(timezone.utc)


def bound_literal(value, kind: T.DataType) -> Column:
    """A constant of the column's own type, so that the comparison reaches the scan."""
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = as_utc(value).strftime("%Y-%m-%d %H:%M:%S.%f")
        if isinstance(kind, T.TimestampNTZType):
            return F.lit(text).cast("timestamp_ntz")
        return F.lit(text + "+00:00").cast("timestamp")
    return F.lit(value).cast(kind)


@dataclass(frozen=True)
class TimeWindow:
    """Two UTC instants, both ends included."""

    start: datetime
    end: datetime

    def __post_init__(self):
        object.__setattr__(self, "start", as_utc(self.start))
        object.__setattr__(self, "end", as_utc(self.end))
        if self.end < self.start:
            raise ValueError(f"window ends before it starts: {self.start} > {self.end}")

    def rows(self, df: DataFrame, column: str) -> DataFrame:
        kind = df.schema[column].dataType
        return df.where(F.col(column).between(bound_literal(self.start, kind), bound_literal(self.end, kind)))

    def whole_days(self) -> "TimeWindow":
        """Widened to the whole UTC days it touches."""
        first = self.start.replace(hour=0, minute=0, second=0, microsecond=0)
        last = self.end.replace(hour=0, minute=0, second=0, microsecond=0) + timedelta(days=1)
        return TimeWindow(first, last - timedelta(microseconds=1))

    def since(self, epoch: datetime | str | None) -> "TimeWindow":
        """The window of a refresh run: from `epoch`, where one is given, to the same end."""
        return self if epoch is None else replace(self, start=as_utc(epoch))

    def with_lag(self, lag: timedelta) -> "TimeWindow":
        return replace(self, start=self.start - lag)


@dataclass(frozen=True)
class Incremental:
    """A cursor column with optional bounds.

    `start` unset means no lower bound. `on_null` says what happens to rows whose
    cursor is NULL: `raise` (nothing is published), `include` or `exclude`.
    """

    cursor: str
    start: object = None
    end: object = None
    range_start: str = "closed"
    range_end: str = "closed"
    lag: object = None
    on_null: str = "raise"
    resumed: bool = False
    """Set by `restored`: rows at the start may have been loaded already."""

    def __post_init__(self):
        if self.on_null not in ("raise", "include", "exclude"):
            raise ValueError(f"on_null: {self.on_null}")
        for name in ("range_start", "range_end"):
            if getattr(self, name) not in ("open", "closed"):
                raise ValueError(f"{name}: {getattr(self, name)}")

    @property
    def both_closed(self) -> bool:
        return self.end is not None and self.range_start == "closed" and self.range_end == "closed"

    def rows(self, df: DataFrame) -> DataFrame:
        kind = df.schema[self.cursor].dataType
        cursor = F.col(self.cursor)
        keep = None
        if self.start is not None:
            low = self.low(kind)
            keep = cursor >= low if self.range_start == "closed" or self.lag is not None else cursor > low
        if self.end is not None:
            high = bound_literal(self.end, kind)
            upper = cursor <= high if self.range_end == "closed" else cursor < high
            keep = upper if keep is None else keep & upper
        if self.on_null == "exclude":
            return df.where(cursor.isNotNull() if keep is None else keep)
        return df if keep is None else df.where(keep | cursor.isNull())

    def restored(self, saved) -> "Incremental":
        """The same settings, beginning at the last saved value.

        With a closed start its rows are read again, since more rows of that value may have
        arrived: a merge absorbs them, an append leaves out those that are stored.
        """
        return replace(self, start=saved, resumed=True)

    def low(self, kind: T.DataType) -> Column | None:
        """The smallest value that is read."""
        if self.start is None:
            return None
        low = self.start
        if self.lag is not None:
            low = (as_utc(low) if isinstance(low, str) and isinstance(self.lag, timedelta) else low) - self.lag
        return bound_literal(low, kind)
