"""Earthquake feeds: windowed ingest, daily statistics per region, classified snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import SEVERITY_ORDER, floor_bin, last_token, position_in, remerged, severity
from tidemark.operators.reports import group_counts, totals
from tidemark.operators.rollup import finished, measures, rolled, states
from tidemark.plans.dataset import rows_between
from tidemark.plans.resources import Resource, source, transformation
from tidemark.sources.features import bounded_events, feature_files
from tidemark.windows import Incremental, TimeWindow


@source
def quake_feeds(events_folder: str, summary_folder: str, window: TimeWindow, **scan) -> Sequence[Resource]:
    """`earthquakes` for a closed window, merged by id, and `feeds_summary`, replaced.

    Stateless: what is loaded depends on the window only, so a window can be run again.
    """
    cursor = Incremental("time", window.start, window.end, on_null="exclude")
    return [
        Resource(
            "earthquakes",
            lambda spark: bounded_events(feature_files(spark, events_folder, **scan), None),
            "merge",
            "id",
            incremental=cursor,
            newest="updated_at",
            partition_by=("time", "day"),
        ),
        Resource("feeds_summary", lambda spark: feature_files(spark, summary_folder, **scan), "replace", "id"),
    ]


def place_region(place: Column | str) -> Column:
    return last_token(place, ", ", "Unknown")


def _placed(dataset, window: TimeWindow | None, align: str) -> DataFrame:
    """Earthquakes of a window with day and region."""
    if align not in ("group", "none"):
        raise ValueError(f"align: {align}")
    if window is None:
        quakes = dataset["earthquakes"]
    else:
        quakes = rows_between(dataset, "earthquakes", "time", window.whole_days() if align == "group" else window)
    return quakes.withColumns({"day": F.col("time").cast("date"), "region": place_region("place")})


@transformation(write_disposition="merge", primary_key=["day", "region"], partition_by="day", unique_batch=True)
def earthquake_daily_stats(dataset, window: TimeWindow | None = None, align: str = "group") -> DataFrame:
    """Events, magnitudes and depth per UTC day and region.

    A merge writes whole (day, region) rows, so a window that covers part of a day would
    replace that day's row by a partial one. `align="group"` widens the window to whole
    days first; `align="none"` takes it as it is.
    """
    quakes = _placed(dataset, window, align)
    return (
        quakes.groupBy("day", "region")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.avg("magnitude").alias("avg_magnitude"),
            F.max("magnitude").alias("max_magnitude"),
            F.min("magnitude").alias("min_magnitude"),
            F.avg(remerged(quakes, "depth_km")).alias("avg_depth_km"),
        )
    )


QUAKE_MEASURES = (
    measures.rows("event_count"),
    measures.mean("avg_magnitude", "magnitude"),
    measures.greatest("max_magnitude", "magnitude"),
    measures.least("min_magnitude", "magnitude"),
    measures.mean("avg_depth_km", "depth"),
    measures.distinct("places", "place"),
)


@transformation(write_disposition="merge", primary_key=["day", "region"], partition_by="day", unique_batch=True)
def earthquake_daily_states(dataset, window: TimeWindow | None = None, align: str = "group") -> DataFrame:
    """What `earthquake_daily_stats` holds, as states that roll up to longer times and to regions."""
    quakes = _placed(dataset, window, align)
    return states(quakes.withColumn("depth", remerged(quakes, "depth_km")), ["day", "region"], QUAKE_MEASURES)


def quakes_by(stored: DataFrame, *by: str | Column) -> DataFrame:
    """Values of `QUAKE_MEASURES` for any coarser groups of stored daily states."""
    return finished(rolled(stored, by, QUAKE_MEASURES), QUAKE_MEASURES)


@transformation(primary_key="id")
def feeds_summary_classified(dataset) -> DataFrame:
    """The snapshot feed with severity and region."""
    feed = dataset["feeds_summary"].drop("_row_id", "_load_id")
    return feed.withColumns({"severity": severity("magnitude"), "region": place_region("place")})


def events_per_day(stats: DataFrame) -> DataFrame:
    return totals(stats, "day", "event_count", "events").orderBy("day")


def largest_regions(stats: DataFrame, k: int = 15) -> DataFrame:
    return totals(stats, "region", "event_count", "events").orderBy(F.desc("events"), "region").limit(k)


def magnitude_bins(quakes: DataFrame, step: float = 0.5) -> DataFrame:
    known = quakes.where(F.col("magnitude").isNotNull())
    return group_counts(known, [floor_bin("magnitude", step).alias("magnitude_bin")], None, "events").orderBy(
        "magnitude_bin"
    )


def severity_counts(classified: DataFrame) -> DataFrame:
    """Events per severity, with the place of each in the display order; largest first."""
    counts = group_counts(classified, ["severity"], None, "events")
    return counts.withColumn("severity_order", position_in("severity", SEVERITY_ORDER)).orderBy(
        F.desc("events"), "severity_order"
    )


def magnitude_and_depth(quakes: DataFrame) -> DataFrame:
    """Points with both values; depth is read from its variant column where it has one."""
    points = quakes.select("magnitude", remerged(quakes, "depth_km").alias("depth_km"), "type")
    return points.where(F.col("magnitude").isNotNull() & F.col("depth_km").isNotNull())
