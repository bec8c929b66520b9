"""GeoJSON feature collections to flat event rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.columns import from_epoch_ms
from tidemark.windows import TimeWindow

COLLECTION_SCHEMA = (
    "features array<struct<id: string,"
    " properties: struct<mag: double, magType: string, place: string, time: bigint, updated: bigint,"
    " type: string, tsunami: bigint, alert: string, status: string, url: string>,"
    " geometry: struct<coordinates: array<double>>>>"
)

# Fixed value: the smallest magnitude that is asked for.
MIN_MAGNITUDE = 2.5


def flat_features(collections: DataFrame, column: str = "features") -> DataFrame:
    """One row of 14 columns per feature; a missing geometry or coordinate gives NULL."""
    feature = F.col("feature")
    prop = feature.getField("properties")
    point = feature.getField("geometry").getField("coordinates")
    return collections.select(F.explode(column).alias("feature")).select(
        feature.getField("id").alias("id"),
        prop.getField("mag").alias("magnitude"),
        prop.getField("magType").alias("magnitude_type"),
        prop.getField("place").alias("place"),
        from_epoch_ms(prop.getField("time")).alias("time"),
        from_epoch_ms(prop.getField("updated")).alias("updated_at"),
        prop.getField("type").alias("type"),
        prop.getField("tsunami").alias("tsunami"),
        prop.getField("alert").alias("alert"),
        prop.getField("status").alias("status"),
        prop.getField("url").alias("url"),
        F.get(point, F.lit(0)).alias("longitude"),
        F.get(point, F.lit(1)).alias("latitude"),
        F.get(point, F.lit(2)).alias("depth_km"),
    )


def feature_files(spark: SparkSession, folder: str, glob: str = "*.geojson", multi_line: bool = True) -> DataFrame:
    """Landed collections. With `multi_line=False` every line is a collection, and files split."""
    raw = (
        spark.read.schema(COLLECTION_SCHEMA)
        .option("pathGlobFilter", glob)
        .option("multiLine", str(multi_line).lower())
        .json(folder)
    )
    return flat_features(raw)


def bounded_events(
    events: DataFrame,
    window: TimeWindow | None,
    time: str = "time",
    magnitude: str = "magnitude",
    min_magnitude: float = MIN_MAGNITUDE,
    order_by: tuple[str, ...] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Events inside the window and at or above the magnitude; both bounds reach the scan.

    `limit` is the page size of the service and is off by default: rows past it would be lost.
    """
    df = events if window is None else window.rows(events, time)
    df = df.where(F.col(magnitude) >= F.lit(min_magnitude))
    if order_by:
        df = df.orderBy(*order_by)
    return df if limit is None else df.limit(limit)
