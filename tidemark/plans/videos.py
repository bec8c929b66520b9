"""A catalogue of video clips: scan, quality rules, curation and statistics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tidemark.operators.curation import before_after, category_profile, curated, kept_share, overall_statistics
from tidemark.operators.quality import case, is_not_null, is_unique
from tidemark.plans.resources import Resource
from tidemark.sources.files import parquet_tree

# Columns left out at the scan, default thresholds and measured columns.
HEAVY_COLUMNS = ("video_blob", "embedding")
THRESHOLDS = {
    "aesthetic_score": 5.0,
    "motion_score": 2.0,
    "temporal_consistency_score": 0.99,
    "fps": 24,
    "seconds": 2.0,
}
MEANS = {
    "avg_aesthetic": "aesthetic_score",
    "avg_motion": "motion_score",
    "avg_temporal": "temporal_consistency_score",
    "avg_fps": "fps",
    "avg_seconds": "seconds",
}

VIDEO_CHECKS = [
    is_unique("video_path"),
    is_not_null("video_path"),
    is_not_null("caption"),
    is_not_null("aesthetic_score"),
    is_not_null("motion_score"),
    case("aesthetic_score BETWEEN 0 AND 10"),
    case("motion_score >= 0"),
    case("temporal_consistency_score BETWEEN 0 AND 1.001"),
    case("fps > 0 AND fps <= 120"),
    case("seconds > 0"),
    case("frame > 0"),
    case("camera_motion IN ('static', 'pan', 'tilt', 'zoom', 'rotate', 'follow', 'handheld')"),
]


def video_files(folder: str, limit: int | None = None) -> Resource:
    return Resource("videos", lambda spark: parquet_tree(spark, folder, HEAVY_COLUMNS, limit), "replace")


def overall(videos: DataFrame) -> DataFrame:
    return overall_statistics(videos, "caption", MEANS)


def by_camera_motion(videos: DataFrame) -> DataFrame:
    return category_profile(videos, "camera_motion", "caption", {"avg_motion": "motion_score"})


def curated_videos(videos: DataFrame, thresholds: Mapping[str, float] = THRESHOLDS) -> DataFrame:
    return curated(videos, thresholds)


def comparison(videos: DataFrame, thresholds: Mapping[str, float] = THRESHOLDS) -> DataFrame:
    return before_after(videos, thresholds, "caption", MEANS)


def share_kept(videos: DataFrame, thresholds: Mapping[str, float] = THRESHOLDS) -> DataFrame:
    return kept_share(videos, thresholds, "caption")
