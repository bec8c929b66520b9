"""Commits of a code host: quality rules, the flat commit table and its report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.columns import count_true, mapped, percentage, rounded_mean
from tidemark.operators.quality import case, is_in, is_not_null, metrics
from tidemark.operators.reports import distinct_trend, histogram, key_figures, top_groups, trend, weekday_hours
from tidemark.plans.resources import Resource, paged_resource, source, transformation

COMMIT_SCHEMA = (
    "sha string, author struct<login: string>, committer struct<login: string>,"
    " commit struct<author: struct<name: string, email: string, date: timestamp>,"
    " committer: struct<date: timestamp>, message: string, comment_count: bigint,"
    " verification: struct<verified: boolean>>, parents array<struct<sha: string>>"
)
CONTRIBUTOR_SCHEMA = "login string, id bigint, type string, contributions bigint"

COMMIT_CHECKS = [
    is_not_null("sha"),
    is_not_null("commit__author__name"),
    is_not_null("commit__author__date"),
    case("commit__comment_count >= 0"),
]
CONTRIBUTOR_CHECKS = [
    is_not_null("login"),
    is_not_null("id"),
    is_in("type", ["User", "Bot"]),
    case("contributions > 0"),
]
COMMIT_METRICS = [
    metrics.column.null_count("sha"),
    metrics.column.null_rate("commit__author__name"),
    metrics.column.unique_count("sha"),
    metrics.column.mean("commit__comment_count"),
    metrics.column.maximum("commit__comment_count"),
    metrics.table.row_count(),
]
CONTRIBUTOR_METRICS = [
    metrics.column.null_count("login"),
    metrics.column.unique_count("login"),
    metrics.column.mean("contributions"),
    metrics.column.maximum("contributions"),
    metrics.column.minimum("contributions"),
    metrics.table.row_count(),
]


@source
def code_host(commits_folder: str, contributors_folder: str, **scan) -> list[Resource]:
    """Landed pages of both collections, replaced on every run."""
    return [
        paged_resource("commits", commits_folder, COMMIT_SCHEMA, **scan),
        paged_resource("contributors", contributors_folder, CONTRIBUTOR_SCHEMA, **scan),
    ]


def parents_per_commit(parents: DataFrame) -> DataFrame:
    return parents.groupBy("_parent_id").agg(F.count("_row_id").alias("parent_count"))


@transformation
def commits(dataset) -> DataFrame:
    """13 readable columns per commit, with the number of parents from the child table."""
    raw = dataset["commits"]
    parents = parents_per_commit(dataset["commits__parents"])
    joined = raw.join(parents, raw["_row_id"] == parents["_parent_id"], "left")
    parent_count = F.coalesce("parent_count", F.lit(0).cast("bigint"))
    return joined.select(
        "sha",
        F.coalesce("author__login", F.lit("unknown")).alias("author_login"),
        F.coalesce("committer__login", F.lit("unknown")).alias("committer_login"),
        F.col("commit__author__name").alias("author_name"),
        F.col("commit__author__email").alias("author_email"),
        F.col("commit__author__date").alias("authored_at"),
        F.col("commit__committer__date").alias("committed_at"),
        F.col("commit__message").alias("message"),
        F.length("commit__message").cast("bigint").alias("message_length"),
        F.col("commit__verification__verified").alias("is_verified"),
        F.col("commit__comment_count").alias("comment_count"),
        parent_count.alias("parent_count"),
        (parent_count > 1).alias("is_merge_commit"),
    )


def at_a_glance(table: DataFrame) -> DataFrame:
    """Six key figures in one pass."""
    figures = key_figures(
        table,
        {
            "total": F.count(F.lit(1)),
            "merges": F.count_if("is_merge_commit"),
            "authors": F.count_distinct("author_login"),
            "verified": F.count_if("is_verified"),
            "avg_message": rounded_mean("message_length"),
        },
    )
    return figures.withColumn("regular", F.col("total") - F.col("merges"))


def top_authors(table: DataFrame, k: int = 15) -> DataFrame:
    return top_groups(
        table,
        "author_login",
        {
            "total_commits": F.count("sha"),
            "merge_commits": count_true("is_merge_commit"),
            "verified_commits": count_true("is_verified"),
            "avg_message_length": rounded_mean("message_length"),
        },
        "total_commits",
        k,
        {"merge_pct": ("merge_commits", "total_commits"), "verified_pct": ("verified_commits", "total_commits")},
    )


# The display names of the author table.
AUTHOR_LABELS = {
    "author_login": "Author",
    "total_commits": "Total",
    "merge_commits": "Merges",
    "verified_commits": "Verified",
    "avg_message_length": "Avg Msg Len",
    "merge_pct": "Merge %",
    "verified_pct": "Verified %",
}


def author_breakdown(table: DataFrame, k: int = 15) -> DataFrame:
    return top_authors(table, k).withColumnsRenamed(AUTHOR_LABELS)


def monthly_activity(table: DataFrame) -> DataFrame:
    """Commits, merges and others per month, and the share of merges."""
    months = trend(table, "authored_at", "month", "sha", F.col("is_merge_commit"), "merges", "regular")
    return months.withColumn("merge_ratio", percentage("merges", "total"))


def monthly_authors(table: DataFrame) -> DataFrame:
    return distinct_trend(table, "authored_at", "month", "author_login", "unique_authors")


def commit_hours(table: DataFrame) -> DataFrame:
    return weekday_hours(table, "authored_at", "sha", "commits")


def message_lengths(table: DataFrame, step: float | None = None) -> DataFrame:
    kind = mapped("is_merge_commit", {True: "Merge", False: "Regular"}).alias("type")
    return histogram(table, "message_length", [kind], step)


def monthly_verification(table: DataFrame) -> DataFrame:
    return trend(table, "authored_at", "month", "sha", F.col("is_verified"), "verified", "unverified")
