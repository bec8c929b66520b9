"""Coverage of intervals: islands, gaps and freshness, by a sweep along the starts.

Rows are range-partitioned by group and start, so a group with most of all rows is spread over
many partitions like any other. Inside a partition a running maximum of the ends merges intervals
into local islands, one pass over sorted rows. What a partition cannot know is how far the
partitions before it reach: that is one maximum per group and partition, carried forward by a
window over those maxima only. An interval is one row from beginning to end, however long it is.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import fresh_folder
from tidemark.windows import TimeWindow, bound_literal


def _local_islands(df: DataFrame, start: str, end: str, by: Sequence[str], counted: str | None) -> tuple[DataFrame, list[str]]:
    """Groups (under internal names), part, s, e, n: what intervals cover by those of their own part.

    Parts ascend with group and start. They depend on sampled bounds, so the islands are written
    once and read from there. Rows with equal starts are put together before anything is sorted.
    """
    groups = [f"_g{i}" for i in range(len(by))]
    # NULL ends and intervals that end before they start cover nothing; see `rejected`.
    rows = df.where(F.col(start) <= F.col(end)).select(
        *[F.col(c).alias(g) for c, g in zip(by, groups)],
        F.col(start).alias("s"),
        F.col(end).alias("e"),
        (F.col(counted) if counted else F.lit(1)).cast("bigint").alias("n"),
    )
    starts = rows.groupBy(*groups, "s").agg(F.max("e").alias("e"), F.sum("n").alias("n"))
    parts = starts.repartitionByRange(*groups, "s").withColumn("part", F.spark_partition_id())
    inside = Window.partitionBy(*groups, "part").orderBy("s")
    before = F.max("e").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    local = (
        parts.withColumn("_opens", F.when(F.col("s") <= before, 0).otherwise(1))
        .withColumn("_k", F.sum("_opens").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*groups, "part", "_k")
        .agg(F.min("s").alias("s"), F.max("e").alias("e"), F.sum("n").alias("n"))
        .drop("_k")
    )
    spark = df.sparkSession
    folder = fresh_folder(spark, "intervals")
    local.write.parquet(folder)
    return spark.read.schema(local.schema).parquet(folder), groups


def _reached(local: DataFrame, groups: list[str]) -> DataFrame:
    """`local` with `_reach`, the greatest end of the group in the parts before, and `_last`, the last island that started there.

    The last local island of a part starts an island if anything in the part does. So two
    values per group and part are enough, and the window over a group has a row per part.
    """
    named = [F.col(g).alias(f"_{g}") for g in groups]
    parts = local.groupBy(*named, F.col("part").alias("_part")).agg(F.max("e").alias("_top"), F.max("s").alias("_start"))
    along = Window.partitionBy(*[f"_{g}" for g in groups]).orderBy("_part")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_reach", F.max("_top").over(earlier))
    opened = F.when(F.col("_reach").isNull() | (F.col("_start") > F.col("_reach")), F.col("_start"))
    parts = parts.withColumn("_opened", opened).withColumn("_last", F.max("_opened").over(earlier))
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in groups]
    met = reduce(lambda a, b: a & b, same, F.col("part") == F.col("_part"))
    return local.join(parts, met, "left").select(*local.columns, "_reach", "_last")


def islands(df: DataFrame, start: str, end: str, by: Sequence[str] = (), counted: str | None = None) -> DataFrame:
    """Merged intervals per group: by, island_start, island_end, n. Intervals that touch are one."""
    local, groups = _local_islands(df, start, end, by, counted)
    # Within the reach of the parts before, a local island belongs to the last that started there.
    first = F.when(F.col("s") <= F.col("_reach"), F.col("_last")).otherwise(F.col("s"))
    merged = _reached(local, groups).groupBy(*groups, first.alias("island_start")).agg(F.max("e").alias("island_end"), F.sum("n").alias("n"))
    return merged.select(*[F.col(g).alias(c) for g, c in zip(groups, by)], "island_start", "island_end", "n")


def gaps(df: DataFrame, start: str, end: str, by: Sequence[str] = ()) -> DataFrame:
    """What lies between the islands of each group: by, gap_start, gap_end.

    A gap ends where a local island starts beyond all that was covered before it, which its part
    and the carried maximum tell.
    """
    local, groups = _local_islands(df, start, end, by, None)
    reached = _reached(local, groups)
    before = F.lag("e").over(Window.partitionBy(*groups, "part").orderBy("s"))
    return (
        reached.withColumn("gap_start", F.greatest("_reach", before))
        .where(F.col("gap_start") < F.col("s"))
        .select(*[F.col(g).alias(c) for g, c in zip(groups, by)], "gap_start", F.col("s").alias("gap_end"))
    )


def rejected(df: DataFrame, start: str, end: str) -> DataFrame:
    """Rows that are no interval: an end is NULL, or before the start."""
    return df.where(~F.coalesce(F.col(start) <= F.col(end), F.lit(False)))


def completed(run_log: DataFrame, status: str = "status", value: str = "completed") -> DataFrame:
    return run_log.where(F.col(status) == value)


def freshness(
    run_log: DataFrame,
    needed: TimeWindow,
    job: str = "job",
    start: str = "interval_start",
    end: str = "interval_end",
) -> DataFrame:
    """Per upstream job: how far its completed runs cover `needed` without a hole, and whether wholly.

    Jobs without a completed run are in the result and not fresh. `covered_to` is the end
    of the stretch that holds the needed start, NULL where nothing does.
    """
    kind = run_log.schema[end].dataType
    low, high = bound_literal(needed.start, kind), bound_literal(needed.end, kind)
    stretches = islands(completed(run_log), start, end, [job])
    first = stretches.where((F.col("island_start") <= low) & (F.col("island_end") >= low))
    reached = first.groupBy(job).agg(F.max("island_end").alias("covered_to"))
    jobs = run_log.select(job).distinct()
    probe = reached.withColumnRenamed(job, "_job")
    joined = jobs.join(probe, jobs[job].eqNullSafe(probe["_job"]), "left")
    return joined.select(job, "covered_to", F.coalesce(F.col("covered_to") >= high, F.lit(False)).alias("is_fresh"))
