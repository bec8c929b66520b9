from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import (
    SEVERITY_ORDER,
    banded,
    count_true,
    floor_bin,
    from_epoch_ms,
    last_token,
    local_day_end,
    local_day_start,
    mapped,
    percentage,
    position_in,
    remerged,
    rounded_mean,
    severity,
    truncated,
    weekday_index,
    weekday_label,
)


def one(spark, value, schema, expression):
    return [r[0] for r in spark.createDataFrame([(v,) for v in value], schema).select(expression).collect()]


def test_last_token(spark):
    places = ["10 km N of Town, Chile", "Alaska", "", None, "a, b, c", "x, ", "dot.sep"]
    assert one(spark, places, "v string", last_token("v")) == [
        "Chile",
        "Alaska",
        "Unknown",
        "Unknown",
        "c",
        "Unknown",
        "dot.sep",
    ]
    assert one(spark, ["a.b.c"], "v string", last_token("v", ".")) == ["c"]


def test_severity_edges(spark):
    values = [8.0, 7.99, 7.0, 6.0, 5.0, 4.0, 3.99, None]
    assert one(spark, values, "v double", severity("v")) == [
        "great",
        "major",
        "major",
        "strong",
        "moderate",
        "light",
        "minor",
        "minor",
    ]
    assert one(spark, [1.0], "v double", banded("v", [], "none")) == ["none"]


def test_position_in_order(spark):
    assert one(spark, ["minor", "great", "other", None], "v string", position_in("v", SEVERITY_ORDER)) == [0, 5, None, None]


def test_mapped(spark):
    assert one(spark, [0, 6, 9, None], "v int", weekday_label("v")) == ["Mon", "Sun", None, None]
    assert one(spark, [True, False, None], "v boolean", mapped("v", {True: "Merge", False: "Regular"})) == [
        "Merge",
        "Regular",
        None,
    ]


def test_weekday_monday_is_zero(spark):
    days = [datetime(2024, 1, 1), datetime(2024, 1, 7)]
    assert one(spark, days, "v timestamp_ntz", weekday_index("v")) == [0, 6]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_truncated_keeps_type(spark, kind):
    df = spark.createDataFrame([("2024-02-29 13:14:15",)], "v string").select(F.col("v").cast(kind).alias("v"))
    out = df.select(truncated(df, "v", "month").alias("m"))
    assert out.schema["m"].dataType.simpleString() == kind
    assert out.select(F.col("m").cast("string")).first()[0] == "2024-02-01 00:00:00"


def test_percentage_and_means(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (2, 3)], "a int, b int")
    assert [r[0] for r in df.select(percentage("a", "b")).collect()] == [33.3, None, 66.7]
    assert df.agg(rounded_mean("a")).first()[0] == 1.0


def test_count_true(spark):
    df = spark.createDataFrame([("a", True), ("a", False), ("a", None), ("b", None)], "k string, v boolean")
    assert sorted(df.groupBy("k").agg(count_true("v")).collect()) == [("a", 1), ("b", None)]


def test_floor_bin(spark):
    assert one(spark, [2.74, 2.5, -0.1, None], "v double", floor_bin("v", 0.5)) == [2.5, 2.5, -0.5, None]
    assert one(spark, [499, 500, 1999], "v int", floor_bin("v", 500)) == [0.0, 500.0, 1500.0]


def test_epoch_ms(spark):
    out = spark.createDataFrame([(1704067200123,), (None,)], "v bigint").select(from_epoch_ms("v").cast("string"))
    assert [r[0] for r in out.collect()] == ["2024-01-01 00:00:00.123", None]


def test_local_days_across_clock_changes(spark):
    stamps = ["2026-04-14 10:00:00", "2024-03-31 12:00:00", "2024-10-27 12:00:00", "2024-01-05 23:30:00"]
    df = spark.createDataFrame([(s,) for s in stamps], "v string").select(F.col("v").cast("timestamp").alias("v"))
    start, end = local_day_start("v", "Europe/Berlin"), local_day_end("v", "Europe/Berlin")
    out = df.select(start.cast("string"), ((F.unix_timestamp(end) - F.unix_timestamp(start)) / 3600).cast("int")).collect()
    assert [tuple(r) for r in out] == [
        ("2026-04-13 22:00:00", 24),
        ("2024-03-30 23:00:00", 23),
        ("2024-10-26 22:00:00", 25),
        ("2024-01-05 23:00:00", 24),
    ]


def test_remerged_with_and_without_variant(spark):
    both = spark.createDataFrame([(3, None), (None, 2.5), (None, None)], "d bigint, d__v_double double")
    assert [r[0] for r in both.select(remerged(both, "d")).collect()] == [3.0, 2.5, None]
    plain = both.select("d")
    assert [r[0] for r in plain.select(remerged(plain, "d")).collect()] == [3.0, None, None]
