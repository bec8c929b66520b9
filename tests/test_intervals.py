import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import intervals
from tidemark.windows import TimeWindow

ORIGIN = datetime(2024, 1, 1)


def brute(spans):
    out = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end), out[-1][2] + 1)
        else:
            out.append((start, end, 1))
    return out


def log(spark, spans, kind="timestamp_ntz"):
    df = spark.createDataFrame([(j, s, e) for j, s, e in spans], "job string, s timestamp_ntz, e timestamp_ntz")
    return df.select("job", F.col("s").cast(kind).alias("s"), F.col("e").cast(kind).alias("e"))


@pytest.fixture
def many_parts(spark):
    """Parts as small as they get: no partition is put together with another."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield 13
    spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("seed,longest", [(1, 5), (2, 60), (3, 400), (4, 30), (5, 3)])
def test_islands_and_gaps_equal_brute_force(spark, many_parts, seed, longest):
    pick = random.Random(seed)
    spans = []
    for job in ("a", "b", None):
        for _ in range(60):
            start = ORIGIN + timedelta(hours=pick.randrange(0, 900))
            spans.append((job, start, start + timedelta(hours=pick.randrange(0, longest))))
    df = log(spark, spans)
    want_islands, want_gaps = [], []
    for job in ("a", "b", None):
        merged = brute([(s, e) for j, s, e in spans if j == job])
        want_islands += [(job, s, e, n) for s, e, n in merged]
        want_gaps += [(job, a[1], b[0]) for a, b in zip(merged, merged[1:])]
    got = [tuple(r) for r in intervals.islands(df, "s", "e", ["job"]).collect()]
    assert sorted(got, key=repr) == sorted(want_islands, key=repr)
    got = [tuple(r) for r in intervals.gaps(df, "s", "e", ["job"]).collect()]
    assert sorted(got, key=repr) == sorted(want_gaps, key=repr)


def test_touching_nested_and_empty_intervals(spark):
    day = timedelta(days=1)
    spans = [
        ("a", ORIGIN, ORIGIN + day),
        ("a", ORIGIN + day, ORIGIN + 2 * day),
        ("a", ORIGIN, ORIGIN + 5 * day),
        ("a", ORIGIN + 5 * day, ORIGIN + 5 * day),
        ("a", ORIGIN + 6 * day, ORIGIN + 7 * day),
    ]
    got = intervals.islands(log(spark, spans), "s", "e", ["job"]).collect()
    assert sorted((r.island_end - r.island_start, r.n) for r in got) == [(day, 1), (5 * day, 4)]
    gaps = intervals.gaps(log(spark, spans), "s", "e", ["job"]).collect()
    assert [(r.gap_start, r.gap_end) for r in gaps] == [(ORIGIN + 5 * day, ORIGIN + 6 * day)]


def test_without_groups_and_null_bounds(spark):
    spans = [("a", ORIGIN, ORIGIN + timedelta(hours=1)), ("b", None, ORIGIN), ("c", ORIGIN + timedelta(hours=1), ORIGIN + timedelta(hours=30))]
    got = intervals.islands(log(spark, spans, "timestamp"), "s", "e").collect()
    assert [(r.n, r.island_end - r.island_start) for r in got] == [(2, timedelta(hours=30))]


def test_a_hot_group_is_spread_and_long_intervals_stay_one_row(spark, many_parts):
    pick = random.Random(9)
    spans = [("hot", ORIGIN + timedelta(minutes=10 * pick.randrange(5000)), 5) for _ in range(3000)]
    spans += [("hot", ORIGIN + timedelta(days=10), 60 * 24 * 3650), ("cold", ORIGIN, 5)]
    rows = [(j, s, s + timedelta(minutes=m)) for j, s, m in spans]
    df = log(spark, rows)
    local, _ = intervals._local_islands(df, "s", "e", ["job"], None)
    hot = local.where("_g0 = 'hot'")
    assert hot.select("part").distinct().count() >= many_parts - 2
    assert local.count() <= len({r[:2] for r in rows})
    want = brute([(s, e) for j, s, e in rows if j == "hot"])
    got = sorted((r.island_start, r.island_end, r.n) for r in intervals.islands(df, "s", "e", ["job"]).where("job = 'hot'").collect())
    assert got == want
    # Ungrouped, and as gaps: more than one task works on them, none on all rows.
    merged = brute([(s, e) for _, s, e in rows])
    gaps = intervals.gaps(df, "s", "e")
    assert sorted((r.gap_start, r.gap_end) for r in gaps.collect()) == [(a[1], b[0]) for a, b in zip(merged, merged[1:])]
    local, _ = intervals._local_islands(df, "s", "e", [], None)
    assert local.select("part").distinct().count() >= many_parts - 2


def test_names_of_groups_may_be_those_used_inside(spark, many_parts):
    df = spark.createDataFrame([("a", 1, 3, 2), ("a", 2, 4, 5), (None, 9, 9, 1)], "s string, part int, e int, n int")
    got = intervals.islands(df, "part", "e", ["s"], counted="n").collect()
    assert sorted(map(tuple, got), key=repr) == [("a", 1, 4, 7), (None, 9, 9, 1)]
    assert intervals.gaps(df.where("false"), "part", "e", ["s"]).collect() == []


def test_freshness(spark):
    rows = [
        ("a", ORIGIN, ORIGIN + timedelta(hours=2), "completed"),
        ("a", ORIGIN, ORIGIN + timedelta(hours=9), "failed"),
        ("b", ORIGIN, ORIGIN + timedelta(hours=5), "completed"),
    ]
    df = spark.createDataFrame(rows, "job string, interval_start timestamp, interval_end timestamp, status string")
    got = {r.job: r.is_fresh for r in intervals.freshness(df, TimeWindow(ORIGIN, ORIGIN + timedelta(hours=5))).collect()}
    assert got == {"a": False, "b": True}


def test_freshness_needs_the_whole_interval(spark):
    at = lambda h: ORIGIN + timedelta(hours=h)
    rows = [
        ("hole", at(0), at(3), "completed"),
        ("hole", at(3), at(4), "failed"),
        ("hole", at(4), at(9), "completed"),
        ("late", at(2), at(9), "completed"),
        ("whole", at(-30), at(4), "completed"),
        ("whole", at(3), at(12), "completed"),
        ("never", at(0), at(9), "failed"),
    ]
    df = spark.createDataFrame(rows, "job string, interval_start timestamp, interval_end timestamp, status string")
    got = {r.job: (r.is_fresh, r.covered_to) for r in intervals.freshness(df, TimeWindow(at(1), at(8))).collect()}
    assert {job: fresh for job, (fresh, _) in got.items()} == {"hole": False, "late": False, "whole": True, "never": False}
    assert got["hole"][1] == at(3) and got["late"][1] is None and got["whole"][1] == at(12)


def test_reversed_intervals_are_left_out(spark):
    spans = [("a", ORIGIN, ORIGIN + timedelta(hours=1)), ("a", ORIGIN + timedelta(hours=5), ORIGIN), ("a", None, ORIGIN)]
    df = log(spark, spans)
    assert [r.n for r in intervals.islands(df, "s", "e", ["job"]).collect()] == [1]
    assert intervals.rejected(df, "s", "e").count() == 2
