import itertools
import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark import Incremental, Pipeline, Resource, Source, TimeWindow
from tidemark.plans import NullCursor, quakes
from tidemark.streaming import landed_files, load_stream


def events(spark, stamps):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "id bigint, s string")
    return df.select("id", F.col("s").cast("timestamp").alias("time"))


STAMPS = ["2024-01-01 00:00:00", "2024-01-01 12:00:00", "2024-01-02 00:00:00", "2024-01-02 00:00:01", None]


def test_windows_are_closed_and_utc(spark):
    df = events(spark, STAMPS)
    window = TimeWindow("2024-01-01T01:00:00+01:00", "2024-01-02T00:00:00+00:00")
    assert sorted(r.id for r in window.rows(df, "time").collect()) == [0, 1, 2]
    naive = df.withColumn("time", F.col("time").cast("timestamp_ntz"))
    assert sorted(r.id for r in window.rows(naive, "time").collect()) == [0, 1, 2]
    with pytest.raises(ValueError):
        TimeWindow("2024-01-02", "2024-01-01")


def test_whole_days_and_lag():
    window = TimeWindow("2024-01-01T05:00:00", "2024-01-02T00:00:00")
    wide = window.whole_days()
    assert wide.start == datetime(2024, 1, 1, tzinfo=timezone.utc)
    assert wide.end == datetime(2024, 1, 2, 23, 59, 59, 999999, tzinfo=timezone.utc)
    assert window.with_lag(timedelta(hours=2)).start.hour == 3


@pytest.mark.parametrize("on_null,ids", [("include", [1, 2, 4]), ("exclude", [1, 2])])
def test_null_cursors(spark, run, on_null, ids):
    cursor = Incremental("time", "2024-01-01T12:00:00", "2024-01-02", on_null=on_null)
    run.run(Resource("e", lambda s: events(spark, STAMPS), "merge", "id", incremental=cursor))
    assert sorted(r.id for r in run.dataset().e.collect()) == ids


def test_null_cursor_raises_and_publishes_nothing(spark, run):
    cursor = Incremental("time", "2024-01-01T12:00:00", "2024-01-02")
    with pytest.raises(NullCursor):
        run.run(Resource("e", lambda s: events(spark, STAMPS), "merge", "id", incremental=cursor))
    assert run.dataset().tables == [] and run.state == []


def test_append_over_closed_windows_is_refused(spark, run):
    cursor = Incremental("time", "2024-01-01", "2024-01-02", on_null="exclude")
    with pytest.raises(ValueError, match="merge"):
        run.run(Resource("e", lambda s: events(spark, STAMPS), incremental=cursor))


def test_saved_cursor_is_restored(spark, run):
    cursor = Incremental("time", on_null="exclude")
    bound = Source.of("app", [Resource("e", lambda s: events(spark, STAMPS[:3]), incremental=cursor)])
    assert run.restore_incremental(bound.e, cursor) is None
    run.run(bound, load_id="1")
    saved = run.restore_incremental(bound.e, cursor)
    assert saved.start == "2024-01-02T00:00:00+00:00" and saved.on_null == "exclude"
    more = bound.e.with_rows(events(spark, STAMPS)).with_hints(incremental=saved)
    run.run(Source.of("app", [more]), load_id="2")
    assert sorted(r.id for r in run.dataset().e.collect()) == [0, 1, 2, 3]
    again = Source.of("app", [more.with_hints(incremental=run.restore_incremental(bound.e, cursor))])
    assert run.run(again, load_id="3").row_counts == {"e": 0}
    assert run.restore_incremental(bound.e, cursor).start == "2024-01-02T00:00:01+00:00"
    with pytest.raises(ValueError):
        run.restore_incremental(Resource("e", lambda s: None), cursor)


def test_rows_that_arrive_at_the_saved_value_are_not_lost(spark, run, rows):
    """As many rows as the source has then are stored in the end, copies too."""
    cursor = Incremental("n")
    first = spark.createDataFrame([(1, "a"), (5, "b"), (5, "b")], "n bigint, v string")
    bound = Source.of("app", [Resource("t", lambda s: first, incremental=cursor)])
    run.run(bound, load_id="1")
    second = spark.createDataFrame([(5, "b"), (5, "b"), (5, "b"), (5, "c"), (6, "d")], "n bigint, v string")
    saved = run.restore_incremental(bound.t, cursor)
    run.run(Source.of("app", [bound.t.with_rows(second).with_hints(incremental=saved)]), load_id="2")
    assert rows(run.dataset().t, "n", "v") == [(1, "a"), (5, "b"), (5, "b"), (5, "b"), (5, "c"), (6, "d")]
    nested = spark.createDataFrame([(1, [(1,)])], "n bigint, kids array<struct<a: bigint>>")
    deep = Source.of("app", [Resource("u", lambda s: nested, incremental=cursor)])
    run.run(deep, load_id="3")
    with pytest.raises(ValueError, match="primary key"):
        run.run(Source.of("app", [deep.u.with_hints(incremental=run.restore_incremental(deep.u, cursor))]), load_id="4")


def test_number_cursor_with_lag(spark, run):
    cursor = Incremental("id", lag=2)
    bound = Source.of("app", [Resource("n", lambda s: s.range(10), "merge", "id", incremental=cursor)])
    run.run(bound, load_id="1")
    saved = run.restore_incremental(bound.n, cursor)
    read = run.run(Source.of("app", [bound.n.with_hints(incremental=saved)]), load_id="2")
    assert read.row_counts == {"n": 3} and run.dataset().n.count() == 10


def quake_rows(spark):
    stamps = [f"2024-01-0{1 + h // 24} {h % 24:02d}:30:00" for h in range(0, 72, 5)]
    df = events(spark, stamps)
    return df.select(
        "id", "time", F.lit("x, Chile").alias("place"), F.col("id").cast("double").alias("magnitude"), F.lit(1.0).alias("depth_km")
    )


def stats(run):
    return sorted(tuple(r) for r in run.dataset()["earthquake_daily_stats"].select("day", "region", "event_count").collect())


def test_windows_in_any_order_equal_one_window(spark, tmp_path):
    data = {"earthquakes": quake_rows(spark)}
    spans = [("2024-01-01T03:00:00", "2024-01-01T20:00:00"), ("2024-01-01T18:00:00", "2024-01-02T08:00:00"), ("2024-01-02T07:00:00", "2024-01-03T22:00:00")]
    whole = Pipeline(spark, "whole", str(tmp_path))
    whole.run(quakes.earthquake_daily_stats(data))
    for number, order in enumerate(list(itertools.permutations(spans))[::2]):
        run = Pipeline(spark, f"p{number}", str(tmp_path))
        for load, span in enumerate(order):
            run.run(quakes.earthquake_daily_stats(data, TimeWindow(*span)), load_id=str(load))
        assert stats(run) == stats(whole)


def test_unaligned_window_keeps_only_its_part(spark):
    data = {"earthquakes": quake_rows(spark)}
    window = TimeWindow("2024-01-01T03:00:00", "2024-01-01T12:00:00")
    part = quakes.earthquake_daily_stats(data, window, align="none").rows(spark).collect()
    full = quakes.earthquake_daily_stats(data, window).rows(spark).collect()
    assert [r.event_count for r in part] == [2] and [r.event_count for r in full] == [5]


def test_micro_batches_continue(spark, run, tmp_path):
    landing, progress = tmp_path / "landing", str(tmp_path / "progress")
    landing.mkdir()

    def land(name, items):
        (landing / name).write_text("\n".join(json.dumps(i) for i in items))

    def drain():
        stream = landed_files(spark, str(landing), "id bigint, v string, u bigint", files_per_batch=1)
        target = Resource("e", lambda s: stream, "merge", "id", newest="u", buckets=2)
        load_stream(stream, run, target, progress).awaitTermination()
        return sorted(tuple(r) for r in run.dataset().e.select("id", "v").collect())

    land("1.json", [{"id": 1, "v": "a", "u": 1}, {"id": 2, "v": "b", "u": 1}])
    assert drain() == [(1, "a"), (2, "b")]
    land("2.json", [{"id": 2, "v": "B", "u": 2}, {"id": 3, "v": "c", "u": 1}])
    land("3.json", [{"id": 4, "v": "d", "u": 1}])
    assert drain() == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    before = run.dataset().loads().count()
    assert drain() == [(1, "a"), (2, "B"), (3, "c"), (4, "d")] and run.dataset().loads().count() == before == 3
