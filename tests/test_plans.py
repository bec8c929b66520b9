import json

import pytest
from pyspark.sql import functions as F

from tidemark import Pipeline, Resource, TimeWindow
from tidemark.operators.normalize import flagged_columns
from tidemark.operators.quality import CheckSuite, DataQualityError, prepare_checks, read_metric, run_metrics
from tidemark.plans import commits, quakes, shop, videos


# ---- shop ----


@pytest.fixture
def fruit(run):
    run.run(shop.fruit_shop())
    return run.dataset()


def test_fruit_shop(fruit, rows):
    assert rows(fruit.row_counts()) == [("customers", 13), ("inventory", 6), ("inventory_categories", 3), ("purchases", 100)]
    assert rows(shop.customers_per_city(fruit.customers)) == [("berlin", 5), ("montreal", 4), ("new york", 4)]
    assert flagged_columns(fruit.customers, "pii") == ["name"]
    assert dict(fruit.inventory.dtypes)["price"] == "decimal(10,2)"


def test_inventory_checks(fruit, rows):
    got = prepare_checks(fruit.inventory, shop.INVENTORY_CHECKS, "table", "inventory")
    assert rows(got, "check_name", "passed", "failed") == [
        ("name__is_in", 3, 3),
        ("price__case__LT", 0, 6),
        ("price__is_not_null", 6, 0),
    ]
    suite = CheckSuite(fruit, {"inventory": shop.INVENTORY_CHECKS})
    assert rows(suite.get_successes("inventory", "name__is_in"), "name") == [("apple",), ("cherry",), ("pear",)]
    assert rows(suite.get_failures("inventory", "name__is_in"), "name") == [("peach",), ("plum",), ("strawberry",)]


def test_customer_metrics(spark, warehouse, rows):
    ingest = Pipeline(spark, "ingest", warehouse)
    orders = spark.createDataFrame(
        [("o1", "c1", "2017-01-01"), ("o2", "c1", "2017-01-09"), ("o3", "c2", "2017-01-03")],
        "id string, customer_id string, ordered_at string",
    ).withColumn("ordered_at", F.col("ordered_at").cast("timestamp"))
    paid = spark.createDataFrame(
        [("o1", "1.50"), ("o1", "2.00"), ("o2", None), ("o3", None), ("zz", "7.25")], "order_id string, amount string"
    ).withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    ingest.run([Resource("orders", lambda s: orders, "replace"), Resource("payments", lambda s: paid, "replace")])
    made = Pipeline(spark, "metrics", warehouse)
    info = made.run(shop.customer_metrics(ingest.dataset()))
    assert info.row_counts == {"customer_orders": 2, "customer_payments": 3}
    got = made.dataset()["customer_orders"].select(
        "customer_id", F.col("first_order").cast("string"), F.col("most_recent_order").cast("string"), "number_of_orders"
    )
    assert rows(got) == [("c1", "2017-01-01 00:00:00", "2017-01-09 00:00:00", 2), ("c2", "2017-01-03 00:00:00", "2017-01-03 00:00:00", 1)]
    totals = made.dataset()["customer_payments"].select("customer_id", F.col("total_amount").cast("double"))
    assert rows(totals) == sorted([("c1", 3.5), ("c2", None), (None, 7.25)], key=repr)


# ---- earthquakes ----


def feature(number, stamp, magnitude=3.0, place="x, Chile", depth=10.0, updated=None):
    return {
        "id": f"q{number}",
        "properties": {"mag": magnitude, "place": place, "time": stamp, "updated": updated or stamp, "type": "earthquake"},
        "geometry": {"coordinates": [1.0, 2.0, depth]},
    }


DAY = 86_400_000
T0 = 1_704_067_200_000  # 2024-01-01 UTC


def land(folder, name, features):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({"type": "FeatureCollection", "features": features}))


def test_quake_feeds_end_to_end(spark, run, tmp_path, rows):
    events, summary = tmp_path / "events", tmp_path / "summary"
    land(
        events,
        "a.geojson",
        [
            feature(1, T0),
            feature(2, T0 + DAY, place=None),
            feature(3, T0 + 2 * DAY, place=""),
            feature(4, T0 + 2 * DAY + 1),
            feature(5, None),
            feature(6, T0 + 5, magnitude=2.4),
            feature(7, T0 + 6, magnitude=4.0, place="Alaska", updated=T0 + 7),
        ],
    )
    land(summary, "s.geojson", [feature(i, T0, magnitude=m) for i, m in enumerate([None, 3.9, 4, 5, 6, 7, 8])])
    window = TimeWindow("2024-01-01T00:00:00", "2024-01-03T00:00:00")
    run.run(quakes.quake_feeds(str(events), str(summary), window), load_id="1")
    assert rows(run.dataset().earthquakes, "id") == [("q1",), ("q2",), ("q3",), ("q7",)]
    land(events, "b.geojson", [feature(7, T0 + 6, magnitude=5.5, place="Alaska", updated=T0 + 9)])
    run.run(quakes.quake_feeds(str(events), str(summary), window).with_resources("earthquakes"), load_id="2")
    assert rows(run.dataset().earthquakes.where("id = 'q7'"), "magnitude") == [(5.5,)]

    run.run(quakes.earthquake_daily_stats(run.dataset(), window), load_id="3")
    stats = run.dataset()["earthquake_daily_stats"]
    assert rows(stats.select(F.col("day").cast("string"), "region", "event_count", "max_magnitude", "avg_depth_km")) == [
        ("2024-01-01", "Alaska", 1, 5.5, 10.0),
        ("2024-01-01", "Chile", 1, 3.0, 10.0),
        ("2024-01-02", "Unknown", 1, 3.0, 10.0),
        ("2024-01-03", "Unknown", 1, 3.0, 10.0),
    ]
    assert [tuple(r)[1] for r in quakes.events_per_day(stats).collect()] == [2, 1, 1]
    assert [tuple(r) for r in quakes.largest_regions(stats, 2).collect()] == [("Unknown", 2), ("Alaska", 1)]

    run.run(quakes.feeds_summary_classified(run.dataset()), load_id="4")
    classified = run.dataset()["feeds_summary_classified"]
    assert rows(classified, "id", "severity") == [
        ("q0", "minor"),
        ("q1", "minor"),
        ("q2", "light"),
        ("q3", "moderate"),
        ("q4", "strong"),
        ("q5", "major"),
        ("q6", "great"),
    ]
    assert [r.severity for r in quakes.severity_counts(classified).collect()] == [
        "minor",
        "light",
        "moderate",
        "strong",
        "major",
        "great",
    ]
    assert [tuple(r) for r in quakes.magnitude_bins(run.dataset().earthquakes).collect()] == [(3.0, 3), (5.5, 1)]
    assert quakes.magnitude_and_depth(run.dataset().earthquakes).count() == 4


def test_depth_variant_is_read_back(spark, run, rows):
    run.run(spark.createDataFrame([(1, 3.0, 10, "e")], "id bigint, magnitude double, depth_km bigint, type string"), "earthquakes", load_id="1")
    more = spark.createDataFrame([(2, 4.0, 10.5, "e"), (3, None, 1.5, "e")], "id bigint, magnitude double, depth_km double, type string")
    run.run(more, "earthquakes", load_id="2")
    assert rows(quakes.magnitude_and_depth(run.dataset().earthquakes)) == [(3.0, 10.0, "e"), (4.0, 10.5, "e")]


# ---- commits ----


def commit(number, login, parents, message="fix", verified=True, date="2024-01-31T10:00:00Z", count=0):
    return {
        "sha": f"s{number}",
        "author": None if login is None else {"login": login},
        "committer": {"login": login},
        "commit": {
            "author": {"name": f"N{login}", "email": "e", "date": date},
            "committer": {"date": date},
            "message": message,
            "comment_count": count,
            "verification": {"verified": verified},
        },
        "parents": [{"sha": f"p{i}"} for i in range(parents)],
    }


COMMITS = [
    commit(1, "ann", 1),
    commit(2, "ann", 2, message="", verified=False, date="2024-02-01T00:00:00Z"),
    commit(3, None, 0, message="longer text", count=4),
]
PEOPLE = [
    {"login": "ann", "id": 1, "type": "User", "contributions": 3},
    {"login": None, "id": 2, "type": "Bot", "contributions": 1},
    {"login": "org", "id": 3, "type": "Organization", "contributions": 0},
]


@pytest.fixture
def host(run, tmp_path):
    for name, items in (("commits", COMMITS), ("people", PEOPLE)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "page-1.json").write_text(json.dumps(items))
    made = commits.code_host(str(tmp_path / "commits"), str(tmp_path / "people"))
    run.run(
        [made.commits.with_metrics(*commits.COMMIT_METRICS), made.contributors.with_metrics(*commits.CONTRIBUTOR_METRICS)],
        load_id="1",
    )
    return run


def test_commit_table(spark, host, warehouse, rows):
    made = Pipeline(spark, "analytics", warehouse)
    made.run(commits.commits(host.dataset()))
    table = made.dataset()["commits"].drop("_load_id")
    assert len(table.columns) == 13
    assert rows(table, "sha", "author_login", "message_length", "is_verified", "comment_count", "parent_count", "is_merge_commit") == [
        ("s1", "ann", 3, True, 0, 1, False),
        ("s2", "ann", 0, False, 0, 2, True),
        ("s3", "unknown", 11, True, 4, 0, False),
    ]
    glance = commits.at_a_glance(table).first().asDict()
    assert glance == {"total": 3, "merges": 1, "authors": 2, "verified": 2, "avg_message": 4.7, "regular": 2}
    top = commits.author_breakdown(table).collect()
    assert list(top[0].asDict()) == ["Author", "Total", "Merges", "Verified", "Avg Msg Len", "Merge %", "Verified %"]
    assert tuple(top[0]) == ("ann", 2, 1, 1, 1.5, 50.0, 50.0)
    assert [(r.total, r.merges, r.regular, r.merge_ratio) for r in commits.monthly_activity(table).collect()] == [
        (2, 0, 2, 0.0),
        (1, 1, 0, 100.0),
    ]
    assert [r.unique_authors for r in commits.monthly_authors(table).collect()] == [2, 1]
    assert [(r.verified, r.unverified) for r in commits.monthly_verification(table).collect()] == [(2, 0), (0, 1)]
    assert [(r.day_name, r.hour, r.commits) for r in commits.commit_hours(table).collect()] == [("Wed", 10, 2), ("Thu", 0, 1)]
    assert commits.message_lengths(table, 5).agg(F.sum("n")).first()[0] == 3


def test_commit_quality_gate(host):
    data = host.dataset()
    suite = CheckSuite(data, {"commits": commits.COMMIT_CHECKS})
    assert all(r["ok"] for r in suite.gate())
    suite.add_checks("contributors", commits.CONTRIBUTOR_CHECKS)
    with pytest.raises(DataQualityError) as caught:
        suite.gate()
    assert [line for line in str(caught.value).splitlines() if line.startswith("FAIL")] == [
        "FAIL: contributors.login__is_not_null -- 1 failures",
        "FAIL: contributors.type__is_in -- 1 failures",
        "FAIL: contributors.contributions__case__GT -- 1 failures",
    ]


def test_commit_metrics(host):
    run_metrics(host, "r")
    value = read_metric(host.dataset(), "commits", "maximum", "commit__comment_count").first().value
    assert value == 4.0
    assert read_metric(host.dataset(), "contributors", "row_count").first().value == 3.0


def test_schema_and_times_are_inferred(spark, run, tmp_path):
    folder = tmp_path / "landed"
    folder.mkdir()
    (folder / "page-1.json").write_text(json.dumps(COMMITS))
    from tidemark import paged_resource

    run.run(paged_resource("raw", str(folder), infer_times=True), load_id="1")
    kinds = dict(run.dataset()["raw"].dtypes)
    assert kinds["commit__author__date"] == "timestamp" and kinds["commit__message"] == "string"
    assert kinds["commit__verification__verified"] == "boolean" and kinds["commit__comment_count"] == "bigint"
    later = [commit(9, "bob", 1, date="2024-03-01T00:00:00Z"), commit(10, "bob", 1, date="soon")]
    (folder / "page-1.json").write_text(json.dumps(later))
    run.run(paged_resource("raw", str(folder), infer_times=True), load_id="2")
    got = run.dataset()["raw"].orderBy("sha").select(F.col("commit__author__date").cast("string"), "commit__author__date__v_text")
    assert [tuple(r) for r in got.collect()] == [(None, "soon"), ("2024-03-01 00:00:00", None)]


# ---- videos ----


def test_videos(spark, run, tmp_path, rows):
    data = [
        ("a", "x", 6.0, 3.0, 0.995, "pan", 30.0, 3.0, 90, [1.0]),
        ("a", "y", 11.0, 3.0, 1.0005, "dolly", 121.0, 3.0, 90, [1.0]),
        (None, None, None, 3.0, 0.9, None, 0.0, 0.0, 0, [1.0]),
        ("d", "z", 5.0, 2.0, 0.99, "pan", 24.0, 2.0, 1, [1.0]),
    ]
    schema = (
        "video_path string, caption string, aesthetic_score double, motion_score double, temporal_consistency_score double,"
        " camera_motion string, fps double, seconds double, frame bigint, embedding array<double>"
    )
    spark.createDataFrame(data, schema).write.parquet(str(tmp_path / "in/part"))
    run.run(videos.video_files(str(tmp_path / "in")))
    table = run.dataset().videos
    assert "embedding" not in table.columns
    failed = {r.check_name: r.failed for r in prepare_checks(table, videos.VIDEO_CHECKS, "table", "videos").collect()}
    assert failed == {
        "video_path__is_unique": 3,
        "video_path__is_not_null": 1,
        "caption__is_not_null": 1,
        "aesthetic_score__is_not_null": 1,
        "motion_score__is_not_null": 0,
        "aesthetic_score__case__Between": 2,
        "motion_score__case__GTE": 0,
        "temporal_consistency_score__case__Between": 0,
        "fps__case__And": 2,
        "seconds__case__GT": 1,
        "frame__case__GT": 1,
        "camera_motion__case__In": 2,
    }
    assert rows(videos.curated_videos(table), "caption") == [("x",), ("y",), ("z",)]
    assert tuple(videos.share_kept(table).first()) == (3, 3, 100.0)
    assert [tuple(r) for r in videos.by_camera_motion(table).collect()] == [("pan", 2, 2.5), ("dolly", 1, 3.0), (None, 0, 3.0)]
    assert videos.overall(table).first().total == 3
    assert {r.metric for r in videos.comparison(table).collect()} == {"count", *videos.MEANS}
