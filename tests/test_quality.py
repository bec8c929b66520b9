import pytest
from pyspark.sql import functions as F

from tidemark import Resource
from tidemark.operators import quality as q
from tidemark.operators.quality import checks, metrics

DATA = [
    ("a", 1.0, "pan"),
    ("b", None, "dolly"),
    ("b", -1.0, None),
    (None, 3.0, "pan"),
]


@pytest.fixture
def videos(spark):
    return spark.createDataFrame(DATA, "path string, score double, motion string")


RULES = [
    checks.is_unique("path"),
    checks.is_not_null("path"),
    checks.is_in("motion", ["pan", "tilt"]),
    checks.case("score > 0"),
]


def test_names():
    assert checks.is_in("name", [1]).name == "name__is_in"
    assert checks.is_not_null("price").name == "price__is_not_null"
    expected = {
        "price < 0": "price__case__LT",
        "n >= 0": "n__case__GTE",
        "motion IN ('static', 'AND')": "motion__case__In",
        "score BETWEEN 0 AND 10": "score__case__Between",
        "fps > 0 AND fps <= 120": "fps__case__And",
        "a = 1 or b = 2": "a__case__Or",
        "a != 1": "a__case__NEQ",
        "a = 1": "a__case__EQ",
        "a LIKE 'x%'": "a__case__Like",
    }
    assert {c: q.case_name(c) for c in expected} == expected
    twice = q.distinct_names([checks.case("a > 1"), checks.case("a > 2"), checks.case("a > 3", name="mine")])
    assert [c.name for c in twice] == ["a__case__GT", "a__case__GT_2", "mine"]


def test_row_level(videos, rows):
    got = q.prepare_checks(videos, RULES, "row", keys=["path", "score"])
    assert got.columns == ["path", "score", "path__is_unique", "path__is_not_null", "motion__is_in", "score__case__GT"]
    assert rows(got) == sorted(
        [
            ("a", 1.0, True, True, True, True),
            ("b", None, False, True, False, False),
            ("b", -1.0, False, True, False, False),
            (None, 3.0, False, False, True, True),
        ],
        key=repr,
    )


def test_table_level_adds_up_to_row_level(videos):
    table = {r.check_name: r for r in q.prepare_checks(videos, RULES, "table", "videos").collect()}
    row = q.prepare_checks(videos, RULES, "row")
    for rule in RULES:
        passed = row.where(F.col(rule.name)).count()
        result = table[rule.name]
        assert (result.n_rows, result.passed, result.failed) == (4, passed, 4 - passed)
        assert result.success_rate == passed / 4 and result.ok == (passed == 4)


def test_failures_and_successes_partition_the_table(videos, rows):
    suite = q.CheckSuite({"videos": videos}, {"videos": RULES})
    for rule in suite.checks["videos"]:
        failures, successes = suite.get_failures("videos", rule.name), suite.get_successes("videos", rule.name)
        assert rows(failures.unionByName(successes)) == rows(videos)
    with pytest.raises(KeyError):
        suite.get_failures("videos", "nothing")


def test_dataset_level_and_gate(spark, videos):
    good = spark.createDataFrame([(1,), (2,)], "id bigint")
    suite = q.CheckSuite({"videos": videos, "good": good}, {"good": [checks.is_unique("id")]})
    assert [r["ok"] for r in suite.gate()] == [True]
    suite.add_checks("videos", RULES)
    verdict = suite.results("dataset").where("check_name = 'verdict'").first()
    assert (verdict.table_name, verdict.n_rows, verdict.passed, verdict.failed, verdict.ok) == ("*", 5, 1, 4, False)
    with pytest.raises(q.DataQualityError, match="FAIL: videos.score__case__GT -- 2 failures") as caught:
        suite.gate()
    assert "PASS: good.id__is_unique" in str(caught.value) and len(caught.value.results) == 5
    assert len(suite.gate(threshold=0.25)) == 5


def test_empty_table_passes(videos):
    got = q.prepare_checks(videos.where("false"), RULES, "table").collect()
    assert all(r.ok and r.n_rows == 0 and r.success_rate == 1.0 for r in got) and len(got) == 4


def test_orphans(spark, rows):
    child = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "order_id bigint, v string")
    parent = spark.createDataFrame([(1,)], "id bigint")
    assert rows(q.orphans(child, parent, {"order_id": "id"}), "v") == [("b",), ("c",)]


ALL = [
    metrics.column.null_count("path"),
    metrics.column.null_rate("path"),
    metrics.column.unique_count("path"),
    metrics.column.unique_count("motion"),
    metrics.column.mean("score"),
    metrics.column.maximum("score"),
    metrics.column.minimum("score"),
    metrics.table.row_count(),
]


def test_metrics(videos):
    got = {(r.column_name, r.metric): r.value for r in q.compute_metrics(videos, ALL, "videos").collect()}
    assert got == {
        ("path", "null_count"): 1.0,
        ("path", "null_rate"): 0.25,
        ("path", "unique_count"): 2.0,
        ("motion", "unique_count"): 2.0,
        ("score", "mean"): 1.0,
        ("score", "maximum"): 3.0,
        ("score", "minimum"): -1.0,
        (None, "row_count"): 4.0,
    }
    empty = {r.metric: r.value for r in q.compute_metrics(videos.where("false"), ALL[:2] + ALL[4:], "v").collect()}
    assert empty["null_rate"] is None and empty["mean"] is None and empty["row_count"] == 0.0
    approx = q.compute_metrics(videos, [metrics.column.unique_count("path", approximate=True)], "v").first()
    assert approx.value == 2.0


def test_metric_history(run, videos):
    run.run(q.with_metrics(Resource("videos", lambda s: videos, "replace"), *ALL), load_id="1")
    assert q.run_metrics(run, "r1").count() == 8
    run.run(Resource("videos", lambda s: videos.where("path = 'a'"), "replace"), load_id="2")
    q.run_metrics(run, "r2", extra=[metrics.dataset.row_count()])
    history = q.read_metric(run.dataset(), "videos", "row_count")
    assert [(r.run_id, r.load_id, r.value) for r in history.collect()] == [("r1", "1", 4.0), ("r2", "2", 1.0)]
    nulls = q.read_metric(run.dataset(), "videos", "null_count", "path")
    assert [r.value for r in nulls.collect()] == [1.0, 0.0]
    assert [r.value for r in q.read_metric(run.dataset(), None, "row_count").collect()] == [1.0]
    assert run.dataset().tables == ["videos"]
    assert run.dataset()("SELECT count(*) AS n FROM _dq_metrics").first().n == 17


def test_names_of_compound_conditions():
    assert q.case_name("a > 1 AND b BETWEEN 1 AND 2") == "a__case__And"
    assert q.case_name("length(caption) > 3") == "caption__case__GT"
    assert q.case_name("v BETWEEN 1 AND 2") == "v__case__Between"
    assert q.case_name("NOT (v IN ('x OR y'))") == "v__case__In"


def test_extremes_of_text_and_times(spark):
    df = spark.sql("select * from values ('b', date'2024-01-02', 3), ('a', date'2024-01-01', 4) t(s, d, n)")
    wanted = [getattr(metrics.column, m)(c) for m in ("maximum", "minimum") for c in ("s", "d", "n")]
    found = [(r.value, r.text_value) for r in q.compute_metrics(df, wanted).collect()]
    assert found == [(None, "b"), (None, "2024-01-02"), (4.0, None), (None, "a"), (None, "2024-01-01"), (3.0, None)]
