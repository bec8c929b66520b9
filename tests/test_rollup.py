import random
import re

import pytest
from pyspark.sql import functions as F

from tests.test_plan_shapes import plan, scans
from tidemark import Resource
from tidemark.operators import quality, rollup
from tidemark.operators.quality import metrics
from tidemark.operators.rollup import finished, measures, rolled, states

ITEMS = [
    measures.rows("rows"),
    measures.count("known", "x"),
    measures.total("total", "x"),
    measures.mean("mean", "x"),
    measures.least("least", "x"),
    measures.greatest("greatest", "x"),
    measures.share("share", "flag"),
    measures.distinct("names", "name"),
]


def frame(spark, n=2000, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        hot = r.random() < 0.4
        rows.append((None if r.random() < 0.05 else "hot" if hot else f"g{r.randrange(9)}", r.randrange(30), r.choice([None, r.randrange(-5, 100)]), r.choice([None, True, False]), r.choice([None, "", f"n{r.randrange(300)}"])))
    return spark.createDataFrame(rows, "g string, day int, x int, flag boolean, name string")


def rows(df, *order):
    return sorted(map(tuple, df.select(*order).collect()), key=repr)


NAMES = [m.name for m in ITEMS]


def test_two_steps_of_rolling_give_the_values_of_raw_rows(spark):
    df = frame(spark)
    daily = states(df, ["g", "day"], ITEMS)
    weekly = rolled(daily, ["g", (F.col("day") / 7).cast("int").alias("week")], ITEMS)
    assert rows(finished(rolled(weekly, ["g"], ITEMS), ITEMS), "g", *NAMES) == rows(finished(states(df, ["g"], ITEMS), ITEMS), "g", *NAMES)
    raw = df.groupBy("g").agg(
        F.count("*"), F.count("x"), F.sum("x"), F.avg("x"), F.min("x"), F.max("x"), F.avg(F.col("flag").cast("int")), F.count_distinct("name")
    )
    got = {r[0]: r[1:] for r in rows(finished(rolled(daily, ["g"], ITEMS), ITEMS), "g", *NAMES)}
    for g, *want in map(tuple, raw.collect()):
        assert got[g][:5] == tuple(want[:3] + [pytest.approx(want[3])] + want[4:5])
        assert got[g][5] == want[5] and got[g][6] == pytest.approx(want[6])
        assert abs(got[g][7] - want[7]) <= max(1, 0.03 * want[7])


def test_groups_without_values_and_empty_tables(spark):
    df = spark.createDataFrame([("a", 1, None, None, None)], "g string, day int, x int, flag boolean, name string")
    (row,) = finished(rolled(states(df, ["g", "day"], ITEMS), ["g"], ITEMS), ITEMS).collect()
    assert row.asDict() == {"g": "a", "rows": 1, "known": 0, "total": None, "mean": None, "least": None, "greatest": None, "share": None, "names": 0}
    assert finished(rolled(states(df.where("false"), ["g"], ITEMS), ["g"], ITEMS), ITEMS).count() == 0
    with pytest.raises(ValueError, match="measure: median"):
        states(df, ["g"], [rollup.Measure("m", "median", "x")])


def test_sketches_of_loads_are_taken_from_their_rows_and_put_together(spark, run):
    df = spark.range(6000).select(F.col("id"), (F.col("id") % 1500).alias("user"), F.timestamp_seconds(F.col("id") * 600).cast("timestamp_ntz").alias("at"))
    for number, where in enumerate(["id < 3000", "id >= 3000"]):
        part = Resource("visits", lambda s, w=where: df.where(w), "append")
        run.run(part.with_metrics(metrics.column.distinct_sketch("user", "at"), metrics.table.row_count()), load_id=str(number))
        found = quality.run_metrics(run, str(number))
        assert found.count() == 1 and "state" not in found.columns
    # A second run of the same load changes no estimate.
    quality.run_metrics(run, "again")
    data = run.dataset()
    stored = data.table(quality.SKETCHES_TABLE)
    assert stored.where("load_id = '0'").agg(F.max("period")).first()[0] < stored.where("load_id = '1'").agg(F.max("period")).first()[0]
    (total,) = quality.distinct_between(data, "visits", "user").collect()
    assert abs(total.estimate - 1500) <= 45
    by_month = quality.distinct_between(data, "visits", "user", by="month").collect()
    exact = {r.m: r.n for r in df.groupBy(F.date_trunc("month", "at").cast("timestamp_ntz").alias("m")).agg(F.count_distinct("user").alias("n")).collect()}
    assert {r.month for r in by_month} == set(exact) and all(abs(r.estimate - exact[r.month]) <= 0.03 * exact[r.month] for r in by_month)
    (early,) = quality.distinct_between(data, "visits", "user", load_ids=["0"]).collect()
    assert abs(early.estimate - 1500) <= 45


def test_many_distinct_counts_are_one_scan(spark):
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    items = [metrics.column.unique_count(c) for c in lines.columns[:10]]
    found = quality.compute_metrics(lines, items)
    text = plan(found)
    assert len(scans(text)) == 1 and "Expand" not in text
    want = lines.agg(*[F.count_distinct(c).cast("double").alias(c) for c in lines.columns[:10]]).first().asDict()
    assert {r.column_name: r.value for r in found.collect()} == want


def test_distinct_counts_of_odd_values(spark):
    data = [(0.0, "a", b"\x00", 1), (-0.0, "", b"", None), (float("nan"), None, None, 1), (float("nan"), "a", b"\x00", 2), (None, "A", b"a", 2)]
    df = spark.createDataFrame(data, "d double, s string, b binary, i int")
    found = quality.compute_metrics(df, [metrics.column.unique_count(c) for c in df.columns] + [metrics.column.null_count("s")])
    got = {(r.column_name, r.metric): r.value for r in found.collect()}
    assert got == {("d", "unique_count"): 2.0, ("s", "unique_count"): 3.0, ("b", "unique_count"): 3.0, ("i", "unique_count"): 2.0, ("s", "null_count"): 1.0}
    assert not re.search("Join", plan(found))
