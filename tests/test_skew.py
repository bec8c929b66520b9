"""One key, source or bucket holds a third of all rows: the results stay whole."""

import collections

import pytest
from pyspark.sql import functions as F

from tidemark import Resource
from tidemark.operators import intervals, normalize, quality
from tidemark.operators.quality import checks
from tidemark.plans import shop

N = 30_000


@pytest.fixture
def hot(spark):
    """30 000 rows; every third has key 0, the others a key of their own."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id"))
    return spark.range(N).select("id", key.alias("key"), (F.col("id") % 7).alias("v"))


def test_uniqueness_of_a_hot_key(hot):
    suite = quality.CheckSuite({"t": hot}, {"t": [checks.is_unique("key")]})
    assert suite.get_failures("t", "key__is_unique").count() == N // 3
    result = suite.results().first()
    assert (result.n_rows, result.passed) == (N, N - N // 3)


def test_hot_order_in_payments(spark, hot):
    paid = hot.select(F.col("key").alias("order_id"), F.lit(1).cast("decimal(18,2)").alias("amount"))
    orders = spark.range(0, N, 2).select("id", (F.col("id") % 5).alias("customer_id"))
    got = {r.customer_id: int(r.total_amount) for r in shop.customer_payments({"orders": orders, "payments": paid}).rows(spark).collect()}
    want = {}
    for i in range(N):
        key = 0 if i % 3 == 0 else i
        customer = key % 5 if key % 2 == 0 else None
        want[customer] = want.get(customer, 0) + 1
    assert got == want


def test_hot_copies_are_numbered(hot):
    numbered = normalize.numbered_copies(hot.select("key"), "copy", chunk=500)
    assert numbered.count() == N
    assert numbered.distinct().count() == N
    assert numbered.where("key = 0").agg(F.max("copy")).first()[0] == N // 3 - 1


def test_hot_key_in_a_merged_batch(spark, run, hot):
    run.run(Resource("t", lambda s: hot, "merge", "key", newest="id", buckets=3), load_id="1")
    table = run.dataset().t
    assert table.count() == N - N // 3 + 1
    assert table.where("key = 0").first().id == N - 3


def test_hot_job_in_a_run_log(spark):
    minute = F.make_dt_interval(mins=F.col("id").cast("int"))
    start = F.lit("2024-01-01").cast("timestamp_ntz") + minute
    log = spark.range(N).select(F.lit("job").alias("job"), start.alias("s"), (start + F.expr("INTERVAL 1 MINUTE")).alias("e"))
    holes = log.where("hour(s) <> 3 OR minute(s) <> 30")
    days = N // (24 * 60)
    got = intervals.islands(holes, "s", "e", ["job"])
    assert got.count() == days + 2 and got.agg(F.sum("n")).first()[0] == holes.count()
    assert intervals.gaps(holes, "s", "e", ["job"]).count() == days + 1


def test_copies_are_made_by_all_tasks(spark):
    """A few rows with many copies each are a few small records after counting: their copies must not come from one task."""
    rows = spark.range(120_000).select((F.col("id") % 40).alias("key"))
    numbered = normalize.numbered_copies(rows, "copy").withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r["key"], r["copy"]) for r in numbered) == [(k, c) for k in range(40) for c in range(3000)]
    assert max(collections.Counter(r["task"] for r in numbered).values()) < 60_000
