"""The plans Spark makes: what reaches the scan, how often it scans, and where Python is."""

import re

import pytest

from __spark_entry__ import queries
from tidemark.operators import quality
from tidemark.operators.quality import checks, metrics

SF = "/root/testdata/sf0.001"
WITH_PYTHON = {"embedded_text", "nearest_vectors"}


def plan(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return re.findall(r"FileScan parquet", text)


def test_window_and_magnitude_reach_the_scan(spark):
    text = plan(queries()["bounded_scan"](spark, SF))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThanOrEqual(ts" in pushed and "GreaterThanOrEqual(value" in pushed


def test_heavy_columns_are_not_read(spark):
    text = plan(queries()["pruned_scan"](spark, SF))
    assert "text" not in re.search(r"ReadSchema: (\S+)", text).group(1)


def test_one_scan_for_all_row_wise_checks(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    rules = [checks.case(f"l_discount <= 0.0{i}") for i in range(9)] + [checks.is_not_null("l_tax")]
    text = plan(quality.prepare_checks(lines, rules, "table"))
    assert len(scans(text)) == 1
    schema = re.search(r"ReadSchema: (\S+)", text).group(1)
    assert "l_comment" not in schema and "l_partkey" not in schema
    row = plan(quality.prepare_checks(lines, rules, "row"))
    assert "Exchange" not in row


def test_one_scan_for_all_metrics_without_distinct(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    items = [metrics.column.mean("l_tax"), metrics.column.maximum("l_tax"), metrics.table.row_count()]
    assert len(scans(plan(quality.compute_metrics(lines, items)))) == 1
    many = items + [metrics.column.unique_count("l_orderkey"), metrics.column.unique_count("l_partkey")]
    assert "Expand" not in plan(quality.compute_metrics(lines, many))


def test_payments_are_summed_before_the_join(spark):
    text = plan(queries()["customer_payments"](spark, SF))
    assert text.index("Join") < text.rindex("partial_sum") and text.count("partial_sum") == 2


def test_top_groups_do_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(queries()["top_authors"](spark, SF))


@pytest.mark.parametrize("name", ["checks_per_row", "customer_orders", "child_rows", "coverage_islands", "severity_counts"])
def test_no_python_and_no_pairs(spark, name):
    text = plan(queries()[name](spark, SF))
    assert "Python" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
