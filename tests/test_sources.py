import json
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark import TimeWindow
from tidemark.operators.normalize import flagged_columns
from tidemark.sources import (
    arrow_rows,
    batches,
    bounded_events,
    dated,
    feature_files,
    inline_rows,
    json_pages,
    parquet_glob,
    parquet_tree,
    seeded_purchases,
)


def test_inline_rows_with_annotation(spark):
    df = inline_rows(spark, [{"id": 1, "name": "x"}, {"id": 2}], "id bigint, name string", {"name": {"pii": True}})
    assert [tuple(r) for r in df.collect()] == [(1, "x"), (2, None)]
    assert flagged_columns(df, "pii") == ["name"]


def test_seeded_rows_do_not_depend_on_partitioning(spark):
    first = seeded_purchases(spark, 500)
    again = seeded_purchases(spark, 500)
    moved = first.select("id").repartition(7)
    assert sorted(first.collect()) == sorted(again.collect())
    assert moved.count() == 500
    low, high, days = first.agg(F.min("quantity"), F.max("quantity"), F.count_distinct("date")).first()
    assert (low, high, days) == (1, 5, 14)
    assert first.agg(F.min("date"), F.max("date")).first() == ("2018-10-01", "2018-10-14")
    assert {r[0] for r in first.select("customer_id").distinct().collect()} == set(range(1, 14))


def test_parquet_glob_and_tree(spark, tmp_path):
    spark.range(3).withColumn("embedding", F.array(F.lit(1.0))).write.parquet(str(tmp_path / "a/b"))
    spark.range(3, 5).withColumn("embedding", F.array(F.lit(1.0))).write.parquet(str(tmp_path / "a/c"))
    tree = parquet_tree(spark, str(tmp_path), exclude=("embedding", "video_blob"))
    assert tree.columns == ["id"] and tree.count() == 5
    assert parquet_tree(spark, str(tmp_path), limit=2).count() == 2
    assert parquet_glob(spark, str(tmp_path / "a/b"), "*.parquet").count() == 3


def test_parquet_glob_of_folders_and_partitions(spark, tmp_path):
    """A table may be a folder of part files; single files beside it and files below partition folders match too."""
    at = str(tmp_path / "tables")
    spark.range(3).repartition(2).write.parquet(f"{at}/documents.parquet")
    spark.range(3, 4).write.parquet(f"{at}/labels.parquet")
    spark.range(9).write.parquet(f"{at}/other")
    pq.write_table(pa.table({"id": [7]}), f"{at}/one.parquet")
    ids = lambda df: sorted(r["id"] for r in df.collect())
    assert ids(parquet_glob(spark, at, "documents.parquet")) == [0, 1, 2]
    assert ids(parquet_glob(spark, at, "one.parquet")) == [7]
    assert ids(parquet_glob(spark, at)) == [0, 1, 2, 3, 7]
    parted = str(tmp_path / "parted")
    spark.range(4).withColumn("day", F.col("id") % 2).write.partitionBy("day").parquet(parted)
    for glob in ("*.parquet", "*"):
        assert sorted(tuple(r) for r in parquet_glob(spark, parted, glob).collect()) == [(0, 0), (1, 1), (2, 0), (3, 1)]


@pytest.fixture
def pages(tmp_path):
    for number in range(1, 13):
        content = [{"id": number * 10 + i, "ordered_at": f"2017-01-{number:02d}T0{i}:00:00"} for i in range(2)]
        (tmp_path / f"orders-page-{number}.json").write_text(json.dumps(content))
    return str(tmp_path)


def test_pages_and_page_limit(spark, pages):
    schema = "id bigint, ordered_at timestamp"
    assert json_pages(spark, pages, schema).count() == 24
    limited = json_pages(spark, pages, schema, page_limit=10)
    assert limited.count() == 20 and limited.agg(F.max("id")).first()[0] == 101
    window = dated(json_pages(spark, pages, schema), "ordered_at", "2017-01-03", "2017-01-05")
    assert sorted(r.id for r in window.collect()) == [30, 31, 40, 41, 50, 51]


def feature(number, **props):
    geometry = props.pop("geometry", {"coordinates": [1.0, 2.0, 3.5]})
    base = {"mag": 3.0, "place": "x, Chile", "time": 1704067200000, "updated": 1704067200000, "type": "earthquake"}
    return {"id": f"q{number}", "properties": {**base, **props}, "geometry": geometry}


@pytest.fixture
def quake_folder(tmp_path):
    features = [
        feature(1),
        feature(2, geometry=None),
        feature(3, geometry={"coordinates": [1.0, 2.0]}),
        feature(4, time=None),
        feature(5, mag=None),
        feature(6, mag=2.4),
    ]
    (tmp_path / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features[:3]}))
    (tmp_path / "b.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features[3:]}))
    (tmp_path / "c.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": []}))
    return str(tmp_path)


def test_features_are_flat_with_nulls(spark, quake_folder):
    df = feature_files(spark, quake_folder)
    assert len(df.columns) == 14 and df.count() == 6
    found = {r.id: r for r in df.collect()}
    assert (found["q2"].longitude, found["q2"].latitude, found["q2"].depth_km) == (None, None, None)
    assert (found["q3"].latitude, found["q3"].depth_km) == (2.0, None)
    assert found["q4"].time is None
    assert found["q1"].time.replace(tzinfo=None) == datetime.fromtimestamp(1704067200, timezone.utc).replace(tzinfo=None)


def test_bounded_events(spark, quake_folder):
    df = feature_files(spark, quake_folder)
    window = TimeWindow("2024-01-01T00:00:00+00:00", "2024-01-01T00:00:00+00:00")
    assert sorted(r.id for r in bounded_events(df, window).collect()) == ["q1", "q2", "q3"]
    first = bounded_events(df, None, order_by=("time", "id"), limit=2)
    assert [r.id for r in first.collect()] == ["q4", "q1"]


def test_batches_and_arrow(spark):
    sizes = [len(b) for b in batches(spark.range(2500), 1000)]
    assert sizes == [1000, 1000, 500]
    assert arrow_rows(spark, pa.table({"a": [1, 2]})).count() == 2
