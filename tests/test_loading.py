import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark import Incremental, Pipeline, Resource, Source, TimeWindow, paged_resource, source, transformation
from tidemark.operators.merge import latest_per_key
from tidemark.operators.normalize import SchemaConflict, flagged_columns, relational_tables, with_row_keys
from tidemark.plans import folders
from tidemark.plans.loading import NullKey
from tidemark.session import shared_folder


def frame(spark, data, schema="id bigint, v string"):
    return spark.createDataFrame(data, schema)


def target(df, **hints):
    hints = {"write_disposition": "merge", "primary_key": "id", **hints}
    return Resource("t", lambda s: df, **hints)


def test_replace_append_merge(spark, run, rows):
    a, b = frame(spark, [(1, "a"), (2, "b")]), frame(spark, [(2, "B"), (3, "c")])
    assert run.run(a, "t", load_id="1").row_counts == {"t": 2}
    run.run(b, "t", load_id="2")
    assert rows(run.dataset().t, "id", "v") == [(1, "a"), (2, "B"), (2, "b"), (3, "c")]
    run.run(b, "t", "replace", load_id="3")
    assert rows(run.dataset().t, "id", "v") == [(2, "B"), (3, "c")]
    assert rows(run.dataset()["t"], "_load_id") == [("3",), ("3",)]


@pytest.mark.parametrize("layout", [{}, {"buckets": 3}, {"partition_by": "v"}, {"partition_by": "id"}])
def test_merge_is_idempotent_in_every_layout(spark, warehouse, rows, layout):
    run = Pipeline(spark, "job", warehouse)
    base = frame(spark, [(1, "a"), (2, "b"), (None, "n"), (4, None)])
    batch = frame(spark, [(2, "B"), (3, "c"), (None, "N"), (4, "a")])
    layout = {**layout, "null_keys": True}
    run.run(target(base, **layout), load_id="1")
    run.run(target(batch, **layout), load_id="2")
    once = rows(run.dataset().t, "id", "v")
    assert once == sorted([(1, "a"), (2, "B"), (3, "c"), (None, "N"), (4, "a")], key=repr)
    run.run(target(batch, **layout), load_id="3")
    assert rows(run.dataset().t, "id", "v") == once


def test_merge_rewrites_only_touched_partitions(spark, run):
    base = frame(spark, [(1, "a"), (2, "b"), (3, "c")])
    run.run(target(base, partition_by="v"), load_id="1")
    before = {e["part"]: e["dir"] for e in run.dataset().stored("t").info["entries"]}
    run.run(target(frame(spark, [(2, "c")]), partition_by="v"), load_id="2")
    after = {e["part"]: e["dir"] for e in run.dataset().stored("t").info["entries"]}
    assert after["_part=a"] == before["_part=a"]
    assert "_part=b" not in after and after["_part=c"] != before["_part=c"]
    assert sorted(tuple(r) for r in run.dataset().t.select("id", "v").collect()) == [(1, "a"), (2, "c"), (3, "c")]


def test_newest_row_of_a_batch_wins(spark, run, rows):
    batch = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "x", None), (2, "y", 0)], "id bigint, v string, u int")
    run.run(target(batch, newest="u"), load_id="1")
    assert rows(run.dataset().t, "id", "v") == [(1, "new"), (2, "y")]
    tied = spark.createDataFrame([(1, "p"), (1, "q")], "id bigint, v string")
    winners = set()
    for number in range(3):
        run.run(target(tied.repartition(number + 1), table_name="tied"), load_id=f"t{number}")
        winners.add(tuple(rows(run.dataset()["tied"], "v")))
    assert len(winners) == 1


def test_composite_key(spark, run, rows):
    schema = "day date, region string, n bigint"
    base = spark.sql("select date'2024-01-01' day, 'a' region, 1L n union all select date'2024-01-02', null, 2L")
    more = spark.sql("select date'2024-01-02' day, cast(null as string) region, 5L n union all select date'2024-01-02', 'a', 6L")
    assert base.dtypes == [tuple(p.split(" ")) for p in schema.split(", ")]
    stats = Resource("s", lambda s: base, "merge", ("day", "region"), partition_by="day", null_keys=True)
    run.run(stats, load_id="1")
    run.run(stats.with_rows(more), load_id="2")
    assert rows(run.dataset().s, "n") == [(1,), (5,), (6,)]


def test_retry_of_a_load(spark, run):
    df = frame(spark, [(1, "a")])
    run.run(df, "t", load_id="1")
    assert run.run(df, "t", load_id="1").skipped
    assert run.dataset().t.count() == 1
    # A crash after the swap and before the log entry: the retry takes the first attempt's place.
    (log,) = folders.names(spark, f"{run.root}/_loads")
    folders.remove(spark, f"{run.root}/_loads/{log}")
    assert not run.run(df, "t", load_id="1").skipped
    assert run.dataset().t.count() == 1


def test_failed_load_publishes_nothing(spark, run):
    run.run(frame(spark, [(1, "a")]), "t", "replace", load_id="1")
    bad = frame(spark, [(2, "x")]).withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        run.run([target(frame(spark, [(9, "z")]), table_name="other"), Resource("t", lambda s: bad, "replace")], load_id="2")
    assert [r.id for r in run.dataset().t.collect()] == [1]
    assert run.dataset().tables == ["t"]


def test_schema_evolution_and_variants(spark, run, rows):
    run.run(spark.createDataFrame([(1, 10)], "id bigint, depth bigint"), "q", load_id="1")
    run.run(spark.createDataFrame([(2, 1.5, "new")], "id bigint, depth double, note string"), "q", load_id="2")
    run.run(spark.createDataFrame([(3,)], "id bigint"), "q", load_id="3")
    q = run.dataset().q
    assert rows(q, "id", "depth", "depth__v_double", "note") == [
        (1, 10, None, None),
        (2, None, 1.5, "new"),
        (3, None, None, None),
    ]
    with pytest.raises(SchemaConflict):
        run.run(Resource("q", lambda s: spark.createDataFrame([(1, "x")], "id bigint, depth string"), contract="add"))


def test_nested_resource_replace_and_merge(spark, run, tmp_path, rows):
    pages = tmp_path / "pages"
    pages.mkdir()
    first = [{"id": 1, "kids": [{"n": 1, "sub": [{"z": 1}]}, {"n": 2, "sub": []}]}, {"id": 2, "kids": [{"n": 9, "sub": []}]}]
    (pages / "p-1.json").write_text(json.dumps(first))
    schema = "id bigint, kids array<struct<n: bigint, sub: array<struct<z: bigint>>>>"
    nested = paged_resource("raw", str(pages), schema, write_disposition="merge", primary_key="id")
    info = run.run(nested, load_id="1")
    assert info.row_counts == {"raw": 2, "raw__kids": 3, "raw__kids__sub": 1}
    (pages / "p-1.json").write_text(json.dumps([{"id": 1, "kids": [{"n": 7, "sub": [{"z": 8}, {"z": 9}]}]}]))
    run.run(nested, load_id="2")
    assert rows(run.dataset()["raw__kids"], "n") == [(7,), (9,)]
    assert rows(run.dataset()["raw__kids__sub"], "z") == [(8,), (9,)]
    run.run(nested.with_hints(write_disposition="replace"), load_id="3")
    assert run.dataset()["raw"].count() == 1 and run.dataset()["raw__kids"].count() == 1
    parents = {(r.table_name, r.parent_table) for r in run.dataset().catalogue().collect()}
    assert ("raw__kids__sub", "raw__kids") in parents and ("raw__kids", "raw") in parents and ("raw", None) in parents


@pytest.mark.parametrize("file_format", ["parquet", "csv", "json"])
def test_child_keys_are_made_again_by_the_reader(spark, run, file_format):
    """Files of child tables hold no hash that follows from the parent's key and the place; every reader sees it."""
    schema = "id bigint, kids array<struct<n: bigint, sub: array<struct<z: bigint>>>>"
    data = [(1, [(5, [(1,), (2,)]), (6, [])]), (2, [(5, [(3,)])]), (None, [(7, [(4,)])])]
    load = lambda rows: Resource("t", lambda s: spark.createDataFrame(rows, schema), "merge", "id", null_keys=True)
    run.run(load(data), load_id="1", file_format=file_format)
    run.run(load([(2, [(8, [(9,)]), (8, [])])]), load_id="2")
    now = spark.createDataFrame([data[0], (2, [(8, [(9,)]), (8, [])]), data[2]], schema)
    want = relational_tables(with_row_keys(now, ["id"]), "t")
    for name in ("t__kids", "t__kids__sub"):
        stored, columns = run.dataset()[name], want[name].columns
        assert sorted(map(tuple, stored.select(columns).collect())) == sorted(map(tuple, want[name].collect()))
        if file_format == "parquet":
            files = spark.read.option("basePath", f"{run.root}/{name}").parquet(f"{run.root}/{name}/_version=*")
            assert files.where("_row_id IS NOT NULL").count() == 0
    # Rows that come into a child's table as a table of their own keep the keys they have.
    own = spark.createDataFrame([(70,)], "n bigint")
    run.run(Resource("t__kids", lambda s: own, "append", row_ids=True), load_id="3")
    run.run(load([(1, [(50, [])])]), load_id="4")
    kids = {r["n"]: r["_row_id"] for r in run.dataset()["t__kids"].collect()}
    assert kids[70] == with_row_keys(own, load_id="3").first()["_row_id"] and set(kids) == {7, 8, 50, 70}


def test_unkeyed_nested_copies_keep_their_children(spark, run):
    df = spark.createDataFrame([(1, [(5,)]), (1, [(5,)])], "id bigint, kids array<struct<n: bigint>>")
    run.run(df, "c")
    parents, kids = run.dataset()["c"], run.dataset()["c__kids"]
    assert parents.select("_row_id").distinct().count() == 2
    assert parents.join(kids, parents._row_id == kids._parent_id).count() == 2


def test_sources_and_names(spark, run):
    @source
    def shop():
        return [
            Resource("a", lambda s: s.range(2)),
            Resource("b", lambda s: s.range(3)),
        ]

    made = shop()
    assert list(made.resources) == ["a", "b"] and made.b.source == "shop"
    assert run.run(made.with_resources("b")).row_counts == {"b": 3}
    assert run.run(made.a.with_name("c")).row_counts == {"c": 2}
    assert run.run(made.a, table_name="d").row_counts == {"d": 2}
    assert run.run([made.a, made.b.with_table("e")]).row_counts == {"a": 2, "e": 3}
    with pytest.raises(KeyError):
        made.with_resources("z")
    with pytest.raises(AttributeError):
        made.z
    assert run.dataset().tables == ["a", "b", "c", "d", "e"]


def test_page_limit_of_a_source(spark, run, tmp_path):
    for number in range(1, 4):
        (tmp_path / f"page-{number}.json").write_text(json.dumps([{"id": number}]))
    pages = Source.of("s", [paged_resource("p", str(tmp_path), "id bigint"), Resource("q", lambda s: s.range(9))])
    assert run.run(pages.add_limit(2)).row_counts == {"p": 2, "q": 9}


def test_refresh_modes(spark, run):
    state = Incremental("id")
    both = Source.of(
        "s", [Resource("a", lambda s: s.range(2), incremental=state), Resource("b", lambda s: s.range(3), incremental=state)]
    )
    run.run(both, load_id="1")
    assert {r["resource"]: r["start_value"] for r in run.state} == {"a": 1, "b": 2}
    run.run(both.with_resources("a"), refresh="drop_resources", load_id="2")
    assert run.dataset().a.count() == 2 and run.dataset().b.count() == 3 and len(run.state) == 2
    run.run(both.with_resources("a"), refresh="drop_sources", load_id="3")
    assert run.dataset().tables == ["a"] and [r["resource"] for r in run.state] == ["a"]


def test_hints_for_types_and_annotations(spark, run):
    df = spark.createDataFrame([(1, "ann", "2018-10-01")], "id bigint, name string, date string")
    run.run(Resource("c", lambda s: df, columns={"name": {"pii": True}, "date": {"type": "date"}}))
    stored = run.dataset().c
    assert dict(stored.dtypes)["date"] == "date" and flagged_columns(stored, "pii") == ["name"]
    notes = {r.column_name: r.annotations for r in run.dataset().catalogue().collect()}
    assert json.loads(notes["name"]) == {"pii": True}


def test_dataset_queries_and_counts(spark, run, rows):
    run.run(frame(spark, [(1, "a"), (2, "b")]), "t", load_id="1")
    run.run(frame(spark, [(3, "c")]), "t", load_id="2")
    data = run.dataset()
    frame(spark, [(7, "shadow")]).createOrReplaceTempView("t")
    assert [r.n for r in data("SELECT count(*) AS n FROM t WHERE id > :low", low=1).collect()] == [2]
    assert spark.table("t").first().id == 7
    spark.catalog.dropTempView("t")
    assert rows(data.row_counts()) == [("t", 3)]
    assert rows(data.rows_per_load()) == [("t", "1", 2), ("t", "2", 1)]
    assert rows(data.loads(), "load_id", "table_name", "rows", "status") == [("1", "t", 2, "completed"), ("2", "t", 1, "completed")]
    with pytest.raises(KeyError):
        data.table("nothing")
    with pytest.raises(AttributeError):
        data.nothing


def test_sql_transformation(spark, run, rows):
    run.run(frame(spark, [(1, "a"), (2, "b")]), "t")

    @transformation(table_name="big", write_disposition="replace")
    def only_big(dataset, low):
        return f"SELECT id FROM t WHERE id > {int(low)}"

    run.run(only_big(run.dataset(), 1))
    assert rows(run.dataset().big, "id") == [(2,)]


@pytest.mark.parametrize("kind", ["parquet", "orc", "json", "csv"])
def test_file_formats_keep_values(spark, run, kind):
    df = spark.sql(
        "select 1L id, timestamp_ntz'2024-01-01 10:00:00.123456' t, timestamp'2024-01-01 10:00:00.123456' z,"
        " 'a,\"b\" c' s, cast(1.25 as decimal(10,2)) d, date'2024-02-03' y, cast(null as string) e"
    )
    run.run(df, "f", load_id="1", file_format=kind)
    assert run.dataset().f.drop("_load_id").collect() == df.collect()


def test_arrow_in_and_results_out(spark, run):
    run.run(pa.table({"a": [1, 2]}), table_name="x")
    stored = run.dataset().x.orderBy("a")
    assert stored.select("a").toArrow().to_pydict() == {"a": [1, 2]}
    assert stored.select("a").toPandas()["a"].tolist() == [1, 2]
    assert [tuple(r) for r in stored.select("a").limit(1).collect()] in ([(1,)], [(2,)])


def test_vacuum_and_compact(spark, run):
    for number in range(3):
        run.run(frame(spark, [(number, "x")]), "t", load_id=str(number))
    run.dataset().compact("t")
    stored = run.dataset().stored("t")
    assert len(stored.info["entries"]) == 1 and len(stored.vacuum()) == 3
    assert run.dataset().t.count() == 3


def test_bad_arguments(spark, run):
    with pytest.raises(ValueError):
        Resource("r", lambda s: None, "upsert")
    with pytest.raises(ValueError):
        Resource("r", lambda s: None, "merge")
    with pytest.raises(ValueError):
        run.run(spark.range(1), "t", refresh="everything")
    with pytest.raises(TypeError):
        run.run(5)


def test_period_layout_prunes_and_moves(spark, run, rows):
    def stamped(data):
        return spark.createDataFrame(data, "id bigint, s string").select("id", F.col("s").cast("timestamp").alias("t"))

    events = Resource(
        "e", lambda s: stamped([(1, "2024-01-01 05:00:00"), (2, "2024-01-02 00:00:00"), (3, None)]), "merge", "id",
        partition_by=("t", "day"),
    )
    run.run(events, load_id="1")
    before = {e["part"]: e["dir"] for e in run.dataset().stored("e").info["entries"]}
    assert set(before) == {"_period=2024-01-01", "_period=2024-01-02", "_period=__HIVE_DEFAULT_PARTITION__"}
    run.run(events.with_rows(stamped([(3, "2024-01-03 00:00:00"), (4, "2024-01-02 23:00:00")])), load_id="2")
    after = {e["part"]: e["dir"] for e in run.dataset().stored("e").info["entries"]}
    assert set(after) == {"_period=2024-01-01", "_period=2024-01-02", "_period=2024-01-03"}
    assert after["_period=2024-01-01"] == before["_period=2024-01-01"]
    data = run.dataset()
    assert rows(data.e, "id") == [(1,), (2,), (3,), (4,)] and "_period" not in data.e.columns
    window = TimeWindow("2024-01-02T00:00:00", "2024-01-03T00:00:00")
    some = data.table_between("e", "t", window)
    assert rows(some, "id") == [(2,), (3,), (4,)] == rows(window.rows(data.e, "t"), "id")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_period" in plan


def test_null_keys_and_key_types_are_refused_before_anything_changes(spark, run, rows):
    run.run(target(frame(spark, [(1, "a")])), load_id="1")
    with pytest.raises(NullKey, match="key id"):
        run.run(target(frame(spark, [(2, "b"), (None, "n")])), load_id="2")
    text_key = spark.createDataFrame([("1", "b")], "id string, v string")
    with pytest.raises(SchemaConflict, match="id"):
        run.run(target(text_key), load_id="3")
    assert rows(run.dataset().t, "id", "v") == [(1, "a")]


def test_a_failed_load_leaves_no_folders(spark, run):
    run.run(target(frame(spark, [(1, "a")])), load_id="1")
    before = folders.names(spark, f"{run.root}/t")
    with pytest.raises(NullKey):
        run.run(target(frame(spark, [(None, "n")])), load_id="2")
    bad = frame(spark, [(1, "a")]).withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        run.run(target(bad), load_id="3")
    assert folders.names(spark, f"{run.root}/t") == before


def test_staged_copies_of_nested_rows_are_deleted(spark, run):
    nested = spark.createDataFrame([(1, [(1,), (2,)])], "id bigint, kids array<struct<a: bigint>>")
    shared = shared_folder(spark)
    before = [n for n in folders.names(spark, shared) if n.startswith("nested-")]
    run.run(Resource("n", lambda s: nested, "merge", "id"), load_id="1")
    assert [n for n in folders.names(spark, shared) if n.startswith("nested-")] == before


def test_a_window_reads_its_periods_only(spark, run):
    days = spark.sql("select id, timestampadd(DAY, id, timestamp'2024-01-01') t from range(20)")
    run.run(Resource("d", lambda s: days, "append", partition_by=("t", "day")), load_id="1")
    some = run.dataset().table_between("d", "t", TimeWindow("2024-01-05T00:00:00", "2024-01-06T00:00:00"))
    assert some.count() == 2 and len({f.rpartition("/")[0] for f in some.inputFiles()}) == 2


def test_load_id_of_other_work_is_an_error(spark, run):
    run.run(frame(spark, [(1, "a")]), "t", load_id="1")
    with pytest.raises(ValueError, match="was used for"):
        run.run(frame(spark, [(1, "a")]), "u", load_id="1")


def test_merge_of_an_empty_window(spark, run, rows):
    cursor = Incremental("id", 5, 9)
    some = frame(spark, [(1, "a"), (6, "b")])
    run.run(target(some, incremental=cursor), load_id="1")
    empty = frame(spark, [(1, "a")])
    assert run.run(target(empty, incremental=cursor), load_id="2").row_counts == {"t": 0}
    assert rows(run.dataset().t, "id", "v") == [(6, "b")]


def test_retry_after_compaction_adds_nothing(spark, run):
    df = frame(spark, [(1, "a")])
    run.run(df, "t", load_id="1")
    run.run(df, "t", load_id="2")
    run.dataset().compact("t")
    for log in folders.names(spark, f"{run.root}/_loads"):
        folders.remove(spark, f"{run.root}/_loads/{log}")
    run.run(df, "t", load_id="2")
    assert run.dataset().t.count() == 2


def test_winners_move_whole_rows_once(spark):
    batch = spark.range(100).selectExpr("id % 10 AS k", "id AS v", "repeat('x', 50) AS t")
    plan = latest_per_key(batch, ["k"], "v", null_keys=False)._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(wide) <= 3 and "max_by" not in plan


def test_stable_layout_skips_the_search(spark, run):
    target_rows = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    fixed = Resource("t", lambda s: target_rows, "merge", "id", partition_by="v", stable_layout=True)
    run.run(fixed, load_id="1")
    run.run(fixed.with_rows(spark.createDataFrame([(2, "b"), (3, "a")], "id bigint, v string")), load_id="2")
    assert sorted(tuple(r) for r in run.dataset().t.select("id", "v").collect()) == [(1, "a"), (2, "b"), (3, "a")]


@pytest.mark.parametrize("limit", [0, 200_000])
def test_small_and_large_batches_merge_alike(spark, run, rows, monkeypatch, limit):
    monkeypatch.setattr("tidemark.plans.dataset.SMALL_BATCH_ROWS", limit)
    everything = spark.range(1000).select("id", F.lit("old").alias("v"))
    batch = spark.range(500, 1500, 5).select("id", F.lit("new").alias("v"))
    for layout in ({}, {"buckets": 4}, {"partition_by": "v"}):
        name = "t" + "".join(layout)
        run.run(target(everything, table_name=name, **layout))
        for _ in range(2):
            run.run(target(batch, table_name=name, **layout))
        table = run.dataset()[name]
        assert table.count() == 1100 and table.select("id").distinct().count() == 1100
        assert table.where("v = 'new'").count() == 200


@pytest.mark.parametrize("kind,values", [("string", ["", "a b/c=d", "é", None]), ("boolean", [True, False, None, True]), ("date", None), ("double", [0.5, -1.0, None, 1e20])])
def test_layout_keeps_values_and_finds_old_rows(spark, run, rows, kind, values):
    from datetime import date

    values = values or [date(2024, 1, 1), None, date(1999, 12, 31), date(2024, 1, 1)]
    df = spark.createDataFrame(list(enumerate(values)), f"id bigint, v {kind}")
    run.run(target(df, partition_by="v"), load_id="1")
    assert rows(run.dataset().t, "id", "v") == sorted(enumerate(values), key=repr)
    moved = spark.createDataFrame([(i, values[(i + 1) % 4]) for i in range(4)], f"id bigint, v {kind}")
    run.run(target(moved, partition_by="v"), load_id="2")
    assert rows(run.dataset().t, "id", "v") == rows(moved)


def test_a_merge_reads_its_source_once(spark, run):
    """The batch is stored before it is used: keys, winners and rows are those of one reading."""
    reads = spark.sparkContext.accumulator(0)

    def once(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    rows = spark.range(90).selectExpr("id % 60 AS id", "id AS v", "map('a', id) AS m").coalesce(1)
    source = rows.mapInArrow(once, rows.schema)
    run.run(Resource("events", lambda s: source, "merge", "id", newest="v"), load_id="1")
    assert reads.value == 90
    kept = run.dataset()["events"]
    assert kept.count() == 60 and kept.agg(F.min("v")).first()[0] == 30
    bad = source.selectExpr("IF(id = 7, NULL, id) AS id", "v", "m")
    with pytest.raises(NullKey):
        run.run(Resource("events", lambda s: bad, "merge", "id"), load_id="2")
    assert run.dataset()["events"].count() == 60
