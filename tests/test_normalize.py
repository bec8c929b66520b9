import pytest
from pyspark.sql import Row, functions as F

from tidemark.operators import normalize as n

NESTED = "id bigint, a struct<b: bigint, c: struct<d: string>>, kids array<struct<n: bigint, sub: array<struct<z: bigint>>>>, tags array<string>"
DATA = [
    (1, Row(b=2, c=Row(d="x")), [Row(n=1, sub=[Row(z=1), Row(z=2)]), Row(n=2, sub=[])], ["t"]),
    (2, None, [], None),
    (3, Row(b=None, c=None), None, []),
]


def test_flatten_names_and_nulls(spark):
    flat = n.flatten(spark.createDataFrame(DATA, NESTED))
    assert flat.columns == ["id", "a__b", "a__c__d", "kids", "tags"]
    assert [(r.a__b, r.a__c__d) for r in flat.orderBy("id").collect()] == [(2, "x"), (None, None), (None, None)]


def test_flatten_refuses_equal_names(spark):
    df = spark.createDataFrame([(Row(b=1), 2)], "a struct<b: bigint>, a__b bigint")
    with pytest.raises(n.SchemaConflict):
        n.flatten(df)


def test_child_tables_round_trip(spark):
    keyed = n.with_row_keys(spark.createDataFrame(DATA, NESTED), ["id"])
    tables = n.relational_tables(keyed, "t")
    assert set(tables) == {"t", "t__kids", "t__kids__sub"}
    assert tables["t"].count() == 3 and "tags" in tables["t"].columns
    kids, sub = tables["t__kids"], tables["t__kids__sub"]
    joined = (
        tables["t"]
        .join(kids, tables["t"]._row_id == kids._parent_id)
        .join(sub, kids._row_id == sub._parent_id)
        .select("id", kids["_list_idx"], "n", "z", (sub["_root_id"] == tables["t"]["_row_id"]).alias("root"))
    )
    assert sorted(tuple(r) for r in joined.collect()) == [(1, 0, 1, 1, True), (1, 0, 1, 2, True)]
    assert kids.count() == 2


def test_children_without_keys_are_refused(spark):
    with pytest.raises(ValueError):
        n.relational_tables(spark.createDataFrame(DATA, NESTED), "t")


def test_row_keys_are_stable_and_unique(spark):
    data = [(i % 7, "x" * (i % 3)) for i in range(200)] + [(None, None)] * 3
    df = spark.createDataFrame(data, "a bigint, b string")
    first = {r._row_id for r in n.with_row_keys(df, load_id="1").collect()}
    assert len(first) == len(data)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        again = {r._row_id for r in n.with_row_keys(df.repartition(5), load_id="1").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert first == again
    assert first.isdisjoint(r._row_id for r in n.with_row_keys(df, load_id="2").collect())


@pytest.mark.parametrize("chunk", [1, 2, 4, 1000])
def test_numbered_copies_of_a_hot_row(spark, chunk):
    df = spark.createDataFrame([("hot",)] * 9 + [("cold",), (None,), (None,)], "v string")
    got = sorted(((r.v or "-"), r.k) for r in n.numbered_copies(df, "k", chunk).collect())
    assert got == sorted([("hot", i) for i in range(9)] + [("cold", 0), ("-", 0), ("-", 1)])


def test_text_to_timestamps_all_or_nothing(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00Z", "2024-01-01", None), (None, "no", None)], "a string, b string, c string")
    kinds = dict(n.timestamps_from_text(df, ["a", "b", "c"]).dtypes)
    assert kinds == {"a": "timestamp", "b": "string", "c": "string"}


def variant(spark, stored, incoming, values, contract="evolve"):
    df = spark.createDataFrame([(v,) for v in values], f"v {incoming}")
    schema = spark.createDataFrame([], f"v {stored}").schema
    return n.reconciled(df, schema, contract, "t")


def test_variant_of_double_on_bigint(spark):
    out = variant(spark, "bigint", "double", [3.0, 3.5, None, float("nan"), 1e300])
    assert out.columns == ["v", "v__v_double"]
    got = [tuple(r) for r in out.collect()]
    assert got[:3] == [(3, None), (None, 3.5), (None, None)]
    assert got[3][0] is None and got[3][1] != got[3][1]
    assert got[4] == (None, 1e300)


def test_variant_of_text_and_bool(spark):
    assert [tuple(r) for r in variant(spark, "bigint", "string", ["12", "x", "012", None]).collect()] == [
        (12, None),
        (None, "x"),
        (None, "012"),
        (None, None),
    ]
    assert [tuple(r) for r in variant(spark, "double", "boolean", [True]).collect()] == [(1.0, None)]
    assert variant(spark, "timestamp", "bigint", [5]).columns == ["v", "v__v_bigint"]


def test_variant_keeps_every_value(spark):
    values = [0.0, -1.0, 2.25, 9007199254740993.0, None]
    out = variant(spark, "bigint", "double", values)
    merged = out.select(F.coalesce("v__v_double", F.col("v").cast("double"))).collect()
    assert [r[0] for r in merged] == values


def test_contracts(spark):
    with pytest.raises(n.SchemaConflict):
        variant(spark, "bigint", "double", [1.0], "add")
    stored = spark.createDataFrame([], "a bigint").schema
    more = spark.createDataFrame([(1, 2)], "a bigint, b bigint")
    assert n.reconciled(more, stored, "add").columns == ["a", "b"]
    with pytest.raises(n.SchemaConflict):
        n.reconciled(more, stored, "freeze")
    fewer = spark.createDataFrame([(2,)], "b bigint")
    assert [tuple(r) for r in n.reconciled(fewer, stored, "evolve").collect()] == [(None, 2)]
    narrow = spark.createDataFrame([(2,)], "a int")
    assert n.reconciled(narrow, stored, "freeze").dtypes == [("a", "bigint")]


def test_annotations(spark):
    df = n.annotated(spark.createDataFrame([(1, "x")], "id bigint, name string"), {"name": {"pii": True}})
    assert n.flagged_columns(df, "pii") == ["name"]


def test_only_full_iso_instants_are_times(spark):
    from tidemark.operators.normalize import instant

    good = ["2024-01-02", "2024-01-02T03:04:05Z", "2024-01-02 03:04:05.123456", "2024-01-02T03:04:05+01:00"]
    bad = ["2024", "10115", "12:30", "2024-01", "20240102", "2024-13-01", "next year", ""]
    df = spark.createDataFrame([(x,) for x in good + bad], "t string").select("t", instant(F.col("t")).isNotNull().alias("is"))
    assert {r.t: r["is"] for r in df.collect()} == {**dict.fromkeys(good, True), **dict.fromkeys(bad, False)}


def test_copies_come_back_as_they_went_in(spark):
    """Negative zeros, NaN, maps and fractions inside lists, several copies of each."""
    plain = [(0.0, 1), (-0.0, 1), (-0.0, 1), (float("nan"), None), (float("nan"), None), (None, 2), (1.5, 2)]
    df = spark.createDataFrame(plain, "d double, i int").repartition(3)
    got = sorted((repr(r.d), repr(r.i), r.k) for r in n.numbered_copies(df, "k").collect())
    assert got == sorted([("0.0", "1", 0), ("-0.0", "1", 0), ("-0.0", "1", 1), ("nan", "None", 0), ("nan", "None", 1), ("None", "2", 0), ("1.5", "2", 0)])
    nested = [({"a": -0.0}, [0.0]), ({"a": -0.0}, [0.0]), ({"a": 0.0}, [-0.0]), (None, None), ({"b": 1.0}, [None])]
    df = spark.createDataFrame(nested, "m map<string, double>, l array<double>").repartition(3)
    got = sorted((repr(r.m), repr(r.l), r.k) for r in n.numbered_copies(df, "k").collect())
    assert got == sorted([*((repr(m), repr(l), 0) for m, l in nested[1:]), (repr(nested[0][0]), "[0.0]", 1)])
    assert len({r._row_id for r in n.with_row_keys(df, load_id="1").collect()}) == 5
