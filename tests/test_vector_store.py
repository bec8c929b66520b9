import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import vectors
from tidemark.operators.vector_store import VectorStore


def counted(calls):
    """The hashed-words provider, with every text it is given added to an accumulator."""

    def build():
        inner = vectors.hashed_words()()

        def provide(texts):
            calls.add(len(texts))
            return inner(texts)

        return provide

    return build


def test_a_second_load_embeds_only_what_is_new(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)
    store = VectorStore(spark, str(tmp_path), "words", counted(calls))
    df = spark.range(1000).select("id", F.concat(F.lit("text "), (F.col("id") % 400).cast("string")).alias("t")).repartition(6)
    first = store.embedded(df, {"t": "v"}, "1")
    assert calls.value == 400 and store.vectors.count() == 400 and first.count() == 1000
    more = df.unionByName(spark.createDataFrame([(5000 + i, f"text {i}") for i in range(396, 404)], "id long, t string"))
    second = {r.id: r.v for r in store.embedded(more, {"t": "v"}, "2").collect()}
    assert calls.value == 404 and store.vectors.where("load = '2'").count() == 4
    want = {r.id: r.v for r in vectors.embedded(more, {"t": "v"}).collect()}
    assert len(second) == 1008 and all(np.array_equal(second[i], want[i]) for i in want)
    # The same load again changes nothing.
    store.add(more, "t", "3")
    assert calls.value == 404 and store.vectors.count() == 404


def test_null_empty_and_copied_texts_in_two_columns(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path), "words", vectors.hashed_words())
    df = spark.createDataFrame([(1, None, "a"), (2, "", "a"), (3, "a", None), (3, "a", None)], "content int, a string, b string")
    out = store.embedded(df, {"a": "va", "b": "vb"}, "1").collect()
    assert sorted((r.content, r.va is None, r.vb is None) for r in out) == [(1, True, False), (2, False, False), (3, False, True), (3, False, True)]
    assert store.vectors.count() == 2
    assert store.embedded(df.where("false"), {"a": "va"}, "2").collect() == []
