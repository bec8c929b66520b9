import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import curation, reports, vectors

LIMITS = {"score": 5.0, "fps": 24}
MEANS = {"avg_score": "score", "avg_fps": "fps"}


@pytest.fixture
def clips(spark):
    data = [("a", 6.0, 30), ("b", 4.0, 30), (None, 9.0, 24), ("d", None, 60), ("e", 5.0, None)]
    return spark.createDataFrame(data, "caption string, score double, fps int")


def test_curation_drops_null(clips, rows):
    assert rows(curation.curated(clips, LIMITS), "caption") == [("a",), (None,)]
    assert curation.curated(clips, {}).count() == 5


def test_before_after_equals_two_passes(clips):
    got = {r.metric: (r.before_full, r.after_filtered) for r in curation.before_after(clips, LIMITS, "caption", MEANS).collect()}
    kept = curation.overall_statistics(curation.curated(clips, LIMITS), "caption", MEANS, "count").first()
    full = curation.overall_statistics(clips, "caption", MEANS, "count").first()
    assert got == {n: (float(full[n]), float(kept[n])) for n in ("count", "avg_score", "avg_fps")}


def test_before_after_of_nothing(clips):
    none = clips.where("false")
    assert [tuple(r)[1:] for r in curation.before_after(none, LIMITS, "caption", MEANS).collect()] == [(0.0, 0.0)] * 3
    assert tuple(curation.kept_share(none, LIMITS, "caption").first()) == (0, 0, 0.0)
    assert tuple(curation.kept_share(clips, LIMITS, "caption").first()) == (1, 4, 25.0)


def test_category_profile_order(spark):
    df = spark.createDataFrame([("x", "t", 1.0), ("y", "t", 2.0), ("y", "t", 4.0), (None, None, 1.0)], "k string, c string, m double")
    got = [tuple(r) for r in curation.category_profile(df, "k", "c", {"m": "m"}).collect()]
    assert got == [("y", 2, 3.0), ("x", 1, 1.0), (None, 0, 1.0)]


def test_top_groups_ties(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 1), ("c", 2)], "k string, v int")
    top = reports.top_groups(df, "k", {"n": F.count("v"), "ones": F.count_if(F.col("v") == 1)}, "n", 2, {"pct": ("ones", "n")})
    assert [tuple(r) for r in top.collect()] == [("c", 2, 1, 50.0), ("a", 1, 1, 100.0)]


def test_trends(spark):
    df = spark.createDataFrame(
        [("2024-01-05 10:00:00", "x", True), ("2024-01-31 23:59:59", "y", None), ("2024-02-01 00:00:00", "x", False)],
        "t string, k string, f boolean",
    ).withColumn("t", F.col("t").cast("timestamp_ntz"))
    got = reports.trend(df, "t", "month", "k", F.col("f"), "yes", "no").collect()
    assert [(r.total, r.yes, r.no) for r in got] == [(2, 1, 1), (1, 0, 1)]
    assert [r.u for r in reports.distinct_trend(df, "t", "month", "k", "u").collect()] == [2, 1]
    assert [r.u for r in reports.distinct_trend(df, "t", "month", "k", "u", approximate=True).collect()] == [2, 1]
    heat = [tuple(r) for r in reports.weekday_hours(df, "t", "k").collect()]
    assert heat == [(2, "Wed", 23, 1), (3, "Thu", 0, 1), (4, "Fri", 10, 1)]


@pytest.mark.parametrize("high,step", [(49, 1.0), (50, 1.0), (51, 2.0), (101, 5.0), (251, 10.0), (0, 1.0)])
def test_bin_step(spark, high, step):
    df = spark.createDataFrame([(0,), (high,)], "v int")
    assert reports.bin_step(df, "v") == step
    assert reports.bin_step(df.where("false"), "v") == 1.0


def test_histogram_counts_all(spark):
    df = spark.range(1000)
    got = reports.histogram(df, "id", [(F.col("id") % 2).alias("odd")])
    assert got.agg(F.sum("n")).first()[0] == 1000 and got.count() == 100


def brute_nearest(corpus, queries, k):
    out = []
    for qid, qv in queries:
        scored = []
        for cid, cv in corpus:
            if cid != qid:
                scored.append((-float(np.dot(qv, cv) / (np.linalg.norm(qv) * np.linalg.norm(cv))), cid))
        out += [(qid, cid) for _, cid in sorted(scored)[:k]]
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [64 * 1024 * 1024, 200])
def test_nearest_vectors_equal_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(vectors, "BLOCK_BYTES", block_bytes)
    made = np.random.default_rng(3).normal(size=(80, 8))
    data = [(i, [float(x) for x in v]) for i, v in enumerate(made)]
    corpus = spark.createDataFrame([*data, (999, None)], "vec_id bigint, embedding array<double>").repartition(5)
    found = vectors.cosine_top_k(corpus, corpus.where("vec_id < 9"), 4)
    assert sorted((r.query_id, r.vec_id) for r in found.collect()) == brute_nearest(data, data[:9], 4)
    assert vectors.cosine_top_k(corpus, corpus.where("false"), 4).count() == 0


def test_search_takes_every_hundredth_vector_without_the_driver(spark, monkeypatch):
    from __spark_entry__ import queries

    monkeypatch.setattr(type(spark.createDataFrame([(1,)], "a int")), "toLocalIterator", None)
    corpus = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    data = [(r.vec_id, r.embedding) for r in corpus.collect()]
    asked = [(i, v) for i, v in data if i % 100 == 0]
    found = queries()["nearest_hundredths"](spark, "/root/testdata/sf0.01").collect()
    assert sorted((r.query_id, r.vec_id) for r in found) == brute_nearest(data, asked, 5)


@pytest.mark.parametrize("broken", [1, 6])
def test_vectors_without_a_score_hide_no_neighbours(spark, broken):
    made = np.random.default_rng(4).normal(size=(30, 4))
    data = [(i, [float(x) for x in v]) for i, v in enumerate(made)]
    odd = [(100 + i, [1.0, float("nan") if i % 2 else None, 0.0, 0.0]) for i in range(broken)]
    corpus = spark.createDataFrame([*data, *odd], "vec_id bigint, embedding array<double>").coalesce(1)
    found = vectors.cosine_top_k(corpus, corpus.where("vec_id < 5"), 3)
    assert sorted((r.query_id, r.vec_id) for r in found.collect()) == brute_nearest(data, data[:5], 3)
    assert vectors.cosine_top_k(corpus, corpus.where("vec_id >= 100"), 3).count() == 0


def test_embedding(spark):
    texts = [("the cat sat",), ("the cat sat",), ("a dog",), ("",), (None,)]
    df = spark.createDataFrame(texts, "t string").coalesce(1)
    got = [r.v for r in vectors.embedded(df, {"t": "v"}).collect()]
    assert got[0] == got[1] != got[2] and got[4] is None and got[3] == [0.0] * 64
    assert abs(sum(x * x for x in got[0]) - 1) < 1e-5
    custom = vectors.embedded(df, {"t": "v"}, lambda: lambda items: np.array([[len(i)] for i in items]))
    assert [r.v for r in custom.collect()] == [[11.0], [11.0], [5.0], [0.0], None]


def test_long_texts_are_read_whole(spark):
    text = " ".join(f"w{i}" for i in range(50_000))
    df = spark.createDataFrame([(text + " end",), (text + " fin",)], "t string")
    first, second = [r.v for r in vectors.embedded(df, {"t": "v"}).collect()]
    assert first != second
    small = vectors.hashed_words(64, words_at_once=10)()(["a b c", "d e f g h i j k", "", "a b c"])
    large = vectors.hashed_words(64)()(["a b c", "d e f g h i j k", "", "a b c"])
    assert np.array_equal(small, large)
