import numpy as np
import pytest

from tidemark.operators import vector_index, vectors
from tidemark.operators.vector_index import VectorIndex

SCHEMA = "vec_id long, embedding array<float>, cell string, lane string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "x", "y") for i, v in rows], SCHEMA)


def clumps(n, clumps=40, width=16, seed=1):
    """Vectors around a few directions, as embeddings of topics are."""
    r = np.random.default_rng(seed)
    centres = r.normal(size=(clumps, width))
    return [(i, centres[r.integers(clumps)] + r.normal(size=width) * 0.25) for i in range(n)]


def pairs(df):
    return sorted((r.query_id, r.vec_id, round(r.score, 9)) for r in df.collect())


def share(found, exact):
    return len({p[:2] for p in found} & {p[:2] for p in exact}) / len(exact)


def test_recall_with_few_probes_on_clumped_vectors(spark, tmp_path):
    corpus = frame(spark, clumps(6000)).repartition(5)
    asked = corpus.where("vec_id % 100 = 0")
    index = VectorIndex.build(corpus, str(tmp_path / "index"))
    assert index.rows.count() == sum(index.counts.values()) == 6000
    assert len(index.centres) == 77 and index.probes <= 12
    exact = pairs(vectors.cosine_top_k(corpus, asked, 5))
    found = pairs(index.search(asked, 5))
    assert len(found) == len(exact) and share(found, exact) >= 0.9
    # Scores are those of the exact search.
    assert set(found) & set(exact) == {p for p in found if p[:2] in {e[:2] for e in exact}}
    again = VectorIndex(spark, str(tmp_path / "index"))
    assert again.probes == index.probes and pairs(again.search(asked, 5)) == found


def test_recall_on_the_given_table_for_all_ids_divisible_by_100(spark, tmp_path):
    corpus = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    asked = corpus.where("vec_id % 100 = 0")
    index = VectorIndex.build(corpus, str(tmp_path / "index"))
    exact, found = pairs(vectors.cosine_top_k(corpus, asked, 5)), pairs(index.search(asked, 5))
    assert len({p[0] for p in found}) == asked.count() and share(found, exact) >= 0.9


def test_all_probes_are_the_exact_search(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 16 * 8 * 50)
    corpus = frame(spark, clumps(900) + [(10_000 + i, np.ones(16)) for i in range(450)])
    asked = corpus.where("vec_id % 10 = 0")
    index = VectorIndex.build(corpus, str(tmp_path / "index"), cells=12)
    assert pairs(index.search(asked, 4, probes=12)) == pairs(vectors.cosine_top_k(corpus, asked, 4))


def test_a_hot_cell_is_cut_into_lanes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_BYTES", 16 * 8 * 50)
    corpus = frame(spark, clumps(300) + [(10_000 + i, np.ones(16)) for i in range(600)])
    index = VectorIndex.build(corpus, str(tmp_path / "index"), cells=10)
    assert max(index.counts.values()) >= 600
    lanes, kept = {}, vector_index._in_lanes

    def counted(rows, name, vector, own, own_lanes, *other):
        out = kept(rows, name, vector, own, own_lanes, *other)
        lanes[own] = out.select("cell", own).distinct().count()
        return out

    monkeypatch.setattr(vector_index, "_in_lanes", counted)
    asked = corpus.where("vec_id BETWEEN 10000 AND 10199")
    assert len(pairs(index.search(asked, 3))) == 600
    assert lanes["lane"] >= 12 and lanes["query_lane"] >= 4


def test_only_probed_folders_are_read(spark, tmp_path):
    corpus = frame(spark, clumps(2000))
    index = VectorIndex.build(corpus, str(tmp_path / "index"))
    found = index.search(corpus.where("vec_id = 7"), 5, probes=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell#" in plan and "IN (" in plan.split("PartitionFilters")[1]
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("bad", [None, [], [1.0] * 15, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15])
def test_odd_vectors_end_no_search(spark, tmp_path, bad):
    rows = clumps(60) + [(500, bad), (501, np.zeros(16)), (3, np.ones(16)), (3, np.ones(16))]
    corpus = frame(spark, rows)
    assert [r.vec_id for r in vectors.rejected_vectors(corpus).collect()] == [500]
    index = VectorIndex.build(corpus, str(tmp_path / "index"))
    assert sum(index.counts.values()) == 63
    found = index.search(corpus, 3, probes=len(index.centres))
    assert pairs(found) == pairs(vectors.cosine_top_k(corpus, corpus, 3))
    assert 500 not in {p[0] for p in pairs(found)}


def test_small_tables(spark, tmp_path):
    for n in (0, 1, 2):
        corpus = frame(spark, clumps(n))
        index = VectorIndex.build(corpus, str(tmp_path / f"index{n}"), dimensions=16)
        assert len(pairs(index.search(corpus, 5))) == (2 if n == 2 else 0)
    with_rows = VectorIndex(spark, str(tmp_path / "index2"))
    assert pairs(with_rows.search(frame(spark, []), 5)) == []
