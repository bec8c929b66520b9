import corpus_pipeline
from tests.llm.helpers import ODD
from tests.parity import difference, oracle
from tidemark.llm.queries import ORACLE, QUERIES, table

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "near dedup", "decontamination", "tokens"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        after = docs.count()
        assert docs.columns == columns and 0 < after <= before
        before = after
    texts = [r["text"] for r in docs.collect()]
    assert len(set(texts)) == len(texts)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == before
    assert corpus_pipeline.run(spark, SF).count() == before


def test_stages_on_odd_rows(spark):
    schema = table(spark, SF, "documents").schema
    for rows in ([(i, t, "en", None, None) for i, t in ODD], []):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF).collect()
            assert len(out) <= len(rows)
            if stage is not corpus_pipeline.tokens:
                assert {r["doc_id"] for r in out} <= {r[0] for r in rows}


def test_queries_with_sql(spark):
    con = oracle(SF)
    for name, sql in ORACLE.items():
        assert difference(spark, con, QUERIES[name], sql, SF) is None, name
