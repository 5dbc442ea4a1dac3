"""The pipeline's stages on awkward rows, and its contract."""

import corpus_pipeline as P
from llm_tables import documents, frame


def test_stages_keep_columns(spark):
    assert [s[0].split()[0] for s in P.STAGES] == ["language", "n-gram", "substring", "mixing", "packing"]
    docs = frame(spark, documents(), clash=True)
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        assert docs.count() > 40
    pieces = P.STAGES[-1][1](spark, docs, "").collect()
    assert {p["doc_id"] for p in pieces} == {r["doc_id"] for r in docs.collect()}


def test_run(spark):
    out = P.run(spark, "/root/testdata/sf0.001")
    got = out.collect()
    assert len(got) > 100
    size = {}
    for p in got:
        size[p["sequence_id"]] = size.get(p["sequence_id"], 0) + p["length"]
    assert max(size.values()) <= 1024 and sorted(size.values())[1] == 1024 or len(size) < 3


def test_empty(spark):
    docs = frame(spark, [])
    for _, stage in P.STAGES:
        assert stage(spark, docs, "").count() == 0
