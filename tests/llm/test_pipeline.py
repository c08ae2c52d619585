import os

import pytest

import corpus_pipeline
from pulselake.llm.hyperminhash import report
from pulselake.llm.toxicity import score
from tests.llm.test_lines_and_benchmark import plain_hits

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_stages(spark, path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], SF_DIR).write.parquet(f"{path}/{k}")
        kept.append(spark.read.parquet(f"{path}/{k}"))
        assert kept[-1].columns[:len(columns)] == columns
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in kept]
    assert all(b <= a for a, b in zip(ids, ids[1:])) and ids[4] == ids[5]
    scored = score(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet")).collect()
    assert {r["doc_id"] for r in scored if not r["predicted"]} == ids[1]
    assert {r["doc_id"] for r in report(kept[1], 5, 80).collect() if r["kept"]} == ids[2]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    assert {r["doc_id"] for r in kept[2].collect() if not plain_hits(r["text"], items, 10)[1]} == ids[3]
