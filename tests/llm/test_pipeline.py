from collections import Counter

import corpus_pipeline
from lexistat.session import stage

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_run_packs_all_that_is_mixed(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = stage(step(spark, docs, FOLDER), name)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] >= counts[1] >= counts[2] >= counts[3]
    mixed = Counter(r["doc_id"] for r in docs.select("doc_id").collect())
    packed = corpus_pipeline.run(spark, FOLDER).filter("piece = 0").collect()
    assert Counter(r["doc_id"] for r in packed) == mixed


def test_awkward_rows_pass_all_stages(spark, awkward):
    docs = awkward
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, FOLDER), name)
    assert docs.count() >= 1
