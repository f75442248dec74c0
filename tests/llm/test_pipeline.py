"""The pipeline's stages: columns, effect of each decision, and an empty table."""

import corpus_pipeline
from conftest import SF_SMALL
from lendlayer.llm.op10_minhash import near_duplicates


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL).cache()
        assert docs.columns == columns, name
        sizes.append(docs.count())
        if name == "exact_dedup":
            assert docs.select("text").distinct().count() == sizes[-1]
        if name == "minhash_near_dedup":
            assert near_duplicates(docs).filter("not kept").count() == 0
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert packed.select("doc_id").distinct().count() == sizes[-1]
