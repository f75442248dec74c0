"""What a task holds at a time: the batches it gets and the scratch arrays of its kernels."""

import tracemalloc

import pyarrow as pa

from lendlayer.llm.op6_token_counts import blocks
from lendlayer.llm.op7_toxicity import features
from lendlayer.llm.textkit import column_texts, word_hashes, words
from lendlayer.session import ARROW_BYTES, ready


def batch_bytes(spark):
    def seen(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)]), pa.array([batch.nbytes])], ["n", "bytes"])

    rows = spark.range(0, 9000, 1, 1).selectExpr("repeat('x', 2000) as text").mapInArrow(seen, "n bigint, bytes bigint").collect()
    assert sum(r["n"] for r in rows) == 9000
    return max(r["bytes"] for r in rows)


def test_batches_are_bounded_by_bytes(spark):
    before = spark.conf.get(ARROW_BYTES, None)
    spark.conf.unset(ARROW_BYTES)
    try:
        assert batch_bytes(ready(spark)) < 5e6
        spark.conf.set(ARROW_BYTES, "1m")  # the platform's own choice stays
        assert batch_bytes(ready(spark)) < 1.2e6
    finally:
        spark.conf.unset(ARROW_BYTES) if before is None else spark.conf.set(ARROW_BYTES, before)


def peak(work):
    work()  # tables that a worker keeps
    tracemalloc.start()
    work()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


def test_scratch_arrays_are_bounded():
    texts = ["some words of a text and another " * 300] * 200  # 2 million characters
    column = pa.array(texts)
    assert peak(lambda: [features(block)[0][-1:].copy() for block in blocks(texts)]) < 25e6
    assert peak(lambda: [word_hashes(part, words(part), lower=True)[-1:].copy() for part in column_texts(column)]) < 25e6
