"""Incremental split: equals the batch split, de-duplicates across batches and restarts."""

import os

import pytest
from conftest import rows

from lendlayer.operators.quality import split_quality
from lendlayer.streaming.quality_stream import start_quality_streams

DDL = "borrower_id string, branch_id string, age int, income double, credit_score int, industry_code string"
FIRST = [
    ("B1001", "BR101", 30, 2000.0, 700, "1"),
    ("B1002", "BR101", 10, 2000.0, 700, "1"),
    (None, "BR101", 30, 2000.0, 700, "1"),
    ("B1003", "BR101", None, 2000.0, 700, "1"),
]
SECOND = [("B1001", "BR101", 30, 2000.0, 700, "1"), ("B1004", "BR102", 40, 5000.0, 800, "2")]


def _start(spark, root):
    return start_quality_streams(
        spark, f"{root}/landing", DDL, "borrower_profile",
        f"{root}/silver", f"{root}/reject", f"{root}/_ckpt", max_files_per_trigger=1,
    )


def test_stream_matches_batch_and_survives_restart(spark, tmp_dir):
    spark.createDataFrame(FIRST, DDL).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/landing")
    spark.createDataFrame(FIRST, DDL).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/landing")
    _start(spark, tmp_dir).await_termination()
    batch = split_quality(spark.createDataFrame(FIRST, DDL), "borrower_profile")
    assert rows(spark.read.parquet(f"{tmp_dir}/silver")) == rows(batch.valid)
    assert len(rows(spark.read.parquet(f"{tmp_dir}/reject"))) == 2 * batch.reject.count()

    # restart on the same checkpoint: only the new file is read; its copy of B1001 is dropped
    spark.createDataFrame(SECOND, DDL).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/landing")
    _start(spark, tmp_dir).await_termination()
    ids = sorted(r.borrower_id for r in spark.read.parquet(f"{tmp_dir}/silver").collect())
    assert ids == ["B1001", "B1004"]


def test_stream_keeps_late_undecided_and_unparsable_rows(spark, tmp_dir):
    """Every row of the input is in one sink: silver (once), its copies, reject or unknown."""
    ddl = "borrower_id string, officer_id string, age int"
    data = [("B1001", "O101", 30), ("B1002", "EMP7", 30), ("B1003", "O103", None), (None, "O104", 30), ("B1001", "O101", 30)]
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    for part in (data, [("B1005", "O9999999999", 41)]):
        spark.createDataFrame(part, ddl).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/landing")
        start_quality_streams(
            spark, f"{tmp_dir}/landing", ddl, "borrower_profile", f"{tmp_dir}/silver", f"{tmp_dir}/reject", f"{tmp_dir}/_ckpt",
            unknown_path=f"{tmp_dir}/unknown",
        ).await_termination()
    silver = {r.borrower_id: r for r in spark.read.parquet(f"{tmp_dir}/silver").collect()}
    assert sorted(silver) == ["B1001", "B1002", "B1005"]
    assert (silver["B1001"].officer_key, silver["B1002"].officer_id, silver["B1002"].officer_key) == (101, "EMP7", None)
    assert [r.borrower_id for r in spark.read.parquet(f"{tmp_dir}/unknown").collect()] == ["B1003"]
    assert [r.officer_id for r in spark.read.parquet(f"{tmp_dir}/reject").collect()] == ["O104"]
    assert spark.conf.get(key, None) == before


def test_one_read_a_batch(spark, tmp_dir):
    for _ in range(3):
        spark.createDataFrame(FIRST, DDL).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/landing")
    streams = start_quality_streams(
        spark, f"{tmp_dir}/landing", DDL, "borrower_profile", f"{tmp_dir}/silver", f"{tmp_dir}/reject", f"{tmp_dir}/_ckpt",
        max_files_per_trigger=1, unknown_path=f"{tmp_dir}/unknown",
    )
    streams.await_termination()
    read = [p["numInputRows"] for p in streams.split.recentProgress]
    assert [n for n in read if n] == [len(FIRST)] * 3
    assert spark.read.parquet(f"{tmp_dir}/reject").count() == 6 and spark.read.parquet(f"{tmp_dir}/unknown").count() == 3


def test_a_replayed_batch_adds_nothing(spark, tmp_dir):
    """The driver dies between a batch's writes and its commit: the batch runs again on restart."""
    for data in (FIRST, SECOND):
        spark.createDataFrame(data, DDL).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/landing")
        _start(spark, tmp_dir).await_termination()

    def state():
        return rows(spark.read.parquet(f"{tmp_dir}/silver")), rows(spark.read.parquet(f"{tmp_dir}/reject"))

    before = state()
    last = max(int(f) for f in os.listdir(f"{tmp_dir}/_ckpt/split/commits") if f.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        os.remove(f"{tmp_dir}/_ckpt/split/commits/{name}")
    streams = _start(spark, tmp_dir)
    streams.await_termination()
    assert [p["batchId"] for p in streams.split.recentProgress if p["numInputRows"]] == [last]
    assert state() == before


def test_a_batch_that_fails_midway_is_written_once(spark, tmp_dir, monkeypatch):
    from lendlayer.streaming import quality_stream

    spark.createDataFrame(FIRST, DDL).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/landing")
    real = quality_stream.batch_sinks

    def failing(split, clean, reject, unknown):
        feed = real(split, clean, reject, unknown)

        def work(batch, batch_id):
            feed(batch, batch_id)
            raise RuntimeError("lost")

        return work

    monkeypatch.setattr(quality_stream, "batch_sinks", failing)
    with pytest.raises(Exception, match="lost"):
        _start(spark, tmp_dir)
    monkeypatch.undo()
    _start(spark, tmp_dir).await_termination()
    batch = split_quality(spark.createDataFrame(FIRST, DDL), "borrower_profile")
    assert rows(spark.read.parquet(f"{tmp_dir}/silver")) == rows(batch.valid)
    assert len(rows(spark.read.parquet(f"{tmp_dir}/reject"))) == batch.reject.count()
