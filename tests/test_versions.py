"""Versioned tables: safe replacement, all outcomes of a split in one write, counts from committed files."""

import glob
import os
import uuid

import pytest
from conftest import rows
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lendlayer.layout import Layout
from lendlayer.operators.quality import split_quality
from lendlayer.plans.jobs import bronze_to_silver, split_nulls
from lendlayer.sources import sinks
from lendlayer.sources.catalog import list_tables
from lendlayer.sources.seeds import seed_table
from lendlayer.sources.sinks import current_version, drop_leftover_versions, overwrite_counted, overwrite_from_self, overwrite_table, write_split
from test_plans import plan_text

DDL = "borrower_id string, branch_id string, age int"
DATA = [("B1001", "BR101", 30)] * 3 + [(None, "BR1", 5)] * 2 + [("X1", "BR101", 5), ("B1002", "BR101", None), ("B1002", "BR101", None), ("B1003", "BR101", 40)]


@pytest.fixture()
def layout(spark, tmp_dir):
    return Layout(prefix=f"v{uuid.uuid4().hex[:6]}_", location=tmp_dir).create(spark)


def versions(spark, layout, layer="silver"):
    return [t.name for t in spark.catalog.listTables(layout.database(layer) + "__versions") if t.tableType != "VIEW"]


def test_a_failure_between_the_steps_leaves_the_old_table(spark, layout, monkeypatch):
    name = layout.table("silver", "t_cleaned")
    overwrite_table(spark.createDataFrame([(1,)], "a int"), name, staged=True)

    def fail(*_):
        raise RuntimeError("catalog down")

    monkeypatch.setattr(sinks, "_place", fail)  # written in full, not yet current
    with pytest.raises(RuntimeError):
        overwrite_table(spark.createDataFrame([("x", 2)], "b string, c int"), name, staged=True)
    monkeypatch.undo()
    assert rows(spark.table(name)) == [(1,)] and spark.table(name).columns == ["a"]
    assert len(versions(spark, layout)) == 1 and list_tables(spark, layout.database("silver")) == ["t_cleaned"]
    assert overwrite_counted(spark.createDataFrame([("x", 2)], "b string, c int"), name, staged=True) == 1
    assert spark.table(name).columns == ["b", "c"]


def test_a_driver_that_dies_before_the_repoint(spark, layout):
    """A complete but never published version is not seen, and can be cleared."""
    name = layout.table("silver", "t_cleaned")
    overwrite_table(spark.range(3), name, staged=True)
    left = sinks._write_version(spark.range(9), name, None)
    assert spark.table(name).count() == 3
    assert drop_leftover_versions(spark, name) == [left.rsplit(".", 1)[-1].strip("`")]
    assert spark.table(name).count() == 3 and len(versions(spark, layout)) == 1


def test_running_readers_keep_their_version(spark, layout):
    name = layout.table("silver", "t_cleaned")
    overwrite_table(spark.range(1), name, staged=True)
    reader = spark.table(name)
    assert overwrite_from_self(spark, spark.table(name).union(spark.range(5)), name) == 6
    assert reader.count() == 1 and spark.table(name).count() == 6
    overwrite_table(spark.range(2), name, staged=True)
    overwrite_table(spark.range(3), name)  # a versioned name always gets a new version
    assert len(versions(spark, layout)) == 2 and spark.table(name).count() == 3


def test_plain_tables_step_aside(spark, layout, monkeypatch):
    name = layout.table("bronze", "officers")
    overwrite_table(spark.range(4), name)
    assert current_version(spark, name) == name
    real = spark.sql

    def sql(text, *args, **more):
        if text.startswith("CREATE OR REPLACE VIEW"):
            raise RuntimeError("catalog down")
        return real(text, *args, **more)

    monkeypatch.setattr(spark, "sql", sql)
    with pytest.raises(RuntimeError):
        overwrite_from_self(spark, spark.table(name).limit(1), name)
    monkeypatch.undo()
    assert spark.table(name).count() == 4 and list_tables(spark, layout.database("bronze")) == ["officers"]
    assert overwrite_from_self(spark, spark.table(name).limit(1), name) == 1
    assert list_tables(spark, layout.database("bronze")) == ["officers"] and current_version(spark, name) != name
    assert seed_table(spark, name, "id int", [(7,)]).first().id == 7  # a seed makes it a plain table again


def test_split_is_one_scan_and_one_write(spark, layout):
    overwrite_table(spark.createDataFrame(DATA, DDL), layout.table("bronze", "people"))
    split = split_quality(spark.table(layout.table("bronze", "people")))
    text = plan_text(sinks.split_outcomes(split), "simple")
    assert text.count("FileScan") == 1 and text.count("Exchange hashpartitioning") == 1
    silver, reject, unknown = layout.table("silver", "p_cleaned"), layout.table("reject", "p"), layout.table("reject", "p_undecided")
    c = write_split(split, silver, reject, unknown_table=unknown)
    assert (c.rows_in, c.rows_valid, c.rows_duplicate, c.rows_reject, c.rows_unknown) == (9, 2, 2, 3, 2)
    assert c.rows_in == c.rows_valid + c.rows_duplicate + c.rows_reject + c.rows_unknown
    assert c.by_reason == {"NULL_VALUES": 2, "INVALID_ID_FORMAT": 1, "OUTLIER_OR_INVALID_RANGE": 0}
    assert rows(spark.table(silver)) == rows(split.valid) and rows(spark.table(unknown)) == rows(split.unknown)
    assert rows(spark.table(reject)) == rows(split.reject) and spark.table(reject).columns == split.reject.columns
    text = plan_text(spark.table(reject), "simple")
    assert "dq_outcome" in text.split("PartitionFilters")[1].split("]")[0]  # reads its part only


def test_all_outcomes_move_together(spark, layout, monkeypatch):
    names = [layout.table("silver", "p_cleaned"), layout.table("reject", "p"), layout.table("reject", "p_undecided")]
    write_split(split_quality(spark.createDataFrame(DATA, DDL)), names[0], names[1], unknown_table=names[2])
    before = [rows(spark.table(n)) for n in names]
    placed = []
    real = sinks._place
    monkeypatch.setattr(sinks, "_place", lambda spark, name, *more: (placed.append(name), real(spark, name, *more)))
    wider = spark.createDataFrame([(*r, 1.5) for r in DATA[2:]], DDL + ", extra double")
    write_split(split_quality(wider), names[0], names[1], unknown_table=names[2])
    assert len(placed) == 1  # one repoint, also where the columns change
    assert [len(spark.table(n).columns) for n in names] == [4, 5, 4] and before[0] != rows(spark.table(names[0]))
    monkeypatch.setattr(sinks, "_place", lambda *_: (_ for _ in ()).throw(RuntimeError("down")))
    after = [rows(spark.table(n)) for n in names]
    with pytest.raises(RuntimeError):
        write_split(split_quality(spark.createDataFrame(DATA, DDL)), names[0], names[1], unknown_table=names[2])
    assert [rows(spark.table(n)) for n in names] == after


def test_batch_keeps_undecided_rows(spark, layout):
    overwrite_table(spark.createDataFrame(DATA, DDL), layout.table("bronze", "people"))
    for _ in range(2):
        row = bronze_to_silver(spark, layout, ["people"])[0]
        assert (row.status, row.rows_in, row.rows_unknown) == ("ok", 9, 2)
    assert rows(spark.table(layout.table("reject", "people_undecided"))) == [("B1002", "BR101", None)] * 2
    assert list_tables(spark, layout.database("reject")) == ["people", "people_undecided"]


def test_empty_input_and_odd_rows(spark, layout):
    silver, reject = layout.table("silver", "p_cleaned"), layout.table("reject", "p")
    c = write_split(split_quality(spark.createDataFrame([], DDL)), silver, reject)
    assert (c.rows_in, c.rows_valid, spark.table(silver).count(), spark.table(reject).columns) == (0, 0, 0, ["borrower_id", "branch_id", "age", "reject_reason"])
    odd = spark.createDataFrame([("B1001", float("nan"), -0.0, [1, None], "a b")] * 2 + [(None, 1.0, 0.0, None, "c")], "borrower_id string, x double, y double, z array<int>, `odd name` string")
    c = write_split(split_quality(odd, dedup=False), silver, reject)
    assert (c.rows_valid, c.rows_duplicate, c.rows_reject) == (2, 0, 1)
    with pytest.raises(ValueError, match="dq_copies"):
        write_split(split_quality(spark.createDataFrame([(1,)], "dq_copies int")), silver, reject)


def test_null_split_moves_both_sinks_at_once(spark, layout):
    overwrite_table(spark.createDataFrame([("L1", "B1"), (None, "B2")], "loan_id string, borrower_id string"), layout.table("bronze", "loans"))
    overwrite_table(spark.createDataFrame([(1,)], "x int"), layout.table("bronze", "no_critical"))
    report = split_nulls(spark, layout, ["loans", "no_critical"])
    assert [(r.rows_in, r.rows_valid, r.rows_reject) for r in report] == [(2, 1, 1), (1, 1, 0)]
    whole, gaps = layout.table("silver", "loans_complete"), layout.table("reject", "loans_incomplete")
    assert current_version(spark, whole) == current_version(spark, gaps)
    assert spark.table(layout.table("reject", "no_critical_incomplete")).columns == ["x"]


def test_counts_read_no_column(spark, layout):
    name = layout.table("silver", "t_cleaned")
    overwrite_table(spark.range(10), name, staged=True)
    assert "ReadSchema: struct<>" in plan_text(spark.table(name).groupBy().count(), "simple")


def test_counts_survive_a_rerun_of_a_map_stage(spark, layout):
    """Shuffle files lost after the map stage: it runs again, observed rows double, the committed count does not."""
    places = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    flag = os.path.join(layout.location, "lost")

    def lose(batches):
        if not os.path.exists(flag):
            open(flag, "w").close()
            for place in places:
                for f in glob.glob(f"{place}/*/shuffle_*"):
                    os.remove(f)
        yield from batches

    seen = Observation("before_shuffle")
    n = 4000
    df = spark.range(n, numPartitions=4).observe(seen, F.count(F.lit(1)).alias("rows")).repartition(40, "id").mapInArrow(lose, "id long")
    assert overwrite_counted(df, layout.table("silver", "t_cleaned"), staged=True) == n
    assert seen.get["rows"] > n
    assert spark.table(layout.table("silver", "t_cleaned")).count() == n
