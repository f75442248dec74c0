"""Seeds, sinks, stage-and-swap, catalog listing, and per-table failure isolation."""

import datetime as dt
import uuid

import pytest

from lendlayer.layout import Layout, gold_name, reject_name, silver_name
from lendlayer.plans.jobs import bronze_to_silver, report_frame, silver_to_gold
from lendlayer.sources.catalog import list_tables, preview, tables_frame
from lendlayer.sources.seeds import create_table, insert_rows, seed_table
from lendlayer.sources.sinks import current_version, overwrite_counted, overwrite_from_self, overwrite_table


@pytest.fixture()
def layout(spark, tmp_dir):
    return Layout(prefix=f"t{uuid.uuid4().hex[:6]}_", location=tmp_dir).create(spark)


def test_naming():
    assert silver_name("loans") == "loans_cleaned"
    assert reject_name("loans") == "loans"
    assert gold_name(silver_name("loans")) == "loans_cleaned_gold"
    with pytest.raises(ValueError):
        Layout().database("platinum")


def test_seed_positional_and_column_list(spark, layout):
    name = layout.table("bronze", "seeded")
    t = seed_table(
        spark, name, "id BIGINT, d DATE, ts TIMESTAMP, x DOUBLE, ok BOOLEAN",
        [(1, "2025-08-01", "2025-08-01 10:00:00", 5, True)],
    )
    r = t.first()
    assert r.d == dt.date(2025, 8, 1) and r.ts == dt.datetime(2025, 8, 1, 10, 0) and r.x == 5.0 and r.ok is True
    insert_rows(spark, name, [("2025-01-02", 2)], columns=["d", "id"])
    got = {r.id: r for r in spark.table(name).collect()}
    assert got[2].d == dt.date(2025, 1, 2) and got[2].x is None
    # seeding again replaces, not appends
    seed_table(spark, name, "id BIGINT", [(9,)])
    assert [r.id for r in spark.table(name).collect()] == [9]


def test_seed_rejects_bad_column_list(spark, layout):
    name = layout.table("bronze", "bad")
    create_table(spark, name, "id INT")
    with pytest.raises(ValueError):
        insert_rows(spark, name, [(1,)], columns=["nope"])


def test_overwrite_replaces_schema_and_counts(spark, layout):
    name = layout.table("silver", "t_cleaned")
    overwrite_table(spark.createDataFrame([(1,)], "a int"), name)
    assert overwrite_counted(spark.createDataFrame([("x", 2.0), ("y", 3.0)], "b string, c double"), name) == 2
    assert spark.table(name).columns == ["b", "c"]


def test_stage_and_swap_self_overwrite(spark, layout):
    name = layout.table("bronze", "officers")
    overwrite_table(spark.createDataFrame([("O1",), ("O2",)], "officer_id string"), name)
    src = spark.table(name)
    assert overwrite_from_self(spark, src.selectExpr("officer_id || 'x' AS officer_id"), name) == 2
    assert sorted(r.officer_id for r in spark.table(name).collect()) == ["O1x", "O2x"]
    assert list_tables(spark, layout.database("bronze")) == ["officers"]


def test_catalog_listing(spark, layout):
    for t in ("a_cleaned", "b_cleaned", "c"):
        overwrite_table(spark.createDataFrame([(1,)], "x int"), layout.table("silver", t))
    assert list_tables(spark, layout.database("silver"), "_cleaned") == ["a_cleaned", "b_cleaned"]
    assert tables_frame(spark, layout.database("silver"), "_cleaned").count() == 2
    assert preview(spark.range(100), 20).count() == 20


def test_failure_isolation(spark, layout):
    overwrite_table(spark.createDataFrame([("B1001", "BR101")], "borrower_id string, branch_id string"),
                    layout.table("bronze", "good"))
    overwrite_table(spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int"), layout.table("bronze", "clash"))
    report = bronze_to_silver(spark, layout, ["clash", "missing", "good"])
    status = {r.table_name: r.status for r in report}
    assert status == {"clash": "failed", "missing": "failed", "good": "ok"}
    assert "collide" in next(r.error for r in report if r.table_name == "clash")
    assert spark.table(layout.table("silver", "good_cleaned")).count() == 1
    gold = silver_to_gold(spark, layout)
    assert [r.table_name for r in gold if r.status == "ok"] == ["good_cleaned"]
    frame = report_frame(spark, report + gold)
    assert frame.filter("status = 'failed'").count() == 2


def test_parallel_tables_and_partitioned_sinks(spark, tmp_dir):
    data = [("B1001", "BR101", 2024), ("B1002", "BR102", 2025), ("B1002", "BR102", 2025), (None, "BR1", 2025)]
    reports = []
    for par in (1, 3):
        lay = Layout(prefix=f"p{par}{uuid.uuid4().hex[:6]}_", location=f"{tmp_dir}/p{par}").create(spark)
        for t in ("a", "b", "c"):
            overwrite_table(spark.createDataFrame(data, "borrower_id string, branch_id string, year int"),
                            lay.table("bronze", t))
        rows = bronze_to_silver(spark, lay, ["a", "b", "c"], partition_by={"a": ["year"]}, parallelism=par)
        reports.append([(r.table_name, r.status, r.rows_valid, r.rows_duplicate, r.rows_reject) for r in rows])
        version = current_version(spark, lay.table("silver", "a_cleaned"))
        assert spark.sql(f"SHOW PARTITIONS {version} PARTITION (dq_outcome = 'valid')").count() == 2
    assert reports[0] == reports[1] == [(t, "ok", 2, 1, 1) for t in ("a", "b", "c")]


def test_failed_staged_write_keeps_previous_table(spark, layout):
    from pyspark.sql import functions as F

    name = layout.table("silver", "keep_cleaned")
    overwrite_table(spark.createDataFrame([(1,)], "x int"), name)
    broken = spark.range(10).select(F.when(F.col("id") == 7, F.lit("bad")).otherwise("1").cast("int").alias("x"))
    with pytest.raises(Exception):
        overwrite_table(broken, name, staged=True)  # fails inside the job (ANSI cast error)
    assert [r.x for r in spark.table(name).collect()] == [1]
    assert list_tables(spark, layout.database("silver")) == ["keep_cleaned"]


def test_use_namespace(spark, layout):
    from lendlayer.sources.catalog import use_namespace

    before = spark.catalog.currentDatabase()
    try:
        use_namespace(spark, layout.database("gold"))
        assert spark.catalog.currentDatabase() == layout.database("gold")
    finally:
        use_namespace(spark, before)


def test_write_split_keep_tagged_same_result(spark, layout):
    from lendlayer.operators.quality import split_quality
    from lendlayer.sources.sinks import write_split

    data = [("B1001", "BR101", 30), ("B1001", "BR101", 30), (None, "BR1", 5), ("X1", "BR101", 5)]
    df = spark.createDataFrame(data, "borrower_id string, branch_id string, age int")
    a = write_split(split_quality(df), layout.table("silver", "a_cleaned"), layout.table("reject", "a"))
    b = write_split(split_quality(df), layout.table("silver", "b_cleaned"), layout.table("reject", "b"),
                    keep_tagged=True)
    assert a == b and (a.rows_valid, a.rows_duplicate, a.rows_reject) == (1, 1, 2)


def test_partitioned_write_has_few_files_a_value(spark, layout):
    name = layout.table("silver", "parts")
    overwrite_table(spark.range(4000, numPartitions=40).selectExpr("id", "id % 5 AS v"), name, ["v"])
    files = [r.f for r in spark.table(name).selectExpr("_metadata.file_path AS f").distinct().collect()]
    assert 5 <= len(files) <= 10  # written as they came: 40 tasks x 5 values


def test_named_catalog(spark, tmp_dir):
    lay = Layout(prefix=f"c{uuid.uuid4().hex[:6]}_", location=tmp_dir, catalog="spark_catalog").create(spark)
    name = lay.table("silver", "x_cleaned")
    assert name.startswith("spark_catalog.")
    for n in (2, 3):
        assert overwrite_counted(spark.range(n), name, staged=True) == n
    assert spark.table(name).count() == 3
    assert list_tables(spark, lay.database("silver")) == ["x_cleaned"]


def test_table_format_follows_the_session(spark, layout):
    name = layout.table("bronze", "as_orc")
    before = spark.conf.get("spark.sql.sources.default")
    try:
        spark.conf.set("spark.sql.sources.default", "orc")
        seed_table(spark, name, "id INT", [(1,), (2,)])
        overwrite_from_self(spark, spark.table(name), name)
    finally:
        spark.conf.set("spark.sql.sources.default", before)
    provider = spark.sql(f"DESCRIBE EXTENDED {current_version(spark, name)}").filter("col_name = 'Provider'").first().data_type
    assert provider.lower() == "orc" and spark.table(name).count() == 2


def test_null_splitter_job_isolates_tables(spark, layout):
    from lendlayer.plans.jobs import split_nulls

    data = [("L1", "B1"), (None, "B2"), ("L3", None)]
    overwrite_table(spark.createDataFrame(data, "loan_id string, borrower_id string"), layout.table("bronze", "loans"))
    report = split_nulls(spark, layout, ["loans", "missing"])
    assert [(r.status, r.rows_in, r.rows_valid, r.rows_reject) for r in report] == [("ok", 3, 1, 2), ("failed", None, None, None)]
    assert [r.loan_id for r in spark.table(layout.table("silver", "loans_complete")).collect()] == ["L1"]
    assert spark.table(layout.table("reject", "loans_incomplete")).count() == 2
