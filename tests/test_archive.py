"""Union by name, the archive of rejects, and lookups left out for want of their key."""

import datetime as dt
import uuid

import pytest
from conftest import rows

from lendlayer.layout import Layout
from lendlayer.operators.archive import union_by_name
from lendlayer.plans.jobs import archive_rejects, bronze_to_silver, silver_to_gold
from lendlayer.sources.sinks import overwrite_table
from test_plans import plan_text


@pytest.fixture()
def layout(spark, tmp_dir):
    return Layout(prefix=f"a{uuid.uuid4().hex[:6]}_", location=tmp_dir).create(spark)


def test_union_fills_with_typed_nulls(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "id int, `odd name` string")
    b = spark.createDataFrame([(2.5, 2)], "amount double, id int")
    c = spark.createDataFrame([], "d date")
    out = union_by_name({"a": a, "b": b, "c": c})
    assert out.dtypes == [("table_name", "string"), ("id", "int"), ("odd name", "string"), ("amount", "double"), ("d", "date")]
    assert rows(out) == [("a", 1, "x", None, None), ("a", 1, "x", None, None), ("b", 2, None, 2.5, None)]
    assert union_by_name({"b": b, "a": a}, tag=None).columns == ["amount", "id", "odd name"]
    assert "Exchange" not in plan_text(out, "simple")


def test_union_refuses_clashes(spark):
    a, b = spark.createDataFrame([(1,)], "id int"), spark.createDataFrame([("1",)], "id string")
    with pytest.raises(TypeError, match="id.*int.*string"):
        union_by_name({"a": a, "b": b})
    with pytest.raises(ValueError, match="table_name"):
        union_by_name({"a": a.withColumnRenamed("id", "table_name")})
    with pytest.raises(ValueError, match="nothing"):
        union_by_name({})


def test_archive_job(spark, layout):
    overwrite_table(spark.createDataFrame([(None, "BR101"), ("B1001", "bad")], "borrower_id string, branch_id string"), layout.table("bronze", "people"))
    overwrite_table(spark.createDataFrame([(None, 5.0), ("L1", 1.0)], "loan_id string, x double"), layout.table("bronze", "loans"))
    bronze_to_silver(spark, layout, ["people", "loans"])
    for _ in range(2):
        row = archive_rejects(spark, layout, ["people", "loans"], dt.date(2026, 1, 1))
        assert (row.status, row.rows_in, row.rows_out) == ("ok", 3, 3)
    archive = spark.table(layout.table("reject", "reject_archive"))
    assert rows(archive.select("table_name", "reject_reason", "x")) == [("loans", "NULL_VALUES", 5.0), ("people", "INVALID_ID_FORMAT", None), ("people", "NULL_VALUES", None)]
    text = plan_text(archive.filter("table_name = 'loans'"), "simple")
    assert "table_name" in text.split("PartitionFilters")[1].split("]")[0]
    row = archive_rejects(spark, layout, ["people", "never"])
    assert row.status == "failed" and archive.count() == 3


def test_join_left_out_for_want_of_its_key_is_reported(spark, layout):
    people = spark.createDataFrame([("O101", 101, "x")], "officer_id string, officer_key int, full_name string")
    overwrite_table(people, layout.table("silver", "loan_officers_cleaned"))
    overwrite_table(spark.createDataFrame([("L1", "O101")], "loan_id string, officer_id string"), layout.table("silver", "repayments_cleaned"))
    report = {r.table_name: r for r in silver_to_gold(spark, layout, ["repayments_cleaned", "loan_officers_cleaned"])}
    assert report["repayments_cleaned"].status == "ok"
    assert report["repayments_cleaned"].error == "join officer left out: the table has officer_id but no officer_key"
    assert "officer_name" not in spark.table(layout.table("gold", "repayments_cleaned_gold")).columns
    assert report["loan_officers_cleaned"].error is None
