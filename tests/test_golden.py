"""Golden outcomes on small invented sample rows, through the real jobs and tables."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

import samples
from lendlayer.layout import Layout
from lendlayer.operators.quality import split_critical, split_quality
from lendlayer.plans.jobs import bronze_to_silver, ingest_file, repair_officer_ids, silver_to_gold
from lendlayer.schemas import ddl, schema
from lendlayer.sources.seeds import create_table, insert_rows


@pytest.fixture(scope="module")
def layout(spark):
    import tempfile

    root = tempfile.mkdtemp(prefix="lendlayer-golden-")
    lay = Layout(prefix=f"g{uuid.uuid4().hex[:6]}_", location=root).create(spark)
    seeds = [
        ("loan_history", samples.LOAN_HISTORY_COLUMNS, samples.LOAN_HISTORY),
        ("repayment_summary", samples.REPAYMENT_SUMMARY_COLUMNS, samples.REPAYMENT_SUMMARY),
        ("loan_officers", samples.LOAN_OFFICERS_COLUMNS, samples.LOAN_OFFICERS),
        ("borrower_profile", samples.BORROWER_PROFILE_COLUMNS, samples.BORROWER_PROFILE),
        ("repayments", samples.REPAYMENTS_COLUMNS, samples.REPAYMENTS),
    ]
    for table, cols, data in seeds:
        name = lay.table("bronze", table)
        create_table(spark, name, ddl(table))
        insert_rows(spark, name, data, columns=cols)
    return lay


@pytest.fixture(scope="module")
def silver_report(spark, layout):
    repair = repair_officer_ids(spark, layout, "loan_officers")
    assert repair.status == "ok"
    tables = ["loan_history", "repayment_summary", "loan_officers", "borrower_profile", "repayments"]
    return {r.table_name: r for r in bronze_to_silver(spark, layout, tables)}


def test_seeded_types(spark, layout):
    t = spark.table(layout.table("bronze", "loan_history"))
    assert dict(t.dtypes)["due_date"] == "date"
    assert dict(t.dtypes)["is_overdue"] == "boolean"
    assert t.filter(F.col("loan_type").isNull()).count() == 10  # unlisted column -> null


def test_officer_ids_repaired_in_place(spark, layout, silver_report):
    ids = sorted(r.officer_id for r in spark.table(layout.table("bronze", "loan_officers")).collect())
    assert ids == list(range(102, 112))
    assert dict(spark.table(layout.table("bronze", "loan_officers")).dtypes)["officer_id"] == "int"


def test_silver_counts(silver_report):
    assert silver_report["repayment_summary"].rows_valid == 5
    assert silver_report["repayment_summary"].rows_reject == 5
    for t in ("loan_history", "loan_officers", "borrower_profile", "repayments"):
        assert silver_report[t].rows_valid == 10 or t == "repayments"
        assert silver_report[t].rows_reject == 0
    assert silver_report["repayments"].rows_valid == 3


def test_repayment_summary_rejects_usd_rows(spark, layout, silver_report):
    rejected = spark.table(layout.table("reject", "repayment_summary"))
    assert sorted(r.loan_id for r in rejected.collect()) == ["L1001", "L1003", "L1005", "L1007", "L1009"]
    assert {r.reject_reason for r in rejected.collect()} == {"OUTLIER_OR_INVALID_RANGE"}


@pytest.fixture(scope="module")
def gold(spark, layout, silver_report):
    report = silver_to_gold(spark, layout, as_of=dt.date(2026, 1, 1))
    assert {r.status for r in report if r.status != "missing_lookup"} == {"ok"}
    return report


def test_gold_loan_history(spark, layout, gold):
    g = {r.loan_id: r for r in spark.table(layout.table("gold", "loan_history_cleaned_gold")).collect()}
    assert len(g) == 10
    assert {lid for lid, r in g.items() if r.repayment_count_agg == 1} == {"L1002", "L1004", "L1006", "L1008", "L1010"}
    assert {r.repayment_count_agg for lid, r in g.items() if lid in {"L1001", "L1003", "L1005"}} == {0}
    assert g["L1002"].total_repaid == samples.repaid(2)
    assert g["L1001"].total_repaid == 0.0
    assert {r.is_overdue for r in g.values()} == {1}  # every due date is before 2026-01-01
    assert g["L1001"].borrower_name == samples.person(1)
    assert all(r.processing_date == dt.date(2026, 1, 1) for r in g.values())


def test_gold_officer_names(spark, layout, gold):
    g = {r.loan_id: r for r in spark.table(layout.table("gold", "repayments_cleaned_gold")).collect()}
    assert g["L1001"].officer_name is None  # O101 has no officer row
    assert g["L1002"].officer_name == samples.person(52)


def test_gold_repayment_summary_skips_self_join(spark, layout, gold):
    cols = spark.table(layout.table("gold", "repayment_summary_cleaned_gold")).columns
    assert "repayment_count_agg" not in cols and "total_repaid" not in cols
    assert "officer_name" in cols


def test_gold_missing_branch_lookup_reported(gold):
    missing = [r for r in gold if r.status == "missing_lookup"]
    assert [r.table_name for r in missing] == ["branch_master_dirty_cleaned"]


def test_csv_ingest_crlf_booleans(spark, tmp_dir):
    path = os.path.join(tmp_dir, "customer_metadata.csv")
    with open(path, "w", newline="") as fh:
        fh.write(samples.CUSTOMER_CSV)
    lay = Layout(prefix=f"c{uuid.uuid4().hex[:6]}_", location=tmp_dir).create(spark)
    row = ingest_file(spark, lay, path, "customer_metadata", schema("customer_metadata"), fmt="csv")
    assert row.status == "ok" and row.rows_out == 4
    t = spark.table(lay.table("bronze", "customer_metadata"))
    got = {r.borrower_id: r for r in t.collect()}
    assert got["B1004"].default_flag is True and got["B1001"].default_flag is False
    assert got["B1004"].credit_score == 604 and got["B1001"].income == 41000.0


def test_json_array_multiline_and_null_splitter(spark, tmp_dir):
    path = os.path.join(tmp_dir, "loan_collateral.json")
    with open(path, "w", newline="") as fh:
        fh.write(samples.collateral_json())
    lay = Layout(prefix=f"j{uuid.uuid4().hex[:6]}_", location=tmp_dir).create(spark)
    row = ingest_file(spark, lay, path, "loan_collateral", schema("loan_collateral"), fmt="json")
    assert row.rows_out == 10
    df = spark.table(lay.table("bronze", "loan_collateral"))
    valid, invalid = split_critical(df)
    assert valid.count() == 6
    assert sorted(r.collateral_id for r in invalid.collect()) == sorted(samples.COLLATERAL_NO_EXPIRY)


def test_json_read_line_by_line_gives_null_rows(spark, tmp_dir):
    """Reading a pretty-printed array as JSON lines: every line is an all-null row."""
    path = os.path.join(tmp_dir, "loan_collateral_lines.json")
    with open(path, "w", newline="") as fh:
        fh.write(samples.collateral_json())
    from lendlayer.sources.files import read_json

    df = read_json(spark, path, schema("loan_collateral"), multi_line=False)
    lines = samples.collateral_json().count("\n")
    assert df.count() == lines
    assert df.filter(F.col("collateral_id").isNotNull()).count() == 0
    split = split_quality(df, "loan_collateral")
    assert split.valid.count() == 0
    assert {r.reject_reason for r in split.reject.collect()} == {"NULL_VALUES"}


def test_repair_refuses_ids_that_do_not_parse(spark, tmp_dir):
    lay = Layout(prefix=f"r{uuid.uuid4().hex[:6]}_", location=tmp_dir).create(spark)
    name = lay.table("bronze", "loan_officers")
    create_table(spark, name, "officer_id string, full_name string, branch_id string")
    insert_rows(spark, name, [("O101", "a", "BR101"), ("EMP7", "b", "BR102"), ("O9999999999", "c", "BR103")])
    row = repair_officer_ids(spark, lay)
    assert (row.status, row.rows_in, row.rows_unknown) == ("failed", 3, 2)
    assert sorted(r.officer_id for r in spark.table(name).collect()) == ["EMP7", "O101", "O9999999999"]
    report = bronze_to_silver(spark, lay, ["loan_officers"])[0]
    assert (report.rows_valid, report.rows_reject) == (3, 0)
    kept = {r.officer_id: r.officer_key for r in spark.table(lay.table("silver", "loan_officers_cleaned")).collect()}
    assert kept == {"O101": 101, "EMP7": None, "O9999999999": None}


def test_failing_and_stale_lookups_are_reported(spark, tmp_dir):
    lay = Layout(prefix=f"f{uuid.uuid4().hex[:6]}_", location=tmp_dir).create(spark)
    spark.createDataFrame([("L1", "B1001", 1.0)], "loan_id string, borrower_id string, amount double").write.saveAsTable(lay.table("silver", "loan_history_cleaned"))
    spark.createDataFrame([("B1001", "x")], "borrower_id string, full_name string").write.saveAsTable(lay.table("silver", "borrower_profile_cleaned"))
    spark.createDataFrame([("L1", "many")], "loan_id string, amount_in_inr string").write.saveAsTable(lay.table("silver", "repayment_summary_cleaned"))
    report = {r.table_name: r for r in silver_to_gold(spark, lay, ["loan_history_cleaned"], as_of=dt.date(2026, 1, 1))}
    assert report["repayment_summary_cleaned"].status == "failed_lookup" and "many" in report["repayment_summary_cleaned"].error
    assert report["loan_history_cleaned"].status == "ok"
    assert spark.table(lay.table("gold", "loan_history_cleaned_gold")).first().borrower_name == "x"
    assert [t.name for t in spark.catalog.listTables(lay.database("gold"))] == ["loan_history_cleaned_gold"]
    report = {r.table_name: r for r in silver_to_gold(spark, lay, ["loan_history_cleaned"], stale=["borrower_profile_cleaned"])}
    assert report["borrower_profile_cleaned"].status == "stale_lookup"
