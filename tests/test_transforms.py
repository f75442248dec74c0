"""Standardisation, officer ids, derivations, enrichment joins."""

import datetime as dt

import pytest

from conftest import rows
from lendlayer.functions.names import first_existing, id_columns, normalize_column_names
from lendlayer.functions.standardize import normalize_officer_id, standardize, trim_strings
from lendlayer.operators.derive import derive_loan_columns
from lendlayer.operators.enrich import Lookup, enrich, left_join, standard_lookups


def test_normalize_names_and_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`Loan ID` int, ` Amount ` int")
    assert normalize_column_names(df).columns == ["loan_id", "amount"]
    clash = spark.createDataFrame([(1, 2)], "`Loan ID` int, `loan_id` int")
    with pytest.raises(ValueError, match="collide"):
        normalize_column_names(clash)


def test_trim_only_strings_and_only_spaces(spark):
    df = spark.createDataFrame([("  a b  ", 3, "\tx ")], "s string, n int, t string")
    assert trim_strings(df).first() == ("a b", 3, "\tx")


def test_standardize_idempotent(spark):
    df = spark.createDataFrame([(" B1 ", 1)], "`Borrower ID` string, `AGE` int")
    once = standardize(df)
    assert rows(standardize(once)) == rows(once) == [("B1", 1)]


def test_officer_id_normalisation(spark):
    df = spark.createDataFrame([("O102",), ("OX1",), ("BOO7",), (None,)], "officer_id string")
    assert [r.officer_id for r in normalize_officer_id(df).collect()] == [102, None, None, None]
    guarded = normalize_officer_id(df, guarded=True).collect()
    assert [r.officer_id for r in guarded] == [102, None, None, None]
    twice = normalize_officer_id(normalize_officer_id(df))
    assert [r.officer_id for r in twice.collect()] == [102, None, None, None]
    guarded_keeps = spark.createDataFrame([("7O",)], "officer_id string")
    assert normalize_officer_id(guarded_keeps, guarded=True).first().officer_id is None


def test_name_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "amount int, loan_id int, x_id int")
    assert first_existing(df, ["loan_amount", "amount"]) == "amount"
    assert first_existing(df, ["nope"]) is None
    assert id_columns(df) == ["loan_id", "x_id"]


def test_derivations(spark):
    df = spark.createDataFrame(
        [("L1", 100.0, 83.2, 650, 5, dt.date(2020, 1, 1), True), ("L2", 10.0, 1.0, 700, 1, None, True)],
        "loan_id string, amount double, exchange_rate double, interest_rate_bps int, tenure_years int, "
        "due_date date, is_overdue boolean",
    )
    out = derive_loan_columns(df, dt.date(2021, 1, 1))
    assert out.columns.index("is_overdue") == 6  # replaced in place
    assert dict(out.dtypes)["is_overdue"] == "int"
    got = {r.loan_id: r for r in out.collect()}
    assert got["L1"].loan_amount_inr == 100.0 * 83.2
    assert got["L1"].interest_rate_pct == 6.5 and got["L1"].tenure_months == 60
    assert got["L1"].is_overdue == 1 and got["L2"].is_overdue == 0


def test_derivations_need_inputs(spark):
    df = spark.createDataFrame([(1.0,)], "loan_amount double")
    assert derive_loan_columns(df).columns == ["loan_amount"]


FACTS = "loan_id string, borrower_id string, branch_id string"


def test_fan_out_multiplies_by_key_multiplicity(spark):
    facts = spark.createDataFrame([("L1", "B1", "BR1"), ("L2", "B2", "BR1")], FACTS)
    people = spark.createDataFrame([("B1", "Ann"), ("B1", "Anne"), ("B1", "Ann")], "borrower_id string, full_name string")
    out = enrich(facts, "loans", standard_lookups(borrowers=people))
    assert rows(out.select("loan_id", "borrower_name")) == [("L1", "Ann"), ("L1", "Anne"), ("L2", None)]


def test_null_keys_spread_join_is_exact(spark):
    facts = spark.createDataFrame([("L1", None, "BR1"), ("L2", None, "BR1"), ("L3", "B1", "BR2")], FACTS)
    lookup = spark.createDataFrame([("B1", "Ann"), (None, "Ghost")], "borrower_id string, borrower_name string")
    out = left_join(facts, lookup, "borrower_id")
    assert out.columns == ["borrower_id", "loan_id", "branch_id", "borrower_name"]
    assert rows(out.select("loan_id", "borrower_name")) == [("L1", None), ("L2", None), ("L3", "Ann")]
    # a null key whose row-hash stand-in equals a real lookup key still does not match
    from pyspark.sql import functions as F

    stand_in = facts.filter("loan_id = 'L1'").select(
        F.xxhash64(*[F.col(c) for c in facts.columns]).cast("string").alias("borrower_id")).first()[0]
    trap = spark.createDataFrame([(stand_in, "Collision")], "borrower_id string, borrower_name string")
    assert left_join(facts, trap, "borrower_id").filter("borrower_name IS NOT NULL").count() == 0


def test_null_keys_int_and_fallback_types(spark):
    facts = spark.createDataFrame([(1, None), (2, 7)], "loan int, officer_id int")
    officers = spark.createDataFrame([(7, "Bob")], "officer_id int, officer_name string")
    assert rows(left_join(facts, officers, "officer_id").select("loan", "officer_name")) == [(1, None), (2, "Bob")]
    dated = spark.createDataFrame([(1, None), (2, dt.date(2025, 1, 1))], "n int, d date")
    cal = spark.createDataFrame([(dt.date(2025, 1, 1), "Q1")], "d date, q string")
    assert rows(left_join(dated, cal, "d").select("n", "q")) == [(1, None), (2, "Q1")]


def test_self_derived_lookup(spark):
    people = spark.createDataFrame([("B1", "Ann"), (None, "Ghost")], "borrower_id string, full_name string")
    out = enrich(people, "borrower_profile_cleaned", standard_lookups(borrowers=people))
    assert rows(out.select("full_name", "borrower_name")) == [("Ann", "Ann"), ("Ghost", None)]


def test_join_key_types_must_agree(spark):
    facts = spark.createDataFrame([("O101",)], "officer_id string")
    officers = spark.createDataFrame([(101, "Bob")], "officer_id int, full_name string")
    with pytest.raises(TypeError, match="normalise"):
        enrich(facts, "t", standard_lookups(officers=officers))


def test_repayment_fill_and_self_skip(spark):
    loans = spark.createDataFrame([("L1",), ("L2",)], "loan_id string")
    summary = spark.createDataFrame([("L1", 5.0), ("L1", 7.0)], "loan_id string, amount_in_inr double")
    out = {r.loan_id: r for r in enrich(loans, "loans", standard_lookups(repayment_summary=summary)).collect()}
    assert (out["L1"].repayment_count_agg, out["L1"].total_repaid) == (2, 12.0)
    assert (out["L2"].repayment_count_agg, out["L2"].total_repaid) == (0, 0.0)
    same = enrich(summary, "repayment_summary_cleaned", standard_lookups(repayment_summary=summary))
    assert same.columns == summary.columns


def test_branch_only_missing_columns(spark):
    facts = spark.createDataFrame([("L1", "B1", "BR1", "West")], FACTS + ", region string")
    branches = spark.createDataFrame(
        [("BR1", "Pune", "East"), ("BR1", "Pune", "East")], "branch_id string, branch_name string, region string"
    )
    out = enrich(facts, "loans", standard_lookups(branches=branches))
    assert out.columns == ["branch_id", "loan_id", "borrower_id", "region", "branch_name"]
    assert rows(out.select("region", "branch_name")) == [("West", "Pune")]
    nothing_missing = spark.createDataFrame([("BR1", "x", "y")], "branch_id string, branch_name string, region string")
    assert enrich(nothing_missing, "b", standard_lookups(branches=branches)).columns == nothing_missing.columns


def test_lookup_collision_is_refused(spark):
    facts = spark.createDataFrame([("B1", "x")], "borrower_id string, borrower_name string")
    lk = Lookup("b", "borrower_id", spark.createDataFrame([("B1", "y")], "borrower_id string, borrower_name string"))
    with pytest.raises(ValueError, match="duplicate"):
        enrich(facts, "t", [lk])
