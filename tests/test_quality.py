"""Data-quality split: precedence, three-valued logic, conservation, policies, edge cases."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from lendlayer.operators.quality import (
    DEFAULT_RULES,
    INVALID_ID_FORMAT,
    NULL_VALUES,
    OUTLIER_OR_INVALID_RANGE,
    Rule,
    key_check,
    outside,
    rule_violations,
    split_critical,
    split_quality,
)

BORROWER = "borrower_id string, branch_id string, age int, income double, credit_score int, industry_code string"


def frame(spark, data, ddl=BORROWER):
    return spark.createDataFrame(data, ddl)


def test_precedence_first_failing_group_wins(spark):
    df = frame(
        spark,
        [
            (None, "BRX", 5, 1.0, 1, "1234567"),  # fails all three groups -> null
            ("X1", "BR101", 5, 1.0, 1, "1"),  # format and range -> format
            ("B1001", "BR101", 5, 2000.0, 700, "1"),  # range only
            ("B1002", "BR102", 30, 2000.0, 700, "1"),  # valid
        ],
    )
    split = split_quality(df)
    got = {r.borrower_id: r.reject_reason for r in split.reject.collect()}
    assert got == {None: NULL_VALUES, "X1": INVALID_ID_FORMAT, "B1001": OUTLIER_OR_INVALID_RANGE}
    assert [r.borrower_id for r in split.valid.collect()] == ["B1002"]


def test_null_range_value_lands_in_neither_output(spark):
    df = frame(spark, [("B1001", "BR101", None, 2000.0, 700, "1"), ("B1002", "BR101", None, 5.0, 700, "1")])
    split = split_quality(df)
    assert split.valid.count() == 0
    # null age with another rule true: the OR is TRUE, so the row is rejected
    assert [r.borrower_id for r in split.reject.collect()] == ["B1002"]
    assert [r.borrower_id for r in split.unknown.collect()] == ["B1001"]


def test_unknown_policies(spark):
    df = frame(spark, [("B1001", "BR101", None, 2000.0, 700, "1")])
    assert split_quality(df, on_unknown="keep").valid.count() == 1
    assert split_quality(df, on_unknown="reject").reject.first().reject_reason == OUTLIER_OR_INVALID_RANGE
    with pytest.raises(ValueError):
        split_quality(df, on_unknown="maybe")


def test_duplicates_removed_from_valid_but_kept_in_reject(spark):
    good = ("B1001", "BR101", 30, 2000.0, 700, "1")
    bad = ("B1002", "BR101", 3, 2000.0, 700, "1")
    split = split_quality(frame(spark, [good, good, good, bad, bad]))
    assert split.valid.count() == 1
    assert split.reject.count() == 2
    counts = {r.outcome: (r.row_count, r.distinct_rows) for r in split.counts().collect()}
    assert counts == {"valid": (3, 1), OUTLIER_OR_INVALID_RANGE: (2, 1)}


def test_table_scoped_rules_and_aliases(spark):
    df = spark.createDataFrame([("BR101", 0, 50.0)], "branch_id string, employee_count int, loan_volume double")
    assert split_quality(df, "branch_master_dirty").valid.count() == 1  # literal name: rules do not apply
    aliased = split_quality(df, "branch_master_dirty", aliases={"branch_master_dirty": "branch_master"})
    assert aliased.reject.first().reject_reason == OUTLIER_OR_INVALID_RANGE


def test_no_rules_apply_gives_empty_typed_reject(spark):
    df = spark.createDataFrame([("a", 1)], "name string, n int")
    split = split_quality(df)
    assert split.valid.count() == 1
    assert split.reject.count() == 0
    assert dict(split.reject.dtypes)["reject_reason"] == "string"


def test_clean_ids_are_declared_non_nullable(spark):
    df = frame(spark, [("B1001", "BR101", 30, 2000.0, 700, "1")])
    fields = {f.name: f.nullable for f in split_quality(df).valid.schema.fields}
    assert fields["borrower_id"] is False and fields["branch_id"] is False and fields["age"] is True


def test_custom_rule_registry(spark):
    rules = DEFAULT_RULES + (Rule("tiny_income", 3, ("income",), outside(5000, 1e9)),)
    df = frame(spark, [("B1001", "BR101", 30, 2000.0, 700, "1")])
    assert split_quality(df, rules=rules).reject.count() == 1


def test_rule_violations_single_group(spark):
    df = frame(spark, [("B1001", "BR101", 10, 2000.0, 700, "1"), ("B1002", "BR101", 30, 2000.0, 700, "1")])
    assert [r.borrower_id for r in rule_violations(df, ["age_range"]).collect()] == ["B1001"]
    with pytest.raises(ValueError):
        rule_violations(df, ["age_range", "null_ids"])


def test_split_critical(spark):
    df = spark.createDataFrame([("L1", "B1"), ("L2", None), (None, "B3")], "loan_id string, borrower_id string")
    valid, invalid = split_critical(df)
    assert rows(valid) == [("L1", "B1")]
    assert len(rows(invalid)) == 2
    none_valid, none_invalid = split_critical(spark.createDataFrame([(1,)], "x int"))
    assert none_valid.count() == 1 and none_invalid.count() == 0


def test_key_check(spark):
    df = spark.createDataFrame([("O1",), ("O1",), ("O2",), (None,)], "officer_id string")
    assert rows(key_check(df, ["officer_id"])) == [(None, 1), ("O1", 2)]


ids = st.one_of(st.none(), st.sampled_from(["B1001", "B12", "X9", "B1234567"]))
branches = st.one_of(st.none(), st.sampled_from(["BR101", "BR1", "BR999"]))
ages = st.one_of(st.none(), st.integers(0, 130))
incomes = st.one_of(st.none(), st.sampled_from([0.0, 999.0, 1000.0, 5e6, 1e7, 2e7]))
scores = st.one_of(st.none(), st.integers(250, 950))
codes = st.one_of(st.none(), st.sampled_from(["6201", "1234567"]))
records = st.lists(st.tuples(ids, branches, ages, incomes, scores, codes), min_size=0, max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=records)
def test_conservation_and_precedence_property(spark, data):
    df = frame(spark, data)
    split = split_quality(df)
    n_valid = split.valid_with_duplicates.count()
    rejected = split.reject.collect()
    n_unknown = split.unknown.count()
    assert n_valid + len(rejected) + n_unknown == len(data)
    for r in rejected:
        if r.borrower_id is None or r.branch_id is None:
            assert r.reject_reason == NULL_VALUES
        elif r.reject_reason != INVALID_ID_FORMAT:
            assert r.reject_reason == OUTLIER_OR_INVALID_RANGE
    assert split.valid.count() == split.valid_with_duplicates.distinct().count()
    assert split.valid.filter(F.col("borrower_id").isNull()).count() == 0


def test_dotted_and_spaced_names(spark):
    df = spark.createDataFrame([("B1001", "BR101", 1.5), ("B1001", "BR101", 1.5)], "`borrower.id` string, branch_id string, `loan amount` double")
    split = split_quality(df)
    assert split.valid.count() == 1 and split.valid.columns == df.columns
    assert key_check(df, ["borrower.id"]).first().row_count == 2


def test_rules_from_config_match_the_registry(spark, tmp_dir):
    import json
    import os

    from lendlayer.operators.quality import load_rules, rules_from_config

    spec = [
        {"name": "null_ids", "group": 1, "kind": "any_null_ids"},
        {"name": "branch_id_format", "group": 2, "kind": "not_matching", "column": "branch_id", "pattern": "^BR[0-9]{3}$"},
        {"name": "borrower_id_format", "group": 2, "kind": "not_matching", "column": "borrower_id",
         "pattern": "^B[0-9]{3,6}$"},
        {"name": "age_range", "group": 3, "kind": "outside", "column": "age", "low": 18, "high": 100},
        {"name": "income_range", "group": 3, "kind": "outside", "column": "income", "low": 1000, "high": 1e7},
        {"name": "credit_score_range", "group": 3, "kind": "outside", "column": "credit_score", "low": 300, "high": 900},
        {"name": "industry_code_length", "group": 3, "kind": "longer_than", "column": "industry_code", "max_length": 6},
        {"name": "rate", "group": 3, "kind": "not_positive_or_above", "column": "exchange_rate", "high": 200,
         "tables": ["repayment_summary"]},
    ]
    path = os.path.join(tmp_dir, "rules.json")
    with open(path, "w") as fh:
        json.dump(spec, fh)
    rules = load_rules(path)
    data = [(None, "BR101", 30, 2000.0, 700, "1"), ("X1", "BR101", 30, 2000.0, 700, "1"),
            ("B1001", "BR101", 5, 2000.0, 700, "1"), ("B1002", "BR101", None, 2000.0, 700, "1"),
            ("B1003", "BR101", 30, 2000.0, 700, "1")]
    df = frame(spark, data)
    ours, builtin = split_quality(df, rules=rules), split_quality(df)
    assert rows(ours.reject) == rows(builtin.reject)
    assert rows(ours.valid) == rows(builtin.valid) and rows(ours.unknown) == rows(builtin.unknown)
    with pytest.raises(ValueError, match="unknown rule kind"):
        rules_from_config([{"name": "x", "group": 3, "kind": "between", "column": "age"}])
    with pytest.raises(ValueError, match="needs column"):
        rules_from_config([{"name": "x", "group": 3, "kind": "outside", "column": "age"}])
    with pytest.raises(ValueError, match="group must be one of"):
        rules_from_config([{"name": "x", "group": 4, "kind": "outside", "column": "age", "low": 1, "high": 2}])


def test_status_encoding_matches_case_chain_for_every_outcome(spark):
    """All 27 combinations of three group results (true / false / NULL), all policies:
    the one-evaluation encoding equals the plain CASE chain it replaces."""
    import itertools

    from lendlayer.operators.quality import GROUP_REASON, UNKNOWN, VALID, status_column

    combos = list(itertools.product((True, False, None), repeat=3))
    df = spark.createDataFrame(combos, "g1 boolean, g2 boolean, g3 boolean")
    groups = [(GROUP_REASON[i], F.col(f"g{i}")) for i in (1, 2, 3)]

    def case_chain(policy):
        expr = None
        for reason, cond in groups:
            if policy == "drop":
                pairs = [(cond, reason), (cond.isNull(), UNKNOWN)]
            elif policy == "reject":
                pairs = [(F.coalesce(cond, F.lit(True)), reason)]
            else:
                pairs = [(F.coalesce(cond, F.lit(False)), reason)]
            for c, label in pairs:
                expr = F.when(c, label) if expr is None else expr.when(c, label)
        return expr.otherwise(VALID)

    for policy in ("drop", "reject", "keep"):
        got = df.select(status_column(groups, policy).alias("a"), case_chain(policy).alias("b")).collect()
        assert all(r.a == r.b for r in got), policy
