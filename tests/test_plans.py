"""Physical-plan shape: the properties the scale design relies on, checked on `explain`.

Plans are taken with static broadcast off and AQE off, i.e. as they would be planned
for tables far above the broadcast threshold.
"""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lendlayer.functions.standardize import standardize
from lendlayer.operators.enrich import SPREAD_KEY, enrich, standard_lookups
from lendlayer.operators.quality import split_quality
from lendlayer.plans import queries as Q
from lendlayer.plans.flagship import gold_loans
from lendlayer.plans.views import branch_view, loan_view, repayment_view


def plan_text(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture()
def at_scale(spark):
    saved = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for k, v in saved.items():
        spark.conf.set(k, v)


def test_no_python_evaluation_anywhere(spark):
    for name in ("gold_loans", "gold_repayments", "dq_summary", "enrich_officer", "key_check"):
        text = plan_text(Q.QUERIES[name](spark, SF_SMALL), "simple")
        assert "EvalPython" not in text and "PythonUDF" not in text, name


def test_scans_are_pruned(spark):
    text = plan_text(Q.QUERIES["gold_loans"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    lineitem = [s for s in schemas if "l_orderkey" in s]
    assert lineitem and all(s.count(":") == 5 for s in lineitem)  # 5 of 11 columns
    orders = [s for s in schemas if "o_orderkey" in s]
    assert orders and all(s.count(":") == 4 for s in orders)  # 4 of 6 columns


def test_flagship_exchanges_at_scale(at_scale):
    text = plan_text(gold_loans(at_scale, SF_SMALL))
    joins = re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) LeftOuter", text)
    assert joins == ["SortMergeJoin"] * 3  # borrower, repayment and branch; nothing is hinted to broadcast
    exchanges = re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", text)
    keys = [re.sub(r"#\d+L?", "", e).rsplit(",", 1)[0] for e in exchanges]
    assert sum(k.startswith(SPREAD_KEY) for k in keys) == 6  # both sides of each join
    assert keys.count("loan_id") == 1  # the partial aggregate of repayments


def test_partial_aggregation_before_every_shuffle(at_scale):
    text = plan_text(Q.QUERIES["repayment_by_loan"](at_scale, SF_SMALL), "simple")
    assert "partial_count(1)" in text and "partial_sum(" in text
    text = plan_text(Q.QUERIES["key_check"](at_scale, SF_SMALL), "simple")
    assert "partial_count(1)" in text
    # whole-row dedup: a hash aggregate on each side of the exchange (map-side combine)
    text = plan_text(Q.QUERIES["dq_valid"](at_scale, SF_SMALL), "simple")
    lines = [re.sub(r"^[\s:+\-*|]*(\(\d+\)\s*)?", "", ln) for ln in text.splitlines()]
    agg_exchange_agg = [
        i for i in range(1, len(lines) - 1)
        if lines[i].startswith("Exchange hashpartitioning")
        and lines[i - 1].startswith("HashAggregate") and lines[i + 1].startswith("HashAggregate")
    ]
    assert agg_exchange_agg


def test_keys_are_spread(at_scale):
    text = plan_text(Q.QUERIES["enrich_borrower"](at_scale, SF_SMALL))
    assert re.search(r"SortMergeJoin.*?Left keys \[2\]: \[" + SPREAD_KEY + r"#\d+L?, borrower_id#\d+\]", text, re.S)


def test_single_pass_tagging(spark):
    split = split_quality(standardize(repayment_view(spark, SF_SMALL)), "repayment_summary")
    assert plan_text(split.reject, "simple").count("FileScan parquet") == 1
    assert plan_text(split.valid, "simple").count("FileScan parquet") == 1


def test_planning_runs_no_job(spark):
    group = "plan-only"
    spark.sparkContext.setJobGroup(group, group)
    try:
        gold_loans(spark, SF_SMALL)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext._jsc.clearJobGroup()


@pytest.fixture()
def skewed(spark):
    """Settings under which AQE's skew-join rule triggers at test size."""
    keys = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.enabled")
    saved = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in zip(keys, ("true", "-1", "-1", "1k", "1.1", "1k", "false")):
            spark.conf.set(k, v)
        yield spark
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_borrower_is_split(skewed):
    n = 30_000
    facts = skewed.range(n).select(
        F.concat(F.lit("L"), F.col("id").cast("string")).alias("loan_id"),
        F.when(F.col("id") % 3 == 0, F.lit("B000001"))  # the hot borrower: a third of all rows
        .otherwise(F.concat(F.lit("B"), (F.col("id") % 5000).cast("string"))).alias("borrower_id"),
    )
    people = skewed.range(5000).select(
        F.concat(F.lit("B"), F.col("id").cast("string")).alias("borrower_id"),
        F.concat(F.lit("name"), F.col("id").cast("string")).alias("full_name"),
    ).union(skewed.createDataFrame([("B000001", "Hot")], "borrower_id string, full_name string"))
    out = enrich(facts, "loans", standard_lookups(borrowers=people))
    got = out.collect()  # runs this plan itself, so its adaptive plan becomes final
    assert len(got) == n
    assert sum(r.borrower_name == "Hot" for r in got) == n // 3
    assert "skew=true" in plan_text(out, "simple")


def test_hot_loan_is_split_against_its_own_aggregate(skewed):
    """The aggregate's partitioning must not be reused, or AQE could not split the hot loan."""
    n = 30_000
    facts = skewed.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("L1")).otherwise(F.concat(F.lit("L"), (F.col("id") % 5000).cast("string"))).alias("loan_id"),
        F.lit(1.0).alias("amount_in_inr"),
    )
    out = enrich(facts, "repayments_cleaned", standard_lookups(repayment_summary=facts))
    got = out.collect()
    assert len(got) == n and sum(r.repayment_count_agg for r in got if r.loan_id == "L1") >= (n // 3) ** 2
    assert "skew=true" in plan_text(out, "simple")


def test_rows_of_a_hot_loan_are_not_sorted(at_scale):
    """The aggregates are hashed and the repayments stream past them, so no task holds a hot loan's rows."""
    for name in ("gold_hot_loan", "gold_repayments"):
        text = plan_text(Q.QUERIES[name](at_scale, SF_SMALL))
        assert re.search(r"ShuffledHashJoin LeftOuter BuildRight.*?Left keys \[2\]: \[" + SPREAD_KEY + r"#\d+L?, loan_id#\d+\]", text, re.S), name
    assert "Sort " not in plan_text(Q.QUERIES["gold_hot_loan"](at_scale, SF_SMALL), "simple")
