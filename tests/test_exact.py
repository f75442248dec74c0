"""Outcome counts by row digests, and sums that don't depend on the order of rows."""

import math
import random
from fractions import Fraction

import pytest
from conftest import SF_SMALL, rows
from pyspark.sql import functions as F
from test_plans import at_scale, plan_text  # noqa: F401

from lendlayer.operators import quality
from lendlayer.operators.enrich import exact_sum, repayment_aggregates
from lendlayer.operators.quality import split_quality
from lendlayer.plans import queries as Q

DDL = "borrower_id string, branch_id string, note string, x double"
DATA = [
    ("B1001", "BR101", None, 1.0), ("B1001", "BR101", None, 1.0), ("B1002", "BR101", "a", None), ("B1002", "BR101", None, None),
    ("B1003", "BR101", "", None), ("B1003", "BR101", None, 0.0), ("B1003", "BR101", None, -0.0), ("B1004", "BR101", "", float("nan")),
    (None, "BR101", "a", 1.0), ("BR101", None, "a", 1.0), ("BR101", None, "a", 1.0), ("X", "BR101", "B", 2.0),
]


def whole_counts(df):
    split = split_quality(df)
    tagged = split.tagged.toDF(*split.columns, "s")
    return {r.s: (r.n, r.d) for r in tagged.groupBy(*split.columns, "s").count().groupBy("s").agg(F.sum("count").alias("n"), F.count("*").alias("d")).collect()}


def digest_counts(df):
    return {r.outcome.replace("valid", "VALID"): (r.row_count, r.distinct_rows) for r in split_quality(df).counts().collect()}


def test_counts_by_digest(spark):
    df = spark.createDataFrame(DATA * 3 + DATA[:2], DDL).repartition(3)
    assert digest_counts(df) == whole_counts(df)
    assert digest_counts(df.limit(0)) == {}


@pytest.mark.parametrize("weak", [1, 3])
def test_rows_that_meet_in_a_digest_are_compared_whole(spark, monkeypatch, weak):
    """Digests made to collide: the counts stay right."""
    real = quality.row_digest

    def collide(df, columns):
        low, high, check = real(df, columns)
        return F.pmod(low, F.lit(weak)), F.lit(0).cast("long"), check

    monkeypatch.setattr(quality, "row_digest", collide)
    df = spark.createDataFrame(DATA * 2, DDL).repartition(3)
    assert digest_counts(df) == whole_counts(df)


def test_columns_without_an_exact_hash_are_compared_whole(spark):
    df = spark.createDataFrame([("B1001", "BR101", [1, None]), ("B1001", "BR101", [None, 1]), ("B1001", "BR101", [None, 1])], "borrower_id string, branch_id string, z array<int>")
    assert digest_counts(df) == {"VALID": (3, 2)}


def test_counts_shuffle_digests_only(spark):
    df = Q.QUERIES["dq_summary"](spark, SF_SMALL)
    df.collect()  # its own run, so the adaptive plan is final
    final = plan_text(df, "simple").split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1  # the branch that fetches rows is gone
    wide = [ln for ln in final.splitlines() if "Exchange hashpartitioning" in ln and "full_name" in ln]
    assert not wide and "_d1" in final


def test_digests_are_shuffled_once(at_scale):
    """The branch that would fetch rows reads the same shuffle of digests; only its own scan is another."""
    text = plan_text(Q.QUERIES["dq_summary"](at_scale, SF_SMALL), "simple")
    assert text.count("FileScan") == 2 and "ReusedExchange" in text


def fixed(values, digits=6):
    """Half-up rounding to the grid of the shortest decimal text, added exactly."""
    grid = 10**digits
    total = Fraction(0)
    for v in values:
        n = Fraction(repr(v)) * grid
        total += Fraction(math.floor(abs(n) + Fraction(1, 2)) * (1 if n >= 0 else -1), grid)
    return float(total)


def test_sum_is_the_same_in_any_order(spark):
    rng = random.Random(4)
    values = [rng.choice([1e15, -1e15, 0.1, 0.3, 123456.789, 1e-7, 83.2 * 17]) * rng.random() for _ in range(500)]
    values += [0.1] * 10 + [1e21, -1e21, 2.5e-7, 5e-7]
    sums = set()
    for n in (1, 3, 7):
        rng.shuffle(values)
        df = spark.createDataFrame([("L1", v) for v in values] + [("L1", None)], "loan_id string, amount_in_inr double").repartition(n)
        sums.add(repayment_aggregates(df).first().total_repaid)
    assert sums == {fixed(values)}
    assert repayment_aggregates(spark.createDataFrame([("a", 0.1)] * 3, "loan_id string, amount_in_inr double")).first().total_repaid == 0.3


def test_sum_of_what_does_not_fit(spark):
    df = spark.createDataFrame(
        [("nan", float("nan")), ("nan", 1.0), ("inf", float("inf")), ("inf", 2.5), ("big", 1e300), ("big", 1.0), ("null", None), ("mixed", None), ("mixed", 2.0)],
        "k string, x double",
    )
    got = dict(rows(df.groupBy("k").agg(exact_sum(F.col("x")))))
    assert math.isnan(got["nan"]) and got["inf"] == math.inf and got["big"] == 1e300 and got["null"] is None and got["mixed"] == 2.0
