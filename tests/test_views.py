"""The loan-shaped views reproduce the fixture counts documented in FIXTURES.md §3 (sf0.01)."""

from pyspark.sql import functions as F

from lendlayer.plans.views import borrower_view, branch_view, loan_view, officer_view, repayment_view

SF = "/root/testdata/sf0.01"


def test_view_sizes_and_dirt(spark):
    branch = branch_view(spark, SF)
    assert branch.count() == 25
    out_of_limits = (F.col("employee_count") < 1) | (F.col("employee_count") > 1000) | (
        F.col("loan_volume") < 1000) | (F.col("loan_volume") > 1e9)
    assert branch.filter(out_of_limits).count() == 4

    borrower = borrower_view(spark, SF)
    assert borrower.count() == 1500
    assert borrower.filter(F.col("age").isNull()).count() == 38
    assert borrower.filter((F.col("age") < 18) | (F.col("age") > 100)).count() == 179
    assert borrower.filter(F.length("industry_code") > 6).count() == 50

    assert officer_view(spark, SF).count() == 100

    loan = loan_view(spark, SF)
    assert loan.count() == 15000
    assert loan.filter(F.col("borrower_id").isNull()).count() == 167
    assert loan.filter(F.col("due_date").isNull()).count() == 215

    repayment = repayment_view(spark, SF)
    assert repayment.count() == 63045
    assert repayment.distinct().count() == 60000
