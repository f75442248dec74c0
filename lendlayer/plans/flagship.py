"""The flagship plan: loans to gold in one lazy plan.

standardise -> data-quality split -> de-duplicate (silver, per table) ->
left-join borrower names, per-loan repayment aggregates and missing branch
attributes -> zero-fill unmatched aggregates -> derive loan columns -> stamp the
load date (derivations after the joins, so they are not shuffled).

Shuffles at scale (fact = loans, ~orders; repayments ~lineitem):
* loans: whole-row de-duplication (partial + final hash aggregate), then one
  exchange per shuffled join key (borrower_id, loan_id);
* repayments: whole-row de-duplication, then the per-loan aggregate (partial
  aggregate before the shuffle); the aggregate and the loans meet on loan_id;
* borrowers: de-duplicated pairs, shuffled on borrower_id (AQE may broadcast them
  when their runtime size is under the threshold);
* branches: a small dimension, broadcast after its row count is checked.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from lendlayer.functions.standardize import normalize_officer_id, standardize
from lendlayer.operators.derive import derive_loan_columns, stamp_processing_date
from lendlayer.operators.enrich import enrich, standard_lookups
from lendlayer.operators.quality import split_quality
from lendlayer.plans.views import borrower_view, branch_view, loan_view, officer_view, repayment_view

# Fixed reference date for repeatable results (the load date and the overdue cut-off).
AS_OF = dt.date(2003, 6, 30)

GOLD_LOAN_COLUMNS = (
    "loan_id",
    "borrower_id",
    "branch_id",
    "loan_amount",
    "exchange_rate",
    "interest_rate_bps",
    "tenure_years",
    "issue_date",
    "due_date",
    "loan_amount_inr",
    "interest_rate_pct",
    "tenure_months",
    "is_overdue",
    "borrower_name",
    "repayment_count_agg",
    "total_repaid",
    "branch_name",
    "region",
    "employee_count",
    "loan_volume",
    "processing_date",
)


def silver(df: DataFrame, table: str) -> DataFrame:
    """Bronze frame -> clean rows: standardise, officer ids to int, split, de-duplicate."""
    return split_quality(normalize_officer_id(standardize(df)), table).valid


def gold_loans(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF) -> DataFrame:
    loans = silver(loan_view(spark, sf_dir), "loan_history")
    lookups = standard_lookups(
        borrowers=silver(borrower_view(spark, sf_dir), "borrower_profile"),
        repayment_summary=silver(repayment_view(spark, sf_dir), "repayment_summary"),
        branches=silver(branch_view(spark, sf_dir), "branch_master"),
    )
    # Derived columns depend only on loan columns, so they are computed after the
    # joins: the same rows, but four fewer columns carried through both join shuffles.
    gold = derive_loan_columns(enrich(loans, "loan_history_cleaned", lookups), as_of)
    return stamp_processing_date(gold, as_of).select(*GOLD_LOAN_COLUMNS)


def gold_repayments(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF) -> DataFrame:
    """Repayment rows to gold: officer names (ids repaired to int on both sides) and the
    per-loan aggregates of the clean repayment summary; no borrower or branch columns
    exist on this fact, so those joins are left out at plan time."""
    facts = silver(repayment_view(spark, sf_dir), "repayments")
    lookups = standard_lookups(
        officers=silver(officer_view(spark, sf_dir), "loan_officers"),
        repayment_summary=silver(repayment_view(spark, sf_dir), "repayment_summary"),
        branches=silver(branch_view(spark, sf_dir), "branch_master"),
    )
    gold = enrich(derive_loan_columns(facts, as_of), "repayments_cleaned", lookups)
    return stamp_processing_date(gold, as_of)


def gold_borrowers(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF) -> DataFrame:
    """Borrowers to gold: their own names as the borrower lookup, plus branch attributes."""
    borrowers = silver(borrower_view(spark, sf_dir), "borrower_profile")
    lookups = standard_lookups(
        borrowers=borrowers,
        branches=silver(branch_view(spark, sf_dir), "branch_master"),
    )
    gold = enrich(derive_loan_columns(borrowers, as_of), "borrower_profile_cleaned", lookups)
    return stamp_processing_date(gold, as_of)
