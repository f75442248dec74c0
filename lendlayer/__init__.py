"""lendlayer: layered loan and repayment data quality and enrichment on Spark.

The operators take and return lazy ``DataFrame`` plans (use them with
``df.transform``). Spark actions run only in ``lendlayer.sources.sinks``,
``lendlayer.plans.jobs`` and ``lendlayer.streaming``.
"""

from lendlayer.functions.names import normalize_column_names
from lendlayer.functions.standardize import normalize_officer_id, standardize, trim_strings
from lendlayer.operators.derive import derive_loan_columns
from lendlayer.operators.enrich import (
    Lookup,
    borrower_lookup,
    branch_lookup,
    enrich,
    officer_lookup,
    repayment_aggregates,
)
from lendlayer.operators.quality import (
    QualitySplit,
    key_check,
    split_critical,
    split_quality,
    tag_quality,
)

__all__ = [
    "Lookup",
    "QualitySplit",
    "borrower_lookup",
    "branch_lookup",
    "derive_loan_columns",
    "enrich",
    "key_check",
    "normalize_column_names",
    "normalize_officer_id",
    "officer_lookup",
    "repayment_aggregates",
    "split_critical",
    "split_quality",
    "standardize",
    "tag_quality",
    "trim_strings",
]
