"""Derived loan columns, each added only when its input columns exist.

One projection; all arithmetic is built-in expressions (codegen, no Python).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlayer.functions.names import first_existing

# Amount column candidates in priority order, and the rate column.
AMOUNT_CANDIDATES = ("loan_amount_usd", "loan_amount", "amount", "sanction_amount")
RATE_COLUMN = "exchange_rate"


def as_of_column(as_of: dt.date | str | Column | None) -> Column:
    """The reference date: a fixed date for repeatable runs, else ``current_date()``."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of))


def derive_loan_columns(df: DataFrame, as_of: dt.date | str | Column | None = None) -> DataFrame:
    """Add the loan derivations whose inputs are present.

    * ``loan_amount_inr`` = first amount column x ``exchange_rate`` (both as double)
    * ``interest_rate_pct`` = ``interest_rate_bps / 100``
    * ``tenure_months`` = ``tenure_years * 12``
    * ``is_overdue`` = 1 if ``due_date`` is before ``as_of`` else 0 (null date -> 0);
      replaces an existing ``is_overdue`` in place.
    """
    cols = set(df.columns)
    new: dict[str, Column] = {}
    amount = first_existing(df, AMOUNT_CANDIDATES)
    if amount and RATE_COLUMN in cols:
        new["loan_amount_inr"] = F.col(amount).cast("double") * F.col(RATE_COLUMN).cast("double")
    if "interest_rate_bps" in cols:
        new["interest_rate_pct"] = F.col("interest_rate_bps") / 100
    if "tenure_years" in cols:
        new["tenure_months"] = F.col("tenure_years") * 12
    if "due_date" in cols:
        new["is_overdue"] = F.when(F.col("due_date") < as_of_column(as_of), 1).otherwise(0)
    return df.withColumns(new) if new else df


def stamp_processing_date(df: DataFrame, as_of: dt.date | str | Column | None = None) -> DataFrame:
    """Add ``processing_date`` (the load date)."""
    return df.withColumn("processing_date", as_of_column(as_of))
