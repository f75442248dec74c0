"""Star enrichment: left-join lookup relations onto a fact frame, then fill defaults.

Lookups are plain data (:class:`Lookup`): the key, the lookup frame, whether to add
only the columns the fact lacks, tables to skip, and defaults for unmatched rows.

Scale notes
* Lookup frames are de-duplicated on whole rows, not on the key: two names for one
  id multiply the fact row, exactly as a left join over the raw lookup would.
* No lookup is hinted to broadcast: Spark decides from size statistics and AQE from
  runtime bytes (broadcast below the threshold, sort-merge join beyond it).
* Joins run on a hash of the key beside the key itself. That costs one more exchange of
  the lookup's (already aggregated) rows, and buys that both sides of the join are plain
  shuffles, the only shape whose skewed partitions AQE splits: a loan that holds a third
  of all rows is spread over many tasks.
* Where a loan may have any number of fact rows, the repayment aggregates (one row per loan)
  are hashed, a partition at a time, and the facts stream past them unsorted: a hot loan's rows
  take no memory, however few tasks they are spread over. Lookups that may repeat a key stay
  with Spark's choice, as a hashed side can't spill.
* Fact rows with a null key can never match, but hashed on the key alone all of them
  would go to one reducer. Their hash is that of the whole row instead, which spreads
  them; exact copies of such a row are a skewed partition that AQE splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlayer.functions.names import qcol, ref
from lendlayer.functions.standardize import OFFICER_KEY

SPREAD_KEY = "__join_key"


@dataclass(frozen=True)
class Lookup:
    """A relation joined onto facts by ``key`` (left outer, USING semantics)."""

    name: str
    key: str
    frame: DataFrame
    only_missing: bool = False
    skip_for: frozenset[str] = frozenset()
    fill: Mapping[str, Any] = field(default_factory=dict)
    #: The business id behind ``key``, where that is a column derived from it.
    made_from: str | None = None
    #: Fact tables with any number of rows per key: the frame (one row per key) is hashed, the facts not sorted.
    hashed_for: frozenset[str] = frozenset()


def left_join(df: DataFrame, lookup: DataFrame, key: str, hashed: bool = False) -> DataFrame:
    """``df LEFT JOIN lookup USING (key)``: key first, then ``df``'s, then ``lookup``'s columns.

    Null keys match nothing; they join on a hash of their row, so they are spread. With ``hashed``,
    partitions of ``lookup`` are held in memory and the rows of ``df`` are not sorted.
    """
    left_type = df.schema[key].dataType
    right_type = lookup.schema[key].dataType
    if left_type != right_type:
        raise TypeError(
            f"join key {key!r} is {left_type.simpleString()} on the left and "
            f"{right_type.simpleString()} in the lookup; normalise both sides first"
        )
    left_names = [c for c in df.columns if c != key]
    right_names = [c for c in lookup.columns if c != key]
    k = ref(key)
    spread = F.when(qcol(key).isNull(), F.xxhash64(*[qcol(c) for c in df.columns])).otherwise(F.xxhash64(qcol(key)))
    facts = df.withColumn(SPREAD_KEY, spread).alias("f")
    keyed = lookup.withColumn(SPREAD_KEY, F.xxhash64(qcol(key))).alias("l")
    if hashed:
        keyed = keyed.hint("shuffle_hash")
    cond = (F.col(f"f.{SPREAD_KEY}") == F.col(f"l.{SPREAD_KEY}")) & (F.col(f"f.{k}") == F.col(f"l.{k}"))
    return facts.join(keyed, cond, "left").select(
        f"f.{k}", *[f"f.{ref(c)}" for c in left_names], *[f"l.{ref(c)}" for c in right_names]
    )


def enrich(df: DataFrame, table: str | None, lookups: Sequence[Lookup]) -> DataFrame:
    """Apply each applicable lookup in order, then fill defaults of unmatched rows.

    A lookup applies when its key is a column of ``df`` and ``table`` is not in its
    ``skip_for``. With ``only_missing`` it adds just the lookup columns ``df`` lacks,
    and is skipped when there are none.
    """
    fills: dict[str, Any] = {}
    for lk in lookups:
        fills.update(lk.fill)
        if lk.key not in df.columns or (table is not None and table in lk.skip_for):
            continue
        extra = [c for c in lk.frame.columns if c != lk.key]
        if lk.only_missing:
            extra = [c for c in extra if c not in df.columns]
            if not extra:
                continue
        else:
            clash = [c for c in extra if c in df.columns]
            if clash:
                raise ValueError(f"lookup {lk.name!r} would duplicate columns {clash}")
        df = left_join(df, lk.frame.select(*[ref(c) for c in (lk.key, *extra)]), lk.key, table in lk.hashed_for)
    present = {c: v for c, v in fills.items() if c in df.columns}
    return df.fillna(present) if present else df


def unmatched_lookups(df: DataFrame, table: str | None, lookups: Sequence[Lookup]) -> list[str]:
    """Lookups that :func:`enrich` leaves out though ``df`` has their business id, each with the reason."""
    return [
        f"join {lk.name} left out: the table has {lk.made_from} but no {lk.key}"
        for lk in lookups
        if lk.made_from in df.columns and lk.key not in df.columns and not (table is not None and table in lk.skip_for)
    ]


def borrower_lookup(borrowers: DataFrame) -> DataFrame:
    """Distinct ``(borrower_id, borrower_name)`` pairs."""
    return borrowers.select("borrower_id", F.col("full_name").alias("borrower_name")).dropDuplicates()


def officer_lookup(officers: DataFrame) -> DataFrame:
    """Distinct ``(officer_id, officer_name)`` pairs, on the integer key where the table has one."""
    key = officer_join_key(officers)
    return officers.select(key, F.col("full_name").alias("officer_name")).dropDuplicates()


def officer_join_key(df: DataFrame) -> str:
    return OFFICER_KEY if OFFICER_KEY in df.columns else "officer_id"


def branch_lookup(branches: DataFrame) -> DataFrame:
    """Distinct whole branch rows."""
    return branches.dropDuplicates()


#: Digits after the point that sums keep, and before it.
SUM_SCALE, SUM_DIGITS = 6, 22


def exact_sum(column: Column) -> Column:
    """The sum of a double column, the same for any order and partitioning of the rows.

    Values are rounded half up to ``SUM_SCALE`` digits after the point and added as
    decimals, which is exact; the sum becomes a double once. Overflow rule: a value with more than
    ``SUM_DIGITS`` digits before the point, an infinity or a NaN does not fit that grid. Such values are
    added up as doubles, as before, and their sum is added to the exact one. The exact sum of a group holds
    10**10 values of the largest size; beyond, Spark raises its overflow error (or gives null with ANSI mode off).
    """
    fits = F.abs(column) < 10.0**SUM_DIGITS
    exact = F.sum(F.when(fits, column).cast(f"decimal({SUM_DIGITS + SUM_SCALE},{SUM_SCALE})")).cast("double")
    others = F.sum(F.when(~fits, column))
    return F.when(others.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + others)


def repayment_aggregates(repayments: DataFrame) -> DataFrame:
    """Per ``loan_id``: ``repayment_count_agg`` (rows) and ``total_repaid`` (:func:`exact_sum` of ``amount_in_inr``).

    A hash aggregate with a map-side partial step: a loan holding a third of all
    rows is pre-summed in every map task, so only partial sums are shuffled.
    """
    amount = F.col("amount_in_inr")
    if repayments.schema["amount_in_inr"].dataType.typeName() in ("float", "string"):
        amount = amount.cast("double")
    return repayments.groupBy("loan_id").agg(
        F.count(F.lit(1)).alias("repayment_count_agg"),
        exact_sum(amount).alias("total_repaid"),
    )


# The self-join guard, the facts of hot loans and the defaults of unmatched repayment rows.
REPAYMENT_SOURCE_TABLE = "repayment_summary_cleaned"
REPAYMENT_TABLES = frozenset({"repayments_cleaned"})  # many rows per loan
REPAYMENT_FILL = {"repayment_count_agg": 0, "total_repaid": 0}


def standard_lookups(
    borrowers: DataFrame | None = None,
    officers: DataFrame | None = None,
    repayment_summary: DataFrame | None = None,
    branches: DataFrame | None = None,
) -> list[Lookup]:
    """Borrower -> officer -> repayment aggregates -> missing branch columns.

    Inputs are the clean (silver) tables; a missing one just leaves its join out.
    None is forced to broadcast.
    """
    out = []
    if borrowers is not None:
        out.append(Lookup("borrower", "borrower_id", borrower_lookup(borrowers)))
    if officers is not None:
        key = officer_join_key(officers)
        out.append(Lookup("officer", key, officer_lookup(officers), made_from="officer_id" if key != "officer_id" else None))
    if repayment_summary is not None:
        out.append(
            Lookup(
                "repayment",
                "loan_id",
                repayment_aggregates(repayment_summary),
                skip_for=frozenset({REPAYMENT_SOURCE_TABLE}),
                fill=REPAYMENT_FILL,
                hashed_for=REPAYMENT_TABLES,
            )
        )
    if branches is not None:
        out.append(Lookup("branch", "branch_id", branch_lookup(branches), only_missing=True))
    return out
