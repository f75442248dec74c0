"""Declarative data-quality rules, a single-pass tagger, and the clean / reject split.

Rules are plain data: a reason group, the columns they need, an optional set of
tables they are scoped to, and a predicate that is TRUE when a row fails.
Groups are checked in order — missing ids, then id formats, then ranges — and a
row is rejected with the reason of the first group that fails.

The split keeps SQL three-valued logic: a group whose condition is NULL for a row
(e.g. a null ``age`` with no other rule true) neither rejects nor passes it, so by
default (``on_unknown="drop"``) such a row lands in neither output. It is tagged
``UNKNOWN`` and available from ``QualitySplit.unknown`` and the counts.

Scale notes: the tag is one projection over the scan (no extra pass per group);
clean and reject are two filters of the same tagged plan; de-duplication of clean
rows is a hash aggregate over all columns with a map-side partial step, so a row
copied a million times is collapsed before the shuffle.
"""

from __future__ import annotations

import functools
import itertools
import operator
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlayer.functions.names import has_columns, id_columns, present_columns, qcol, ref

# Outcome labels.
NULL_VALUES = "NULL_VALUES"
INVALID_ID_FORMAT = "INVALID_ID_FORMAT"
OUTLIER_OR_INVALID_RANGE = "OUTLIER_OR_INVALID_RANGE"
VALID = "VALID"
UNKNOWN = "UNKNOWN"

GROUP_REASON = {1: NULL_VALUES, 2: INVALID_ID_FORMAT, 3: OUTLIER_OR_INVALID_RANGE}
REASONS = (NULL_VALUES, INVALID_ID_FORMAT, OUTLIER_OR_INVALID_RANGE)

STATUS = "__dq_status"
REJECT_REASON = "reject_reason"
UNKNOWN_POLICIES = ("drop", "reject", "keep")


def any_true(conditions: Iterable[Column]) -> Column | None:
    """OR-fold of conditions (``None`` for an empty list)."""
    conditions = list(conditions)
    return functools.reduce(operator.or_, conditions) if conditions else None


def any_null(columns: Iterable[str]) -> Column | None:
    return any_true(qcol(c).isNull() for c in columns)


def outside(low: float, high: float) -> Callable[[Column], Column]:
    """Fails when the value is below ``low`` or above ``high`` (bounds are allowed)."""
    return lambda c: (c < low) | (c > high)


def not_positive_or_above(high: float) -> Callable[[Column], Column]:
    return lambda c: (c <= 0) | (c > high)


def longer_than(n: int) -> Callable[[Column], Column]:
    return lambda c: F.length(c) > n


def not_matching(pattern: str) -> Callable[[Column], Column]:
    return lambda c: ~c.rlike(pattern)


@dataclass(frozen=True)
class Rule:
    """One check. ``check`` gets the ``requires`` columns and returns TRUE on failure."""

    name: str
    group: int
    requires: tuple[str, ...] = ()
    check: Callable[..., Column] | None = None
    tables: frozenset[str] | None = None

    def __post_init__(self) -> None:
        if self.group not in GROUP_REASON:
            raise ValueError(f"rule {self.name!r}: group must be one of {sorted(GROUP_REASON)}, got {self.group!r}")

    def applies_to(self, table: str | None) -> bool:
        return self.tables is None or table in self.tables

    def build(self, df: DataFrame, table: str | None) -> Column | None:
        if not self.applies_to(table) or not has_columns(df, *self.requires):
            return None
        return self.check(*[qcol(c) for c in self.requires])

    def non_null_if_passed(self, df: DataFrame, table: str | None) -> list[str]:
        """Columns this rule guarantees non-null on the rows it passes."""
        return []

    @property
    def reason(self) -> str:
        return GROUP_REASON[self.group]


@dataclass(frozen=True)
class AnyNullIdRule(Rule):
    """Group 1: any identifier column (name ends with ``suffix``) is null."""

    suffix: str = "_id"

    def build(self, df: DataFrame, table: str | None) -> Column | None:
        if not self.applies_to(table):
            return None
        return any_null(id_columns(df, self.suffix))

    def non_null_if_passed(self, df: DataFrame, table: str | None) -> list[str]:
        return id_columns(df, self.suffix) if self.applies_to(table) else []


# Id patterns, numeric limits, and the tables scoped rules apply to.
BRANCH_ID_PATTERN = "^BR[0-9]{3}$"
BORROWER_ID_PATTERN = "^B[0-9]{3,6}$"
AGE_RANGE = (18, 100)
INCOME_RANGE = (1000, 1e7)
CREDIT_SCORE_RANGE = (300, 900)
INDUSTRY_CODE_MAX_LENGTH = 6
REPAYMENT_AMOUNT_RANGE = (100, 1e7)
EXCHANGE_RATE_MAX = 200
EMPLOYEE_COUNT_RANGE = (1, 1000)
LOAN_VOLUME_RANGE = (1000, 1e9)
REPAYMENT_SUMMARY = frozenset({"repayment_summary"})
BRANCH_MASTER = frozenset({"branch_master"})

DEFAULT_RULES: tuple[Rule, ...] = (
    AnyNullIdRule("null_ids", 1),
    Rule("branch_id_format", 2, ("branch_id",), not_matching(BRANCH_ID_PATTERN)),
    Rule("borrower_id_format", 2, ("borrower_id",), not_matching(BORROWER_ID_PATTERN)),
    Rule("age_range", 3, ("age",), outside(*AGE_RANGE)),
    Rule("income_range", 3, ("income",), outside(*INCOME_RANGE)),
    Rule("credit_score_range", 3, ("credit_score",), outside(*CREDIT_SCORE_RANGE)),
    Rule("industry_code_length", 3, ("industry_code",), longer_than(INDUSTRY_CODE_MAX_LENGTH)),
    Rule("amount_in_inr_range", 3, ("amount_in_inr",), outside(*REPAYMENT_AMOUNT_RANGE), REPAYMENT_SUMMARY),
    Rule("exchange_rate_range", 3, ("exchange_rate",), not_positive_or_above(EXCHANGE_RATE_MAX), REPAYMENT_SUMMARY),
    Rule("employee_count_range", 3, ("employee_count",), outside(*EMPLOYEE_COUNT_RANGE), BRANCH_MASTER),
    Rule("loan_volume_range", 3, ("loan_volume",), outside(*LOAN_VOLUME_RANGE), BRANCH_MASTER),
)

RULES_BY_NAME = {r.name: r for r in DEFAULT_RULES}

# Rule kinds usable from configuration, and the parameters each takes.
RULE_KINDS: dict[str, tuple[Callable[..., Callable[[Column], Column]], tuple[str, ...]]] = {
    "outside": (outside, ("low", "high")),
    "not_positive_or_above": (not_positive_or_above, ("high",)),
    "longer_than": (longer_than, ("max_length",)),
    "not_matching": (not_matching, ("pattern",)),
}


def rules_from_config(spec: Iterable[Mapping[str, Any]]) -> tuple[Rule, ...]:
    """Rules from plain data, so new tables or limits need no code.

    Each item: ``name``, ``group`` (1 null ids, 2 formats, 3 ranges), ``kind``
    (``any_null_ids`` or one of :data:`RULE_KINDS`), ``column`` (not for
    ``any_null_ids``), the kind's parameters, and optional ``tables``::

        [{"name": "age_range", "group": 3, "kind": "outside", "column": "age", "low": 18, "high": 100},
         {"name": "rate", "group": 3, "kind": "not_positive_or_above", "column": "exchange_rate",
          "high": 200, "tables": ["repayment_summary"]}]
    """
    rules = []
    for item in spec:
        tables = frozenset(item["tables"]) if item.get("tables") is not None else None
        kind = item["kind"]
        if kind == "any_null_ids":
            rules.append(AnyNullIdRule(item["name"], int(item["group"]), tables=tables,
                                       suffix=item.get("suffix", "_id")))
            continue
        if kind not in RULE_KINDS:
            raise ValueError(f"unknown rule kind {kind!r}; known: any_null_ids, {', '.join(RULE_KINDS)}")
        make, params = RULE_KINDS[kind]
        missing = [p for p in params if p not in item]
        if missing or "column" not in item:
            raise ValueError(f"rule {item.get('name')!r} needs column and {list(params)}")
        check = make(*[item[p] for p in params])
        rules.append(Rule(item["name"], int(item["group"]), (item["column"],), check, tables))
    return tuple(rules)


def load_rules(path: str) -> tuple[Rule, ...]:
    """:func:`rules_from_config` over a JSON file (a list of rule objects)."""
    import json

    with open(path) as fh:
        return rules_from_config(json.load(fh))


def group_conditions(
    df: DataFrame, table: str | None, rules: Sequence[Rule] = DEFAULT_RULES
) -> list[tuple[str, Column]]:
    """``[(reason, OR of the group's applicable rules)]`` in group order, empty groups left out."""
    out = []
    for group in sorted({r.group for r in rules}):
        cond = any_true(c for r in rules if r.group == group if (c := r.build(df, table)) is not None)
        if cond is not None:
            out.append((GROUP_REASON[group], cond))
    return out


def _label(digits: Sequence[int], reasons: Sequence[str], on_unknown: str) -> str:
    """The status of one combination of group outcomes (0 pass, 1 fail, 2 NULL)."""
    for digit, reason in zip(digits, reasons):
        if digit == 1 or (digit == 2 and on_unknown == "reject"):
            return reason
        if digit == 2 and on_unknown == "drop":
            return UNKNOWN
    return VALID


def status_column(groups: Sequence[tuple[str, Column]], on_unknown: str = "drop") -> Column:
    """First failing group's reason, ``UNKNOWN`` for a NULL group result, else ``VALID``.

    ``on_unknown``: ``"drop"`` tags NULL results ``UNKNOWN`` (they reach neither output),
    ``"reject"`` treats NULL as a failure of that group, ``"keep"`` treats it as a pass.

    Each group condition is evaluated exactly once per row: it becomes a digit
    (``coalesce(int(cond), 2)``: 0 pass, 1 fail, 2 NULL), the digits form one base-3
    number, and that number indexes a constant array holding the label of every
    combination (3^groups entries, at most 27). A ``CASE WHEN cond … WHEN cond IS
    NULL …`` chain would evaluate a condition twice for every row reaching it, and
    Spark does not share sub-expressions across later ``CASE`` branches — the id-format
    group's regexes would run twice per row.
    """
    if on_unknown not in UNKNOWN_POLICIES:
        raise ValueError(f"on_unknown must be one of {UNKNOWN_POLICIES}, got {on_unknown!r}")
    if not groups:
        return F.lit(VALID)
    reasons = [reason for reason, _ in groups]
    code = None
    for _, cond in groups:
        digit = F.coalesce(cond.cast("int"), F.lit(2))
        code = digit if code is None else code * 3 + digit
    labels = [_label(digits, reasons, on_unknown) for digits in itertools.product((0, 1, 2), repeat=len(groups))]
    # one constant built from SQL text: a single call, not one literal per label
    table = F.expr("array(" + ", ".join("'" + x.replace("'", "''") + "'" for x in labels) + ")")
    return F.element_at(table, code + 1)


def resolve_table(table: str | None, aliases: Mapping[str, str] | None) -> str | None:
    return (aliases or {}).get(table, table)


def tag_quality(
    df: DataFrame,
    table: str | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    on_unknown: str = "drop",
    aliases: Mapping[str, str] | None = None,
) -> DataFrame:
    """``df`` plus a ``__dq_status`` column: a reject reason, ``VALID`` or ``UNKNOWN``.

    ``table`` scopes table-specific rules; ``aliases`` maps a table name onto the
    name its rules are registered under (e.g. ``branch_master_dirty`` -> ``branch_master``).
    """
    if STATUS in df.columns or REJECT_REASON in df.columns:
        raise ValueError(f"input already has a {STATUS!r} or {REJECT_REASON!r} column")
    groups = group_conditions(df, resolve_table(table, aliases), rules)
    return df.withColumn(STATUS, status_column(groups, on_unknown))


_NEVER_USED = {"string": "", "int": 0, "bigint": 0, "double": 0.0}


def _non_nullable(column: str, dtype: str) -> Column:
    """``column`` declared non-nullable for rows already filtered on ``IS NOT NULL``.

    ``coalesce`` with a typed literal never takes the literal on such rows; it only
    tells the analyser the column cannot be null, so joins on it skip null-key salting.
    """
    if dtype not in _NEVER_USED:
        return ref(column)
    return F.coalesce(qcol(column), F.lit(_NEVER_USED[dtype]).cast(dtype)).alias(column)


@dataclass(frozen=True)
class QualitySplit:
    """The outcome of a split; every member is a lazy ``DataFrame`` over one tagged plan."""

    tagged: DataFrame
    columns: tuple[str, ...] = field(default=())
    dedup: bool = True
    non_null: tuple[str, ...] = field(default=())

    @property
    def valid_with_duplicates(self) -> DataFrame:
        """Rows passing every group, copies kept.

        The null checks the rows passed are restated as ``isNotNull`` conjuncts: a
        no-op on the rows, but it marks those columns non-nullable in the schema,
        so later joins on them need no null-key handling.
        """
        cond = functools.reduce(
            operator.and_, [qcol(c).isNotNull() for c in self.non_null], F.col(STATUS) == VALID
        )
        rows = self.tagged.filter(cond)
        if not self.non_null:
            return rows.select(*[ref(c) for c in self.columns])
        types = dict(self.tagged.dtypes)
        return rows.select(
            *[_non_nullable(c, types[c]) if c in self.non_null else ref(c) for c in self.columns]
        )

    @property
    def valid(self) -> DataFrame:
        """Rows passing every group, de-duplicated on whole rows."""
        rows = self.valid_with_duplicates
        return rows.dropDuplicates() if self.dedup else rows

    @property
    def reject(self) -> DataFrame:
        """Failing rows with ``reject_reason`` (the first failing group), copies kept."""
        return self.tagged.filter(F.col(STATUS).isin(*REASONS)).select(
            *[qcol(c) for c in self.columns], F.col(STATUS).alias(REJECT_REASON)
        )

    @property
    def unknown(self) -> DataFrame:
        """Rows whose first undecided group evaluated to NULL (in neither output)."""
        return self.tagged.filter(F.col(STATUS) == UNKNOWN).select(*[ref(c) for c in self.columns])

    def counts(self) -> DataFrame:
        """One row per outcome: ``outcome``, ``row_count``, ``distinct_rows``.

        ``outcome`` is ``valid``, ``unknown`` or a reject reason; for ``valid``,
        ``distinct_rows`` is the size of the clean output and the difference to
        ``row_count`` the copies removed.

        Rows are counted by a 128-bit digest, so a shuffled row is a digest, an outcome and
        its counts, whatever the table's width. Along go the least and the greatest of a
        third hash: where they differ, different rows met in one digest, and only those
        rows are fetched and compared whole. Nothing is fetched unless that happens (the adaptive plan drops
        the branch when no digest is listed; before 10**15 rows one is not to be expected).
        Maps and other columns that can't be hashed are compared whole.
        """
        label = F.expr(f"CASE {STATUS} WHEN '{VALID}' THEN 'valid' WHEN '{UNKNOWN}' THEN 'unknown' ELSE {STATUS} END")
        whole = [ref(c) for c in self.columns]
        outcome = "__dq_outcome"
        tagged = self.tagged.withColumn(outcome, label)
        one = F.count(F.lit(1))
        digest = row_digest(self.tagged, self.columns)
        if digest is None:
            per_row = tagged.groupBy(*whole, outcome).agg(one.alias("_n"))
            met = per_row
        else:
            low, high, check = digest
            narrow = tagged.select(outcome, low.alias("_d1"), high.alias("_d2"), check.alias("_d3"))
            per_digest = narrow.groupBy("_d1", "_d2", outcome).agg(
                one.alias("_n"), F.min("_d3").alias("_least"), F.max("_d3").alias("_most")
            )
            met = per_digest.filter("_least = _most").select(outcome, "_n")
            # the count is part of the condition so that both branches read the same shuffle
            several = per_digest.filter("_least <> _most and _n > 1").select("_d1", "_d2", outcome)
            again = tagged.select(*whole, outcome, low.alias("_d1"), high.alias("_d2"))
            again = again.join(F.broadcast(several), ["_d1", "_d2", outcome], "left_semi")  # pairs of rows in 2**128 digests
            met = met.unionByName(again.groupBy(*whole, outcome).agg(one.alias("_n")).select(outcome, "_n"))
        return met.groupBy(F.col(outcome).alias("outcome")).agg(F.sum("_n").alias("row_count"), one.alias("distinct_rows"))


# Seeds of the three hashes of a row.
DIGEST_SEEDS = (0x5BD1E995, 0x1B873593, 0x2545F491)
_HASHED = ("string", "boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz", "binary")


def row_digest(df: DataFrame, columns: Sequence[str]) -> tuple[Column, Column, Column] | None:
    """Three 64-bit hashes of a whole row, or None if a column's type has no exact hash.

    Which columns are null is hashed along: the hash function skips nulls, and without it ``(x, null)`` and
    ``(null, x)`` would be alike.
    """
    types = dict(df.dtypes)
    if any(types[c] not in _HASHED and not types[c].startswith("decimal") for c in columns):
        return None
    nulls = [
        " + ".join(f"if({ref(c)} is null, {1 << i}, 0)" for i, c in enumerate(columns[at : at + 30])) for at in range(0, len(columns), 30)
    ]
    hashed = ", ".join([*nulls, *[ref(c) for c in columns]])
    # from SQL text: one call each, not several per column
    return tuple(F.expr(f"xxhash64({', '.join([str(seed), hashed]) if hashed else seed})") for seed in DIGEST_SEEDS)


def split_quality(
    df: DataFrame,
    table: str | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    on_unknown: str = "drop",
    aliases: Mapping[str, str] | None = None,
    dedup: bool = True,
) -> QualitySplit:
    """Tag once, then expose clean / reject / unknown as filters of the tagged plan."""
    tagged = tag_quality(df, table, rules, on_unknown, aliases)
    resolved = resolve_table(table, aliases)
    non_null = {c for r in rules for c in r.non_null_if_passed(df, resolved)}
    return QualitySplit(
        tagged=tagged,
        columns=tuple(df.columns),
        dedup=dedup,
        non_null=tuple(c for c in df.columns if c in non_null),
    )


def rule_violations(
    df: DataFrame,
    rule_names: Sequence[str],
    table: str | None = None,
    rules: Sequence[Rule] = DEFAULT_RULES,
) -> DataFrame:
    """Rows for which any of the named rules is TRUE, each with the group's reason.

    Unlike the split, no precedence: this is the raw predicate of the named rules,
    useful to audit one rule. All named rules must share one group.
    """
    by_name = {r.name: r for r in rules}
    chosen = [by_name[n] for n in rule_names]
    if len({r.group for r in chosen}) != 1:
        raise ValueError("rule_violations takes rules of a single group")
    cond = any_true(c for r in chosen if (c := r.build(df, table)) is not None)
    if cond is None:
        return df.filter(F.lit(False)).withColumn(REJECT_REASON, F.lit(None).cast("string"))
    return df.filter(cond).withColumn(REJECT_REASON, F.lit(chosen[0].reason))


# The critical columns of the null splitter.
CRITICAL_COLUMNS = ("loan_id", "borrower_id", "collateral_id", "insurance_expiry")


def split_critical(
    df: DataFrame, critical: Sequence[str] = CRITICAL_COLUMNS
) -> tuple[DataFrame, DataFrame]:
    """``(valid, invalid)``: rows with no / some null among the critical columns present.

    With none of the critical columns present, every row is valid and the invalid
    side is an empty frame of the same schema (planned as an empty relation, no scan).
    """
    cond = any_null(present_columns(df, critical))
    if cond is None:
        return df, df.filter(F.lit(False))
    return df.filter(~cond), df.filter(cond)


def key_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that break uniqueness or are null: ``keys + row_count``.

    A hash aggregate with a map-side partial step, so a key held by a third of all
    rows is counted per map task first and only partial counts are shuffled.
    """
    counted = df.groupBy(*[ref(k) for k in keys]).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.filter((F.col("row_count") > 1) | any_null(keys))
