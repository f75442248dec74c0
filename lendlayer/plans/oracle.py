"""Reference SQL for every catalogue query, runnable by DuckDB over the raw test tables.

Written independently of the DataFrame code: the loan-shaped views are CTEs with the
definitions from FIXTURES.md §3, and the quality split is a ``CASE`` in group order
with explicit NULL handling (three-valued logic). Regexes avoid ``$``-before-newline
inputs (RE2 and Java differ there; the data has none).
"""

from __future__ import annotations

VIEW_SQL = {
    "branch": """
SELECT concat('BR', CAST(100 + n_nationkey AS STRING)) AS branch_id,
       n_name AS branch_name,
       r_name AS region,
       CAST(CASE WHEN n_nationkey = 3 THEN 0 WHEN n_nationkey = 4 THEN 1500
                 ELSE 10 + n_nationkey END AS INT) AS employee_count,
       CAST(CASE WHEN n_nationkey = 5 THEN 500 WHEN n_nationkey = 6 THEN 2000000000
                 ELSE 1000000 * (1 + n_nationkey) END AS DOUBLE) AS loan_volume
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "borrower": """
SELECT CASE WHEN c_custkey % 50 = 7 THEN NULL
            WHEN c_custkey % 50 = 11 THEN concat('X', CAST(c_custkey AS STRING))
            ELSE concat('B', lpad(CAST(c_custkey AS STRING), 6, '0')) END AS borrower_id,
       concat('  ', c_name, ' ') AS full_name,
       CASE WHEN c_custkey % 60 = 13 THEN concat('BR', CAST(c_nationkey AS STRING), 'Z')
            ELSE concat('BR', CAST(100 + c_nationkey AS STRING)) END AS branch_id,
       CAST(CASE WHEN c_custkey % 40 = 3 THEN NULL ELSE 15 + c_custkey % 95 END AS INT) AS age,
       CAST(c_acctbal * 1100 AS DOUBLE) AS income,
       CAST(250 + (c_custkey * 7) % 700 AS INT) AS credit_score,
       CASE WHEN c_custkey % 30 = 0 THEN '1234567' ELSE '6201' END AS industry_code
FROM customer""",
    "officer": """
SELECT concat('O', CAST(100 + s_suppkey AS STRING)) AS officer_id,
       s_name AS full_name,
       concat('BR', CAST(100 + s_nationkey AS STRING)) AS branch_id
FROM supplier""",
    "loan": """
SELECT concat('L', CAST(o_orderkey AS STRING)) AS loan_id,
       CASE WHEN o_orderkey % 90 = 1 THEN NULL
            ELSE concat('B', lpad(CAST(o_custkey AS STRING), 6, '0')) END AS borrower_id,
       concat('BR', CAST(100 + o_custkey % 30 AS STRING)) AS branch_id,
       o_totalprice AS loan_amount,
       CAST(CASE WHEN o_orderkey % 2 = 0 THEN 83.2 ELSE 1 END AS DOUBLE) AS exchange_rate,
       CAST(500 + o_orderkey % 400 AS INT) AS interest_rate_bps,
       CAST(1 + o_orderkey % 10 AS INT) AS tenure_years,
       CAST(o_orderdate AS DATE) AS issue_date,
       CASE WHEN o_orderkey % 70 = 2 THEN NULL
            ELSE CAST(o_orderdate AS DATE) + CAST(365 * (1 + o_orderkey % 10) AS INT) END AS due_date
FROM orders""",
    "repayment": """
SELECT concat('L', CAST(l_orderkey AS STRING)) AS loan_id,
       concat('O', CAST(100 + l_suppkey AS STRING)) AS officer_id,
       l_linenumber AS emi_number,
       CAST(l_shipdate AS DATE) AS payment_date,
       CAST(CASE WHEN l_linenumber = 7 THEN 250 WHEN l_linenumber = 6 THEN 0
                 WHEN l_linenumber % 2 = 0 THEN 120 ELSE 1 END AS DOUBLE) AS exchange_rate,
       CAST(l_extendedprice * CASE WHEN l_linenumber % 2 = 0 THEN 120 ELSE 1 END AS DOUBLE) AS amount_in_inr
FROM lineitem
UNION ALL
SELECT concat('L', CAST(l_orderkey AS STRING)), concat('O', CAST(100 + l_suppkey AS STRING)), l_linenumber,
       CAST(l_shipdate AS DATE),
       CAST(CASE WHEN l_linenumber = 7 THEN 250 WHEN l_linenumber = 6 THEN 0
                 WHEN l_linenumber % 2 = 0 THEN 120 ELSE 1 END AS DOUBLE),
       CAST(l_extendedprice * CASE WHEN l_linenumber % 2 = 0 THEN 120 ELSE 1 END AS DOUBLE)
FROM lineitem WHERE l_orderkey % 20 = 0""",
}

AS_OF_SQL = "DATE '2003-06-30'"


def t(c: str) -> str:
    return f"trim({c}, ' ') AS {c}"


# Standardised (trimmed) views; officer ids repaired where noted.
STD_SQL = {
    "sb": "SELECT "
    + ", ".join([t("borrower_id"), t("full_name"), t("branch_id"), "age", "income", "credit_score", t("industry_code")])
    + " FROM borrower",
    "sr": "SELECT "
    + ", ".join([t("loan_id"), t("officer_id"), "emi_number", "payment_date", "exchange_rate", "amount_in_inr"])
    + " FROM repayment",
    "srn": "SELECT trim(loan_id, ' ') AS loan_id, "
    "TRY_CAST(replace(trim(officer_id, ' '), 'O', '0') AS INTEGER) AS officer_id, "
    "emi_number, payment_date, exchange_rate, amount_in_inr FROM repayment",
    "sbr": "SELECT "
    + ", ".join([t("branch_id"), t("branch_name"), t("region"), "employee_count", "loan_volume"])
    + " FROM branch",
    "sl": "SELECT "
    + ", ".join(
        [
            t("loan_id"),
            t("borrower_id"),
            t("branch_id"),
            "loan_amount",
            "exchange_rate",
            "interest_rate_bps",
            "tenure_years",
            "issue_date",
            "due_date",
        ]
    )
    + " FROM loan",
}

BORROWER_COLS = "borrower_id, full_name, branch_id, age, income, credit_score, industry_code"
REPAYMENT_COLS = "loan_id, officer_id, emi_number, payment_date, exchange_rate, amount_in_inr"
BRANCH_COLS = "branch_id, branch_name, region, employee_count, loan_volume"
LOAN_COLS = (
    "loan_id, borrower_id, branch_id, loan_amount, exchange_rate, interest_rate_bps, "
    "tenure_years, issue_date, due_date"
)

FMT_BRANCH = "NOT regexp_matches(branch_id, '^BR[0-9]{3}$')"
FMT_BORROWER = "NOT regexp_matches(borrower_id, '^B[0-9]{3,6}$')"
R_AGE = "(age < 18 OR age > 100)"
R_INCOME = "(income < 1000 OR income > 10000000.0)"
R_SCORE = "(credit_score < 300 OR credit_score > 900)"
R_INDUSTRY = "(length(industry_code) > 6)"
R_AMOUNT = "(amount_in_inr < 100 OR amount_in_inr > 10000000.0)"
R_RATE = "(exchange_rate <= 0 OR exchange_rate > 200)"
R_EMPLOYEES = "(employee_count < 1 OR employee_count > 1000)"
R_VOLUME = "(loan_volume < 1000 OR loan_volume > 1000000000.0)"


def status_case(null_cols: list[str], fmt: list[str], rng: list[str]) -> str:
    parts = []
    for reason, conds in (
        ("NULL_VALUES", [f"{c} IS NULL" for c in null_cols]),
        ("INVALID_ID_FORMAT", fmt),
        ("OUTLIER_OR_INVALID_RANGE", rng),
    ):
        if conds:
            cond = " OR ".join(conds)
            parts.append(f"WHEN ({cond}) THEN '{reason}' WHEN ({cond}) IS NULL THEN 'UNKNOWN'")
    return "CASE " + " ".join(parts) + " ELSE 'VALID' END"


TAG_SQL = {
    "tb": f"SELECT *, {status_case(['borrower_id', 'branch_id'], [FMT_BRANCH, FMT_BORROWER], [R_AGE, R_INCOME, R_SCORE, R_INDUSTRY])} AS dq_status FROM sb",
    "tr": f"SELECT *, {status_case(['loan_id', 'officer_id'], [], [R_AMOUNT, R_RATE])} AS dq_status FROM sr",
    "trn": f"SELECT *, {status_case(['loan_id', 'officer_id'], [], [R_AMOUNT, R_RATE])} AS dq_status FROM srn",
    "tbr": f"SELECT *, {status_case(['branch_id'], [FMT_BRANCH], [R_EMPLOYEES, R_VOLUME])} AS dq_status FROM sbr",
    "tl": f"SELECT *, {status_case(['loan_id', 'borrower_id', 'branch_id'], [FMT_BRANCH, FMT_BORROWER], [])} AS dq_status FROM sl",
}

# Each helper CTE and what it reads.
DEPENDS = {
    "sb": ["borrower"],
    "sr": ["repayment"],
    "srn": ["repayment"],
    "sbr": ["branch"],
    "sl": ["loan"],
    "tb": ["sb"],
    "tr": ["sr"],
    "trn": ["srn"],
    "tbr": ["sbr"],
    "tl": ["sl"],
}
CTE_SQL = {**VIEW_SQL, **STD_SQL, **TAG_SQL}
REASONS_SQL = "('NULL_VALUES', 'INVALID_ID_FORMAT', 'OUTLIER_OR_INVALID_RANGE')"


def q(body: str, *ctes: str, extra: tuple[tuple[str, str], ...] = ()) -> str:
    """``WITH`` the named CTEs (and what they depend on, in order), then ``body``."""
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in DEPENDS.get(name, []):
            visit(dep)
        if name not in order:
            order.append(name)

    for name in ctes:
        visit(name)
    parts = [f"{n} AS ({CTE_SQL[n]})" for n in order] + [f"{n} AS ({s})" for n, s in extra]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def violations(cond: str, reason: str) -> str:
    return q(f"SELECT *, '{reason}' AS reject_reason FROM sb WHERE {cond}", "sb")


OFFICER_INT = "TRY_CAST(replace(officer_id, 'O', '0') AS INTEGER)"
OFFICER_GUARDED = (
    "TRY_CAST(CASE WHEN regexp_matches(officer_id, '^O[0-9]+$') "
    "THEN regexp_replace(officer_id, '^O', '0') ELSE officer_id END AS INTEGER)"
)
# Exact decimal sums, turned into doubles once (by way of text, which rounds correctly).
EXACT_SUM = "CAST(CAST(sum(CAST(amount_in_inr AS DECIMAL(28, 6))){over} AS VARCHAR) AS DOUBLE)"
REPAYMENT_AGG = (
    f"SELECT loan_id, count(*) AS repayment_count_agg, {EXACT_SUM.format(over='')} AS total_repaid "
    "FROM {src} GROUP BY loan_id"
)

GOLD_LOANS = q(
    f"""
SELECT vl.loan_id, vl.borrower_id, vl.branch_id, vl.loan_amount, vl.exchange_rate,
       vl.interest_rate_bps, vl.tenure_years, vl.issue_date, vl.due_date,
       CAST(vl.loan_amount AS DOUBLE) * CAST(vl.exchange_rate AS DOUBLE) AS loan_amount_inr,
       CAST(vl.interest_rate_bps AS DOUBLE) / 100 AS interest_rate_pct,
       vl.tenure_years * 12 AS tenure_months,
       CASE WHEN vl.due_date < {AS_OF_SQL} THEN 1 ELSE 0 END AS is_overdue,
       bl.borrower_name,
       coalesce(ra.repayment_count_agg, 0) AS repayment_count_agg,
       coalesce(ra.total_repaid, 0) AS total_repaid,
       br.branch_name, br.region, br.employee_count, br.loan_volume,
       {AS_OF_SQL} AS processing_date
FROM vl
LEFT JOIN bl ON vl.borrower_id = bl.borrower_id
LEFT JOIN ra ON vl.loan_id = ra.loan_id
LEFT JOIN br ON vl.branch_id = br.branch_id""",
    "tl",
    "tb",
    "trn",
    "tbr",
    extra=(
        ("vl", f"SELECT DISTINCT {LOAN_COLS} FROM tl WHERE dq_status = 'VALID'"),
        ("vb", f"SELECT DISTINCT {BORROWER_COLS} FROM tb WHERE dq_status = 'VALID'"),
        ("bl", "SELECT DISTINCT borrower_id, full_name AS borrower_name FROM vb"),
        ("vr", f"SELECT DISTINCT {REPAYMENT_COLS} FROM trn WHERE dq_status = 'VALID'"),
        ("ra", REPAYMENT_AGG.format(src="vr")),
        ("br", f"SELECT DISTINCT {BRANCH_COLS} FROM tbr WHERE dq_status = 'VALID'"),
    ),
)

ORACLE: dict[str, str] = {
    "standardize_names_trim": q("SELECT * FROM sb", "sb"),
    "officer_id_normalize": q(f"SELECT {OFFICER_INT} AS officer_id, full_name, branch_id FROM officer", "officer"),
    "officer_id_normalize_guarded": q(
        f"SELECT {OFFICER_GUARDED} AS officer_id, full_name, branch_id FROM officer", "officer"
    ),
    "dq_null_ids": violations("borrower_id IS NULL OR branch_id IS NULL", "NULL_VALUES"),
    "dq_id_format": violations(f"{FMT_BRANCH} OR {FMT_BORROWER}", "INVALID_ID_FORMAT"),
    "dq_range_age": violations(R_AGE, "OUTLIER_OR_INVALID_RANGE"),
    "dq_range_income": violations(R_INCOME, "OUTLIER_OR_INVALID_RANGE"),
    "dq_range_credit_score": violations(R_SCORE, "OUTLIER_OR_INVALID_RANGE"),
    "dq_range_industry_code": violations(R_INDUSTRY, "OUTLIER_OR_INVALID_RANGE"),
    "dq_repayment_ranges": q(
        f"SELECT {REPAYMENT_COLS}, dq_status AS reject_reason FROM tr WHERE dq_status IN {REASONS_SQL}", "tr"
    ),
    "dq_branch_ranges": q(
        f"SELECT {BRANCH_COLS}, dq_status AS reject_reason FROM tbr WHERE dq_status IN {REASONS_SQL}", "tbr"
    ),
    "dq_reject_all_reasons": q(
        f"SELECT {BORROWER_COLS}, dq_status AS reject_reason FROM tb WHERE dq_status IN {REASONS_SQL}", "tb"
    ),
    "dq_valid": q(f"SELECT DISTINCT {BORROWER_COLS} FROM tb WHERE dq_status = 'VALID'", "tb"),
    "dq_unknown_rows": q(f"SELECT {BORROWER_COLS} FROM tb WHERE dq_status = 'UNKNOWN'", "tb"),
    "dq_summary": q(
        """
SELECT CASE dq_status WHEN 'VALID' THEN 'valid' WHEN 'UNKNOWN' THEN 'unknown' ELSE dq_status END AS outcome,
       CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_rows
FROM per_row GROUP BY 1""",
        "tb",
        extra=(("per_row", f"SELECT dq_status, count(*) AS n FROM tb GROUP BY {BORROWER_COLS}, dq_status"),),
    ),
    "split_critical_valid": q("SELECT * FROM loan WHERE NOT (loan_id IS NULL OR borrower_id IS NULL)", "loan"),
    "split_critical_invalid": q("SELECT * FROM loan WHERE loan_id IS NULL OR borrower_id IS NULL", "loan"),
    "split_critical_none": q("SELECT * FROM branch", "branch"),
    "loan_amount_inr": q(
        "SELECT loan_id, loan_amount, exchange_rate, "
        "CAST(loan_amount AS DOUBLE) * CAST(exchange_rate AS DOUBLE) AS loan_amount_inr FROM loan",
        "loan",
    ),
    "interest_tenure": q(
        "SELECT loan_id, interest_rate_bps, tenure_years, CAST(interest_rate_bps AS DOUBLE) / 100 AS interest_rate_pct, "
        "tenure_years * 12 AS tenure_months FROM loan",
        "loan",
    ),
    "overdue_flag": q(
        f"SELECT loan_id, due_date, CASE WHEN due_date < {AS_OF_SQL} THEN 1 ELSE 0 END AS is_overdue FROM loan",
        "loan",
    ),
    "borrower_lookup": q("SELECT DISTINCT borrower_id, full_name AS borrower_name FROM sb", "sb"),
    "officer_lookup": q(f"SELECT DISTINCT {OFFICER_INT} AS officer_id, full_name AS officer_name FROM officer", "officer"),
    "branch_lookup": q("SELECT DISTINCT * FROM branch", "branch"),
    "repayment_by_loan": q(
        REPAYMENT_AGG.format(src="repayment"),
        "repayment",
    ),
    "enrich_borrower": q(
        "SELECT * FROM loan LEFT JOIN (SELECT DISTINCT borrower_id, full_name AS borrower_name FROM sb) b "
        "USING (borrower_id)",
        "loan",
        "sb",
    ),
    "enrich_officer": q(
        "SELECT * FROM rn LEFT JOIN ol USING (officer_id)",
        "repayment",
        "officer",
        extra=(
            (
                "rn",
                f"SELECT loan_id, {OFFICER_INT} AS officer_id, emi_number, payment_date, exchange_rate, "
                "amount_in_inr FROM repayment",
            ),
            ("ol", f"SELECT DISTINCT {OFFICER_INT} AS officer_id, full_name AS officer_name FROM officer"),
        ),
    ),
    "enrich_repayment": q(
        f"SELECT {LOAN_COLS}, coalesce(a.repayment_count_agg, 0) AS repayment_count_agg, "
        "coalesce(a.total_repaid, 0) AS total_repaid FROM loan LEFT JOIN a USING (loan_id)",
        "loan",
        "repayment",
        extra=(("a", REPAYMENT_AGG.format(src="repayment")),),
    ),
    "enrich_branch": q(
        f"SELECT * FROM loan LEFT JOIN (SELECT DISTINCT {BRANCH_COLS} FROM branch) b USING (branch_id)",
        "loan",
        "branch",
    ),
    "enrich_skip_self": q("SELECT * FROM repayment", "repayment"),
    "gold_loans": GOLD_LOANS,
    "key_check": q(
        "SELECT loan_id, emi_number, count(*) AS row_count FROM repayment GROUP BY loan_id, emi_number "
        "HAVING count(*) > 1 OR loan_id IS NULL OR emi_number IS NULL",
        "repayment",
    ),
}

# --- round trips, seeds, in-place repair, and the run report -------------------------

CTE_SQL["sof"] = (
    "SELECT TRY_CAST(replace(trim(officer_id, ' '), 'O', '0') AS INTEGER) AS officer_id, "
    "trim(full_name, ' ') AS full_name, trim(branch_id, ' ') AS branch_id FROM officer"
)
CTE_SQL["tof"] = f"SELECT *, {status_case(['officer_id', 'branch_id'], [FMT_BRANCH], [])} AS dq_status FROM sof"
DEPENDS.update({"sof": ["officer"], "tof": ["sof"]})
OFFICER_COLS = "officer_id, full_name, branch_id"
CTE_SQL.update(
    {
        "vl": f"SELECT DISTINCT {LOAN_COLS} FROM tl WHERE dq_status = 'VALID'",
        "vb": f"SELECT DISTINCT {BORROWER_COLS} FROM tb WHERE dq_status = 'VALID'",
        "vr": f"SELECT DISTINCT {REPAYMENT_COLS} FROM trn WHERE dq_status = 'VALID'",
        "vbr": f"SELECT DISTINCT {BRANCH_COLS} FROM tbr WHERE dq_status = 'VALID'",
        "vo": f"SELECT DISTINCT {OFFICER_COLS} FROM tof WHERE dq_status = 'VALID'",
        "ol2": "SELECT DISTINCT officer_id, full_name AS officer_name FROM vo",
        "bl2": "SELECT DISTINCT borrower_id, full_name AS borrower_name FROM vb",
    }
)
DEPENDS.update({"vl": ["tl"], "vb": ["tb"], "vr": ["trn"], "vbr": ["tbr"], "vo": ["tof"], "ol2": ["vo"], "bl2": ["vb"]})


def silver_row(table: str, tagged: str, cols: str) -> str:
    distinct = f"(SELECT count(*) FROM (SELECT DISTINCT {cols} FROM {tagged} WHERE dq_status = 'VALID'))"
    return (
        f"SELECT 'silver' AS layer, '{table}' AS table_name, 'ok' AS status, count(*) AS rows_in, "
        f"{distinct} AS rows_valid, "
        f"count(*) FILTER (WHERE dq_status = 'VALID') - {distinct} AS rows_duplicate, "
        f"count(*) FILTER (WHERE dq_status IN {REASONS_SQL}) AS rows_reject, "
        f"count(*) FILTER (WHERE dq_status = 'UNKNOWN') AS rows_unknown, "
        f"{distinct} AS rows_out FROM {tagged}"
    )


def gold_row(table: str, rows_in: str, rows_out: str) -> str:
    nulls = ", ".join(f"CAST(NULL AS BIGINT) AS {c}" for c in ("rows_valid", "rows_duplicate", "rows_reject", "rows_unknown"))
    return (
        f"SELECT 'gold' AS layer, '{table}' AS table_name, 'ok' AS status, (SELECT count(*) FROM {rows_in}) AS rows_in, "
        f"{nulls}, (SELECT count(*) FROM {rows_out}) AS rows_out"
    )


BRANCH_MISSING = "(SELECT DISTINCT branch_id, branch_name, region, employee_count, loan_volume FROM vbr)"
RUN_REPORT = q(
    "\nUNION ALL\n".join(
        [
            "SELECT 'bronze' AS layer, 'loan_officers' AS table_name, 'ok' AS status, count(*) AS rows_in, "
            "CAST(NULL AS BIGINT) AS rows_valid, CAST(NULL AS BIGINT) AS rows_duplicate, "
            "CAST(NULL AS BIGINT) AS rows_reject, CAST(NULL AS BIGINT) AS rows_unknown, count(*) AS rows_out FROM officer",
            silver_row("borrower_profile", "tb", BORROWER_COLS),
            silver_row("loan_history", "tl", LOAN_COLS),
            silver_row("repayment_summary", "trn", REPAYMENT_COLS),
            silver_row("loan_officers", "tof", OFFICER_COLS),
            silver_row("branch_master_dirty", "tbr", BRANCH_COLS),
            gold_row(
                "borrower_profile_cleaned",
                "vb",
                f"(SELECT * FROM vb LEFT JOIN bl2 USING (borrower_id) LEFT JOIN {BRANCH_MISSING} USING (branch_id))",
            ),
            gold_row("loan_history_cleaned", "vl", f"({GOLD_LOANS})"),
            gold_row("repayment_summary_cleaned", "vr", "(SELECT * FROM vr LEFT JOIN ol2 USING (officer_id))"),
            gold_row(
                "loan_officers_cleaned",
                "vo",
                f"(SELECT * FROM vo LEFT JOIN ol2 USING (officer_id) LEFT JOIN {BRANCH_MISSING} USING (branch_id))",
            ),
            gold_row("branch_master_dirty_cleaned", "vbr", "vbr"),
        ]
    ),
    "officer",
    "vb",
    "bl2",
    "vl",
    "vr",
    "vbr",
    "vo",
    "ol2",
)

ORACLE.update(
    {
        "csv_roundtrip": q("SELECT * FROM borrower", "borrower"),
        "json_roundtrip": q("SELECT * FROM loan", "loan"),
        "seed_insert": q("SELECT *, CAST(NULL AS VARCHAR) AS remarks FROM repayment", "repayment"),
        "overwrite_self": q(f"SELECT {OFFICER_INT} AS officer_id, full_name, branch_id FROM officer", "officer"),
        "run_report": RUN_REPORT,
        "stream_dq_valid": ORACLE["dq_valid"],
        "stream_dq_reject": q(
            f"SELECT {BORROWER_COLS}, dq_status AS reject_reason FROM tb, (VALUES (1), (2)) AS copies(n) "
            f"WHERE dq_status IN {REASONS_SQL}",
            "tb",
        ),
    }
)

CTE_SQL["trr"] = f"SELECT *, {status_case(['loan_id', 'officer_id'], [], [])} AS dq_status FROM srn"
CTE_SQL["vrr"] = f"SELECT DISTINCT {REPAYMENT_COLS} FROM trr WHERE dq_status = 'VALID'"
CTE_SQL["ra2"] = REPAYMENT_AGG.format(src="vr")
DEPENDS.update({"trr": ["srn"], "vrr": ["trr"], "ra2": ["vr"]})

ORACLE.update(
    {
        "gold_repayments": q(
            f"SELECT {REPAYMENT_COLS}, officer_name, coalesce(ra2.repayment_count_agg, 0) AS repayment_count_agg, "
            f"coalesce(ra2.total_repaid, 0) AS total_repaid, {AS_OF_SQL} AS processing_date "
            "FROM vrr LEFT JOIN ol2 USING (officer_id) LEFT JOIN ra2 USING (loan_id)",
            "vrr",
            "ol2",
            "ra2",
        ),
        "gold_borrowers": q(
            f"SELECT *, {AS_OF_SQL} AS processing_date FROM vb LEFT JOIN bl2 USING (borrower_id) "
            f"LEFT JOIN {BRANCH_MISSING} b USING (branch_id)",
            "vb",
            "bl2",
            "vbr",
        ),
    }
)

CTE_SQL["sof2"] = "SELECT " + ", ".join([t("officer_id"), t("full_name"), t("branch_id")]) + " FROM officer"
CTE_SQL["tof2"] = f"SELECT *, {status_case(['officer_id', 'branch_id'], [FMT_BRANCH], [])} AS dq_status FROM sof2"
DEPENDS.update({"sof2": ["officer"], "tof2": ["sof2"]})


def summary_rows(table: str, tagged: str, cols: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, "
        "CASE dq_status WHEN 'VALID' THEN 'valid' WHEN 'UNKNOWN' THEN 'unknown' ELSE dq_status END AS outcome, "
        "CAST(sum(n) AS BIGINT) AS row_count, count(*) AS distinct_rows "
        f"FROM (SELECT dq_status, count(*) AS n FROM {tagged} GROUP BY {cols}, dq_status) GROUP BY 1, 2"
    )


ORACLE["dq_summary_all"] = q(
    "\nUNION ALL\n".join(
        [
            summary_rows("borrower_profile", "tb", BORROWER_COLS),
            summary_rows("loan_history", "tl", LOAN_COLS),
            summary_rows("repayment_summary", "tr", REPAYMENT_COLS),
            summary_rows("loan_officers", "tof2", OFFICER_COLS),
            summary_rows("branch_master", "tbr", BRANCH_COLS),
        ]
    ),
    "tb",
    "tl",
    "tr",
    "tof2",
    "tbr",
)

_UNPARSED_OFFICERS = (
    "SELECT CASE WHEN s_suppkey % 10 = 3 THEN concat('EMP', CAST(s_suppkey AS STRING)) "
    "WHEN s_suppkey % 10 = 7 THEN concat('O99999', CAST(10000 + s_suppkey AS STRING)) "
    "ELSE concat('O', CAST(100 + s_suppkey AS STRING)) END AS officer_id, s_name AS full_name, "
    "concat('BR', CAST(100 + s_nationkey AS STRING)) AS branch_id FROM supplier"
)
_HOT_LOAN = (
    "SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'L0' ELSE concat('L', CAST(l_orderkey AS STRING)) END AS loan_id, "
    "l_linenumber AS emi_number, CAST(l_extendedprice AS DOUBLE) AS amount_in_inr FROM lineitem"
)

ORACLE.update(
    {
        "dq_officer_ids": f"SELECT DISTINCT *, {OFFICER_INT} AS officer_key FROM ({_UNPARSED_OFFICERS})",
        "repair_report": (
            "SELECT 'loan_officers' AS table_name, 'failed' AS status, count(*) AS rows_in, "
            f"count(*) FILTER (WHERE {OFFICER_INT} IS NULL) AS rows_unknown, count(*) AS rows_out FROM ({_UNPARSED_OFFICERS})"
        ),
        "positional_insert": q("SELECT *, 'seeded' AS remarks FROM repayment", "repayment"),
        "seed_job": ORACLE["seed_insert"],
        "split_critical_none_invalid": q("SELECT * FROM branch WHERE false", "branch"),
        "null_split_job": q(
            "SELECT 'loan_history' AS table_name, 'ok' AS status, count(*) AS rows_in, "
            "count(borrower_id) AS rows_valid, count(*) - count(borrower_id) AS rows_reject FROM loan "
            "UNION ALL SELECT 'branch_master_dirty', 'ok', count(*), count(*), 0 FROM branch",
            "loan",
            "branch",
        ),
        "gold_hot_loan": (
            f"WITH f AS ({_HOT_LOAN}) SELECT *, count(*) OVER (PARTITION BY loan_id) AS repayment_count_agg, "
            f"{EXACT_SUM.format(over=' OVER (PARTITION BY loan_id)')} AS total_repaid FROM f"
        ),
        "amount_candidates": q(
            "SELECT loan_id, loan_amount AS sanction_amount, loan_amount * 2 AS loan_amount_usd, exchange_rate, due_date, "
            f"CASE WHEN due_date < {AS_OF_SQL} THEN 1 ELSE 0 END AS is_overdue, "
            "CAST(loan_amount * 2 AS DOUBLE) * exchange_rate AS loan_amount_inr FROM loan",
            "loan",
        ),
    }
)


def _rejects(table: str, tagged: str, cols: str) -> str:
    key = f"TRY_CAST(replace(officer_id, 'O', '0') AS INTEGER) AS officer_key, " if "officer_id" in cols else ""
    return (
        f"SELECT '{table}' AS table_name, {cols}, {key}dq_status AS reject_reason, {AS_OF_SQL} AS processing_date "
        f"FROM {tagged} WHERE dq_status IN {REASONS_SQL}"
    )


_RUN_TABLES = (
    ("borrower_profile", "tb", BORROWER_COLS),
    ("loan_history", "tl", LOAN_COLS),
    ("repayment_summary", "tr", REPAYMENT_COLS),
    ("loan_officers", "tof2", OFFICER_COLS),
    ("branch_master_dirty", "tbr", BRANCH_COLS),
)
_TAGGED = tuple(tagged for _, tagged, _ in _RUN_TABLES)
_NO_COUNTS = ", ".join(f"CAST(NULL AS BIGINT) AS {c}" for c in ("rows_in", "rows_valid", "rows_duplicate", "rows_reject", "rows_unknown", "rows_out"))


def _failure(layer: str, table: str, status: str) -> str:
    return f"SELECT '{layer}' AS layer, '{table}' AS table_name, '{status}' AS status, {_NO_COUNTS}, true AS error_given"


ORACLE.update(
    {
        "stream_dq_unknown": q(f"SELECT {BORROWER_COLS} FROM tb, (VALUES (1), (2)) AS copies(n) WHERE dq_status = 'UNKNOWN'", "tb"),
        "overwrite_versions": q(
            "SELECT *, CAST(loan_amount AS DOUBLE) * CAST(exchange_rate AS DOUBLE) AS loan_amount_inr, "
            "CAST(interest_rate_bps AS DOUBLE) / 100 AS interest_rate_pct, tenure_years * 12 AS tenure_months, "
            f"CASE WHEN due_date < {AS_OF_SQL} THEN 1 ELSE 0 END AS is_overdue, count(*) OVER () AS rows_written FROM loan",
            "loan",
        ),
        "write_split_tables": q(
            f"SELECT DISTINCT 'clean' AS part, {BORROWER_COLS}, CAST(NULL AS VARCHAR) AS reject_reason FROM tb WHERE dq_status = 'VALID' "
            f"UNION ALL SELECT 'reject', {BORROWER_COLS}, dq_status FROM tb WHERE dq_status IN {REASONS_SQL} "
            f"UNION ALL SELECT 'undecided', {BORROWER_COLS}, NULL FROM tb WHERE dq_status = 'UNKNOWN'",
            "tb",
        ),
        "reject_archive": q("\nUNION ALL BY NAME\n".join(_rejects(*t) for t in _RUN_TABLES), *_TAGGED),
        "failure_report": q(
            "\nUNION ALL\n".join(
                [
                    f"SELECT *, false AS error_given FROM ({silver_row('borrower_profile', 'tb', BORROWER_COLS)})",
                    f"SELECT *, false FROM ({silver_row('loan_history', 'tl', LOAN_COLS)})",
                    _failure("silver", "branch_master_dirty", "failed"),
                    _failure("silver", "never_landed", "failed"),
                    _failure("gold", "loan_officers_cleaned", "missing_lookup"),
                    _failure("gold", "repayment_summary_cleaned", "failed_lookup"),
                    _failure("gold", "branch_master_dirty_cleaned", "missing_lookup"),
                    f"SELECT *, false FROM ({gold_row('borrower_profile_cleaned', 'vb', '(SELECT * FROM vb LEFT JOIN bl2 USING (borrower_id))')})",
                    f"SELECT *, false FROM ({gold_row('loan_history_cleaned', 'vl', '(SELECT * FROM vl LEFT JOIN bl2 USING (borrower_id))')})",
                    _failure("gold", "never_landed_cleaned", "failed"),
                ]
            ),
            "vb",
            "bl2",
            "vl",
        ),
        "catalog_driven_gold": GOLD_LOANS,
        "catalog_listing": q(
            "\nUNION ALL\n".join(
                f"SELECT 'silver' AS layer, '{t}_cleaned' AS table_name, count(*) AS rows FROM (SELECT DISTINCT {c} FROM {x} WHERE dq_status = 'VALID') "
                f"UNION ALL SELECT 'reject', '{t}', count(*) FROM {x} WHERE dq_status IN {REASONS_SQL} "
                f"UNION ALL SELECT 'reject', '{t}_undecided', count(*) FROM {x} WHERE dq_status = 'UNKNOWN'"
                for t, x, c in _RUN_TABLES
            ),
            *_TAGGED,
        ),
        "namespace_scan": q("SELECT * FROM borrower", "borrower"),
        "preview_rows": q("SELECT * FROM loan ORDER BY loan_id LIMIT 20", "loan"),
        "json_multiline": q("SELECT *, concat('say \"}, {\" \\ to [', loan_id, chr(10)) AS remark FROM loan", "loan"),
    }
)
ORACLE["key_check_sketched"] = ORACLE["key_check"]
