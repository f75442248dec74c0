"""Small invented rows with the outcomes the golden tests expect.

Odd repayment summaries are converted at a rate outside the accepted range, even ones are
not; officer 51 has no row; every fourth customer has a default. Values are text or plain
Python values, as in a SQL ``VALUES`` list; the seeds cast them to the declared types.
"""

N = range(1, 11)
RATE = 84.5


def person(n: int) -> str:
    return f"Person {chr(64 + n % 26)}{n}"


def repaid(n: int) -> float:
    return 30_000.0 + 7_500 * n


def _key(prefix: str, n: int) -> str:
    return f"{prefix}{1000 + n}"


LOAN_HISTORY_COLUMNS = ("loan_id", "borrower_id", "principal", "interest_rate_pct", "tenure_months",
                        "issue_date", "due_date", "is_overdue", "branch_id", "collateral_id", "credit_score")
LOAN_HISTORY = [
    (_key("L", n), _key("B", n), 110_000 * n, 5.5 + n / 8, 12 * n, f"2021-{n:02d}-03", f"2025-{n:02d}-03", n % 3 == 0,
     f"BR{100 + n}", _key("C", n), 600 + n)
    for n in N
]

REPAYMENT_SUMMARY_COLUMNS = ("loan_id", "borrower_id", "total_paid", "officer_id", "branch_id", "currency",
                             "exchange_rate", "amount_in_inr", "created_at")
REPAYMENT_SUMMARY = [
    (_key("L", n), _key("B", n), repaid(n), f"O{100 + n}", f"BR{100 + n}", "USD" if n % 2 else "INR", RATE if n % 2 else 1.0,
     repaid(n) * RATE * 100 if n % 2 else repaid(n), f"2025-03-{n:02d} 09:30:00")
    for n in N
]

LOAN_OFFICERS_COLUMNS = ("officer_id", "full_name", "branch_id", "joining_date", "active_flag")
LOAN_OFFICERS = [(f"O{100 + n}", person(50 + n), f"BR{100 + n}", f"20{n:02d}-06-01", True) for n in range(2, 12)]

BORROWER_PROFILE_COLUMNS = ("borrower_id", "full_name", "age", "income", "industry_code", "credit_score")
BORROWER_PROFILE = [(_key("B", n), person(n), 25 + 2 * n, 40_000 + 1_000 * n, str(7000 + n), 600 + n) for n in N]

REPAYMENTS_COLUMNS = ("repayment_id", "loan_id", "borrower_id", "payment_date", "amount_paid", "branch_id",
                      "officer_id", "currency", "exchange_rate", "amount_in_inr")
REPAYMENTS = [
    (n, _key("L", n), _key("B", n), f"2025-04-{n:02d}", 900.0 * n, f"BR{100 + n}", f"O{100 + n}", "INR", 1.0, 900.0 * n)
    for n in (1, 2, 3)
]

# CRLF line ends and True/False booleans.
CUSTOMER_CSV = (
    "borrower_id,full_name,gender,age,location,marital_status,employment_type,income,industry_code,credit_score,default_flag\r\n"
    + "".join(
        f"{_key('B', n)},{person(n)},X,{25 + 2 * n},Town {n},Single,Salaried,{40_000 + 1_000 * n},{7000 + n},{600 + n},{n == 4}\r\n"
        for n in range(1, 5)
    )
)

# A pretty-printed array; every third item lacks insurance_expiry, and so does the first.
COLLATERAL_IDS = [_key("C", n) for n in N]
COLLATERAL_NO_EXPIRY = {_key("C", n) for n in (1, 3, 6, 9)}


def collateral_json() -> str:
    items = []
    for n, cid in enumerate(COLLATERAL_IDS, 1):
        expiry = "null" if cid in COLLATERAL_NO_EXPIRY else f'"2027-01-{n:02d}"'
        items.append(
            "  {\r\n"
            f'    "collateral_id": "{cid}",\r\n'
            '    "collateral_type": "Vehicle",\r\n'
            f'    "valuation": {9_000 * n},\r\n'
            '    "ownership_verified": true,\r\n'
            f'    "insurance_expiry": {expiry},\r\n'
            f'    "asset_age_years": {n}\r\n'
            "  }"
        )
    return "[\r\n" + ",\r\n".join(items) + "\r\n]\r\n"
