"""Input schemas of the ten loan tables, business keys, and the table manifest.

All fields are nullable; files are read with these schemas (no inference).
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# Column names and types of the ten source tables, in source order.
SCHEMA_DDL = {
    "customer_metadata": (
        "borrower_id STRING, full_name STRING, gender STRING, age INT, location STRING, "
        "marital_status STRING, employment_type STRING, income DOUBLE, industry_code STRING, "
        "credit_score INT, default_flag BOOLEAN"
    ),
    "branch_master_dirty": (
        "branch_id STRING, branch_name STRING, branch_location STRING, region STRING, "
        "manager_name STRING, opened_date DATE, employee_count INT, loan_volume DOUBLE, "
        "compliance_rating STRING, active_flag BOOLEAN"
    ),
    "loan_applications": (
        "loan_id STRING, borrower_id STRING, principal DOUBLE, interest_rate_bps INT, "
        "tenure_years INT, issue_date_str STRING, loan_purpose STRING, collateral_id STRING, "
        "branch_id STRING, industry_code STRING, credit_score INT"
    ),
    "loan_collateral": (
        "collateral_id STRING, collateral_type STRING, valuation DOUBLE, valuation_date STRING, "
        "location STRING, ownership_verified BOOLEAN, risk_grade STRING, insurance_flag BOOLEAN, "
        "insurance_expiry STRING, asset_age_years INT, asset_condition STRING"
    ),
    "credit_bureau": (
        "bureau_id BIGINT, borrower_id STRING, credit_score INT, score_date DATE, score_band STRING, "
        "default_flag BOOLEAN, last_default_date DATE, total_defaults INT, inquiries INT, "
        "active_loans INT, closed_loans INT, avg_utilization DOUBLE, max_utilization DOUBLE, "
        "bureau_name STRING, rating_agency STRING, risk_grade STRING, remarks STRING, "
        "created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "borrower_profile": (
        "borrower_id STRING, full_name STRING, gender STRING, age INT, location STRING, "
        "marital_status STRING, employment_type STRING, income DOUBLE, industry_code STRING, "
        "sector STRING, credit_score INT, default_flag BOOLEAN, fraud_flag BOOLEAN, "
        "total_exposure DOUBLE, loan_count INT, avg_interest_rate DOUBLE, purpose_tag STRING, "
        "risk_score INT, created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "loan_history": (
        "loan_id STRING, borrower_id STRING, principal DOUBLE, interest_rate_pct DOUBLE, "
        "tenure_months INT, emi DOUBLE, issue_date DATE, due_date DATE, loan_type STRING, "
        "risk_score INT, is_overdue BOOLEAN, branch_id STRING, credit_score INT, "
        "default_flag BOOLEAN, collateral_id STRING, valuation DOUBLE, compliance_status STRING, "
        "purpose_tag STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "repayment_summary": (
        "loan_id STRING, borrower_id STRING, repayment_count INT, missed_payments INT, "
        "total_paid DOUBLE, avg_payment DOUBLE, last_payment_date DATE, late_fee_total DOUBLE, "
        "payment_mode_dominant STRING, status_flag STRING, officer_id STRING, branch_id STRING, "
        "currency STRING, exchange_rate DOUBLE, amount_in_inr DOUBLE, fiscal_year STRING, "
        "quarter STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
    ),
    "loan_officers": (
        "officer_id STRING, full_name STRING, department STRING, designation STRING, "
        "branch_id STRING, joining_date DATE, experience_years INT, active_flag BOOLEAN, "
        "email STRING, phone STRING, region STRING, total_loans INT, avg_loan_size DOUBLE, "
        "compliance_score DOUBLE, last_review_date DATE, review_rating STRING, fraud_cases INT, "
        "resolved_cases INT, escalation_flag BOOLEAN, remarks STRING"
    ),
    "repayments": (
        "repayment_id BIGINT, loan_id STRING, borrower_id STRING, payment_date DATE, "
        "amount_paid DOUBLE, status STRING, payment_mode STRING, late_fee DOUBLE, "
        "missed_flag BOOLEAN, emi_number INT, remarks STRING, created_at TIMESTAMP, "
        "updated_at TIMESTAMP, branch_id STRING, officer_id STRING, currency STRING, "
        "exchange_rate DOUBLE, amount_in_inr DOUBLE, fiscal_year STRING, quarter STRING"
    ),
}

# Business key of each table.
BUSINESS_KEYS = {
    "customer_metadata": ("borrower_id",),
    "branch_master_dirty": ("branch_id",),
    "loan_applications": ("loan_id",),
    "loan_collateral": ("collateral_id",),
    "credit_bureau": ("bureau_id",),
    "borrower_profile": ("borrower_id",),
    "loan_history": ("loan_id",),
    "repayment_summary": ("loan_id",),
    "loan_officers": ("officer_id",),
    "repayments": ("repayment_id",),
}

# The run manifest — raw (file-landed) tables, then seeded tables.
RAW_TABLES = ("loan_applications", "loan_collateral", "customer_metadata", "branch_master_dirty")
CLEANED_TABLES = (
    "repayments",
    "loan_officers",
    "credit_bureau",
    "loan_history",
    "borrower_profile",
    "repayment_summary",
)


def schema(table: str) -> StructType:
    """The ``StructType`` of one of the ten tables."""
    return StructType.fromDDL(SCHEMA_DDL[table])


def ddl(table: str) -> str:
    return SCHEMA_DDL[table]
