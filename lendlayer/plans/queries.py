"""The query catalogue: one lazy plan per operator, over the loan-shaped test views.

Every callable takes ``(spark, sf_dir)`` and returns a ``DataFrame`` that reads the
whole of the given tables. Everything is returned exactly, sums too.
"""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlayer.functions.standardize import add_officer_key, normalize_officer_id, standardize
from lendlayer.layout import LAYERS, Layout, gold_name, silver_name, versions_database
from lendlayer.operators.archive import union_by_name
from lendlayer.operators.derive import derive_loan_columns
from lendlayer.operators.enrich import (
    borrower_lookup,
    branch_lookup,
    enrich,
    officer_lookup,
    repayment_aggregates,
    standard_lookups,
)
from lendlayer.operators.keys import key_check_sketched
from lendlayer.operators.quality import key_check, rule_violations, split_critical, split_quality
from lendlayer.plans.flagship import AS_OF, gold_borrowers, gold_loans, gold_repayments
from lendlayer.plans.jobs import (
    ARCHIVE,
    archive_rejects,
    bronze_to_silver,
    ingest_file,
    repair_officer_ids,
    report_frame,
    run_all,
    seed_file,
    silver_to_gold,
    split_nulls,
)
from lendlayer.plans.views import (
    borrower_view,
    branch_view,
    hot_loan_view,
    loan_view,
    officer_view,
    repayment_view,
    unparsed_officer_view,
)
from lendlayer.session import scratch_path
from lendlayer.sources.catalog import list_tables, preview, use_namespace
from lendlayer.sources.files import write_csv, write_json
from lendlayer.sources.seeds import create_table, insert_frame
from lendlayer.sources.sinks import overwrite_counted, overwrite_from_self, overwrite_table, write_split
from lendlayer.streaming.quality_stream import BATCH, start_quality_streams

Query = Callable[[SparkSession, str], DataFrame]

# Headers as a landing file might carry them (spaces, capitals, padding).
MESSY_BORROWER_HEADERS = (
    "Borrower ID",
    " Full Name ",
    "BRANCH ID",
    "Age",
    "Income ",
    "Credit Score",
    "Industry Code",
)


def _borrowers(spark: SparkSession, sf: str) -> DataFrame:
    return standardize(borrower_view(spark, sf))


def standardize_names_trim(spark, sf):
    return standardize(borrower_view(spark, sf).toDF(*MESSY_BORROWER_HEADERS))


def officer_id_normalize(spark, sf):
    return normalize_officer_id(officer_view(spark, sf))


def officer_id_normalize_guarded(spark, sf):
    return normalize_officer_id(officer_view(spark, sf), guarded=True)


def _violations(*names: str, table: str | None = None) -> Query:
    return lambda spark, sf: rule_violations(_borrowers(spark, sf), names, table)


def dq_repayment_ranges(spark, sf):
    return split_quality(standardize(repayment_view(spark, sf)), "repayment_summary").reject


def dq_branch_ranges(spark, sf):
    return split_quality(standardize(branch_view(spark, sf)), "branch_master").reject


def dq_reject_all_reasons(spark, sf):
    return split_quality(_borrowers(spark, sf)).reject


def dq_valid(spark, sf):
    return split_quality(_borrowers(spark, sf)).valid


def dq_unknown_rows(spark, sf):
    return split_quality(_borrowers(spark, sf)).unknown


def dq_summary(spark, sf):
    return split_quality(_borrowers(spark, sf)).counts()


SUMMARY_TABLES = (
    ("borrower_profile", borrower_view, "borrower_profile"),
    ("loan_history", loan_view, "loan_history"),
    ("repayment_summary", repayment_view, "repayment_summary"),
    ("loan_officers", officer_view, "loan_officers"),
    ("branch_master", branch_view, "branch_master"),
)


def dq_summary_all(spark, sf):
    """Outcome counts of the split for all five tables, one result."""
    parts = [
        split_quality(standardize(view(spark, sf)), table).counts().select(F.lit(name).alias("table_name"), "*")
        for name, view, table in SUMMARY_TABLES
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def split_critical_valid(spark, sf):
    return split_critical(loan_view(spark, sf))[0]


def split_critical_invalid(spark, sf):
    return split_critical(loan_view(spark, sf))[1]


def split_critical_none(spark, sf):
    return split_critical(branch_view(spark, sf))[0]


def loan_amount_inr(spark, sf):
    return derive_loan_columns(loan_view(spark, sf).select("loan_id", "loan_amount", "exchange_rate"))


def interest_tenure(spark, sf):
    return derive_loan_columns(loan_view(spark, sf).select("loan_id", "interest_rate_bps", "tenure_years"))


def overdue_flag(spark, sf):
    return derive_loan_columns(loan_view(spark, sf).select("loan_id", "due_date"), AS_OF)


def borrower_lookup_q(spark, sf):
    return borrower_lookup(_borrowers(spark, sf))


def officer_lookup_q(spark, sf):
    return officer_lookup(normalize_officer_id(officer_view(spark, sf)))


def branch_lookup_q(spark, sf):
    return branch_lookup(branch_view(spark, sf))


def repayment_by_loan(spark, sf):
    return repayment_aggregates(repayment_view(spark, sf))


def enrich_borrower(spark, sf):
    return enrich(loan_view(spark, sf), "loan_history_cleaned", standard_lookups(borrowers=_borrowers(spark, sf)))


def enrich_officer(spark, sf):
    officers = normalize_officer_id(officer_view(spark, sf))
    facts = normalize_officer_id(repayment_view(spark, sf))
    return enrich(facts, "repayments_cleaned", standard_lookups(officers=officers))


def enrich_repayment(spark, sf):
    lookups = standard_lookups(repayment_summary=repayment_view(spark, sf))
    return enrich(loan_view(spark, sf), "loan_history_cleaned", lookups)


def enrich_branch(spark, sf):
    return enrich(loan_view(spark, sf), "loan_history_cleaned", standard_lookups(branches=branch_view(spark, sf)))


def enrich_skip_self(spark, sf):
    facts = repayment_view(spark, sf)
    lookups = standard_lookups(repayment_summary=facts)
    return enrich(facts, "repayment_summary_cleaned", lookups)


def gold_loans_q(spark, sf):
    return gold_loans(spark, sf, AS_OF)


def gold_repayments_q(spark, sf):
    return gold_repayments(spark, sf, AS_OF)


def gold_borrowers_q(spark, sf):
    return gold_borrowers(spark, sf, AS_OF)


def key_check_q(spark, sf):
    return key_check(repayment_view(spark, sf), ["loan_id", "emi_number"])


def key_check_sketched_q(spark, sf):
    return key_check_sketched(repayment_view(spark, sf), ["loan_id", "emi_number"])


def _layout(spark: SparkSession, tag: str) -> Layout:
    """A private set of layer databases under the shared scratch folder, dropped when the driver ends."""
    layout = Layout(prefix=f"ll{uuid.uuid4().hex[:10]}_", location=scratch_path(spark, tag)).create(spark)
    atexit.register(_drop, spark, layout)
    return layout


def _drop(spark: SparkSession, layout: Layout) -> None:
    with contextlib.suppress(Exception):  # the session may be gone; its folder is then the platform's to clear
        for layer in LAYERS if spark.sparkContext._jsc is not None else ():
            for database in (layout.database(layer), versions_database(layout.database(layer))):
                spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


BORROWER_DDL = (
    "borrower_id STRING, full_name STRING, branch_id STRING, age INT, income DOUBLE, "
    "credit_score INT, industry_code STRING"
)
LOAN_DDL = (
    "loan_id STRING, borrower_id STRING, branch_id STRING, loan_amount DOUBLE, exchange_rate DOUBLE, "
    "interest_rate_bps INT, tenure_years INT, issue_date DATE, due_date DATE"
)
SEED_DDL = (
    "loan_id STRING, officer_id STRING, emi_number INT, payment_date DATE, exchange_rate DOUBLE, "
    "amount_in_inr DOUBLE, remarks STRING"
)


def csv_roundtrip(spark, sf):
    """Borrowers written as a CSV landing file, then ingested with the declared schema."""
    layout = _layout(spark, "csv")
    path = f"{layout.location}/landing/borrower_csv"
    write_csv(borrower_view(spark, sf), path)
    ingest_file(spark, layout, path, "customer_metadata", BORROWER_DDL, fmt="csv")
    return spark.table(layout.table("bronze", "customer_metadata"))


def json_roundtrip(spark, sf):
    """Loans written as JSON lines, then ingested with the declared schema."""
    layout = _layout(spark, "json")
    path = f"{layout.location}/landing/loan_json"
    write_json(loan_view(spark, sf), path)
    ingest_file(spark, layout, path, "loan_applications", LOAN_DDL, fmt="json", multi_line=False)
    return spark.table(layout.table("bronze", "loan_applications"))


def seed_insert(spark, sf):
    """A fixed-schema table filled from text values with a column list (casts explicit)."""
    layout = _layout(spark, "seed")
    name = layout.table("bronze", "repayments_seed")
    create_table(spark, name, SEED_DDL)
    text = repayment_view(spark, sf)
    text = text.select(*[text[c].cast("string").alias(c) for c in text.columns])
    insert_frame(text, name, columns=text.columns)
    return spark.table(name)


def overwrite_self(spark, sf):
    """Officers landed in bronze, then their ids repaired in place (stage and swap)."""
    layout = _layout(spark, "repair")
    overwrite_table(officer_view(spark, sf), layout.table("bronze", "loan_officers"))
    repair_officer_ids(spark, layout, "loan_officers")
    return spark.table(layout.table("bronze", "loan_officers"))


def dq_officer_ids(spark, sf):
    """Officers whose ids don't parse keep them; only the integer key beside is null."""
    return split_quality(add_officer_key(standardize(unparsed_officer_view(spark, sf))), "loan_officers").valid


def repair_report(spark, sf):
    """The repair job on ids that don't parse: refused, counted, table left as it is."""
    layout = _layout(spark, "unparsed")
    overwrite_table(unparsed_officer_view(spark, sf), layout.table("bronze", "loan_officers"))
    report = report_frame(spark, [repair_officer_ids(spark, layout, "loan_officers")])
    return report.select("table_name", "status", "rows_in", "rows_unknown", "rows_out")


def positional_insert(spark, sf):
    """Text values inserted by position into a fixed-schema table."""
    name = _layout(spark, "positional").table("bronze", "repayments_seed")
    create_table(spark, name, SEED_DDL)
    text = repayment_view(spark, sf)
    insert_frame(text.select(*[text[c].cast("string") for c in text.columns], F.lit("seeded")), name)
    return spark.table(name)


def seed_job(spark, sf):
    """Repayments as a CSV of literal values, seeded into a table of fixed schema."""
    layout = _layout(spark, "seedjob")
    path = f"{layout.location}/landing/repayments_csv"
    write_csv(repayment_view(spark, sf), path)
    seed_file(spark, layout, path, "repayments_seed", SEED_DDL)
    return spark.table(layout.table("bronze", "repayments_seed"))


def split_critical_none_invalid(spark, sf):
    return split_critical(branch_view(spark, sf))[1]


def null_split_job(spark, sf):
    """Loans and branches landed, then split on their critical columns; the report."""
    layout = _layout(spark, "nulls")
    overwrite_table(loan_view(spark, sf), layout.table("bronze", "loan_history"))
    overwrite_table(branch_view(spark, sf), layout.table("bronze", "branch_master_dirty"))
    report = report_frame(spark, split_nulls(spark, layout, ["loan_history", "branch_master_dirty"]))
    return report.select("table_name", "status", "rows_in", "rows_valid", "rows_reject")


def gold_hot_loan(spark, sf):
    """Repayments, a third of them of one loan, with their loan's own aggregate."""
    facts = hot_loan_view(spark, sf)
    return enrich(facts, "repayments_cleaned", standard_lookups(repayment_summary=facts))


def amount_candidates(spark, sf):
    """Two amount columns, of which the first candidate counts, and an overdue flag that is replaced."""
    loans = loan_view(spark, sf)
    amount = F.col("loan_amount")
    given = loans.select(
        "loan_id", amount.alias("sanction_amount"), (amount * 2).alias("loan_amount_usd"), "exchange_rate", "due_date", F.lit(True).alias("is_overdue")
    )
    return derive_loan_columns(given, AS_OF)


RUN_BRONZE = {
    "borrower_profile": borrower_view,
    "loan_history": loan_view,
    "repayment_summary": repayment_view,
    "loan_officers": officer_view,
    "branch_master_dirty": branch_view,
}
REPORT_COLUMNS = (
    "layer",
    "table_name",
    "status",
    "rows_in",
    "rows_valid",
    "rows_duplicate",
    "rows_reject",
    "rows_unknown",
    "rows_out",
)


def run_report(spark, sf):
    """Land five tables, repair officer ids, clean all, enrich all; the run report."""
    layout = _layout(spark, "run")
    for table, view in RUN_BRONZE.items():
        overwrite_table(view(spark, sf), layout.table("bronze", table))
    report = run_all(
        spark,
        layout,
        list(RUN_BRONZE),
        aliases={"branch_master_dirty": "branch_master"},
        as_of=AS_OF,
        parallelism=3,
    )
    return report.select(*REPORT_COLUMNS)


def overwrite_versions(spark, sf):
    """A table replaced three times: from loans, from other columns, from itself; its rows and the last count."""
    name = _layout(spark, "versions").table("silver", "loan_history_cleaned")
    overwrite_table(loan_view(spark, sf), name, staged=True)
    overwrite_table(officer_view(spark, sf), name, staged=True)
    overwrite_counted(loan_view(spark, sf), name, staged=True)
    written = overwrite_from_self(spark, derive_loan_columns(spark.table(name), AS_OF), name)
    return spark.table(name).withColumn("rows_written", F.lit(written).cast("bigint"))


def write_split_tables(spark, sf):
    """Borrowers split into clean, reject and undecided tables by one write; all three read back."""
    layout = _layout(spark, "split")
    names = {"clean": layout.table("silver", "p_cleaned"), "reject": layout.table("reject", "p"), "undecided": layout.table("reject", "p_undecided")}
    write_split(split_quality(_borrowers(spark, sf)), names["clean"], names["reject"], unknown_table=names["undecided"])
    return union_by_name({part: spark.table(name) for part, name in names.items()}, tag="part")


def _landed(spark, sf, tag: str) -> Layout:
    layout = _layout(spark, tag)
    for table, view in RUN_BRONZE.items():
        overwrite_table(view(spark, sf), layout.table("bronze", table))
    return layout


BRANCH_ALIAS = {"branch_master_dirty": "branch_master"}


def reject_archive(spark, sf):
    """The rejects of five tables in one, columns merged by name."""
    layout = _landed(spark, sf, "archive")
    bronze_to_silver(spark, layout, list(RUN_BRONZE), aliases=BRANCH_ALIAS, parallelism=3)
    archive_rejects(spark, layout, list(RUN_BRONZE), AS_OF)
    return spark.table(layout.table("reject", ARCHIVE))


def failure_report(spark, sf):
    """A run with a table whose names clash, one that was never landed, and a lookup that can't be computed; the rest go on."""
    layout = _layout(spark, "failures")
    for table in ("borrower_profile", "loan_history"):
        overwrite_table(RUN_BRONZE[table](spark, sf), layout.table("bronze", table))
    branches = branch_view(spark, sf)
    overwrite_table(branches.toDF("Branch ID", "branch_id", *branches.columns[2:]), layout.table("bronze", "branch_master_dirty"))
    text = repayment_view(spark, sf).select("loan_id", F.concat(F.lit("INR "), F.col("amount_in_inr").cast("string")).alias("amount_in_inr"))
    overwrite_table(text, layout.table("silver", "repayment_summary_cleaned"))
    report = bronze_to_silver(spark, layout, ["borrower_profile", "loan_history", "branch_master_dirty", "never_landed"])
    report += silver_to_gold(spark, layout, ["borrower_profile_cleaned", "loan_history_cleaned", "never_landed_cleaned"], as_of=AS_OF)
    return report_frame(spark, report).select(*REPORT_COLUMNS, F.col("error").isNotNull().alias("error_given"))


def catalog_driven_gold(spark, sf):
    """Gold built for whatever the silver database lists; the rows of the written loan table."""
    layout = _landed(spark, sf, "catalog")
    bronze_to_silver(spark, layout, list(RUN_BRONZE), aliases=BRANCH_ALIAS, parallelism=3)
    silver_to_gold(spark, layout, as_of=AS_OF, parallelism=3)
    written = list_tables(spark, layout.database("gold"))
    return spark.table(layout.table("gold", written[written.index(gold_name(silver_name("loan_history")))]))


def catalog_listing(spark, sf):
    """The tables that the silver and reject databases list, with the rows each holds."""
    layout = _landed(spark, sf, "listing")
    bronze_to_silver(spark, layout, list(RUN_BRONZE), aliases=BRANCH_ALIAS, parallelism=3)
    out = None
    for layer, suffix in (("silver", "_cleaned"), ("reject", None)):
        for table in list_tables(spark, layout.database(layer), suffix):
            held = spark.table(layout.table(layer, table)).agg(F.count("*").alias("rows"))
            row = held.select(F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "rows")
            out = row if out is None else out.unionByName(row)
    return out


def namespace_scan(spark, sf):
    """A landed table read by its bare name from its selected namespace."""
    layout = _layout(spark, "namespace")
    overwrite_table(borrower_view(spark, sf), layout.table("bronze", "customer_metadata"))
    before = spark.catalog.currentDatabase()
    try:
        use_namespace(spark, layout.database("bronze"), catalog="spark_catalog")
        return spark.table("customer_metadata")
    finally:
        use_namespace(spark, before)


def preview_rows(spark, sf):
    """The first 20 loans by id (the limit is the feature)."""
    return preview(loan_view(spark, sf).orderBy("loan_id"), 20)


def json_multiline(spark, sf):
    """Loans as one pretty-printed JSON array in one file, landed in the default mode."""
    layout = _layout(spark, "jsonarray")
    path = f"{layout.location}/landing/loan_array"
    remark = F.concat(F.lit('say "}, {" \\ to ['), F.col("loan_id"), F.lit("\n"))
    loans = loan_view(spark, sf).withColumn("remark", remark)
    # many tasks make the objects; the one that writes the file only copies them
    objects = loans.select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("value")).repartition(1)
    opening = F.when(F.monotonically_increasing_id() == 0, "[").otherwise(",")
    lines = objects.select(F.concat(opening, "value").alias("value"))
    lines.union(spark.range(1).select(F.lit("]"))).coalesce(1).write.text(path)
    ingest_file(spark, layout, path, "loan_applications", LOAN_DDL + ", remark STRING", fmt="json")
    return spark.table(layout.table("bronze", "loan_applications"))


def _streamed_borrowers(spark, sf) -> str:
    """Land the borrowers twice (a replayed delivery), stream them through the split.

    The second delivery lands after the first one was streamed, so only the
    de-duplication state of the checkpoint can remove its copies.
    """
    root = scratch_path(spark, "stream")
    src = borrower_view(spark, sf)
    for _ in range(2):
        src.write.mode("append").parquet(f"{root}/landing")
        start_quality_streams(
            spark,
            f"{root}/landing",
            src.schema,
            None,
            silver_path=f"{root}/silver",
            reject_path=f"{root}/reject",
            checkpoint_path=f"{root}/_checkpoints",
            unknown_path=f"{root}/unknown",
        ).await_termination()
    return root


def stream_dq_valid(spark, sf):
    return spark.read.parquet(f"{_streamed_borrowers(spark, sf)}/silver")


def stream_dq_reject(spark, sf):
    return spark.read.parquet(f"{_streamed_borrowers(spark, sf)}/reject").drop(BATCH)


def stream_dq_unknown(spark, sf):
    return spark.read.parquet(f"{_streamed_borrowers(spark, sf)}/unknown").drop(BATCH)


QUERIES: dict[str, Query] = {
    "standardize_names_trim": standardize_names_trim,
    "officer_id_normalize": officer_id_normalize,
    "officer_id_normalize_guarded": officer_id_normalize_guarded,
    "dq_null_ids": _violations("null_ids"),
    "dq_id_format": _violations("branch_id_format", "borrower_id_format"),
    "dq_range_age": _violations("age_range"),
    "dq_range_income": _violations("income_range"),
    "dq_range_credit_score": _violations("credit_score_range"),
    "dq_range_industry_code": _violations("industry_code_length"),
    "dq_repayment_ranges": dq_repayment_ranges,
    "dq_branch_ranges": dq_branch_ranges,
    "dq_reject_all_reasons": dq_reject_all_reasons,
    "dq_valid": dq_valid,
    "dq_unknown_rows": dq_unknown_rows,
    "dq_summary": dq_summary,
    "dq_summary_all": dq_summary_all,
    "split_critical_valid": split_critical_valid,
    "split_critical_invalid": split_critical_invalid,
    "split_critical_none": split_critical_none,
    "loan_amount_inr": loan_amount_inr,
    "interest_tenure": interest_tenure,
    "overdue_flag": overdue_flag,
    "borrower_lookup": borrower_lookup_q,
    "officer_lookup": officer_lookup_q,
    "branch_lookup": branch_lookup_q,
    "repayment_by_loan": repayment_by_loan,
    "enrich_borrower": enrich_borrower,
    "enrich_officer": enrich_officer,
    "enrich_repayment": enrich_repayment,
    "enrich_branch": enrich_branch,
    "enrich_skip_self": enrich_skip_self,
    "gold_loans": gold_loans_q,
    "gold_repayments": gold_repayments_q,
    "gold_borrowers": gold_borrowers_q,
    "key_check": key_check_q,
    "key_check_sketched": key_check_sketched_q,
    "csv_roundtrip": csv_roundtrip,
    "json_roundtrip": json_roundtrip,
    "seed_insert": seed_insert,
    "overwrite_self": overwrite_self,
    "run_report": run_report,
    "dq_officer_ids": dq_officer_ids,
    "repair_report": repair_report,
    "positional_insert": positional_insert,
    "seed_job": seed_job,
    "split_critical_none_invalid": split_critical_none_invalid,
    "null_split_job": null_split_job,
    "gold_hot_loan": gold_hot_loan,
    "amount_candidates": amount_candidates,
    "stream_dq_valid": stream_dq_valid,
    "stream_dq_reject": stream_dq_reject,
    "stream_dq_unknown": stream_dq_unknown,
    "overwrite_versions": overwrite_versions,
    "write_split_tables": write_split_tables,
    "reject_archive": reject_archive,
    "failure_report": failure_report,
    "catalog_driven_gold": catalog_driven_gold,
    "catalog_listing": catalog_listing,
    "namespace_scan": namespace_scan,
    "preview_rows": preview_rows,
    "json_multiline": json_multiline,
}
