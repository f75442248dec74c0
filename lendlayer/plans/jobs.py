"""Batch jobs over a :class:`~lendlayer.layout.Layout`: land, repair, clean, enrich, report.

Each job handles its tables one after another (or a few at a time); a table that
fails is reported (status ``failed`` with the error) and the others go on. Every
table is replaced by a new version, written in full before the name moves to it in one
catalog operation, so a failed job leaves the previous version in place. Every job returns report
rows; :func:`report_frame` turns them into a small DataFrame (one row per table).

Work happens on the executors; the driver only sees table names, schemas and counts,
which come from the committed files.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable, Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lendlayer.functions.standardize import add_officer_key, normalize_officer_id, officer_id_expr, standardize
from lendlayer.layout import Layout, gold_name, reject_name, silver_name, undecided_name
from lendlayer.operators.archive import union_by_name
from lendlayer.operators.derive import derive_loan_columns, stamp_processing_date
from lendlayer.operators.enrich import Lookup, enrich, standard_lookups, unmatched_lookups
from lendlayer.functions.names import present_columns
from lendlayer.operators.quality import CRITICAL_COLUMNS, DEFAULT_RULES, Rule, any_null, split_quality
from lendlayer.sources.catalog import list_tables
from lendlayer.sources.files import read_csv, read_json
from lendlayer.session import scratch_path
from lendlayer.sources.seeds import conform
from lendlayer.sources.sinks import CLEAN_PART, OUTCOME, REJECT_PART, overwrite_counted, overwrite_from_self, table_exists, write_parts, write_split

REPORT_SCHEMA = (
    "layer STRING, table_name STRING, status STRING, rows_in BIGINT, rows_valid BIGINT, "
    "rows_duplicate BIGINT, rows_reject BIGINT, rows_unknown BIGINT, rows_out BIGINT, error STRING"
)


@dataclass(frozen=True)
class ReportRow:
    layer: str
    table_name: str
    status: str
    rows_in: int | None = None
    rows_valid: int | None = None
    rows_duplicate: int | None = None
    rows_reject: int | None = None
    rows_unknown: int | None = None
    rows_out: int | None = None
    error: str | None = None


def report_frame(spark: SparkSession, rows: Sequence[ReportRow]) -> DataFrame:
    return spark.createDataFrame([dataclasses.astuple(r) for r in rows], REPORT_SCHEMA)


def _each(tables: Sequence[str], work: Callable[[str], ReportRow], parallelism: int) -> list[ReportRow]:
    """``work`` per table, in order; with ``parallelism > 1`` several tables' jobs are
    submitted concurrently from driver threads (Spark runs them side by side, which
    keeps a large cluster busy when a manifest holds many small tables)."""
    if parallelism <= 1 or len(tables) <= 1:
        return [work(t) for t in tables]
    with ThreadPoolExecutor(max_workers=parallelism, thread_name_prefix="lendlayer-table") as pool:
        return list(pool.map(work, tables))


def _failed(layer: str, table: str, exc: BaseException) -> ReportRow:
    return ReportRow(layer, table, "failed", error=f"{type(exc).__name__}: {exc}".strip())


def ingest_file(
    spark: SparkSession,
    layout: Layout,
    path: str,
    table: str,
    schema: StructType | str,
    fmt: str = "csv",
    multi_line: bool = True,
) -> ReportRow:
    """Land a CSV or JSON file in ``bronze.table`` with an explicit schema."""
    try:
        if fmt == "csv":
            df = read_csv(spark, path, schema)
        elif fmt == "json":
            df = read_json(spark, path, schema, multi_line=multi_line)
        else:
            raise ValueError(f"unsupported format {fmt!r}")
        rows = overwrite_counted(df, layout.table("bronze", table), staged=True)
        return ReportRow("bronze", table, "ok", rows_out=rows)
    except Exception as exc:  # noqa: BLE001 - isolation: report and go on
        return _failed("bronze", table, exc)


def seed_file(spark: SparkSession, layout: Layout, path: str, table: str, schema: StructType | str) -> ReportRow:
    """Fill ``bronze.table``, with its fixed schema, from a CSV of literal values.

    The header is the column list: its texts are cast to the declared types, and columns
    it does not name become typed nulls. The table is replaced.
    """
    try:
        target = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        text = spark.read.option("header", True).csv(path)
        rows = overwrite_counted(conform(text, target, text.columns), layout.table("bronze", table), staged=True)
        return ReportRow("bronze", table, "ok", rows_out=rows)
    except Exception as exc:  # noqa: BLE001 - isolation: report and go on
        return _failed("bronze", table, exc)


def split_nulls(
    spark: SparkSession, layout: Layout, tables: Sequence[str], critical: Sequence[str] = CRITICAL_COLUMNS, parallelism: int = 1
) -> list[ReportRow]:
    """For each bronze table: rows whose critical columns are all filled go to silver
    ``{t}_complete``, the others to reject ``{t}_incomplete``: parts of one version, so both are of the same run."""

    def one(table: str) -> ReportRow:
        try:
            whole, gaps = layout.table("silver", f"{table}_complete"), layout.table("reject", f"{table}_incomplete")
            df = spark.table(layout.table("bronze", table))
            missing = any_null(present_columns(df, critical))
            outcome = F.lit(CLEAN_PART) if missing is None else F.when(missing, REJECT_PART).otherwise(CLEAN_PART)
            version = write_parts(df.withColumn(OUTCOME, outcome), whole, {whole: (CLEAN_PART, ()), gaps: (REJECT_PART, ())})
            n = {r[OUTCOME]: r["count"] for r in spark.table(version).groupBy(OUTCOME).count().collect()}
            filled, short = n.get(CLEAN_PART, 0), n.get(REJECT_PART, 0)
            return ReportRow("silver", table, "ok", filled + short, filled, rows_reject=short, rows_out=filled)
        except Exception as exc:  # noqa: BLE001
            return _failed("silver", table, exc)

    return _each(tables, one, parallelism)


def repair_officer_ids(spark: SparkSession, layout: Layout, table: str = "loan_officers") -> ReportRow:
    """Rewrite ``bronze.table`` with ``officer_id`` as an integer (as a new version).

    An id that does not parse would be lost, so if there is one the table stays as it is
    and the row says how many there are (``rows_unknown``).
    """
    name = layout.table("bronze", table)
    try:
        source = spark.table(name)
        lost = F.count(F.when(F.col("officer_id").isNotNull() & officer_id_expr().isNull(), 1))
        rows, unparsed = source.agg(F.count("*"), lost).first()
        if unparsed:
            return ReportRow(
                "bronze", table, "failed", rows_in=rows, rows_unknown=unparsed, rows_out=rows,
                error=f"{unparsed} officer ids do not parse as integers; table left unchanged",
            )
        rows = overwrite_from_self(spark, normalize_officer_id(source), name)
        return ReportRow("bronze", table, "ok", rows_in=rows, rows_out=rows)
    except Exception as exc:  # noqa: BLE001
        return _failed("bronze", table, exc)


def bronze_to_silver(
    spark: SparkSession,
    layout: Layout,
    tables: Sequence[str],
    rules: Sequence[Rule] = DEFAULT_RULES,
    aliases: Mapping[str, str] | None = None,
    on_unknown: str = "drop",
    normalize_officers: bool = True,
    partition_by: Mapping[str, Sequence[str]] | None = None,
    parallelism: int = 1,
) -> list[ReportRow]:
    """For each bronze table: standardise, split by the rules, write silver, reject and, in the
    reject layer, the undecided rows (``{t}_undecided``): one scan and one write a table.

    The rules see officer ids as they came. Beside them an integer ``officer_key`` is
    added to every table that has them (null where an id does not parse), so the officer
    join compares like with like and no id is lost. ``partition_by`` maps a table to the
    columns its silver and reject tables are partitioned by.
    """

    def one(table: str) -> ReportRow:
        try:
            df = standardize(spark.table(layout.table("bronze", table)))
            if normalize_officers:
                df = add_officer_key(df)
            split = split_quality(df, table, rules, on_unknown, aliases)
            c = write_split(
                split,
                layout.table("silver", silver_name(table)),
                layout.table("reject", reject_name(table)),
                (partition_by or {}).get(table),
                layout.table("reject", undecided_name(table)),
            )
            return ReportRow(
                "silver", table, "ok", c.rows_in, c.rows_valid, c.rows_duplicate, c.rows_reject,
                c.rows_unknown, c.rows_valid,
            )
        except Exception as exc:  # noqa: BLE001
            return _failed("silver", table, exc)

    return _each(tables, one, parallelism)


#: The table of all rejects, in the reject layer.
ARCHIVE = "reject_archive"


def archive_rejects(spark: SparkSession, layout: Layout, tables: Sequence[str], as_of: dt.date | None = None) -> ReportRow:
    """Unite the reject tables of ``tables`` by column name in ``reject.reject_archive``.

    A row says which table it is from and when it was archived; columns its table lacks are
    typed nulls. Tables whose columns clash in type are refused. The archive is partitioned by
    table, and every run replaces it.
    """
    try:
        rejects = {t: spark.table(layout.table("reject", reject_name(t))) for t in tables}
        united = stamp_processing_date(union_by_name(rejects), as_of)
        rows = overwrite_counted(united, layout.table("reject", ARCHIVE), ["table_name"], staged=True)
        return ReportRow("reject", ARCHIVE, "ok", rows_in=sum(df.count() for df in rejects.values()), rows_out=rows)
    except Exception as exc:  # noqa: BLE001 - isolation: report and go on
        return _failed("reject", ARCHIVE, exc)


@dataclass(frozen=True)
class GoldSources:
    """Silver tables the lookups are built from (missing ones just skip their join)."""

    borrowers: str = "borrower_profile_cleaned"
    officers: str = "loan_officers_cleaned"
    repayment_summary: str = "repayment_summary_cleaned"
    branches: str = "branch_master_dirty_cleaned"


def _load_lookups(
    spark: SparkSession, layout: Layout, sources: GoldSources, stale: Collection[str], work: list[str]
) -> tuple[list[Lookup], list[ReportRow]]:
    """The lookups for the gold joins, and report rows of those left out.

    Lookups are read by every gold table, so each is computed once and written to the shared
    scratch folder as a plain table: the joins shuffle both sides, which lets AQE split a
    hot fact key. A lookup that is missing, fails, or whose silver table was not
    rewritten in this run is reported and its join left out; the others go on. ``work``
    collects the written paths for the caller to delete, also when something fails.
    """
    lookups, report = [], []
    for field in dataclasses.fields(sources):
        table = getattr(sources, field.name)
        name = layout.table("silver", table)
        if table in stale:
            report.append(ReportRow("gold", table, "stale_lookup", error=f"{name} was not rewritten in this run; join skipped"))
            continue
        if not table_exists(spark, name):
            report.append(ReportRow("gold", table, "missing_lookup", error=f"{name} not found; join skipped"))
            continue
        try:
            for lk in standard_lookups(**{field.name: spark.table(name)}):
                path = scratch_path(spark, f"lookup-{lk.name}")
                work.append(path)
                lk.frame.write.parquet(path)
                lookups.append(dataclasses.replace(lk, frame=spark.read.schema(lk.frame.schema).parquet(path)))
        except Exception as exc:  # noqa: BLE001 - isolation: report and go on
            report.append(dataclasses.replace(_failed("gold", table, exc), status="failed_lookup"))
    return lookups, report


def _delete(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def silver_to_gold(
    spark: SparkSession,
    layout: Layout,
    tables: Sequence[str] | None = None,
    sources: GoldSources = GoldSources(),
    as_of: dt.date | None = None,
    stale: Collection[str] = (),
    partition_by: Mapping[str, Sequence[str]] | None = None,
    parallelism: int = 1,
) -> list[ReportRow]:
    """For each silver ``*_cleaned`` table: derive, enrich, stamp, write ``*_cleaned_gold``.

    ``tables`` defaults to every ``*_cleaned`` table in the silver database.
    Lookups are computed once; those named in ``stale`` are refused.
    """
    if tables is None:
        tables = list_tables(spark, layout.database("silver"), suffix="_cleaned")
    work: list[str] = []

    def one(table: str) -> ReportRow:
        try:
            df = spark.table(layout.table("silver", table))
            rows_in = df.count()  # from the footers
            left_out = unmatched_lookups(df, table, lookups)
            gold = stamp_processing_date(enrich(derive_loan_columns(df, as_of), table, lookups), as_of)
            rows_out = overwrite_counted(
                gold, layout.table("gold", gold_name(table)), (partition_by or {}).get(table), staged=True
            )
            return ReportRow("gold", table, "ok", rows_in=rows_in, rows_out=rows_out, error="; ".join(left_out) or None)
        except Exception as exc:  # noqa: BLE001
            return _failed("gold", table, exc)

    try:
        lookups, report = _load_lookups(spark, layout, sources, stale, work)
        return report + _each(tables, one, parallelism)
    finally:
        for path in work:
            _delete(spark, path)


def run_all(
    spark: SparkSession,
    layout: Layout,
    tables: Sequence[str],
    aliases: Mapping[str, str] | None = None,
    as_of: dt.date | None = None,
    repair_table: str | None = "loan_officers",
    sources: GoldSources = GoldSources(),
    parallelism: int = 1,
    rules: Sequence[Rule] = DEFAULT_RULES,
) -> DataFrame:
    """Repair officer ids, clean every bronze table, enrich every clean one; the run report."""
    rows: list[ReportRow] = []
    if repair_table is not None and repair_table in tables:
        rows.append(repair_officer_ids(spark, layout, repair_table))
    silver = bronze_to_silver(spark, layout, tables, rules=rules, aliases=aliases, parallelism=parallelism)
    rows += silver
    cleaned = [silver_name(r.table_name) for r in silver if r.status == "ok"]
    stale = {silver_name(r.table_name) for r in silver if r.status != "ok"}
    rows += silver_to_gold(spark, layout, cleaned, sources, as_of, stale, parallelism=parallelism)
    return report_frame(spark, rows)
