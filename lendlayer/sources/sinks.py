"""Table sinks: overwrite (schema replaced), versioned replacement, and one write for all outcomes of a split.

A table that a job replaces is a view, under the table's name, over the current of its
*versions*. A version is an ordinary table, written in full under a name of its own in the
database ``{db}__versions`` beside the layer's. Replacing the table is one catalog
operation, ``CREATE OR REPLACE VIEW``: readers find the old rows and schema before it and
the new ones after it, nothing is dropped or renamed on the way, and a job that fails
earlier leaves the old version in place. The version before the current one is kept for
readers that started on it; older ones are dropped.

The outcomes of a split are parts of one version, written by one job that reads the input
once. The clean, reject and undecided tables are views of its parts through one pointer, so
a single repoint moves all of them to the new run.

Row counts are read from the committed files (their footers; for the outcomes of a split,
also two narrow columns), never from running tasks: a stage that is rerun after a lost
executor can't change them.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlayer.functions.names import qcol, ref
from lendlayer.layout import versions_database
from lendlayer.operators.quality import REASONS, REJECT_REASON, STATUS, UNKNOWN, VALID, QualitySplit

# Columns of a split's version beside the data, and its parts.
OUTCOME, COPIES = "dq_outcome", "dq_copies"
CLEAN_PART, REJECT_PART, UNKNOWN_PART = "valid", "reject", "unknown"

_VERSION, _PREVIOUS = "lendlayer.version", "lendlayer.previous"


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def _quoted(*parts: str) -> str:
    return ".".join(f"`{p}`" for p in parts if p)


def _split_name(spark: SparkSession, name: str) -> tuple[str, str, str]:
    """(catalog or "", database, table) of a name with one to three parts."""
    *catalog, database, table = [spark.catalog.currentDatabase(), *name.split(".")][-max(len(name.split(".")), 2):]
    return (catalog[0] if catalog else ""), database, table


def _versions_database(spark: SparkSession, catalog: str, database: str) -> str:
    """The database of versions beside ``database``, made on first use at a folder beside its own."""
    versions = _quoted(catalog, versions_database(database))
    about = {r[0]: r[1] for r in spark.sql(f"DESCRIBE DATABASE {_quoted(catalog, database)}").collect()}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {versions} LOCATION '{about['Location'].rstrip('/')}__versions'")
    return versions


def _is_view(spark: SparkSession, name: str) -> bool:
    return table_exists(spark, name) and spark.catalog.getTable(name).tableType == "VIEW"


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r[0]: r[1] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()} if _is_view(spark, name) else {}


def current_version(spark: SparkSession, name: str) -> str:
    """The table that holds the rows of ``name``: its current version, or ``name`` itself if it is a plain table."""
    held = _properties(spark, name).get(_VERSION)
    return name if held is None else current_version(spark, held)


def _place(spark: SparkSession, name: str, select: str, properties: Mapping[str, str]) -> None:
    """Point ``name`` at a query, in one catalog operation. Its schema follows what it reads.

    A plain table under that name (from before tables had versions, or made by hand) steps
    aside first; it comes back if the view can't be made.
    """
    aside = None
    if table_exists(spark, name) and not _is_view(spark, name):
        aside = f"{name}__plain_{uuid.uuid4().hex[:8]}"
        _rename(spark, name, aside)
    given = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    try:
        spark.sql(f"CREATE OR REPLACE VIEW {name} WITH SCHEMA EVOLUTION TBLPROPERTIES ({given}) AS {select}")
    except BaseException:
        if aside:
            _rename(spark, aside, name)
        raise
    if aside:
        spark.sql(f"DROP TABLE IF EXISTS {aside}")


def _rename(spark: SparkSession, name: str, new: str) -> None:
    # the new name goes without the catalog, which a rename cannot change
    spark.sql(f"ALTER TABLE {name} RENAME TO {'.'.join(new.split('.')[-2:])}")


def _publish(spark: SparkSession, name: str, version: str) -> None:
    """Make ``version`` the current one of ``name`` and drop the one before the last."""
    held = _properties(spark, name)
    properties = {_VERSION: version}
    if _VERSION in held:
        properties[_PREVIOUS] = held[_VERSION]
    _place(spark, name, f"SELECT * FROM {version}", properties)
    if _PREVIOUS in held and held[_PREVIOUS] != version:
        spark.sql(f"DROP TABLE IF EXISTS {held[_PREVIOUS]}")


def _write(df: DataFrame, name: str, partition_by: Sequence[str] | None, together: bool = True) -> None:
    if partition_by and together:
        df = df.hint("rebalance", *[qcol(c) for c in partition_by])
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def _write_version(df: DataFrame, name: str, partition_by: Sequence[str] | None, together: bool = True) -> str:
    """``df`` written in full as a new, not yet current version of ``name``."""
    spark = df.sparkSession
    catalog, database, table = _split_name(spark, name)
    version = f"{_versions_database(spark, catalog, database)}.`{table}__v{uuid.uuid4().hex[:12]}`"
    try:
        _write(df, version, partition_by, together)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    return version


def _replace(df: DataFrame, name: str, partition_by: Sequence[str] | None = None) -> str:
    spark = df.sparkSession
    version = _write_version(df, name, partition_by)
    try:
        _publish(spark, name, version)
    except BaseException:
        if _properties(spark, name).get(_VERSION) != version:
            spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    return version


def drop_leftover_versions(spark: SparkSession, name: str) -> list[str]:
    """Drop versions of ``name`` that are neither current nor the one before it, such as those of a
    driver that died while it wrote. Not while another job replaces the same table."""
    catalog, database, table = _split_name(spark, name)
    versions = _versions_database(spark, catalog, database)
    keep = {v.rsplit(".", 1)[-1].strip("`") for v in _properties(spark, name).values()}
    names = [t.name for t in spark.catalog.listTables(versions) if t.name.startswith(f"{table}__v") and t.tableType != "VIEW"]
    gone = sorted(n for n in names if n not in keep)
    for n in gone:
        spark.sql(f"DROP TABLE IF EXISTS {versions}.`{n}`")
    return gone


def overwrite_table(
    df: DataFrame, name: str, partition_by: Sequence[str] | None = None, staged: bool = False
) -> None:
    """Replace table ``name`` (data and schema) with ``df``, in the session's
    ``spark.sql.sources.default`` format (parquet unless set otherwise).

    With ``partition_by`` the rows are first brought together by those columns (Spark's
    ``rebalance``, which splits a hot value again), so a value gets a few files and not one
    per task.

    ``staged=True`` writes a new version and repoints ``name`` to it once it is complete. Without it a
    plain table is overwritten, which removes the old files first; a name that has
    versions always gets a new one.
    """
    if staged or _is_view(df.sparkSession, name):
        _replace(df, name, partition_by)
    else:
        _write(df, name, partition_by)


def overwrite_counted(
    df: DataFrame, name: str, partition_by: Sequence[str] | None = None, staged: bool = False
) -> int:
    """:func:`overwrite_table` and return the number of rows written, from the files' footers."""
    spark = df.sparkSession
    if staged or _is_view(spark, name):
        return spark.table(_replace(df, name, partition_by)).count()
    _write(df, name, partition_by)
    return spark.table(name).count()


def overwrite_from_self(spark: SparkSession, df: DataFrame, name: str) -> int:
    """Overwrite ``name`` with a frame that reads ``name`` itself.

    The frame reads the current version while the new one is written, and the name moves
    over when that is complete.
    """
    return overwrite_counted(df, name, staged=True)


def write_parts(
    df: DataFrame, name: str, tables: Mapping[str, tuple[str, Sequence[str]]], partition_by: Sequence[str] | None = None
) -> str:
    """Write ``df``, which has an ``OUTCOME`` column, as one version partitioned by it, and place tables over its parts.

    ``tables`` maps a table name to its part and the columns it leaves out. All of them read through
    one pointer, ``{name}__parts`` among the versions, so one repoint moves them together. Returns the version.
    """
    spark = df.sparkSession
    catalog, database, table = _split_name(spark, name)
    pointer = f"{_versions_database(spark, catalog, database)}.`{table}__parts`"
    version = _write_version(df, name, [OUTCOME, *(partition_by or ())], together=bool(partition_by))
    try:
        _publish(spark, pointer, version)
    except BaseException:
        if _properties(spark, pointer).get(_VERSION) != version:
            spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    for target, (part, left_out) in tables.items():
        hidden = ", ".join(f"`{c}`" for c in (OUTCOME, *left_out))
        held = {_VERSION: pointer, "lendlayer.part": f"{part}:{hidden}"}
        if {k: v for k, v in _properties(spark, target).items() if k in held} != held:  # the first run, or other columns
            _place(spark, target, f"SELECT * EXCEPT ({hidden}) FROM {pointer} WHERE `{OUTCOME}` = '{part}'", held)
    return version


@dataclass(frozen=True)
class SplitCounts:
    rows_in: int
    rows_valid: int
    rows_duplicate: int
    rows_reject: int
    rows_unknown: int
    by_reason: dict[str, int]


def split_outcomes(split: QualitySplit) -> DataFrame:
    """Every row of a split once, with its outcome, its reason if rejected, and the copies it stands for.

    Clean rows are de-duplicated and counted; rejected and undecided rows stay single. One
    scan and one shuffle: an aggregate over whole rows in which every row that isn't clean
    has a number of its own.
    """
    status = F.col(STATUS)
    taken = [c for c in (OUTCOME, COPIES) if c in split.columns]
    if taken:
        raise ValueError(f"input already has columns {taken}")
    outcome = F.when(status == VALID, CLEAN_PART).when(status == UNKNOWN, UNKNOWN_PART).otherwise(REJECT_PART)
    reason = F.when(status.isin(*REASONS), status)
    single = F.monotonically_increasing_id() + 1
    own = F.when(status == VALID, F.lit(0).cast("long")).otherwise(single) if split.dedup else single
    rows = split.tagged.select(*[ref(c) for c in split.columns], reason.alias(REJECT_REASON), outcome.alias(OUTCOME), own.alias("__dq_own"))
    columns = [*[ref(c) for c in split.columns], REJECT_REASON, OUTCOME]
    return rows.groupBy(*columns, "__dq_own").agg(F.count(F.lit(1)).alias(COPIES)).select(*columns[:-1], COPIES, OUTCOME)


def outcome_counts(version: DataFrame) -> SplitCounts:
    """The counts of a split's committed version: two narrow columns of it."""
    found = version.groupBy(OUTCOME, REJECT_REASON).agg(F.count(F.lit(1)).alias("n"), F.sum(COPIES).alias("all")).collect()

    def of(field: str, part: str) -> int:
        return sum(r[field] for r in found if r[OUTCOME] == part)

    by_reason = {r[REJECT_REASON]: r["n"] for r in found if r[OUTCOME] == REJECT_PART}
    return SplitCounts(
        rows_in=sum(r["all"] for r in found),
        rows_valid=of("n", CLEAN_PART),
        rows_duplicate=of("all", CLEAN_PART) - of("n", CLEAN_PART),
        rows_reject=of("n", REJECT_PART),
        rows_unknown=of("n", UNKNOWN_PART),
        by_reason={r: by_reason.get(r, 0) for r in REASONS},
    )


def write_split(
    split: QualitySplit,
    silver_table: str,
    reject_table: str,
    partition_by: Sequence[str] | None = None,
    unknown_table: str | None = None,
    keep_tagged: bool = False,
) -> SplitCounts:
    """Write a split: clean rows to ``silver_table``, rejects (with reason) to ``reject_table``,
    undecided rows to ``unknown_table`` if one is named.

    One job reads the input once and writes one version partitioned by outcome, undecided rows
    included in any case; the tables are placed over its parts and move to a new run
    together. The rows come out of the de-duplication's shuffle, whose partitions AQE sizes;
    each writes a file per outcome it holds. With ``partition_by`` they are brought together by
    outcome and those columns first. ``keep_tagged`` is accepted for earlier callers: there is no second
    read that it could save.
    """
    hidden = (COPIES, REJECT_REASON)
    tables = {silver_table: (CLEAN_PART, hidden), reject_table: (REJECT_PART, (COPIES,))}
    if unknown_table:
        tables[unknown_table] = (UNKNOWN_PART, hidden)
    version = write_parts(split_outcomes(split), silver_table, tables, partition_by)
    return outcome_counts(split.tagged.sparkSession.table(version))
