"""Tables with a fixed schema, filled from literal rows or from a frame.

String values going into DATE / TIMESTAMP / numeric columns are cast explicitly
(ANSI store assignment refuses the implicit casts). An insert with a column list
fills the unlisted columns with typed nulls; a positional insert maps by order.
Seeding overwrites, so running a seed twice leaves one copy of the rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def create_table(spark: SparkSession, name: str, ddl: str, location: str | None = None) -> None:
    """``CREATE TABLE name (ddl)`` in the session's ``spark.sql.sources.default`` format, replacing an existing one."""
    view = spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType == "VIEW"
    spark.sql(f"DROP {'VIEW' if view else 'TABLE'} IF EXISTS {name}")
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE {name} ({ddl}){where}")


def conform(df: DataFrame, target: StructType, columns: Sequence[str] | None = None) -> DataFrame:
    """``df``'s columns cast to ``target``'s types, in ``target``'s order.

    With ``columns``, ``df``'s columns are matched by position to those names and
    every other target column is a typed null; without, ``df`` maps by position.
    """
    names = list(columns) if columns is not None else [f.name for f in target.fields]
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} values for {len(names)} columns {names}")
    unknown = [n for n in names if n not in target.fieldNames()]
    if unknown:
        raise ValueError(f"columns not in the table: {unknown}")
    source = dict(zip(names, df.columns))
    return df.select(
        *[
            (F.col(source[f.name]) if f.name in source else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )


def insert_frame(df: DataFrame, table: str, columns: Sequence[str] | None = None, overwrite: bool = False) -> None:
    """``INSERT [OVERWRITE] INTO table [(columns)] SELECT * FROM df`` with explicit casts."""
    target = df.sparkSession.table(table).schema
    conform(df, target, columns).write.insertInto(table, overwrite=overwrite)


def literal_rows(spark: SparkSession, rows: Iterable[Sequence[Any]], columns: Sequence[str]) -> DataFrame:
    """Literal rows as all-string columns (the text of a ``VALUES`` list); ``None`` stays null."""
    text = [tuple(None if v is None else str(v) for v in row) for row in rows]
    schema = StructType([StructField(c, StringType()) for c in columns])
    return spark.createDataFrame(text, schema)


def insert_rows(
    spark: SparkSession,
    table: str,
    rows: Iterable[Sequence[Any]],
    columns: Sequence[str] | None = None,
    overwrite: bool = False,
) -> None:
    """``INSERT INTO table [(columns)] VALUES …`` for a small literal seed."""
    names = list(columns) if columns is not None else spark.table(table).columns
    insert_frame(literal_rows(spark, rows, names), table, columns, overwrite)


def seed_table(
    spark: SparkSession,
    name: str,
    ddl: str,
    rows: Iterable[Sequence[Any]],
    columns: Sequence[str] | None = None,
    location: str | None = None,
) -> DataFrame:
    """Create ``name`` with ``ddl`` and fill it with ``rows``; returns the table."""
    create_table(spark, name, ddl, location)
    insert_rows(spark, name, rows, columns)
    return spark.table(name)
