"""Catalog helpers: list a layer's tables by suffix, switch namespace, preview rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def list_tables(spark: SparkSession, database: str, suffix: str | None = None) -> list[str]:
    """Names of the tables in ``database`` (optionally only those ending with ``suffix``), sorted.

    Catalog metadata only (one name per table); no table data reaches the driver. The versions
    behind the tables live in a database of their own and are not listed.
    """
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    return sorted(n for n in names if suffix is None or n.endswith(suffix))


def tables_frame(spark: SparkSession, database: str, suffix: str | None = None) -> DataFrame:
    """``SHOW TABLES IN database`` filtered by suffix, as a DataFrame."""
    shown = spark.sql(f"SHOW TABLES IN {database}").select("namespace", "tableName")
    return shown if suffix is None else shown.filter(shown.tableName.endswith(suffix))


def use_namespace(spark: SparkSession, database: str, catalog: str | None = None) -> None:
    if catalog:
        spark.catalog.setCurrentCatalog(catalog)
    spark.catalog.setCurrentDatabase(database)


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows (the preview is the feature: a bounded sample for display)."""
    return df.limit(n)
