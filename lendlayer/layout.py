"""Where each layer's tables live: one database per layer, optionally at a shared location.

Naming follows the layered convention: silver ``{t}_cleaned``, reject ``{t}``,
gold ``{silver}_gold`` (i.e. ``{t}_cleaned_gold``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

LAYERS = ("bronze", "silver", "reject", "gold")


def silver_name(table: str) -> str:
    return f"{table}_cleaned"


def reject_name(table: str) -> str:
    return table


def undecided_name(table: str) -> str:
    """In the reject layer: rows that no rule rejects but some rule can't decide."""
    return f"{table}_undecided"


def versions_database(database: str) -> str:
    """The database that holds the versions behind ``database``'s tables."""
    return f"{database}__versions"


def gold_name(silver_table: str) -> str:
    return f"{silver_table}_gold"


@dataclass(frozen=True)
class Layout:
    """Maps (layer, table) to a qualified table name.

    ``prefix`` namespaces the four databases (``{prefix}bronze`` …) so several runs
    can share a catalog; ``location`` puts each database under a shared folder
    (``{location}/{layer}``) instead of the warehouse default; ``catalog`` names the catalog
    that holds them (default: the current one).
    """

    prefix: str = ""
    location: str | None = None
    catalog: str | None = None

    def database(self, layer: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}; expected one of {LAYERS}")
        return f"{self.catalog}.{self.prefix}{layer}" if self.catalog else f"{self.prefix}{layer}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{name}"

    def create(self, spark: SparkSession) -> Layout:
        for layer in LAYERS:
            where = f" LOCATION '{self.location}/{layer}'" if self.location else ""
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)}{where}")
        return self
