"""Frame standardisation: normalised names, trimmed strings, repaired officer ids.

All of it is one projection each, so Catalyst keeps it inside whole-stage codegen
and the scan still prunes columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lendlayer.functions.names import normalize_column_names, qcol, ref

# The officer-id repair. Unguarded: every 'O' becomes '0'.
# Guarded: only a leading 'O' of ids shaped like O<digits>.
OFFICER_LETTER = "O"
OFFICER_DIGIT = "0"
OFFICER_SHAPE = "^O[0-9]+$"
OFFICER_PREFIX = "^O"


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim spaces around the value of every string column (chosen by type)."""
    string_cols = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    if not string_cols:
        return df
    return df.select(
        [F.trim(qcol(c)).alias(c) if c in string_cols else ref(c) for c in df.columns]
    )


def standardize(df: DataFrame) -> DataFrame:
    """Normalise column names, then trim every string column."""
    return trim_strings(normalize_column_names(df))


def officer_id_expr(column: str = "officer_id", guarded: bool = False) -> Column:
    """``'O102'`` -> ``102``; ids that do not parse become null (never an error)."""
    text = F.col(column).cast("string")
    if guarded:
        repaired = F.when(
            text.rlike(OFFICER_SHAPE), F.regexp_replace(text, OFFICER_PREFIX, OFFICER_DIGIT)
        ).otherwise(text)
    else:
        # every 'O' -> '0': a character mapping, no regex per row
        repaired = F.translate(text, OFFICER_LETTER, OFFICER_DIGIT)
    return repaired.try_cast("int")


def normalize_officer_id(df: DataFrame, column: str = "officer_id", guarded: bool = False) -> DataFrame:
    """Replace ``column`` by its integer form, in place (a no-op if the column is absent).

    Idempotent: an integer id goes through string and back unchanged.
    """
    if column not in df.columns:
        return df
    return df.withColumn(column, officer_id_expr(column, guarded))


OFFICER_KEY = "officer_key"


def add_officer_key(df: DataFrame, column: str = "officer_id") -> DataFrame:
    """Add the integer form of ``column`` as ``officer_key``, keeping the id as it came
    (a no-op if the column is absent)."""
    if column not in df.columns:
        return df
    return df.withColumn(OFFICER_KEY, officer_id_expr(column))
