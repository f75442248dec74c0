"""Union by name of frames with different columns, and the archive of all tables' rejects."""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlayer.functions.names import ref

TABLE_NAME = "table_name"


def merged_columns(frames: Mapping[str, DataFrame]) -> dict[str, str]:
    """Every column of the frames, in the order they first come, with its type.

    A column that has different types in two frames is refused, with the types and where they
    are: a union would silently widen it.
    """
    found: dict[str, dict[str, str]] = {}
    for name, df in frames.items():
        for column, kind in df.dtypes:
            found.setdefault(column, {})[name] = kind
    clashes = {c: kinds for c, kinds in found.items() if len(set(kinds.values())) > 1}
    if clashes:
        raise TypeError(f"columns of different types: {clashes}")
    return {c: next(iter(kinds.values())) for c, kinds in found.items()}


def union_by_name(frames: Mapping[str, DataFrame], tag: str | None = TABLE_NAME) -> DataFrame:
    """All rows of the frames, duplicates kept; columns a frame lacks are nulls of their type.

    With ``tag`` a first column names the frame that a row is from. One union of
    projections: nothing is shuffled, and a filter on the tag leaves the other frames unread.
    """
    if not frames:
        raise ValueError("nothing to unite")
    columns = merged_columns(frames)
    if tag in columns:
        raise ValueError(f"a frame already has a column {tag!r}")
    parts = []
    for name, df in frames.items():
        present = set(df.columns)
        fitted = [ref(c) if c in present else F.lit(None).cast(kind).alias(c) for c, kind in columns.items()]
        parts.append(df.select(*([F.lit(name).alias(tag)] if tag else []), *fitted))
    return functools.reduce(DataFrame.unionByName, parts)
