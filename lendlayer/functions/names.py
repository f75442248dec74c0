"""Plan-time helpers over column names (run on the driver, touch no rows)."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


_PLAIN = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def ref(name: str) -> str:
    """``name`` as a column reference string: as is when plain, else back-quoted
    (a dot or space in a name is not a path). Strings in a ``select`` list cost no
    extra round trip to the JVM, unlike building a ``Column`` per name."""
    return name if _PLAIN.match(name) else "`" + name.replace("`", "``") + "`"


def qcol(name: str) -> Column:
    """The column called ``name`` (see :func:`ref`)."""
    return F.col(ref(name))


def normalize_name(name: str) -> str:
    """Strip, lower-case, spaces to underscores: ``' Borrower ID'`` -> ``'borrower_id'``."""
    return name.strip().lower().replace(" ", "_")


def normalize_column_names(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`normalize_name`.

    Two input names that normalise to one name would make later references
    ambiguous, so that is refused up front with the colliding names listed.
    """
    new_names = [normalize_name(c) for c in df.columns]
    sources = defaultdict(list)
    for old, new in zip(df.columns, new_names):
        sources[new].append(old)
    clashes = {new: olds for new, olds in sources.items() if len(olds) > 1}
    if clashes:
        raise ValueError(f"column names collide after normalisation: {clashes}")
    if new_names == df.columns:
        return df
    return df.toDF(*new_names)


def first_existing(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The first of ``candidates`` that is a column of ``df``, else ``None``."""
    present = set(df.columns)
    return next((c for c in candidates if c in present), None)


def id_columns(df: DataFrame, suffix: str = "_id") -> list[str]:
    """Columns whose name ends with ``suffix`` (the identifier columns), in order."""
    return [c for c in df.columns if c.endswith(suffix)]


def present_columns(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """``wanted`` restricted to columns of ``df``, in ``wanted`` order."""
    present = set(df.columns)
    return [c for c in wanted if c in present]


def has_columns(df: DataFrame, *names: str) -> bool:
    present = set(df.columns)
    return all(n in present for n in names)
