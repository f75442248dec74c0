"""Key check at size: a partitioned sketch first, so that only keys possibly seen twice are counted.

Counting a key exactly sends every key to its counter, and almost all of them turn out to be
unique. Here a first pass sends bits instead. A key's 64-bit hash names a part and a
32-bit position in it; a task gathers the positions of its keys per part and sends each
part one row, a sorted list of four bytes a key, however often a key occurs in the task. A part's task
merges the lists: a position in two lists, or twice in one, is suspect. Suspects are
the repeated keys and a small share of others whose positions collide (with four million keys a part, one in a thousand).

In the second pass the scan meets the suspects in a broadcast join and only rows that
match, or whose key has a null, are shuffled and counted, exactly and by their whole
keys. The suspects are written first, so their number is known: beyond
``BROADCAST_ROWS`` they are not broadcast, and the keys are counted as :func:`key_check` does it, which is the better plan
when a large share of keys repeats.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlayer.functions.names import qcol
from lendlayer.operators.quality import any_null, key_check
from lendlayer.session import scratch_path

#: Suspects that are broadcast at most (12 bytes each), and hashes that a task gathers before it sends them.
BROADCAST_ROWS, GATHERED = 4_000_000, 4_000_000

_PART, _POSITION, _SUSPECT = "__key_part", "__key_position", "__key_suspect"


def _place(keys: Sequence[str], parts: int) -> list[Column]:
    """Part and position of a key: two separate ranges of bits of its hash."""
    nulls = F.array(*[qcol(k).isNull() for k in keys])  # the hash skips nulls
    h = F.xxhash64(nulls, *[qcol(k) for k in keys])
    part = F.pmod(F.shiftrightunsigned(h, 32), F.lit(parts))
    return [part.cast("int").alias(_PART), F.pmod(h, F.lit(1 << 32)).alias(_POSITION)]


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow map (part, position) -> per part the different positions, and those met twice here."""

    def sent(held: list[np.ndarray]) -> pa.RecordBatch:
        cells, n = np.unique(np.concatenate(held), return_counts=True)
        part, position = cells >> np.uint64(32), cells.astype(np.uint32)
        cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1])).tolist() + [len(part)]
        spans = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([int(part[s.start]) for s in spans], pa.int32()),
                pa.array([position[s].tobytes() for s in spans], pa.binary()),
                pa.array([position[s][n[s] > 1].tobytes() for s in spans], pa.binary()),
            ],
            names=["part", "positions", "twice"],
        )

    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        part, position = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.uint64) for i in (0, 1))
        held.append((part << np.uint64(32)) | position)
        size += batch.num_rows
        if size >= GATHERED:
            yield sent(held)
            held, size = [], 0
    if held:
        yield sent(held)


def _merge(table: pa.Table) -> pa.Table:
    """The suspect positions of one part."""
    read = lambda name: [np.frombuffer(x.as_buffer(), dtype=np.uint32) for x in table.column(name)]
    positions, n = np.unique(np.concatenate(read("positions")), return_counts=True)
    found = np.union1d(positions[n > 1], np.concatenate(read("twice")))
    part = np.full(len(found), table.column("part")[0].as_py(), dtype=np.int32)
    return pa.table({_PART: pa.array(part), _POSITION: pa.array(found.astype(np.int64))})


def suspects(df: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """Part and position of every key possibly seen twice. ``parts`` defaults to the session's shuffle partitions."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = df.select(*_place(keys, parts)).mapInArrow(_gather, "part int, positions binary, twice binary")
    return packed.groupBy("part").applyInArrow(_merge, f"{_PART} int, {_POSITION} long")


def suspect_rows(df: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame | None:
    """The rows whose key is suspect or has a null, by one scan and a broadcast join; None if there are too many suspects."""
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "suspects")
    suspects(df, keys, parts).write.parquet(path)
    found = spark.read.schema(f"{_PART} int, {_POSITION} long").parquet(path)
    if found.count() > BROADCAST_ROWS:
        return None
    marked = found.withColumn(_SUSPECT, F.lit(True)).withColumnsRenamed({_PART: "__s_part", _POSITION: "__s_position"})
    part, position = _place(keys, parts)
    rows = df.select("*", part, position)
    joined = rows.join(F.broadcast(marked), (F.col(_PART) == F.col("__s_part")) & (F.col(_POSITION) == F.col("__s_position")), "left")
    return joined.filter(F.col(_SUSPECT) | any_null(keys)).select(*[qcol(c) for c in df.columns])


def key_check_sketched(df: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """:func:`~lendlayer.operators.quality.key_check` (same rows) that shuffles suspects only."""
    narrow = df.select(*[qcol(k) for k in keys])
    rows = suspect_rows(narrow, keys, parts)
    return key_check(narrow if rows is None else rows, keys)
