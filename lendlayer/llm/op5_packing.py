"""Best-fit packing with certified bin counts.

Documents are encoded, ended with one separator id and cut (only those longer than a
sequence) so that all pieces but the first are full. The pieces are dealt by hash to
partitions of bounded size (by a number they get when they are written, so null and repeated
ids spread like any other) and packed there by best-fit decreasing. Dual feasible
functions give a lower bound of each partition's bins: where the count meets it, the
packing is proven best and stays. Partitions with a gap, and bins less than half full,
give their unfilled bins up: those pieces are dealt anew over fewer, mixed partitions and
packed again, for a few rounds or until no gap is left. A rerun that needs more bins than it
replaces is dropped. Every row says how many bins its partition has and the bound, so what is
left uncertified can be seen.

A partition holds a bounded number of small rows (ids travel only in
:func:`sequences`), so a hot source or one huge document changes nothing.

Null text counts as empty and gives the one separator; null ids pass through; repeated
rows are packed once each; an empty table packs to an empty one. Extra columns are not
looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlayer.llm import bpe
from lendlayer.llm.frames import keep, plain_documents, ready
from lendlayer.llm.op6_token_counts import blocks

SEPARATOR = 0
#: Pieces in a partition, about: its packing is one task's work on a few MB.
PIECES_PER_PARTITION = 1 << 16


def tokenize_pieces(
    docs: DataFrame, path: str, capacity: int = 2048, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and optionally ids.

    A document of n ids (its separator included) has ceil(n / capacity) pieces; the first
    takes what is left over, the others are full.
    """
    ready(docs.sparkSession)
    plain = plain_documents(docs, id_col, text_col)
    id_type = plain.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = bpe.coder(path)
        end = np.array([SEPARATOR], dtype="<u4")
        for batch in batches:
            first = 0
            for block in blocks(batch.column(1).to_pylist()):
                source, piece, start, length, crc, ids = [], [], [], [], [], []
                for k, found in enumerate(made.ids(block)):
                    every = np.concatenate([found.astype("<u4", copy=False), end])
                    n = len(every)
                    head = n % capacity or capacity
                    edges = [0, *range(head, n + 1, capacity)]
                    for p, (a, b) in enumerate(zip(edges, edges[1:])):
                        source.append(first + k)
                        piece.append(p)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(every[a:b].tobytes()))
                        if with_ids:
                            ids.append(every[a:b].astype(np.int32))
                columns = [
                    batch.column(0).take(pa.array(source, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)
                first += len(block)

    return plain.mapInArrow(cut, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each item, and the fill of each bin.

    Open bins are kept by free space; one bit of an integer says which spaces occur.
    """
    order = np.argsort(-lengths, kind="stable")
    place, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces, free = 0, []
    for item, size in zip(order.tolist(), lengths[order].tolist()):
        fitting = spaces >> size
        if fitting:
            space = size + (fitting & -fitting).bit_length() - 1
            b = by_space[space].pop()
            if not by_space[space]:
                spaces ^= 1 << space
        else:
            space, b = capacity, len(free)
            free.append(capacity)
        place[item], offset[item] = b, capacity - space
        left = free[b] = space - size
        if left:
            by_space[left].append(b)
            spaces |= 1 << left
    return place, offset, capacity - np.array(free, dtype=np.int64)


def bin_bound(lengths: np.ndarray, capacity: int) -> int:
    """A number of bins that no packing can beat: the best of two families of dual feasible functions.

    Rounding by a threshold t: items over capacity - t count as whole bins, items under t
    as nothing, others as they are. Rounding by k: multiples of 1/(k+1) stay, the rest goes
    down to the multiple of 1/(k+1) below, scaled to 1/k.
    """
    if not len(lengths):
        return 0
    amount = np.bincount(lengths, minlength=capacity + 1)[: capacity + 1].astype(np.int64)
    size = np.arange(capacity + 1)
    count, weight = np.cumsum(amount), np.cumsum(amount * size)
    t = np.arange(0, capacity // 2 + 1)
    whole = count[-1] - count[capacity - t]
    below = np.where(t > 0, weight[np.maximum(t - 1, 0)], 0)
    best = int((whole * capacity + weight[capacity - t] - below).max())
    best = -(-best // capacity)
    for k in range(1, 33):
        scaled = (k + 1) * size
        value = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)  # in units of 1 / (k * capacity)
        best = max(best, -(-int((amount * value).sum()) // (k * capacity)))
    return best


def _deal(pieces: DataFrame, rows: int, seed: int, capacity: int) -> DataFrame:
    """Pack ``pieces`` in hash partitions of about :data:`PIECES_PER_PARTITION` rows."""
    parts = max(1, -(-rows // PIECES_PER_PARTITION))
    id_type = pieces.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, nr bigint, round int, part bigint, "
        "bin bigint, offset bigint, fill bigint, n_bins bigint, bound bigint"
    )

    def pack(rows: pa.Table) -> pa.Table:
        lengths, number = rows.column("length").to_numpy(), rows.column("nr").to_numpy()
        order = np.lexsort((number, -lengths))
        rows, lengths = rows.take(pa.array(order)), lengths[order]
        place, offset, fill = best_fit(lengths, capacity)
        part, n = rows.column("part")[0].as_py(), rows.num_rows
        made = {
            "round": pa.array(np.full(n, seed, np.int32)), "part": pa.array(np.full(n, part, np.int64)), "bin": pa.array(np.asarray(place, np.int64)),
            "offset": pa.array(np.asarray(offset, np.int64)), "fill": pa.array(np.asarray(fill[place], np.int64)),
            "n_bins": pa.array(np.full(n, len(fill), np.int64)), "bound": pa.array(np.full(n, bin_bound(lengths, capacity), np.int64)),
        }
        kept = rows.select(["doc_id", "piece", "start", "length", "ids_crc32", "nr"])
        return pa.table({**{c: kept.column(c) for c in kept.column_names}, **made})

    part = F.pmod(F.xxhash64("nr", F.lit(seed)), F.lit(parts)).alias("part")
    return pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "nr", part).groupBy("part").applyInArrow(pack, schema)


def _bins(packed: DataFrame) -> int:
    return packed.select("round", "part", "bin").distinct().count()


def pack_pieces(pieces: DataFrame, capacity: int = 2048, rounds: int = 3) -> DataFrame:
    """Adds sequence_id and offset to the rows of :func:`tokenize_pieces` (without ids), with their partition's bins and lower bound."""
    pieces = keep(pieces.withColumn("nr", F.monotonically_increasing_id()), "pieces")
    # A full piece is a sequence of its own and certified by itself.
    packed = keep(_deal(pieces, pieces.count(), 0, capacity), "packed")
    settled: list[DataFrame] = []
    for seed in range(1, rounds + 1):
        given = (F.col("fill") < capacity) & ((F.col("n_bins") > F.col("bound")) | (2 * F.col("fill") <= capacity))
        pool = packed.filter(given)
        rows, bins, gaps = pool.agg(
            F.count("*"), F.count_distinct("part", "bin"), F.count_distinct(F.when(F.col("n_bins") > F.col("bound"), F.col("part")))
        ).first()
        if bins < 2 or (seed > 1 and not gaps):
            break
        again = keep(_deal(pool, rows, seed, capacity), "repacked")
        if _bins(again) >= bins:
            break
        settled.append(packed.filter(~given))
        packed = again
    for other in settled:
        packed = packed.unionByName(other)
    sequence = F.shiftleft(F.col("round").cast("long"), 58) + F.shiftleft(F.col("part"), 24) + F.col("bin")
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", sequence.alias("sequence_id"), "offset", F.col("n_bins").alias("part_bins"), F.col("bound").alias("part_bound")
    )


def pack_documents(docs: DataFrame, path: str, capacity: int = 2048, rounds: int = 3, **columns: str) -> DataFrame:
    return pack_pieces(tokenize_pieces(docs, path, capacity, **columns), capacity, rounds)


def sequences(docs: DataFrame, packed: DataFrame, path: str, capacity: int = 2048, **columns: str) -> DataFrame:
    """The training sequences: sequence_id, ids (at most ``capacity``), pieces (doc_id and length in order).

    Expects ids to be unique; a sequence gathers at most ``capacity`` ids.
    """
    pieces = tokenize_pieces(docs, path, capacity, with_ids=True, **columns).select("doc_id", "piece", "ids")
    rows = packed.join(pieces, ["doc_id", "piece"]).select("sequence_id", F.struct("offset", "doc_id", "length", "ids").alias("x"))
    one = rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list("x")).alias("x"))
    return one.select(
        "sequence_id", F.flatten("x.ids").alias("ids"), F.transform("x", lambda v: F.struct(v["doc_id"], v["length"])).alias("pieces")
    )
