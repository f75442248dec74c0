"""Repeated passages by a depth-limited radix sort of text suffixes.

A byte goes when it lies in a window of ``length`` bytes that also starts earlier: in a row
that comes before (by doc_id, then by a hash of the text for rows that share an id) or
earlier in the same text. Windows are judged on the input and never cross documents.

Suffixes are ordered by their first ``length`` bytes only, digit by digit, the most
significant digit first, and whatever stands alone in its group is done:

* The first digit deals suffixes to machines. It is the window's anchor: its least-hashed
  gram, so equal windows have the same anchor at the same distance. Neighbouring windows
  share an anchor, hence one row stands for a run of some thirty of them.
* The second digit is a fingerprint of the run's whole text. Runs that agree on both (128
  bits) are copies: all but the first are repeats as they stand. Runs alone with their
  anchor are unique. What is left, a few percent, are first copies whose anchor also
  stands in another context.
* These are read back from the texts, and their windows are ordered byte by byte, eight at
  a time: groups that are equal through ``length`` bytes are exactly the repeated windows.

Skew: copies within a task are settled there, so one copied passage sends a row per task. Anchors that
a sample of documents shows to be very common (at most ``HEAVY`` of them, which bounds what
is broadcast) are dealt by both digits. An anchor with more than ``wide`` contexts has its
windows dealt singly by their hash. Neither changes the result.

Null texts count as empty, and texts shorter than ``length`` lose nothing. Null ids come
first. Rows with the same id and text are one document, and each gets its result. Other
columns are not looked at. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlayer.llm.frames import keep, plain_documents, ready
from lendlayer.llm.textkit import BYTE, U64, Texts, _BASE, _INVERSE, _power_table, column_texts, mix, span_hashes

#: Most anchors that are dealt by two digits from the start.
HEAVY = 1 << 20
#: One document in so many is looked at for them.
SAMPLE = 64
#: Contexts of one anchor that are ordered together; beyond, windows are dealt singly.
WIDE = 2048
#: Windows of a long text that are hashed at a time, and runs that a task gathers before it settles copies.
CHUNK, GATHER = 1 << 20, 1 << 20
#: Windows that are ordered at a time (whole groups; one group may be longer).
SORTED = 1 << 20

_OTHER = mix(BYTE ^ U64(0xA24BAED4963EE407))
_RUN = 16  # a run is its start and its number of windows in one long
_NONE = np.iinfo(np.int64).min

_ANCHORS = "g long, s long, doc_id long, sub int, run long, settled boolean"
_LINKS = "doc_id long, sub int, run long, g long, wide boolean, settled boolean"
_SEGMENTS = "g long, k long, doc_id long, sub int, run long, bytes binary"
_RUNS = "doc_id long, sub int, run long"


def _gram_hashes(symbols: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all ``k``-byte grams."""
    n = len(symbols)
    sums = np.zeros(n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(symbols * _power_table(_BASE, n), out=sums[1:])
        return mix((sums[k:] - sums[:-k]) * _power_table(_INVERSE, n + 1)[: n - k + 1])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    if size < width:
        values = np.minimum(values[: len(values) - (width - size)], values[width - size :])
    return values


def anchor_runs(texts: Texts, length: int, gram: int):
    """(anchor hash, fingerprint, row, start in row, windows) of every run of windows with one anchor."""
    size = len(texts.data)
    found = []
    for c in range(0, size - length + 1, CHUNK):
        data = texts.data[c : c + CHUNK + length - 1]
        h = _gram_hashes(BYTE[data], gram)
        # the leftmost of the least: the position breaks ties
        low = U64((1 << 21) - 1)
        at = (_least((h & ~low) | np.arange(len(h), dtype=np.uint64), length - gram + 1) & low).astype(np.int64)
        begun = np.zeros(len(at), dtype=np.int64)
        inner = texts.offsets[(texts.offsets > c) & (texts.offsets < c + len(at))]
        np.add.at(begun, inner - c, 1)
        row = np.searchsorted(texts.offsets, c, side="right") - 1 + np.cumsum(begun)
        i = np.flatnonzero(np.arange(c + length, c + length + len(at)) <= texts.offsets[row + 1])
        if not len(i):
            continue
        anchor = at[i]
        cut = np.ones(len(i), dtype=bool)
        cut[1:] = (anchor[1:] != anchor[:-1]) | (i[1:] != i[:-1] + 1) | (row[i[1:]] != row[i[:-1]])
        first = np.flatnonzero(cut)
        n = np.diff(np.append(first, len(i)))
        a, j = i[first], anchor[first]
        s = mix(span_hashes(_OTHER[data], a, a + n - 1 + length) + (j - a).astype(np.uint64))
        found.append((h[j], s, row[a], a + c - texts.offsets[row[a]], n))
    return found


def _ids(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Ids as numbers that order like the rows (null first)."""
    return column.fill_null(_NONE).to_numpy(zero_copy_only=False).astype(np.int64)


def _id_array(ids: np.ndarray) -> pa.Array:
    return pa.array(ids, mask=ids == _NONE)


def _anchors(length: int, gram: int):
    """Arrow map (doc_id, sub, text) -> runs; of copies that meet here all but the first are settled."""

    def settle(parts: list) -> pa.RecordBatch:
        g, s, doc, sub, a, n = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((a, sub, doc, s, g))
        g, s, doc, sub, a, n = (x[order] for x in (g, s, doc, sub, a, n))
        settled = np.zeros(len(g), dtype=bool)
        settled[1:] = (g[1:] == g[:-1]) & (s[1:] == s[:-1])
        same = np.zeros(len(g), dtype=bool)  # a row that is the very same document's
        same[1:] = settled[1:] & (doc[1:] == doc[:-1]) & (sub[1:] == sub[:-1]) & (a[1:] == a[:-1])
        one = ~same
        arrays = [
            pa.array(g.view(np.int64)[one]), pa.array(s.view(np.int64)[one]), _id_array(doc[one]), pa.array(sub[one]),
            pa.array(((a << _RUN) | n)[one]), pa.array(settled[one]),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=["g", "s", "doc_id", "sub", "run", "settled"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            ids, subs = _ids(batch.column("doc_id")), batch.column("sub").to_numpy(zero_copy_only=False)
            for texts in column_texts(batch.column("text")):
                for g, s, row, a, n in anchor_runs(texts, length, gram):
                    at = texts.first + row
                    parts.append((g, s, ids[at], subs[at], a, n))
                    held += len(g)
                    if held >= GATHER:
                        yield settle(parts)
                        parts, held = [], 0
        if parts:
            yield settle(parts)

    return work


def _groups(columns: list[str], least: int):
    """Cut a sorted stream of batches into tables of at least ``least`` rows that hold whole groups of ``columns``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, rows, enough = [], 0, least
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows < enough:
                continue
            table = pa.Table.from_batches(held)
            keys = [table.column(c).to_numpy() for c in columns]
            change = np.zeros(rows - 1, dtype=bool)
            for k in keys:
                change |= k[1:] != k[:-1]
            at = np.flatnonzero(change)
            if not len(at):
                enough = 2 * rows  # one long group: look again when it has doubled
                continue
            end = int(at[-1]) + 1
            yield table.slice(0, end)
            enough = least
            held, rows = table.slice(end).to_batches(), table.num_rows - end
        if held:
            yield pa.Table.from_batches(held)

    return cut


def _link(wide: int):
    """Arrow map over runs sorted by anchor, fingerprint and place: the settled ones, and first copies in several contexts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(["g", "salt"], 1 << 16)(batches):
            g, salt, s = (table.column(c).to_numpy() for c in ("g", "salt", "s"))
            doc, sub, run = _ids(table.column("doc_id").combine_chunks()), table.column("sub").to_numpy(), table.column("run").to_numpy()
            n = len(g)
            group = np.ones(n, dtype=bool)
            group[1:] = (g[1:] != g[:-1]) | (salt[1:] != salt[:-1])
            context = group.copy()
            context[1:] |= s[1:] != s[:-1]
            number = np.cumsum(group) - 1
            contexts = np.bincount(number[context], minlength=number[-1] + 1)[number]
            head = np.maximum.accumulate(np.where(context, np.arange(n), 0))
            itself = (doc == doc[head]) & (sub == sub[head]) & (run == run[head])
            done = (salt < 0) | ~itself
            out = done | (context & ((salt > 0) | (contexts > 1)))
            yield pa.RecordBatch.from_arrays(
                [
                    _id_array(doc[out]), pa.array(sub[out]), pa.array(run[out]), pa.array(g[out]),
                    pa.array(((salt > 0) | (contexts > wide))[out]), pa.array(done[out]),
                ],
                names=["doc_id", "sub", "run", "g", "wide", "settled"],
            )

    return work


def equal_windows(data: np.ndarray, start: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Order windows of one ``group`` by their ``length`` bytes, most significant digits first.

    Gives the indexes of windows that equal another one of their group, and the number of
    their class; what stands alone leaves after the pass that shows it.
    """
    digits = np.zeros(len(data) - 7, dtype=np.uint64)
    for j in range(8):
        digits = (digits << U64(8)) | data[j : len(data) - 7 + j]
    alive = np.arange(len(start))
    for depth in range(0, length, 8):
        if not len(alive):
            break
        digit = digits[start + min(depth, length - 8)]
        order = np.lexsort((digit, group))
        digit, group = digit[order], group[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (digit[1:] != digit[:-1]) | (group[1:] != group[:-1])
        label = np.cumsum(new) - 1
        more = (np.bincount(label) > 1)[label]
        alive, start, group = alive[order][more], start[order][more], label[more]
    return alive, group


def _windows(table: pa.Table, length: int):
    """The windows of a table of segments: bytes, and of each window its place there, its segment and its start."""
    column = table.column("bytes").combine_chunks()
    _, where, values = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(values, dtype=np.uint8)[offsets[0] : offsets[-1]]
    run = table.column("run").to_numpy()
    a, n = run >> _RUN, run & ((1 << _RUN) - 1)
    segment = np.repeat(np.arange(len(run)), n)
    nth = np.arange(len(segment)) - np.repeat(np.cumsum(n) - n, n)
    return data, (offsets[:-1] - offsets[0])[segment] + nth, segment, a[segment] + nth


def _later(table: pa.Table, keys: list[str], length: int) -> tuple[np.ndarray, ...]:
    """Windows of a table of segments and whether each equals one of an earlier place in its group."""
    data, at, segment, start = _windows(table, length)
    change = np.zeros(table.num_rows, dtype=np.int64)
    for c in keys:
        k = table.column(c).to_numpy()
        change[1:] |= k[1:] != k[:-1]
    again, label = equal_windows(data, at, np.cumsum(change)[segment], length)
    doc, sub = _ids(table.column("doc_id").combine_chunks())[segment], table.column("sub").to_numpy()[segment]
    order = np.lexsort((start[again], sub[again], doc[again], label))
    again, label = again[order], label[order]
    new = np.ones(len(again), dtype=bool)
    new[1:] = label[1:] != label[:-1]
    head = again[np.maximum.accumulate(np.where(new, np.arange(len(again)), 0))]
    later = np.zeros(len(at), dtype=bool)
    later[again] = (doc[again] != doc[head]) | (sub[again] != sub[head]) | (start[again] != start[head])
    return data, at, segment, start, doc, sub, later


def _run_batch(doc: np.ndarray, sub: np.ndarray, segment: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Windows in order as runs."""
    new = np.ones(len(start), dtype=bool)
    new[1:] = (segment[1:] != segment[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(start)))
    return pa.RecordBatch.from_arrays(
        [_id_array(doc[first]), pa.array(sub[first]), pa.array((start[first] << _RUN) | n)], names=["doc_id", "sub", "run"]
    )


def _order(length: int):
    """Arrow map over segments sorted by key: runs of windows that also start earlier."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(["g", "k"], SORTED // 32)(batches):
            settled = pc.equal(pc.binary_length(table.column("bytes")), 0)
            if pc.any(settled).as_py():
                yield from table.filter(settled).select(["doc_id", "sub", "run"]).to_batches()
                table = table.filter(pc.invert(settled))
                if not table.num_rows:
                    continue
            _, _, segment, start, doc, sub, later = _later(table, ["g", "k"], length)
            if later.any():
                yield _run_batch(doc[later], sub[later], segment[later], start[later])

    return work


def _segments(length: int):
    """Arrow map (doc_id, sub, text, todo) -> the bytes of the runs to do; those of wide anchors window by window."""

    def table_of(rows: list) -> pa.Table:
        kinds = {"g": pa.int64(), "doc_id": pa.int64(), "sub": pa.int32(), "run": pa.int64(), "bytes": pa.binary()}
        return pa.table({name: pa.array(cells, kind) for (name, kind), cells in zip(kinds.items(), zip(*rows))})

    def batch_of(g, k, doc, sub, run, cells) -> pa.RecordBatch:
        arrays = [pa.array(g, pa.int64()), pa.array(k, pa.int64()), doc, pa.array(sub, pa.int32()), pa.array(run, pa.int64()), cells]
        return pa.RecordBatch.from_arrays(arrays, names=["g", "k", "doc_id", "sub", "run", "bytes"])

    def single(rows: list) -> Iterator[pa.RecordBatch]:
        """The different windows of these segments at their first places; the others, settled, without bytes."""
        table = table_of(sorted(rows, key=lambda r: r[0]))
        data, at, segment, start, doc, sub, later = _later(table, ["g"], length)
        g, first = table.column("g").to_numpy()[segment], ~later
        h = span_hashes(_OTHER[data], at, at + length).view(np.int64)
        cells = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, length)[at[first]])
        texts = pa.Array.from_buffers(pa.binary(length), len(cells), [None, pa.py_buffer(cells)]).cast(pa.binary())
        yield batch_of(g[first], h[first], _id_array(doc[first]), sub[first], (start[first] << _RUN) | 1, texts)
        done = _run_batch(doc[later], sub[later], segment[later], start[later])
        n = done.num_rows
        yield batch_of(np.zeros(n, np.int64), np.arange(n), done.column(0), done.column(1), done.column(2), pa.array([b""] * n, pa.binary()))

    def whole(rows: list) -> pa.RecordBatch:
        table = table_of(rows).combine_chunks()
        g, doc, sub, run, cells = (table.column(c).combine_chunks() for c in ("g", "doc_id", "sub", "run", "bytes"))
        return batch_of(g, np.zeros(len(rows), np.int64), doc, sub, run, cells)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        narrow, wide = [], []
        for batch in batches:
            for doc, sub, text, todo in zip(*(batch.column(c) for c in ("doc_id", "sub", "text", "todo"))):
                raw = text.as_buffer().to_pybytes()
                doc, sub = doc.as_py(), sub.as_py()
                for item in todo.as_py():
                    a, n = item["run"] >> _RUN, item["run"] & ((1 << _RUN) - 1)
                    (wide if item["wide"] else narrow).append((item["g"], doc, sub, item["run"], raw[a : a + n - 1 + length]))
                if len(narrow) >= 1 << 14:
                    yield whole(narrow)
                    narrow = []
                if len(wide) >= 1 << 12:
                    yield from single(wide)
                    wide = []
        if narrow:
            yield whole(narrow)
        if wide:
            yield from single(wide)

    return work


def _sub() -> Column:
    return F.pmod(F.xxhash64("text"), F.lit(2**31 - 1)).cast("int")


def repeated_runs(docs: DataFrame, length: int = 100, wide: int = WIDE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, sub, runs``: per text (``sub`` is the hash of its text) the runs of windows that start earlier too.

    A run is ``start * 65536 + windows``.
    """
    if length < 16 or length >= 1 << _RUN:
        raise ValueError(f"length must be from 16 to {(1 << _RUN) - 1}, got {length}")
    spark = ready(docs.sparkSession)
    gram = 2 * length // 5
    plain = plain_documents(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("sub", _sub())
    long_enough = plain.filter(F.octet_length("text") >= length)

    some = long_enough.filter(F.pmod(F.xxhash64("doc_id", "sub"), F.lit(SAMPLE)) == 0)
    common = some.mapInArrow(_anchors(length, gram), _ANCHORS).filter("not settled").groupBy("g").count()
    common = keep(common.filter(F.col("count") >= SAMPLE).orderBy(F.desc("count"), "g").limit(HEAVY).select("g", F.lit(True).alias("heavy")), "common")

    runs = long_enough.mapInArrow(_anchors(length, gram), _ANCHORS).join(F.broadcast(common), "g", "left")
    spread = F.lit(HEAVY)
    salt = (
        F.when(F.col("settled"), -1 - F.pmod(F.xxhash64("doc_id", "run"), spread))
        .when(F.col("heavy"), 1 + F.pmod(F.col("s"), spread))
        .otherwise(F.lit(0).cast("long"))
    )
    dealt = runs.select("g", salt.alias("salt"), "s", "doc_id", "sub", "run").repartition("g", "salt")
    links = keep(dealt.sortWithinPartitions("g", "salt", "s", "doc_id", "sub", "run").mapInArrow(_link(wide), _LINKS), "links")

    todo = links.filter("not settled").groupBy("doc_id", "sub").agg(F.collect_list(F.struct("run", "g", "wide")).alias("todo"))
    todo = todo.withColumnsRenamed({"doc_id": "t_id", "sub": "t_sub"})
    held = long_enough.join(todo, F.col("doc_id").eqNullSafe(F.col("t_id")) & (F.col("sub") == F.col("t_sub")))
    parts = held.select("doc_id", "sub", "text", "todo").mapInArrow(_segments(length), _SEGMENTS)
    ordered = parts.repartition("g", "k").sortWithinPartitions("g", "k").mapInArrow(_order(length), _RUNS)
    found = keep(ordered, "repeats").unionByName(links.filter("settled").select("doc_id", "sub", "run"))
    return found.groupBy("doc_id", "sub").agg(F.collect_list("run").alias("runs"))


def _cut(length: int):
    """Arrow map (doc_id, text, runs) -> doc_id, text, spans (start, end of removed bytes), kept bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            spans, kept = [], []
            for text, runs in zip(batch.column("text"), batch.column("runs")):
                raw = text.as_buffer().to_pybytes()
                if not runs.is_valid:
                    spans.append([])
                    kept.append(raw)
                    continue
                run = np.sort(runs.values.to_numpy(zero_copy_only=False))
                a = run >> _RUN
                b = np.maximum.accumulate(a + (run & ((1 << _RUN) - 1)) - 1 + length)
                new = np.ones(len(a), dtype=bool)
                new[1:] = a[1:] > b[:-1]
                first = np.flatnonzero(new)
                a, b = a[first], b[np.append(first[1:], len(b)) - 1]
                edges = [0, *np.stack([a, b], axis=1).ravel().tolist(), len(raw)]
                spans.append([{"start": x, "end": y} for x, y in zip(edges[1:-1:2], edges[2:-1:2])])
                kept.append(b"".join(raw[x:y] for x, y in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(spans, kind), pa.array(kept, pa.binary())],
                names=["doc_id", "text", "spans", "kept"],
            )

    return work


def remove_repeats(docs: DataFrame, length: int = 100, wide: int = WIDE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, spans, kept``: per row the byte spans (end exclusive) that repeat earlier text and the other bytes."""
    runs = repeated_runs(docs, length, wide, id_col, text_col).withColumnsRenamed({"doc_id": "r_id", "sub": "r_sub"})
    plain = plain_documents(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("sub", _sub())
    joined = plain.join(runs, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("sub") == F.col("r_sub")), "left")
    schema = "doc_id long, text string, spans array<struct<start: long, end: long>>, kept binary"
    return joined.select("doc_id", "text", "runs").mapInArrow(_cut(length), schema)


def repeat_digest(removed: DataFrame) -> DataFrame:
    """Sizes and the hash of what stays, per row of :func:`remove_repeats`."""
    n_removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])
    return removed.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), n_removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
