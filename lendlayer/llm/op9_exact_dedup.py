"""Exact de-duplication by composable polynomial fingerprints and streamed comparison.

Texts are equal when they are the same after each run of ``[\\x20\\x09-\\x0D]`` is replaced by
one space. The fingerprint of a normalised text is a polynomial in its bytes modulo two
primes, and that of a concatenation follows from its parts: shift the first by the length
of the second and add. So chunks are hashed on their own; those of a huge text as separate
rows spread over the cluster, and only their hashes come together.

Equal fingerprints are not trusted: every text of a group is compared chunk by chunk with
the text that would stay. The chunks of a group are dealt to salted buckets that each hold
a copy of that text's chunk, so neither a huge text nor a huge group meets in one task.
Of rows that repeat both id and text one is compared, however many they are.
Texts that differ from it after all are told apart by their digests.

Null text counts as empty, and empty texts equal each other. A null id is greater than any
other; a group without ids has a null ``keep_id`` and keeps its rows. Rows that repeat both
id and text count towards ``group_size`` and are all marked kept (:func:`drop_copies` lets one
of them stay). An empty table gives an empty one. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlayer.llm.frames import keep, ready, text_of

PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 69069069)
CHUNK_BYTES = 1 << 16
#: Texts of more bytes are hashed as separate chunk rows.
HUGE_BYTES = 1 << 16
#: Texts compared with one copy of a group's first text.
COMPARED_TOGETHER = 128

_BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_powers: list[np.ndarray] = []


def normalise(raw: bytes) -> bytes:
    """Each run of the six ASCII blanks as one space."""
    inner = b" ".join(raw.split())
    if raw[:1].isspace():
        inner = b" " + inner
    if inner.strip() and raw[-1:].isspace():
        inner += b" "
    return inner


def chunk_hash(chunk: bytes) -> tuple[int, int]:
    """Polynomial of one chunk of at most :data:`CHUNK_BYTES` bytes, modulo each prime."""
    if not _powers:
        for prime, base in zip(PRIMES, BASES):
            table = np.ones(CHUNK_BYTES, dtype=np.uint64)
            for i in range(1, CHUNK_BYTES):
                table[i] = int(table[i - 1]) * base % prime
            _powers.append(table[::-1].copy())
    # a byte below 2**9 times a power below 2**31, 2**16 times: no sum leaves 64 bits
    values = np.frombuffer(chunk, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    n = len(values)
    return tuple(int(np.dot(values, p[CHUNK_BYTES - n :])) % prime for p, prime in zip(_powers, PRIMES))


def combine(parts: list[tuple[int, int, int]]) -> tuple[int, int]:
    """Fingerprint of a text from the (length, hash, hash) of its chunks in order."""
    out = [0, 0]
    for n, *hashes in parts:
        for k, (prime, base) in enumerate(zip(PRIMES, BASES)):
            out[k] = (out[k] * pow(base, n, prime) + hashes[k]) % prime
    return out[0], out[1]


def chunks_of(text: bytes) -> Iterator[bytes]:
    for i in range(0, max(len(text), 1), CHUNK_BYTES):
        yield text[i : i + CHUNK_BYTES]


def fingerprint(text: bytes) -> int:
    """62 bits of a normalised text."""
    a, b = combine([(len(c), *chunk_hash(c)) for c in chunks_of(text)])
    return a << 31 | b


def _binary(column: pa.Array) -> list[bytes]:
    return column.cast(pa.binary()).to_pylist()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, raw (hash of the text as it is), fp, n_bytes and text_sha256 of the normalised text."""
    ready(docs.sparkSession)
    text = text_of(text_col)
    plain = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("raw"), text.alias("text"))
    id_type = plain.schema["doc_id"].dataType.simpleString()
    small = plain.filter(F.octet_length("text") <= HUGE_BYTES)
    huge = plain.filter(F.octet_length("text") > HUGE_BYTES)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, size, sha = [], [], []
            for raw in _binary(batch.column(2)):
                text = normalise(raw)
                fp.append(fingerprint(text))
                size.append(len(text))
                sha.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fp, pa.int64()), pa.array(size, pa.int64()), pa.array(sha, pa.string())],
                ["doc_id", "raw", "fp", "n_bytes", "text_sha256"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                text = normalise(_binary(batch.column(3).slice(row, 1))[0])
                sha = hashlib.sha256(text).hexdigest()
                parts = list(chunks_of(text))
                n = len(parts)
                same = pa.array([row] * n, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).take(same) for k in range(3)] + [pa.array([sha] * n), pa.array(range(n), pa.int64()), pa.array(parts, pa.binary())],
                    ["row", "doc_id", "raw", "text_sha256", "seq", "chunk"],
                )

    def hash_chunks(chunk: pa.Array) -> pa.Array:
        made = [(len(c), *chunk_hash(c)) for c in chunk.to_pylist()]
        return pa.array([{"n": n, "a": a, "b": b} for n, a, b in made], pa.struct([("n", pa.int64()), ("a", pa.int64()), ("b", pa.int64())]))

    def join_chunks(parts: pa.Array) -> pa.Array:
        out = []
        for row in parts.to_pylist():
            a, b = combine([(p["h"]["n"], p["h"]["a"], p["h"]["b"]) for p in row])
            out.append(a << 31 | b)
        return pa.array(out, pa.int64())

    one = small.mapInArrow(whole, f"doc_id {id_type}, raw bigint, fp bigint, n_bytes bigint, text_sha256 string")
    rows = (
        huge.select(F.monotonically_increasing_id().alias("row"), "doc_id", "raw", "text")
        .mapInArrow(cut, f"row bigint, doc_id {id_type}, raw bigint, text_sha256 string, seq bigint, chunk binary")
        .repartition("row", "seq")
    )
    hashed = rows.select(
        "row", "doc_id", "raw", "text_sha256",
        F.struct("seq", F.arrow_udf(hash_chunks, "struct<n: bigint, a: bigint, b: bigint>")(F.col("chunk")).alias("h")).alias("part"),
    )
    many = (
        hashed.groupBy("row", "doc_id", "raw", "text_sha256")
        .agg(F.sort_array(F.collect_list("part")).alias("parts"))
        .select(
            "doc_id", "raw", F.arrow_udf(join_chunks, "bigint")(F.col("parts")).alias("fp"),
            F.aggregate("parts", F.lit(0).cast("bigint"), lambda s, p: s + p["h"]["n"]).alias("n_bytes"), "text_sha256",
        )
    )
    return one.unionByName(many)


def _unequal(docs: DataFrame, members: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, raw) of texts that differ from the first text of their fingerprint's group.

    ``members``: doc_id, raw, fp, n_bytes, first, salts, times; one row for each different id and text of a group.
    """
    text = text_of(text_col)
    plain = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("raw"), text.alias("text"))
    wanted = members.withColumnsRenamed({"doc_id": "w_id", "raw": "w_raw"})
    found = plain.join(
        wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("raw") == F.col("w_raw"))
    ).select("doc_id", "raw", "fp", "n_bytes", "first", "salts", F.pmod(F.xxhash64("doc_id", "raw"), "salts").alias("salt"), "text", "times")
    id_type = plain.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "raw", "fp", "n_bytes", "first", "salt", "seq", "chunk"]
        seen: set = set()  # of repeated rows, which the join brings together, each task compares one
        for batch in batches:
            firsts, copies = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            own, times = batch.column(6).to_pylist(), batch.column(8).to_pylist()
            for row in range(len(batch)):
                if times[row] > 1:
                    key = (batch.column(0)[row].as_py(), batch.column(1)[row].as_py())
                    if key in seen:
                        continue
                    seen.add(key)
                parts = list(chunks_of(normalise(_binary(batch.column(7).slice(row, 1))[0])))
                for salt in range(copies[row]) if firsts[row] else (own[row],):
                    n = len(parts)
                    same = pa.array([row] * n, pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(k).take(same) for k in range(5)]
                        + [pa.array([salt] * n, pa.int64()), pa.array(range(n), pa.int64()), pa.array(parts, pa.binary())],
                        names,
                    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, chunk = None, None
        for batch in batches:
            odd = []
            keys = zip(*(batch.column(k).to_pylist() for k in (2, 3, 5, 6)))
            for row, (key, first, part) in enumerate(zip(keys, batch.column(4).to_pylist(), batch.column(7).to_pylist())):
                if first:
                    at, chunk = (key, part) if key != at else (at, chunk)
                    if part == chunk:
                        continue
                if key != at or part != chunk:
                    odd.append(row)
            picked = pa.array(odd, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(picked), batch.column(1).take(picked)], ["doc_id", "raw"])

    rows = found.mapInArrow(
        cut, f"doc_id {id_type}, raw bigint, fp bigint, n_bytes bigint, first boolean, salt bigint, seq bigint, chunk binary"
    )
    dealt = rows.repartition("fp", "n_bytes", "salt", "seq").sortWithinPartitions("fp", "n_bytes", "salt", "seq", F.desc("first"))
    return dealt.mapInArrow(compare, f"doc_id {id_type}, raw bigint").distinct()


def _classes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, raw, keep_id, group_size, text_sha256, one row per row of ``docs``."""
    prints = keep(fingerprints(docs, id_col, text_col), "fingerprints")
    units = prints.groupBy("fp", "n_bytes", "doc_id", "raw").agg(F.count("*").alias("times"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "raw")).alias("least")
    groups = units.groupBy("fp", "n_bytes").agg(least, F.sum("times").alias("n"), F.count("*").alias("units")).filter("n > 1")
    groups = groups.select("fp", "n_bytes", F.col("least.doc_id").alias("rep"), F.col("least.raw").alias("rep_raw"), "n", "units")
    # As written tables both sides of these joins are plain shuffles, which can be split where a group is hot.
    groups = keep(groups, "groups").withColumnsRenamed({"fp": "g_fp", "n_bytes": "g_n"})
    rows = keep(prints.join(groups, (F.col("fp") == F.col("g_fp")) & (F.col("n_bytes") == F.col("g_n")), "left").drop("g_fp", "g_n", "rep", "rep_raw", "units"), "rows")
    single = rows.filter(F.col("n").isNull()).select("doc_id", "raw", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), "text_sha256")
    grouped = rows.filter(F.col("n").isNotNull())
    first = F.col("doc_id").eqNullSafe(F.col("rep")) & (F.col("raw") == F.col("rep_raw"))
    several = groups.filter("units > 1")
    members = units.join(several, (F.col("fp") == F.col("g_fp")) & (F.col("n_bytes") == F.col("g_n"))).select(
        "doc_id", "raw", "fp", "n_bytes", first.alias("first"), F.ceil(F.col("units") / COMPARED_TOGETHER).cast("bigint").alias("salts"), "times"
    )
    odd = keep(_unequal(docs, members, id_col, text_col), "unequal").withColumnsRenamed({"doc_id": "o_id", "raw": "o_raw"})
    parted = grouped.join(odd, F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("raw") == F.col("o_raw")), "left").select(
        "doc_id", "raw", "text_sha256", F.xxhash64("fp", "n_bytes").alias("p_key"), "fp", "n_bytes",
        F.when(F.col("o_raw").isNotNull(), F.col("text_sha256")).otherwise("").alias("apart"),
    )
    sizes = keep(parted.groupBy("fp", "n_bytes", "apart").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "sizes")
    sizes = sizes.withColumnsRenamed({"fp": "s_fp", "n_bytes": "s_n", "apart": "s_apart"})
    copies = parted.join(
        sizes, (F.col("fp") == F.col("s_fp")) & (F.col("n_bytes") == F.col("s_n")) & (F.col("apart") == F.col("s_apart"))
    ).select("doc_id", "raw", "keep_id", "group_size", "text_sha256")
    return single.unionByName(copies)


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per document, dropped ones too."""
    return _classes(docs, id_col, text_col).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of repeated rows one."""
    classes = keep(_classes(docs, id_col, text_col), "classes")
    gone = classes.filter(~F.col("doc_id").eqNullSafe(F.col("keep_id"))).select(F.col("doc_id").alias("__gone_id"), F.col("raw").alias("__gone_raw"))
    own = F.xxhash64(text_of(text_col))
    stays = docs.join(gone.distinct(), F.col(id_col).eqNullSafe(F.col("__gone_id")) & (own == F.col("__gone_raw")), "left_anti")
    repeated = classes.groupBy("doc_id", "raw").count().filter("count > 1").select(F.col("doc_id").alias("__again_id"), F.col("raw").alias("__again_raw"))
    if repeated.isEmpty():
        return stays
    same = F.col(id_col).eqNullSafe(F.col("__again_id")) & (own == F.col("__again_raw"))
    once = stays.join(repeated, same, "left_semi").withColumn("__own", own).dropDuplicates([id_col, "__own"]).drop("__own")
    return stays.join(repeated, same, "left_anti").unionByName(once)
