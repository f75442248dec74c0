"""Inputs that are large in one place: long runs, many repeated rows, many null ids."""

import hashlib
import json
import random
import re
import time
from base64 import b64encode, urlsafe_b64encode

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendlayer.llm.op3_secrets import find_secrets, scan_secrets
from lendlayer.llm.op5_packing import pack_pieces
from lendlayer.llm.op9_exact_dedup import drop_copies, mark_copies
from lendlayer.llm.samples import labelled_sample


def token(head, body, sign="sig"):
    part = lambda x: urlsafe_b64encode(json.dumps(x, separators=(",", ":")).encode()).decode().rstrip("=")
    return f"{part(head)}.{part(body)}.{sign}"


def kinds(text):
    return [k for _, k, _ in find_secrets(text)[1]]


def test_short_and_prefixed_tokens(spark):
    short = "eyJhbGciOiJ4In0.eyB9.a"
    texts = [f"x {short} y", f"www.example.{short}", f"{short}.{token({'alg': 'y'}, {'a': 1})}", "a.b.c 10.20.30.40 www.example.com"]
    assert [kinds(t) for t in texts] == [[6], [6], [6, 6], []]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [(s.start, s.end) for s in r.found] for r in scan_secrets(docs).collect()}
    assert got[0] == [(2, 2 + len(short))] and got[1] == [(12, 12 + len(short))] and len(got[2]) == 2 and got[3] == []


def test_the_filter_of_rows_loses_nothing(spark):
    rng = random.Random(6)
    bits = [
        "token=abcdefgh", "AKIA" + "A1" * 8, "0f" * 16, token({"alg": "x"}, {"a": 1}), "eyJhbGciOiJ4In0.eyB9.a", "password : 'hunter22'", "a.b.c",
        "-----BEGIN PRIVATE KEY-----", "-----END PRIVATE KEY-----", "é日本", "plain words", "x" * 31, "x" * 50, "\\n", "SECRET=ABCDEFGH", "",
    ]
    rows = [(i, rng.choice(["", " ", "\n"]).join(rng.choices(bits, k=rng.randint(0, 6)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    names = ("assign", "access", "hex", "armour", "der", "ssh", "token")
    got = {r.doc_id: [(s.start, names.index(s.kind), s.end) for s in r.found] for r in scan_secrets(docs).collect()}
    assert got == {i: find_secrets(t)[1] for i, t in rows}


@pytest.mark.parametrize("text", [
    "a" * 1_000_000, "ab." * 300_000, ("a" * 9 + ".") * 100_000, "-----BEGIN PRIVATE KEY-----\n" * 20_000, "-----BEGIN PRIVATE KEY-----" + "A\n" * 400_000,
    "0f" * 500_000, "\\n" * 400_000, ("A" * 64 + "\n") * 15_000, "token" + " " * 900_000, "-----BEGIN " + "A " * 400_000, "\\" * 900_000,
], ids=lambda t: f"{t[:12]!r}")
def test_long_texts_take_seconds(text):
    began = time.time()
    find_secrets(text)
    assert time.time() - began < 20


def test_blocks_pair_with_the_nearest_beginning():
    version, algorithm, key = b"\x02\x01\x00", b"\x30\x05\x06\x03\x2b\x65\x70", b"\x04\x22\x04\x20" + bytes(32)
    der = b"\x30" + bytes([len(version + algorithm + key)]) + version + algorithm + key
    block = "-----BEGIN PRIVATE KEY-----\n" + b64encode(der).decode() + "\n-----END PRIVATE KEY-----"
    text = f"-----BEGIN PRIVATE KEY----- cut off {block} -----END PRIVATE KEY-----"
    at = text.index(block)
    assert (at, 3, at + len(block)) in find_secrets(text)[1]


def brute_copies(rows):
    norm = lambda t: re.sub("[\x20\x09-\x0d]+", " ", t or "")
    groups = {}
    for d, t in rows:
        groups.setdefault(norm(t), []).append(d)
    least = {k: min((d for d in ds if d is not None), default=None) for k, ds in groups.items()}
    return sorted(((d, least[norm(t)], len(groups[norm(t)]), d == least[norm(t)], hashlib.sha256(norm(t).encode()).hexdigest()) for d, t in rows), key=str)


def test_many_repeated_rows(spark):
    """One id and text 20,000 times; null ids with one text in many spellings of its blanks."""
    rows = [(5, "one  text")] * 20_000 + [(3, "one text"), (7, "one\ttext"), (None, "one text")]
    rows += [(None, "other" + " " * (1 + i % 900) + "text") for i in range(3000)] + [(9, "other text"), (9, "other  text")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    began = time.time()
    got = sorted((tuple(r) for r in mark_copies(docs).collect()), key=str)
    assert got == brute_copies(rows) and time.time() - began < 60
    assert [r.doc_id for r in drop_copies(docs).orderBy("doc_id").collect()] in ([3, 9], [3, 9, 9])


def test_many_null_ids_are_dealt_like_others(spark):
    n = 200_000
    pieces = spark.range(n).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), (1 + F.pmod(F.xxhash64("id"), F.lit(1500))).alias("length"),
        F.col("id").alias("ids_crc32"),
    )
    rows = pack_pieces(pieces).toPandas()
    assert len(rows) == n and rows.ids_crc32.nunique() == n and rows.doc_id.isna().all()
    assert (rows.sequence_id // 2**24).nunique() >= n // 65536  # parts
    rows = rows.sort_values(["sequence_id", "offset"])
    sequence, offset = rows.sequence_id.to_numpy(), rows.offset.to_numpy()
    ends = offset + rows.length.to_numpy()
    first = np.append(True, sequence[1:] != sequence[:-1])
    assert (offset == np.where(first, 0, np.append(0, ends[:-1]))).all() and (ends <= 2048).all()
    assert (rows.part_bins >= rows.part_bound).all()


def test_large_ids_beside_null_ones_keep_their_digits(spark):
    big = 2**60 + 1
    pieces = spark.createDataFrame([(big, 0, 0, 5, 1), (None, 0, 0, 7, 2)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    assert {r.doc_id for r in pack_pieces(pieces).collect()} == {big, None}


def test_samples_hold_one_row_an_id(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "b"), (None, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    both = [tuple(sorted(tuple(r) for r in labelled_sample(docs.repartition(n), labels.repartition(n), "quality", 5, 4, {0: 10, 1: 10}).collect())) for n in (1, 3)]
    assert both[0] == both[1] and len(both[0]) <= 2 and (0, "b") in both[0]


def test_votes_of_equally_near_vectors():
    from lendlayer.llm.op1_quality import votes

    rng = np.random.default_rng(3)
    some = rng.standard_normal((40, 6)).astype(np.float32)
    labelled = np.concatenate([some[:5]] * 6 + [some]).astype(np.float32)  # five vectors seven times
    label = rng.integers(0, 2, len(labelled)).astype(np.float64)
    vectors = np.concatenate([some, np.zeros((2, 6), np.float32)])
    for k in (1, 3, 15, 200):
        got = votes(vectors, labelled, label, k)
        for v, g in zip(vectors, got):
            cosine = labelled @ v
            near = sorted(range(len(labelled)), key=lambda i: (-cosine[i], i))[:k]
            weight = np.maximum(cosine[near], 0).astype(float)
            assert g == pytest.approx((weight * label[near]).sum() / weight.sum() if weight.sum() > 1e-9 else 0.5, abs=1e-5)
