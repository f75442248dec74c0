"""Repeated passages against brute force over every window."""

import hashlib
import random

import pytest

from lendlayer.llm import op13_repeats
from lendlayer.llm.op13_repeats import remove_repeats, repeat_digest

SCHEMA = "doc_id long, text string, lang string, sub long, runs long, spans string, kept boolean"


def brute(rows, length):
    """doc_id and text -> the digest, for rows in any order."""
    units = sorted({(d, t or "") for d, t in rows}, key=lambda u: (u[0] is not None, u[0] or 0))
    seen, out = set(), {}
    for doc, text in units:
        raw = text.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            if w in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(w)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[doc, text] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return [(d, *out[d, t or ""]) for d, t in rows]


def result(spark, rows, length, wide=2048):
    docs = spark.createDataFrame([(d, t, "en", 1, 2, "x", True) for d, t in rows], SCHEMA).repartition(3)
    return [tuple(r) for r in repeat_digest(remove_repeats(docs, length, wide)).collect()]


def corpus(seed, n=120):
    rng = random.Random(seed)
    words = ["lorem", "ipsum", "é", "日本", "of", "the", "a", "quick", "🙂", "ab"] + ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(200)]
    make = lambda k: " ".join(rng.choices(words, k=k))
    passage, rows = make(60), []
    for d in range(n):
        text = make(rng.randint(0, 80))
        kind = d % 6
        if kind == 0:
            text = f"{text} {passage} {make(5)}"
        elif kind == 1 and rows:
            text = rng.choice(rows)[1] or ""
        elif kind == 2 and rows:
            old = (rng.choice(rows)[1] or "").split(" ")
            for _ in range(1 + len(old) // 30):
                old[rng.randrange(len(old))] = "edited"
            text = " ".join(old)
        elif kind == 3:
            text = text + " " + text
        elif kind == 4 and d % 4 == 0:
            text = "ab" * rng.randint(1, 300)
        rows.append((d * 7 % 1000, text))
    return rows + [(5000, None), (5001, ""), (None, passage), (5002, "x" * 3000), (5003, passage), (5003, passage)]


@pytest.mark.parametrize("length,wide", [(16, 2048), (33, 2048), (100, 2048), (40, 1), (100, 2)])
def test_brute_force(spark, length, wide):
    rows = corpus(length + wide)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(result(spark, rows, length, wide), key=key) == sorted(brute(rows, length), key=key)


def test_common_anchors_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(op13_repeats, "SAMPLE", 1)
    rows = corpus(3)
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(result(spark, rows, 50), key=key) == sorted(brute(rows, 50), key=key)


def test_small_chunks_and_groups(spark, monkeypatch):
    """A text longer than a chunk, cut anywhere, gives the same runs."""
    import numpy as np

    from lendlayer.llm.textkit import Texts

    rng = random.Random(9)
    raw = "".join(rng.choices("abc ", k=5000)).encode()
    texts = Texts(0, np.frombuffer(raw, np.uint8), np.array([0, 0, 1700, 1750, 5000]))

    def windows(chunk):
        monkeypatch.setattr(op13_repeats, "CHUNK", chunk)
        return {
            (int(row), int(a) + i): int(g) for gs, _, rs, starts, ns in op13_repeats.anchor_runs(texts, 60, 24) for g, row, a, n in zip(gs, rs, starts, ns) for i in range(n)
        }

    whole = windows(1 << 20)
    assert whole == windows(97) and len(whole) == (1700 - 59) + (3250 - 59)


def test_empty(spark):
    assert result(spark, [], 100) == []


def test_long_repeats(spark):
    """One long text of a single word, and many copies of one passage."""
    passage = " ".join(f"w{i}" for i in range(80))
    rows = [(i, f"{i * i} {passage} {i * 31}") for i in range(3000)] + [(9999, "word " * 100_000)]
    got = {r[0]: r[1:] for r in result(spark, rows, 100, 16)}
    assert got[0][1] == 0 and got[9999][1] == 500_000 - 5
    assert all(got[i][1] >= len(passage) and got[i][2] == 1 for i in range(1, 3000))
