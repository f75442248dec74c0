"""Comparisons with centres stay in proportion to the classes, whatever the size of their group."""

import random

import pytest

from lendlayer.llm import op10_minhash
from lendlayer.llm.op10_minhash import near_duplicates


def groups_of(size, total, edits, seed=3):
    """Texts of 200 words in groups of near copies: ``edits`` words of the group's text changed in each."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefghijklm", k=7))
    rows = []
    for g in range(total // size):
        base = [word() for _ in range(200)]
        for _ in range(size):
            text = list(base)
            for _ in range(edits):
                text[rng.randrange(200)] = word()
            rows.append((len(rows), " ".join(text), g))
    return rows


@pytest.mark.parametrize("size", [3, 300, 1800])
def test_pairs_a_class_are_bounded(spark, monkeypatch, size):
    counted = []
    real = op10_minhash._centre_pairs

    def count(*args):
        pairs = real(*args).cache()
        counted.append(pairs.count())
        return pairs

    monkeypatch.setattr(op10_minhash, "_centre_pairs", count)
    rows = groups_of(size, 1800, 2)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in near_duplicates(docs, k=4).collect()}
    assert sum(counted) <= 12 * len(rows)
    least = {}
    for d, _, g in rows:
        least.setdefault(g, d)
    assert got == {d: least[g] for d, _, g in rows}


def test_loose_copies_lose_no_link(spark):
    """Copies near the threshold, against brute force over all pairs."""
    rows = groups_of(60, 240, 7, seed=8)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(4)
    sets = [{tuple(w[i : i + 4]) for i in range(197)} for w in (r[1].split(" ") for r in rows)]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    assert {r.doc_id: r.component_id for r in near_duplicates(docs, k=4).collect()} == {i: find(i) for i in range(len(rows))}
