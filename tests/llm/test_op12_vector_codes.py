"""Vector codes against plain Lloyd rounds in Python integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from lendlayer.llm.op12_vector_codes import build_tree, code_digest, compress_vectors, own

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error long, part int"


def brute(rows, entries=64, rounds=2):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(good[0][1]) // 16
    out, books = [["", 0] for _ in good], []
    for p in range(16):
        parts = [v[p * w : (p + 1) * w] for _, v, _ in good]
        book = [list(x) for x in parts[:entries]]
        for r in range(rounds + 1):
            near = [min(range(len(book)), key=lambda e: (sum((a - b) ** 2 for a, b in zip(x, book[e])), e)) for x in parts]
            if r < rounds:
                for e in range(len(book)):
                    mine = [x for x, n in zip(parts, near) if n == e]
                    if mine:
                        book[e] = [sum(c) // len(mine) for c in zip(*mine)]
        books += [str(c) for e in book for c in e]
        for o, x, e in zip(out, parts, near):
            o[0] += f"{e:02x}"
            o[1] += sum((a - b) ** 2 for a, b in zip(x, book[e]))
    sums = {}
    for (_, _, lab), o in zip(good, out):
        sums[lab] = sums.get(lab, 0) + o[1]
    sha = hashlib.sha256(",".join(books).encode()).hexdigest()
    return sorted(((i, o[0], o[1], sums[lab], sha) for (i, _, lab), o in zip(good, out)), key=str)


def result(spark, rows):
    frame = spark.createDataFrame([(i, v, lab, "x", 1, 2) for i, v, lab in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in code_digest(*compress_vectors(frame)).collect()), key=str)


def vectors(seed, n, dim=32):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(dim)], rng.choice([0, 1, 1, 1, None])) for i in range(n)]
    rows += [(n + i, rows[5][1], 1) for i in range(40)]  # one common vector
    rows += [(-1, None, 1), (-2, [None] * dim, 1), (-3, [float("nan")] * dim, 1), (-4, [float("inf")] * dim, 1), (None, rows[7][1], 2), (3, rows[9][1], 2)]
    return rows


@pytest.mark.parametrize("seed,n", [(1, 400), (2, 30), (3, 1)])
def test_brute_force(spark, seed, n):
    rows = vectors(seed, max(n, 10))
    rows = rows if n > 1 else rows[:1]
    assert result(spark, rows) == brute(rows)


def test_empty_and_wrong_lengths(spark):
    assert result(spark, []) == [] and result(spark, [(1, None, 1)]) == []
    for bad in ([(1, [0.5] * 16, 1), (2, [0.5] * 32, 1)], [(1, [0.5] * 17, 1)], [(1, [1e30] * 16, 1)]):
        with pytest.raises(Exception, match="length|too large"):
            result(spark, bad)


@pytest.mark.parametrize("seed", range(4))
def test_tree(seed):
    """Every ball holds its points and its cached sum; walking it assigns as plain search does."""
    rng = np.random.default_rng(seed)
    points = np.concatenate([rng.integers(-40, 40, (1500, 3)), rng.integers(-5, 5, (1500, 3)), np.zeros((300, 3), np.int64)])
    tree = build_tree(points)
    weight = np.bincount(tree["inverse"])[tree["order"]]
    for node in range(len(tree["low"])):
        span = slice(tree["low"][node], tree["high"][node])
        inside = tree["points"][span]
        assert (np.sqrt(((inside - tree["center"][node]) ** 2).sum(1)) <= tree["radius"][node] * (1 + 1e-9) + 1e-9).all()
        assert (tree["total"][node] == (inside * weight[span, None]).sum(0)).all() and tree["count"][node] == weight[span].sum()
    book = np.concatenate([rng.integers(-40, 40, (30, 3)), rng.integers(-3, 3, (30, 3)), [[0, 0, 0], [0, 0, 0]]])
    entry, count, total = own(tree, book)
    plain = ((tree["points"][:, None] - book[None]) ** 2).sum(2).argmin(1)
    assert (entry == plain).all() and (count == np.bincount(plain, weights=weight, minlength=len(book))).all()
    assert (total == np.stack([np.bincount(plain, weights=weight * tree["points"][:, c], minlength=len(book)) for c in range(3)], 1)).all()
