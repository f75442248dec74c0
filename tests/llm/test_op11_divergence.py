"""The audit against plain counting, and its trees against plain sums."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from lendlayer.llm.op11_divergence import Trees, audit_sources, excess, shares

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, part int, value string"


def brute(rows, top=200):
    docs = [(re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", t or ""), lang or "", src or "") for t, lang, src in rows]
    docs = [([re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in ws], lang, src) for ws, lang, src in docs]
    out = []
    for lang in {d[1] for d in docs}:
        mine = [d for d in docs if d[1] == lang]
        df = Counter(w for ws, _, _ in mine for w in set(ws))
        kept = {w for w, n in df.items() if n >= 3}
        counts = defaultdict(Counter)
        for ws, _, src in mine:
            counts[src].update(w for w in ws if w in kept)
        total = sum(counts.values(), Counter())

        def share(c):
            below = sum(c.values()) + len(kept)
            return {w: 1 + 10**9 * (c[w] + 1) // below for w in kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(total)
        f = lambda a, b: (a - b) ** 2 // b
        for s in counts:
            pairs = [(o, sum(f(p[s][w], p[o][w]) for w in kept)) for o in counts if o != s]
            terms = [(w, f(p[s][w], q[w])) for w in kept if counts[s][w] > 0 and p[s][w] > q[w]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(found[:most])]
    return sorted(out)


def corpus(seed, n=150, sources=7):
    rng = random.Random(seed)
    vocab = ["The", "THE", "the", "Éa", "éa", "日本", "🙂", "x1y", "don't", "a_b", "Z"] + ["".join(rng.choices("abcdeXYZ", k=rng.randint(1, 5))) for _ in range(300)]
    rows = []
    for i in range(n):
        words = rng.choices(vocab, k=rng.randint(0, 40))
        rows.append((" ".join(words), rng.choice(["en", "en", "de", None]), f"s{rng.randrange(sources)}" if rng.random() < 0.9 else None))
    return rows + [(None, "en", "silent"), ("", "xx", "a"), (None, "xx", "b"), ("one", "yy", "only"), ("hot " * 50_000, "en", "s1")] + [("same words here", "zz", "c")] * 3 + [("", "zz", "d")]


def result(spark, rows, **more):
    frame = spark.createDataFrame([(1, t, lang, src, "x", 5, 6, "y") for t, lang, src in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in audit_sources(frame, **more).collect())


@pytest.mark.parametrize("more", [{}, {"terms": 16, "chunk": 2}, {"terms": 5, "chunk": 1, "top": 3}])
def test_brute_force(spark, more):
    rows = corpus(len(more))
    assert result(spark, rows, **more) == brute(rows, more.get("top", 200))


def test_empty(spark):
    assert result(spark, []) == []


def test_shares():
    rng = random.Random(1)
    for _ in range(200):
        below = rng.randrange(1, 9 * 10**15)
        counts = [rng.randrange(0, below) for _ in range(5)]
        kept = rng.randrange(0, below)
        assert shares(np.array(counts), below - kept, kept).tolist() == [1 + 10**9 * (c + 1) // below for c in counts]


def test_trees():
    """Equal subtrees are one node, and a walk's price is the plain sum."""
    rng = np.random.default_rng(2)
    counts = rng.poisson(0.3, (5, 300))
    counts[3] = counts[1]
    trees = Trees(counts)
    assert trees.roots[3] == trees.roots[1] and len(set(trees.roots)) == 4
    assert len(trees.levels[0][0]) < counts.size // 4
    p, q = shares(np.maximum(trees.leaves, 0), 100, 50), shares(np.maximum(trees.leaves, 0), 90, 50)
    plain = {c: i for i, c in enumerate(trees.leaves.tolist())}
    for a, b in ((0, 1), (1, 3), (2, 4)):
        x, y = p[[plain[c] for c in counts[a]]], q[[plain[c] for c in counts[b]]]
        assert trees.price(a, b, p, q) == (excess(x, y).sum(), excess(y, x).sum())
