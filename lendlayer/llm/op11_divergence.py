"""Source divergence audit: term counts of source groups compared as hash-consed segment trees.

Terms (runs of letters and of characters beyond ASCII, A-Z lowered) are counted by language
and source; a language keeps the terms of at least ``support`` of its documents. A group gives a
kept term the scaled share ``1 + floor(1e9 * (count + 1) / (N + V))``, and two shares differ by
``floor((p - q)**2 / q)``. For every group the operator prices each other source of its
language (the sum over all kept terms) and ranks the terms it has more of than its language.

The kept terms of a language are cut by hash into blocks of some thousands. In a block, terms are numbered
by their count in the language, so that rare ones lie side by side, and each group's counts are a
segment tree over those numbers. Trees are hash-consed bottom up: a node is the pair of its
children, so equal count subtrees of any groups are one node (an absent stretch is one node a
level). Two trees are walked together from their roots, a level at a time; a pair of nodes that was
met is not walked again, and only the different pairs of counts at the bottom are priced, both ways at
once. Prices are added up again along the same pairs. Sums over blocks give the result.

Scale: terms are counted per slice of text and again before the shuffle, so a common word
or a hot source sends little. A task holds one block of one language for at most two chunks of some
``CHUNK`` sources, whatever the number of sources and terms. The first 200 terms are
taken per block and then per group. All arithmetic is in integers; shares are divided in
three steps of a thousand, exact up to 9e15 occurrences in a group.

Null texts, languages and sources count as empty. A group without terms still gives every
kept term a share. A language with one source has no pairs; one without kept terms prices
its pairs at 0. Ids are not looked at: repeated rows are documents of their own. An empty table gives an
empty one. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlayer.llm.frames import keep, ready, text_of
from lendlayer.llm.textkit import LOWER, Texts, column_texts

SCALE, SUPPORT, TOP = 1_000_000_000, 3, 200
#: Kept terms of a block and sources of a chunk, about.
TERMS, CHUNK = 8192, 32

_TERM = np.zeros(256, dtype=bool)
_TERM[0x41:0x5B], _TERM[0x61:0x7B], _TERM[0x80:] = True, True, True

_COUNTS = "lang string, source string, term string, n long, df long"
_PRICED = "lang string, source string, part string, item string, value long"
_PAD = -1


def slice_terms(texts: Texts) -> tuple[pa.Array, np.ndarray]:
    """The terms of a slice of texts in order, lowered, and the row of each."""
    data, offsets = texts.data, texts.offsets
    inside = _TERM[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begin[edges] = inside[edges]
    letters = LOWER[data[inside]]
    starts = np.flatnonzero(begin)
    ends = np.append(np.flatnonzero(begin[inside]), len(letters)).astype(np.int32)
    terms = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(letters)))
    return terms, np.searchsorted(offsets, starts, side="right") - 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow map (lang, source, text) -> occurrences and documents by group and term, per slice."""
    for batch in batches:
        numbers: dict = {}
        pairs = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
        group_of = np.array([numbers.setdefault(p, len(numbers)) for p in pairs], dtype=np.int64)
        langs, sources = (pa.array([p[i] for p in numbers], pa.string()) for i in (0, 1))
        for texts in column_texts(batch.column("text"), 8 << 20):
            terms, row = slice_terms(texts)
            if not len(terms):
                continue
            coded = terms.dictionary_encode()
            size = len(coded.dictionary)
            found, n = np.unique(row * size + coded.indices.to_numpy(), return_counts=True)
            key = group_of[texts.first + found // size] * size + found % size
            keys, at = np.unique(key, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [
                    langs.take(pa.array(keys // size)), sources.take(pa.array(keys // size)), coded.dictionary.take(pa.array(keys % size)),
                    pa.array(np.bincount(at, weights=n).astype(np.int64)), pa.array(np.bincount(at)),
                ],
                names=["lang", "source", "term", "n", "df"],
            )


def shares(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """``1 + floor(1e9 * (count + 1) / (total + kept))``, divided in steps that stay within 64 bits."""
    below = int(total) + int(kept)
    if below >= 9 * 10**15:
        raise ValueError(f"{below} occurrences in one group are beyond exact 64-bit shares")
    rest, out = counts.astype(np.int64) + 1, np.zeros(len(counts), np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // below
        rest = rest % below
    return out + 1


def excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


class Trees:
    """Hash-consed segment trees over the rows of a count matrix (padded to a power of two)."""

    def __init__(self, counts: np.ndarray):
        rows, size = counts.shape
        padded = np.full((rows, 1 << max(size - 1, 0).bit_length()), _PAD, dtype=np.int64)
        padded[:, :size] = counts
        self.leaves, ids = np.unique(padded, return_inverse=True)
        self.leaf_of = ids = ids.reshape(padded.shape)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # children by node, lowest level first
        below = len(self.leaves)
        while ids.shape[1] > 1:
            nodes, at = np.unique(ids[:, ::2] * below + ids[:, 1::2], return_inverse=True)
            self.levels.append((nodes // below, nodes % below))
            ids, below = at.reshape(rows, -1), len(nodes)
        self.roots = ids[:, 0]

    def price(self, a: int, b: int, p: np.ndarray, q: np.ndarray) -> tuple[int, int]:
        """Sums over all leaves of the excess of row ``a`` over ``b`` and of ``b`` over ``a``.

        ``p`` and ``q`` are the shares that the two rows give each leaf value.
        """
        left, right = self.roots[[a]], self.roots[[b]]
        met = []
        for first, second in reversed(self.levels):
            x, y = np.concatenate([first[left], second[left]]), np.concatenate([first[right], second[right]])
            base = int(y.max()) + 1
            pairs, at = np.unique(x * base + y, return_inverse=True)
            met.append(at)
            left, right = pairs // base, pairs % base
        real = self.leaves[left] != _PAD
        one, two = np.where(real, excess(p[left], q[right]), 0), np.where(real, excess(q[right], p[left]), 0)
        for at in reversed(met):
            half = len(at) // 2
            one, two = one[at[:half]] + one[at[half:]], two[at[:half]] + two[at[half:]]
        return int(one[0]), int(two[0])


def _block(top: int):
    """One block of one language for one or two chunks of sources: prices of pairs, and each group's first terms."""

    def work(table: pa.Table) -> pa.Table:
        lang, chunks = table.column("lang")[0].as_py(), table.column("chunks")[0].as_py()
        one, two = divmod(table.column("pair")[0].as_py(), chunks)
        kind = table.column("kind")
        groups, words, cells = (table.filter(pc.equal(kind, k)) for k in range(3))
        sources, chunk = groups.column("source").to_pylist(), groups.column("chunk").to_numpy()
        sizes, kept, of_lang = (groups.column(c).to_pylist() for c in ("n", "kept", "of_lang"))

        # numbered by count in the language, then by term
        words = words.select(["term", "n"]).sort_by([("n", "descending"), ("term", "ascending")])
        terms = words.column("term").combine_chunks()
        counts = np.zeros((len(sources) + 1, len(terms)), dtype=np.int64)
        counts[-1] = words.column("n").to_numpy()
        if cells.num_rows:
            row = pc.index_in(cells.column("source"), pa.array(sources, pa.string())).to_numpy()
            counts[row, pc.index_in(cells.column("term"), terms).to_numpy()] = cells.column("n").to_numpy()

        out: list[tuple] = []
        if len(terms):
            trees = Trees(counts)
            share = [shares(np.maximum(trees.leaves, 0), size, k) for size, k in zip(sizes, kept)]
        for a in range(len(sources)):
            for b in range(a + 1, len(sources)):
                if one != two and chunk[a] == chunk[b]:
                    continue
                x, y = trees.price(a, b, share[a], share[b]) if len(terms) else (0, 0)
                out += [(sources[a], "pair", sources[b], x), (sources[b], "pair", sources[a], y)]
        if one == two and len(terms) and sources:
            of_all = shares(np.maximum(trees.leaves, 0), of_lang[0], kept[0])
            order = np.empty(len(terms), np.int64)  # the place of each term by its bytes
            order[pc.sort_indices(terms.cast(pa.binary())).to_numpy()] = np.arange(len(terms))
            for a, source in enumerate(sources):
                pairs, at = np.unique(trees.leaf_of[a, : len(terms)] * len(trees.leaves) + trees.leaf_of[-1, : len(terms)], return_inverse=True)
                mine, all_of = pairs // len(trees.leaves), pairs % len(trees.leaves)
                p, q = share[a][mine], of_all[all_of]
                value, more = excess(p, q)[at], ((trees.leaves[mine] > 0) & (p > q))[at]
                some = np.flatnonzero(more)
                some = some[np.lexsort((order[some], -value[some]))][:top]
                out += [(source, "term", term, v) for term, v in zip(terms.take(pa.array(some)).to_pylist(), value[some].tolist())]
        names, parts, items, values = zip(*out) if out else ((), (), (), ())
        return pa.table(
            {
                "lang": pa.array([lang] * len(out), pa.string()), "source": pa.array(names, pa.string()), "part": pa.array(parts, pa.string()),
                "item": pa.array(items, pa.string()), "value": pa.array(values, pa.int64()),
            }
        )

    return work


def audit_sources(
    docs: DataFrame, support: int = SUPPORT, top: int = TOP, terms: int = TERMS, chunk: int = CHUNK,
    text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """``lang, source, part, item, value, rank`` (see the module)."""
    ready(docs.sparkSession)
    plain = docs.select(text_of(lang_col).alias("lang"), text_of(source_col).alias("source"), text_of(text_col).alias("text"))
    counts = plain.mapInArrow(_count, _COUNTS).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    counts = keep(counts, "counts")
    words = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")).filter(F.col("df") >= support).drop("df")
    words = keep(words, "terms")
    held = keep(counts.drop("df").join(words.select("lang", "term"), ["lang", "term"], "left_semi"), "held")

    groups = plain.select("lang", "source").distinct()
    langs = groups.groupBy("lang").agg(F.count("*").alias("of"))
    about = words.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("of_lang"))
    langs = langs.join(about, "lang", "left").na.fill(0, ["kept", "of_lang"])
    langs = keep(
        langs.select(
            "lang", "kept", "of_lang", F.greatest(F.lit(1), F.ceil(F.col("kept") / terms)).cast("int").alias("blocks"),
            F.ceil(F.col("of") / chunk).cast("int").alias("chunks"),
        ),
        "langs",
    )
    sizes = held.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    members = groups.join(sizes, ["lang", "source"], "left").na.fill(0, ["n"]).join(langs, "lang")

    none = F.lit(None)
    of_source = F.pmod(F.xxhash64("source"), F.col("chunks")).cast("int")
    of_term = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    mates = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda x: F.least(x, F.col("chunk")) * F.col("chunks") + F.greatest(x, F.col("chunk")))
    every = F.filter(F.sequence(F.lit(0), F.col("chunks") * F.col("chunks") - 1), lambda x: F.floor(x / F.col("chunks")) <= x % F.col("chunks"))

    def laid(df: DataFrame, kind: int, pair) -> DataFrame:
        given = {"source": none.cast("string"), "term": none.cast("string"), "chunk": none.cast("int"), "kept": none.cast("long"), "of_lang": none.cast("long")}
        named = [(c if c in df.columns else given[c].alias(c)) for c in ("lang", "block", "chunks", "source", "term", "n", "chunk", "kept", "of_lang")]
        return df.select(*named, F.lit(kind).alias("kind"), F.explode(pair).alias("pair"))

    marks = members.withColumn("chunk", of_source).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    known = langs.select("lang", "blocks", "chunks")
    listed = words.join(known, "lang").withColumn("block", of_term)
    cells = held.join(known, "lang").withColumn("block", of_term).withColumn("chunk", of_source)
    rows = laid(marks, 0, mates).unionByName(laid(listed, 1, every)).unionByName(laid(cells, 2, mates))
    priced = keep(rows.groupBy("lang", "block", "pair").applyInArrow(_block(top), _PRICED), "priced")

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = priced.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(by_value))
    first = priced.filter("part = 'term'").withColumn("rank", F.row_number().over(by_value)).filter(F.col("rank") <= top)
    return pairs.unionByName(first)
