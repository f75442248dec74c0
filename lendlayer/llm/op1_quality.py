"""Quality by the votes of labelled neighbours in a latent semantic space.

A text's terms are hashed words, word shapes and signs of repetition, weighted by term
frequency and inverse document frequency. A truncated singular value decomposition of the
labelled texts' term matrix (randomised range finder) gives the latent space. The labelled
vectors are broadcast (their number is bounded by ``per_class``), every document's vector
is multiplied with all of them in blocks, and the ``neighbours`` most similar ones vote
with their cosine as weight.

Labels come from a bounded sample (``per_class`` documents of each label) outside the
held-out fold. Null and empty texts get score 0; a text like no labelled one at all gets
0.5, and so does every text when there are no labels. Null ids pass through, repeated rows
get equal results, an empty table gives an empty one. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlayer.llm.frames import fold, plain_documents, ready
from lendlayer.llm.samples import labelled_sample
from lendlayer.llm.textkit import U64, Texts, column_texts, mix, span_hashes, windows, word_hashes, words

TERMS = 1 << 13
DIMENSIONS = 48
NEIGHBOURS = 15
PER_CLASS = 2000
#: Documents multiplied with the labelled vectors at a time.
BLOCK = 512

# Shape symbols: a-z and other letters, A-Z, digits; other bytes stand for themselves.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = 97
_SHAPE[128:] = 97
_SHAPE[65:91] = 65
_SHAPE[48:58] = 48
_SYMBOLS = mix(np.arange(1, 257, dtype=np.uint64) * U64(0xA24BAED4963EE407))


def terms(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, weight) of each distinct term of each text, rows ascending; weight 1 + log count."""
    found = words(texts)
    hashes = word_hashes(texts, found, lower=True)
    shape = _SHAPE[texts.data]
    # A word's shape is its symbols without immediate repeats.
    fresh = np.ones(len(shape), dtype=bool)
    fresh[1:] = shape[1:] != shape[:-1]
    fresh[found.starts] = True
    where = np.concatenate([[0], np.cumsum(fresh)])
    shapes = span_hashes(_SYMBOLS[shape[fresh]], where[found.starts], where[found.ends])
    same = (hashes[1:] == hashes[:-1]) & (found.row[1:] == found.row[:-1])
    twice = np.flatnonzero(same)
    triples, at = windows(hashes, found.row, 3)
    _, inverse, count = np.unique(mix(triples + found.row[at].astype(np.uint64)), return_inverse=True, return_counts=True)
    again = at[count[inverse] > 1] if len(at) else at
    marks = [(mix(hashes + U64(1)), found.row), (mix(shapes + U64(2)), found.row)]
    marks += [(np.full(len(x), mix(np.array([m], np.uint64))[0], np.uint64), found.row[x]) for m, x in ((3, twice), (4, again))]
    term = (np.concatenate([m for m, _ in marks]) & U64(TERMS - 1)).astype(np.int64)
    row = np.concatenate([r for _, r in marks])
    cell, count = np.unique(row * TERMS + term, return_counts=True)
    return cell // TERMS, cell % TERMS, (1 + np.log(count)).astype(np.float32)


def latent_space(row: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, dimensions: int, seed: int = 1) -> np.ndarray:
    """Projection (terms x dimensions) by a randomised decomposition of the weighted term matrix."""
    frequency = np.bincount(term, minlength=TERMS)
    idf = np.log((1 + n) / (1 + frequency)) + 1
    matrix = np.zeros((n, TERMS), dtype=np.float32)
    matrix[row, term] = weight * idf[term]
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)
    dice = np.random.Generator(np.random.PCG64(seed))
    basis = matrix @ dice.standard_normal((TERMS, dimensions + 16)).astype(np.float32)
    for _ in range(3):
        basis, _ = np.linalg.qr(basis)
        basis = matrix @ (matrix.T @ basis)
    basis, _ = np.linalg.qr(basis)
    small = basis.T @ matrix
    values, vectors = np.linalg.eigh((small @ small.T).astype(np.float64))
    best = np.argsort(-values)[:dimensions]
    right = (vectors[:, best] / np.sqrt(np.maximum(values[best], 1e-12))).T @ small
    return (idf[:, None] * right.T).astype(np.float32)


def project(row: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, space: np.ndarray) -> np.ndarray:
    """Unit latent vectors of ``n`` texts (zero where nothing is known of a text)."""
    out = np.zeros((n, space.shape[1]), dtype=np.float32)
    ends = np.searchsorted(row, np.arange(n + 1))
    for i in range(n):
        a, b = ends[i], ends[i + 1]
        if b > a:
            out[i] = weight[a:b] @ space[term[a:b]]
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norm, out=np.zeros_like(out), where=norm > 1e-6)


def votes(vectors: np.ndarray, labelled: np.ndarray, label: np.ndarray, neighbours: int) -> np.ndarray:
    """Similarity-weighted share of label 1 among the nearest labelled vectors, 0.5 where none is similar.

    Of labelled vectors that are equally near the first ones vote.
    """
    out = np.full(len(vectors), 0.5)
    k = min(neighbours, len(labelled))
    for i in range(0, len(vectors) if k else 0, BLOCK):
        cosine = vectors[i : i + BLOCK] @ labelled.T
        last = np.partition(cosine, len(labelled) - k, axis=1)[:, len(labelled) - k, None]
        nearer, tied = cosine > last, cosine == last
        some = np.flatnonzero(tied.sum(axis=1) > k - nearer.sum(axis=1))  # more are as near as the last one than have a vote
        tied[some] &= np.cumsum(tied[some], axis=1) <= (k - nearer[some].sum(axis=1))[:, None]
        weight = np.where(nearer | tied, np.maximum(cosine, 0), 0).astype(np.float64)
        total = weight.sum(axis=1)
        share = weight @ label / np.maximum(total, 1e-12)
        out[i : i + BLOCK] = np.where(total > 1e-9, share, 0.5)
    return np.clip(out, 0.0, 1.0)


def fit(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Latent space, labelled vectors and labels from a bounded sample (label, text)."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            for texts in column_texts(batch.column(1)):
                row, term, weight = terms(texts)
                ends = pa.array(np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(label[texts.first : texts.first + len(texts)], pa.int32()),
                        pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32))),
                        pa.ListArray.from_arrays(ends, pa.array(weight)),
                    ],
                    ["label", "term", "weight"],
                )

    # one order of the sample, so that ties and rounding do not depend on its partitions
    got = sample.orderBy(F.xxhash64("text"), "text").mapInArrow(weigh, "label int, term array<int>, weight array<float>").toArrow().combine_chunks()
    label = got["label"].to_numpy().astype(np.float64)
    n = len(label)
    if not n:
        return np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), label
    size = np.array([len(x) for x in got["term"]])
    row = np.repeat(np.arange(n), size)
    term, weight = (np.concatenate([np.asarray(x.values) for x in got[c]]) if size.sum() else np.zeros(0) for c in ("term", "weight"))
    term = term.astype(np.int64)
    space = latent_space(row, term, weight, n, min(DIMENSIONS, n))
    return space, project(row, term, weight, n, space), label


def score_quality(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5, held_out: int = 0, per_class: int = PER_CLASS,
    neighbours: int = NEIGHBOURS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted for every document."""
    spark = ready(docs.sparkSession)
    sample = labelled_sample(docs, labels, label_col, folds, held_out, {0: per_class, 1: per_class}, id_col, text_col)
    model = spark.sparkContext.broadcast(fit(sample))

    def score(text: pa.Array) -> pa.Array:
        space, labelled, label = model.value
        out = []
        for texts in column_texts(text):
            made = votes(project(*terms(texts), len(texts), space), labelled, label, neighbours)
            made[np.diff(words(texts).bounds) == 0] = 0.0
            out.append(made)
        return pa.array(np.concatenate(out) if out else [], pa.float64())

    plain = plain_documents(docs, id_col, text_col)
    scored = plain.select("doc_id", (fold("doc_id", folds) == held_out).alias("held_out"), F.arrow_udf(score, "double")(F.col("text")).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
