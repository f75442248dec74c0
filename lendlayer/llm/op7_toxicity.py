"""Toxicity by a counterfactually regularised linear classifier.

Features are whether a word, or a word beginning of 4, 5 or 6 letters, occurs in a text;
those kept are far more frequent in toxic than in clean labelled texts (likelihood ratio).
A logistic model with non-negative weights is fitted to them, on whole texts and on each
marker of a text alone, so that one strong marker suffices. Its loss also holds the
squared change of score between labelled sentences and their counterfactuals: each identity
term is swapped for others of its language and left out, and each term on its own is
compared with none. So a group's name carries no weight by itself, and neutral mentions of
groups are not taken for insults.

Labels come from a bounded sample (``per_class`` documents of each label) outside the
held-out fold. Null, empty and wordless texts get the model's base score; without labels of
both kinds every score is 0. Null ids pass through, repeated rows get equal results, an
empty table gives an empty one. Other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlayer.llm import bpe
from lendlayer.llm.frames import fold, ready
from lendlayer.llm.op6_token_counts import blocks
from lendlayer.llm.samples import labelled_sample
from lendlayer.llm.textkit import U64, mix, span_hashes

PER_CLASS = {0: 6000, 1: 3000}
BEGINNINGS = (4, 5, 6)
#: Features kept at most, and the least likelihood ratio and number of toxic texts of one.
FEATURES, RATIO, SUPPORT = 1024, 20.0, 3
RIDGE, FAIRNESS = 0.5, 100.0

# Names of groups of people, by language.
IDENTITY = {
    "en": "women men girls boys black white asian latino african european muslim muslims christian christians jewish jews hindu "
    "buddhist atheist immigrants refugees foreigners gay lesbian straight bisexual transgender disabled deaf blind elderly young",
    "de": "frauen männer mädchen jungen schwarze weiße asiaten afrikaner europäer muslime christen juden hindus buddhisten atheisten "
    "einwanderer flüchtlinge ausländer schwule lesben behinderte gehörlose blinde alte junge",
    "fr": "femmes hommes filles garçons noirs blancs asiatiques africains européens musulmans chrétiens juifs hindous bouddhistes "
    "athées immigrés réfugiés étrangers gays lesbiennes handicapés sourds aveugles vieux jeunes",
    "es": "mujeres hombres niñas niños negros blancos asiáticos africanos europeos musulmanes cristianos judíos hindúes budistas "
    "ateos inmigrantes refugiados extranjeros gais lesbianas discapacitados sordos ciegos ancianos jóvenes",
}

_lower: list[np.ndarray] = []


def _lower_table() -> np.ndarray:
    if not _lower:
        table = np.arange(0x110000, dtype=np.uint32)
        for c in range(0x20000):
            low = chr(c).lower()
            if len(low) == 1:
                table[c] = ord(low)
        _lower.append(table)
    return _lower[0]


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature hash) of every word of the texts and of its beginnings."""
    kinds, symbols = bpe.char_classes()
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = _lower_table()[codes]
    n = len(codes)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    inside = kinds[codes] == bpe.LETTER
    edge = np.zeros(n + 1, dtype=bool)
    edge[np.cumsum(sizes)] = True
    edge[0] = True
    before = np.concatenate([[False], inside[:-1]]) & ~edge[:n]
    after = np.concatenate([inside[1:], [False]]) & ~edge[1:]
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(np.cumsum(sizes), starts, side="right")
    scrambled = symbols[codes]
    rows, found = [row], [span_hashes(scrambled, starts, ends)]
    for k in BEGINNINGS:
        long = ends - starts >= k
        rows.append(row[long])
        found.append(mix(span_hashes(scrambled, starts[long], starts[long] + k) + U64(k)))
    return np.concatenate(rows), np.concatenate(found)


def _present(row: np.ndarray, found: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, index into the sorted ``known``) of the features that are known."""
    if not len(known) or not len(found):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    screen = np.zeros(1 << 16, dtype=bool)
    screen[(known & U64(0xFFFF)).astype(np.int64)] = True
    maybe = screen[(found & U64(0xFFFF)).astype(np.int64)]
    row, found = row[maybe], found[maybe]
    at = np.minimum(np.searchsorted(known, found), len(known) - 1)
    hit = known[at] == found
    cell = np.unique(row[hit] * len(known) + at[hit])
    return cell // len(known), cell % len(known)


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def select_features(sample: DataFrame) -> np.ndarray:
    """Sorted hashes of the features that mark toxic texts of the sample."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            first = 0
            for block in blocks(batch.column(1).to_pylist()):
                row, found = features(block)
                order = np.lexsort((found, row))
                row, found = row[order], found[order]
                new = np.ones(len(row), dtype=bool)
                new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
                row, found = row[new], found[new]
                known, inverse = np.unique(found, return_inverse=True)
                toxic = np.bincount(inverse, weights=label[first + row], minlength=len(known)).astype(np.int64)
                every = np.bincount(inverse, minlength=len(known))
                yield pa.RecordBatch.from_arrays([_signed(known), pa.array(toxic), pa.array(every - toxic)], ["feature", "toxic", "clean"])
                first += len(block)

    totals = sample.agg(F.count(F.when(F.col("label") == 1, 1)), F.count(F.when(F.col("label") == 0, 1))).first()
    if not all(totals):
        return np.empty(0, np.uint64)
    n1, n0 = (F.lit(float(t)) for t in totals)
    a, b = F.col("toxic"), F.col("clean")
    expected = (a + b) / (n1 + n0)
    part = lambda x, e: F.when(x > 0, x * F.log(x / e)).otherwise(0.0)
    ratio = 2 * (part(a, n1 * expected) + part(b, n0 * expected) + part(n1 - a, n1 * (1 - expected)) + part(n0 - b, n0 * (1 - expected)))
    made = sample.select("label", "text").mapInArrow(count, "feature bigint, toxic bigint, clean bigint")
    made = made.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter(a >= SUPPORT)
    made = made.withColumn("ratio", ratio).filter((F.col("ratio") >= RATIO) & (a / n1 > b / n0))
    best = made.orderBy(F.desc("ratio"), "feature").limit(FEATURES).select("feature").toArrow()["feature"].to_numpy()
    return np.sort(best.astype(np.int64).view(np.uint64))


def counterfactuals(sentence: str, identity: dict[str, str]) -> list[str]:
    """The sentence with each identity term swapped for the others of its language, or left out."""
    out = []
    for listed in identity.values():
        names = listed.split()
        for found in re.finditer(r"[^\W\d_]+", sentence):
            if found.group().lower() in names:
                head, tail = sentence[: found.start()], sentence[found.end() :]
                out.extend(head + other + tail for other in [*names, ""] if other != found.group().lower())
    return out


def changes(sample: DataFrame, known: np.ndarray, identity: dict[str, str]) -> np.ndarray:
    """Rows of feature changes (+1, -1) between labelled sentences and their counterfactuals."""
    names = sorted({w for listed in identity.values() for w in listed.split()})
    listed = frozenset(names)
    named = lambda text: not listed.isdisjoint(re.findall(r"[^\W\d_]+", text.lower()))
    wide = len(known)

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if not named(text):
                    continue
                for sentence in re.split(r"[.!?\n]+", text):
                    if named(sentence):
                        before = set(_present(*features([sentence]), known)[1].tolist())
                        for other in counterfactuals(sentence, identity):
                            after = set(_present(*features([other]), known)[1].tolist())
                            if after != before:
                                seen.add((tuple(sorted(after - before)), tuple(sorted(before - after))))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in seen], pa.list_(pa.int32())), pa.array([x[1] for x in seen], pa.list_(pa.int32()))], ["more", "less"]
        )

    rows = []
    if names and wide:
        for pair in sample.select("text").mapInArrow(change, "more array<int>, less array<int>").distinct().toArrow().to_pylist():
            step = np.zeros(wide, dtype=np.float32)
            step[pair["more"]], step[pair["less"]] = 1, -1
            rows.append(step)
        row, at = _present(*features(names), known)
        alone = np.zeros((len(names), wide), dtype=np.float32)
        alone[row, at] = 1
        rows.extend(alone[alone.any(axis=1)])
    return np.array(rows, dtype=np.float32).reshape(-1, wide)


def fit_weights(
    present: np.ndarray, toxic: np.ndarray, clean: np.ndarray, steps: np.ndarray, ridge: float = RIDGE, fairness: float = FAIRNESS
) -> tuple[np.ndarray, float]:
    """Non-negative weights and bias by accelerated projected gradient descent.

    Rows of ``present`` are distinct feature sets; ``toxic`` and ``clean`` say how many texts have each.
    """
    wide, every = present.shape[1], (toxic + clean).astype(np.float32)
    back, steps_back = np.ascontiguousarray(present.T), np.ascontiguousarray(steps.T)
    w, b = np.zeros(wide, np.float32), float(np.log((toxic.sum() + 1) / (clean.sum() + 1)))
    probe = np.ones(wide, np.float32)
    norm = 1.0
    for _ in range(20):  # the largest curvature
        probe = 0.25 * (back @ (every * (present @ probe))) + fairness * (steps_back @ (steps @ probe))
        norm = float(np.linalg.norm(probe)) or 1.0
        probe /= np.float32(norm)
    curve = 1.2 * norm + 0.25 * float(every.sum()) + ridge
    look, look_b, t = w.copy(), b, 1.0
    for _ in range(500):
        p = 1 / (1 + np.exp(-np.clip(present @ look + np.float32(look_b), -30, 30)))
        off = (every * p - toxic).astype(np.float32)
        gradient = back @ off + ridge * look + fairness * (steps_back @ (steps @ look))
        next_w = np.maximum(look - gradient / curve, 0).astype(np.float32)
        next_b = look_b - float(off.sum()) / curve
        next_t = (1 + np.sqrt(1 + 4 * t * t)) / 2
        pull = np.float32((t - 1) / next_t)
        look, look_b = next_w + pull * (next_w - w), next_b + float(pull) * (next_b - b)
        w, b, t = next_w, next_b, next_t
    return w.astype(np.float64), b


def fit_markers(present: np.ndarray, toxic: np.ndarray, clean: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias fitted so that one strong marker suffices.

    Features that occur in the same texts (a word and its beginnings) are one marker, whose
    weight they share. Beside its whole set, every text counts once more as its markers one
    at a time, in equal parts: a marker has to stand alone, not only beside others.
    """
    _, first, marker, size = np.unique(present.T, axis=0, return_index=True, return_inverse=True, return_counts=True)
    marker = marker.ravel()
    merged = np.ascontiguousarray(present[:, first])
    part = merged / np.maximum(merged.sum(axis=1, keepdims=True), 1)
    spread = np.zeros((present.shape[1], len(first)), np.float32)
    spread[np.arange(len(marker)), marker] = 1 / size[marker]
    rows = np.concatenate([merged, np.eye(len(first), dtype=np.float32)])
    weights, bias = fit_weights(rows, np.concatenate([toxic, toxic @ part]), np.concatenate([clean, clean @ part]), steps @ spread)
    return (weights / size)[marker], bias


def fit(sample: DataFrame, identity: dict[str, str] | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """Sorted feature hashes, their weights and the bias, from a bounded sample (label, text)."""
    identity = IDENTITY if identity is None else identity
    known = select_features(sample)
    if not len(known):
        return known, np.zeros(0), -40.0

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, first = batch.column(0), 0
            for block in blocks(batch.column(1).to_pylist()):
                row, at = _present(*features(block), known)
                ends = pa.array(np.searchsorted(row, np.arange(len(block) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([label.slice(first, len(block)), pa.ListArray.from_arrays(ends, pa.array(at.astype(np.int32)))], ["label", "at"])
                first += len(block)

    got = sample.select("label", "text").mapInArrow(presence, "label int, at array<int>").toArrow()
    sets: dict[tuple[int, ...], list[int]] = {}
    for label, at in zip(got["label"].to_pylist(), got["at"].to_pylist()):
        sets.setdefault(tuple(at), [0, 0])[label] += 1
    present = np.zeros((len(sets), len(known)), dtype=np.float32)
    for i, at in enumerate(sets):
        present[i, list(at)] = 1
    clean, toxic = np.array(list(sets.values()), dtype=np.float64).T
    weights, bias = fit_markers(present, toxic, clean, changes(sample, known, identity))
    return known, weights, bias


def toxicity_of(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Column:
    """Fits the classifier and gives the score column for ``docs``."""
    spark = ready(docs.sparkSession)
    sample = labelled_sample(docs, labels, label_col, folds, held_out, PER_CLASS, id_col, text_col)
    model = spark.sparkContext.broadcast(fit(sample))

    def score(text: pa.Array) -> pa.Array:
        known, weights, bias = model.value
        out = []
        for block in blocks(text.fill_null("").to_pylist()):
            row, at = _present(*features(block), known)
            logit = bias + np.bincount(row, weights=weights[at], minlength=len(block)) if len(known) else np.full(len(block), bias)
            out.append(1 / (1 + np.exp(-np.clip(logit, -40, 40))))
        return pa.array(np.concatenate(out) if out else [], pa.float64())

    return F.arrow_udf(score, "double")(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, folds: int = 3, held_out: int = 1,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted for every document."""
    score = toxicity_of(docs, labels, folds, held_out, id_col, text_col, label_col)
    scored = docs.select(F.col(id_col).alias("doc_id"), (fold(id_col, folds) == held_out).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def drop_toxic(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.7, folds: int = 3, held_out: int = 1,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with all their columns."""
    score = toxicity_of(docs, labels, folds, held_out, id_col, text_col, label_col)
    return docs.withColumn("__toxicity", score).filter(F.col("__toxicity") < threshold).drop("__toxicity")
