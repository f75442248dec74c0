"""Quality rules and a hashed n-gram likelihood ratio.

Two multinomials over hashed word unigrams and bigrams are counted over all data: one over
the trusted target (documents that the labels call good), one over the raw corpus. A
document's score is the mean log ratio of its n-grams under the two, so it does not depend on
length, and a fixed threshold decides every document alike. Plain rules on word count and
repeated windows reject first.

Null or wordless texts have no n-grams: score 0, but too few words to be kept. Null ids
pass through and are never trusted; repeated rows count as often as they occur; an empty
table gives an empty one; without trusted documents all scores are 0. Other columns are
not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlayer.llm.frames import keep, plain_documents, ready
from lendlayer.llm.textkit import BYTE, SPACE, U64, Texts, Words, code_points, column_texts, mix, span_hashes, windows, word_hashes, words

BUCKETS = 1 << 16
#: A document stays with a mean log ratio of at least this (natural logarithm).
THRESHOLD = -0.1
#: Pseudo-counts that each bucket has in either multinomial.
SMOOTHING = 1.0

_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1
_NEWLINE = 0x0A


def ngram_buckets(texts: Texts, found: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and row of every word and word pair (A-Z lower-cased)."""
    hashes = word_hashes(texts, found, lower=True)
    pairs, at = windows(hashes, found.row, 2)
    grams = np.concatenate([mix(hashes), pairs])
    return (grams & U64(BUCKETS - 1)).astype(np.int64), np.concatenate([found.row, found.row[at]])


def _per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def base_rules(texts: Texts, found: Words) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each row."""
    data, offsets, rows = texts.data, texts.offsets, len(texts)
    out = {
        "n_words": np.diff(found.bounds),
        "word_chars": _per_row((code_points(data) & ~SPACE[data]).astype(np.int64), offsets),
        "n_symbols": _per_row(_SYMBOL[data], offsets),
    }
    # Lines that hold a word: spans between newlines and row ends.
    breaks = np.flatnonzero(data == _NEWLINE)
    line_starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_starts = line_starts[line_starts < len(data)]
    row = np.searchsorted(offsets, line_starts, side="right") - 1
    line_ends = np.append(line_starts[1:], len(data))
    line_ends = np.minimum(line_ends, offsets[row + 1])
    line_ends = line_ends - ((line_ends > line_starts) & (data[np.maximum(line_ends - 1, 0)] == _NEWLINE))
    has_word = np.searchsorted(found.starts, line_ends) > np.searchsorted(found.starts, line_starts)
    line_starts, line_ends, row = line_starts[has_word], line_ends[has_word], row[has_word]
    key = mix(span_hashes(BYTE[data], line_starts, line_ends) + mix(row.astype(np.uint64) + U64(1)))
    _, first = np.unique(key, return_index=True)
    out["n_dup_lines"] = np.bincount(row, minlength=rows) - np.bincount(row[first], minlength=rows)
    hashes = word_hashes(texts, found)
    triples, at = windows(hashes, found.row, 3)
    key = mix(triples + mix(found.row[at].astype(np.uint64) + U64(1)))
    _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
    again = at[count[inverse] > 1] if len(at) else at
    covered = np.zeros(len(found.row) + 3, dtype=bool)
    for j in range(3):
        covered[again + j] = True
    out["n_repeat_words"] = np.bincount(found.row[covered[: len(found.row)]], minlength=rows)
    return out


def ngram_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(bucket, n) over all texts; each task adds up its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for texts in column_texts(batch.column(0)):
                total += np.bincount(ngram_buckets(texts, words(texts))[0], minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], ["bucket", "n"])

    made = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).mapInArrow(count, "bucket int, n bigint")
    return made.groupBy("bucket").agg(F.sum("n").alias("n"))


def log_ratios(raw: DataFrame, trusted: DataFrame) -> np.ndarray:
    """Log of target over corpus probability for each bucket (a table of :data:`BUCKETS` numbers)."""
    both = raw.join(trusted.withColumnRenamed("n", "t"), "bucket", "left").select("bucket", "n", F.coalesce("t", F.lit(0)).alias("t"))
    got = both.toArrow()
    counts = np.full((2, BUCKETS), SMOOTHING)
    counts[:, got["bucket"].to_numpy()] += np.stack([got["t"].to_numpy(), got["n"].to_numpy()])
    if not got["t"].to_numpy().any():
        return np.zeros(BUCKETS)
    share = counts / counts.sum(axis=1, keepdims=True)
    return np.log(share[0] / share[1])


def judge_quality(
    docs: DataFrame,
    labels: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """doc_id, the base rules, base_failed, score, kept for every document."""
    spark = ready(docs.sparkSession)
    plain = plain_documents(docs, id_col, text_col)
    good = labels.filter(F.col(label_col) == 1).select(F.col(id_col).alias("good_id")).distinct()
    trusted = plain.join(good.hint("shuffle_hash"), F.col("doc_id") == F.col("good_id"), "left_semi")
    ratio = spark.sparkContext.broadcast(log_ratios(keep(ngram_counts(plain), "raw_counts"), keep(ngram_counts(trusted), "target_counts")))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def judge(text: pa.Array) -> pa.Array:
        made: dict[str, list[np.ndarray]] = {n: [] for n in (*names, "score")}
        for texts in column_texts(text):
            found = words(texts)
            for name, values in base_rules(texts, found).items():
                made[name].append(values)
            bucket, row = ngram_buckets(texts, found)
            total = np.bincount(row, weights=ratio.value[bucket], minlength=len(texts))
            made["score"].append(total / np.maximum(np.bincount(row, minlength=len(texts)), 1))
        kind = {n: pa.int64() for n in names} | {"score": pa.float64()}
        return pa.StructArray.from_arrays([pa.array(np.concatenate(v) if v else [], kind[n]) for n, v in made.items()], list(made))

    kind = ", ".join(f"{n}: bigint" for n in names)
    out = plain.select("doc_id", F.arrow_udf(judge, f"struct<{kind}, score: double>")(F.col("text")).alias("m")).select("doc_id", "m.*")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
