"""Token counts by a prefix dynamic programme.

For every text the operator stores, per character, by how much the token count changes:
its running sum is the exact count of every prefix, as the library would encode that
prefix on its own. Questions about truncation and budgets read the stored steps and never
encode again.

Within a piece of text that merges can't leave, the last token of a prefix is the one
vocabulary entry that ends there and does not merge with the last token of the shorter
prefix before it; the count is one more than that prefix's. Each distinct piece is worked
out once per worker (see :mod:`lendlayer.llm.bpe`).

Null text counts as empty (0 bytes, 0 tokens); null ids pass through; repeated rows give
repeated results; an empty table gives an empty one. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlayer.llm import bpe
from lendlayer.llm.frames import plain_documents, ready

#: Characters that are encoded at a time (a longer single text goes alone).
BLOCK_CHARS = 250_000


def blocks(texts: list[str], size: int = BLOCK_CHARS):
    """Consecutive texts of about ``size`` characters together."""
    block: list[str] = []
    total = 0
    for text in texts:
        if block and total + len(text) > size:
            yield block
            block, total = [], 0
        block.append(text)
        total += len(text)
    if block:
        yield block


def _check(path: str) -> str:
    if not str(path).endswith(".json"):
        raise ValueError(f"{path}: byte-level vocabularies of the tokenizers library (.json) only")
    return str(path)


def step_columns(path: str, with_steps: bool):
    """Arrow UDF of a text: token count, and with ``with_steps`` the steps (one signed byte or more a character)."""
    path = _check(path)

    def count(text: pa.Array) -> pa.Array:
        made = bpe.coder(path)
        totals, steps = [], []
        for block in blocks(text.to_pylist()):
            for s in made.count_steps(block):
                totals.append(int(s.sum()))
                if with_steps:
                    steps.append(s.astype("<i2").tobytes())
        if not with_steps:
            return pa.array(totals, pa.int64())
        return pa.StructArray.from_arrays([pa.array(totals, pa.int64()), pa.array(steps, pa.binary())], ["n_tokens", "steps"])

    return F.arrow_udf(count, "struct<n_tokens: bigint, steps: binary>" if with_steps else "bigint")


def count_tokens(
    docs: DataFrame, path: str, limit: int = 512, with_steps: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens), and optionally steps.

    ``steps`` holds little-endian 16-bit integers, one a character: see :func:`tokens_of_prefix`
    and :func:`longest_prefix`.
    """
    ready(docs.sparkSession)
    plain = plain_documents(docs, id_col, text_col)
    made = step_columns(path, with_steps)(F.col("text"))
    out = plain.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), made.alias("made"))
    tokens = F.col("made.n_tokens") if with_steps else F.col("made")
    columns = ["doc_id", "n_bytes", tokens.alias("n_tokens"), (tokens > limit).alias("over_limit")]
    return out.select(*columns, *([F.col("made.steps").alias("steps")] if with_steps else []))


def tokens_of_prefix(steps: Column, n_chars: Column) -> Column:
    """Exact token count of the first ``n_chars`` characters, from stored steps (beyond the end: the whole)."""

    @F.arrow_udf("bigint")
    def read(s: pa.Array, n: pa.Array) -> pa.Array:
        rows = zip(s.to_pylist(), n.to_pylist())
        return pa.array([None if a is None or b is None else int(np.frombuffer(a, "<i2")[: max(b, 0)].sum()) for a, b in rows], pa.int64())

    return read(steps, n_chars)


def longest_prefix(steps: Column, budget: Column) -> Column:
    """Characters of the longest prefix with at most ``budget`` tokens, from stored steps."""

    @F.arrow_udf("bigint")
    def read(s: pa.Array, n: pa.Array) -> pa.Array:
        out = []
        for a, b in zip(s.to_pylist(), n.to_pylist()):
            if a is None or b is None:
                out.append(None)
                continue
            fits = np.flatnonzero(np.frombuffer(a, "<i2").cumsum() <= b)
            out.append(int(fits[-1]) + 1 if len(fits) else 0)
        return pa.array(out, pa.int64())

    return read(steps, budget)
