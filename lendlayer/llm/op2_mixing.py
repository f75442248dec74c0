"""Mixing sources to target weights by raking (DataFrame functions only).

Documents fall into cells of source, language and topic. Iterative proportional fitting
scales the cells' token weights to the target shares of one dimension after the other, for
:data:`ROUNDS` rounds; :func:`margin_error` says how far the margins are off then. A document is then sampled with a probability in proportion to its
cell's weight per token, scaled so that ``keep_share`` of all tokens are expected to stay. If
a cell would need more than it has, it is kept whole and the raking goes on with the cells
held at what they have: the others of its source, language and topic make up for it, so a
rare cell never shrinks the sample. The expected token shares of the sample are the targets
unless a source, language or topic has too little; then it is kept whole and the rest share
what it lacks.

Without explicit targets a dimension's target is its own token share raised to ``flatten`` and
normalised, which lifts small sources and damps large ones. Without a topic column, a text's
topic is a hash class of its longest word.

Only the table of cells (at most sources x languages x topics rows) is iterated on. A hot
source is a few cells; documents meet the cells in a join whose cell side is broadcast by
Spark if it is small enough and split by it where a cell is hot otherwise.

Null sources, languages and topics are values of their own; null and empty texts have no
tokens and are sampled like their cell; null ids share one draw per text; repeated rows
share a draw; an empty table gives an empty one. Other columns are not looked at.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlayer.llm.frames import keep, text_of

WORD = r"[^\x20\x09-\x0D]+"
TOPICS = 8
ROUNDS = 10
#: Rounds between two writes of the cells, and such blocks at most.
BLOCK, MOST_BLOCKS = 5, 40
#: Relative error of a margin that counts as fitting.
TOLERANCE = 1e-4
DIMENSIONS = ("source", "lang", "topic")

_log = logging.getLogger(__name__)


def hash_number(value: Column, digits: int) -> Column:
    """The first ``digits`` hexadecimal digits of a text's MD5 as a number."""
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, digits), 16, 10).cast("long")


def longest_word(text: Column) -> Column:
    """The longest word of a text; of several the greatest."""
    words = F.split(text, r"[\x20\x09-\x0D]+")
    return F.array_max(F.transform(words, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]


def topic_of(text: Column, topics: int = TOPICS) -> Column:
    return F.concat(F.lit("t"), F.pmod(hash_number(longest_word(text), 8), F.lit(topics)).cast("string"))


def with_cells(docs: DataFrame, topic_col: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, source, lang, topic and tokens (words) of every document."""
    text = text_of(text_col)
    topic = F.col(topic_col).cast("string") if topic_col else topic_of(text)
    named = lambda c: F.concat(F.when(c.isNull(), "").otherwise("="), F.coalesce(c.cast("string"), F.lit("")))
    return docs.select(
        F.col(id_col).alias("doc_id"), named(F.col("source")).alias("source"), named(F.col("lang")).alias("lang"), named(topic).alias("topic"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"),
    )


def _targets(cells: DataFrame, dimension: str, flatten: float, given: DataFrame | None) -> DataFrame:
    """(dimension, target) with targets that add up to one over the values that occur."""
    have = cells.groupBy(dimension).agg(F.sum("tokens").alias("have"))
    if given is None:
        raw = have.select(F.col(dimension), F.pow("have", F.lit(flatten)).alias("raw"))
    else:
        named = given.select(F.concat(F.lit("="), F.col(dimension).cast("string")).alias(dimension), F.col("share").cast("double").alias("raw"))
        raw = have.select(dimension).join(named, dimension, "left").fillna(0.0, ["raw"])
    whole = raw.agg(F.sum("raw")).first()[0] or 1.0
    return raw.select(F.col(dimension).alias(f"k_{dimension}"), (F.col("raw") / F.lit(float(whole))).alias(f"aim_{dimension}"))


def _aims(cells: DataFrame, flatten: float, targets: Mapping[str, DataFrame] | None) -> DataFrame:
    """The cells with tokens, each with its three targets and its tokens as first weight."""
    cells = keep(cells.filter("tokens > 0"), "cells")
    fitted = cells
    for d in DIMENSIONS:
        fitted = fitted.join(_targets(cells, d, flatten, (targets or {}).get(d)), F.col(d) == F.col(f"k_{d}")).drop(f"k_{d}")
    return keep(fitted.withColumn("weight", F.col("tokens").cast("double")), "aims")


def _rake_plain(fitted: DataFrame, d: str) -> DataFrame:
    margin = F.sum("weight").over(Window.partitionBy(d))
    return fitted.withColumn("weight", F.when(margin > 0, F.col("weight") * F.col(f"aim_{d}") / margin).otherwise(0.0))


def _rake_capped(fitted: DataFrame, d: str) -> DataFrame:
    """One step for the parts ``least(weight, cap)``: the factor never overshoots, as a margin is concave in it."""
    whole = Window.partitionBy(d)
    full, aim = F.col("weight") >= F.col("cap"), F.col(f"aim_{d}")
    margin = F.sum(F.least("weight", "cap")).over(whole)
    stuck, free = F.sum(F.when(full, F.col("cap")).otherwise(0.0)).over(whole), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).over(whole)
    factor = F.when((margin < aim) & (free > 0), (aim - stuck) / free).when(margin > aim, aim / margin).otherwise(1.0)
    return fitted.withColumn("weight", F.col("weight") * factor)


def margin_error(fitted: DataFrame) -> float:
    """The largest relative difference of a margin's share from its target (of the parts under ``cap``, if there is one)."""
    part = F.least("weight", "cap") if "cap" in fitted.columns else F.col("weight")
    worst = None
    for d in DIMENSIONS:
        off = fitted.groupBy(d).agg(F.sum(part).alias("got"), F.first(f"aim_{d}").alias("aim")).filter("aim > 0").select(F.abs(F.col("got") / F.col("aim") - 1).alias("off"))
        worst = off if worst is None else worst.union(off)
    return float(worst.agg(F.max("off")).first()[0] or 0.0)


def _until_fit(fitted: DataFrame, step: Callable[[DataFrame, str], DataFrame], tag: str) -> tuple[DataFrame, float]:
    """Rounds of ``step`` until all margins fit or a block of rounds brings them no nearer, and the error that is left."""
    error = margin_error(fitted)
    for _ in range(MOST_BLOCKS):
        if error <= TOLERANCE:
            break
        for _ in range(BLOCK):
            for d in DIMENSIONS:
                fitted = step(fitted, d)
        fitted, before = keep(fitted, tag), error
        error = margin_error(fitted)
        if error > 0.99 * before:
            break
    return fitted, error


def _rake(aims: DataFrame, rounds: int) -> DataFrame:
    fitted = aims
    for i in range(rounds):
        for d in DIMENSIONS:
            fitted = _rake_plain(fitted, d)
        if i % BLOCK == BLOCK - 1 or i == rounds - 1:
            fitted = keep(fitted, "raked")
    return fitted


def rake(cells: DataFrame, rounds: int = ROUNDS, flatten: float = 0.7, targets: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """source, lang, topic, tokens, weight, aim_*: the cells with weights that fit the margins (they add up to one).

    Every cell carries its three targets, so a step is one sum over each value of a dimension.
    """
    return _rake(_aims(cells, flatten, targets), rounds)


def saturated_scale(fitted: DataFrame, keep_share: float) -> float:
    """The scale at which the expected tokens are ``keep_share`` of all, cells that reach probability 1 kept whole.

    Kept tokens are a concave function of the scale, so Newton's steps rise to the solution from
    below: the cells that the last scale fills are taken out and the rest of the budget is spread
    over the others. Ends when no further cell fills up, or when all that have weight are full.
    """
    t, w = fitted.agg(F.sum("tokens"), F.sum("weight")).first()
    if not t or not w:
        return 0.0
    budget, scale = keep_share * t, keep_share * t / w
    while True:
        full = F.col("weight") * F.lit(scale) >= F.col("tokens")
        whole, rest = fitted.agg(F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, F.col("weight")))).first()
        if not rest:
            return scale
        raised = (budget - (whole or 0)) / rest
        if raised <= scale * (1 + 1e-12):
            return scale
        scale = raised


def probabilities(fitted: DataFrame, keep_share: float) -> DataFrame:
    """source, lang, topic, weight, probability: in proportion to weight per token where no cell exceeds 1.

    Otherwise the raking goes on with every cell held at the tokens it has, so the other cells
    of a full cell's source, language and topic make up for it as far as they can, and the
    scale makes up for the rest.
    """
    t, w, most = fitted.agg(F.sum("tokens"), F.sum("weight"), F.max(F.col("weight") / F.col("tokens"))).first()
    if not t or not w:
        return fitted.select(*DIMENSIONS, "weight", F.lit(0.0).alias("probability"))
    scale, held = keep_share * t / w, fitted.withColumn("raked", F.col("weight"))
    if scale * most > 1:
        held = held.withColumn("cap", F.col("tokens") / F.lit(keep_share * t)).withColumn("weight", F.col("weight") / F.lit(float(w)))
        held, error = _until_fit(held, _rake_capped, "capped")
        if error > TOLERANCE:
            _log.warning("mixing: with keep_share %s the largest margin error is %.3g", keep_share, error)
        scale = saturated_scale(held, keep_share)
    return held.select(*DIMENSIONS, F.col("raked").alias("weight"), F.least(F.lit(1.0), F.col("weight") / F.col("tokens") * F.lit(scale)).alias("probability"))


def draw(id_col: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the id alone."""
    return hash_number(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 13) / float(16**13)


def mix_sources(
    docs: DataFrame, keep_share: float = 0.7, flatten: float = 0.7, rounds: int = ROUNDS, seed: int = 42,
    targets: Mapping[str, DataFrame] | None = None, topic_col: str | None = None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """doc_id, source, lang, topic, tokens, weight (of the cell), probability, sampled: every document."""
    rows = keep(with_cells(docs, topic_col, id_col, text_col), "mix_rows")
    cells = rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"))
    odds = keep(probabilities(rake(cells, rounds, flatten, targets), keep_share), "odds")
    found = rows.join(odds, list(DIMENSIONS), "left")
    # cells without any token have no weight; nothing in them can disturb a share
    chance = F.coalesce("probability", F.lit(keep_share))
    plain = lambda c: F.when(F.col(c) != "", F.expr(f"substring({c}, 2)")).alias(c)
    return found.select(
        "doc_id", *[plain(d) for d in DIMENSIONS], "tokens", F.coalesce("weight", F.lit(0.0)).alias("weight"), chance.alias("probability"),
        (draw(F.col("doc_id"), seed) < chance).alias("sampled"),
    )


def sample_mixture(
    docs: DataFrame, keep_share: float = 0.7, flatten: float = 0.7, rounds: int = ROUNDS, seed: int = 42,
    targets: Mapping[str, DataFrame] | None = None, topic_col: str | None = None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The sampled rows of ``docs`` with all their columns."""
    found = mix_sources(docs, keep_share, flatten, rounds, seed, targets, topic_col, id_col, text_col)
    gone = keep(found.filter(~F.col("sampled")).select(F.col("doc_id").alias("__gone")).distinct(), "unsampled")
    return docs.join(gone, F.col(id_col).eqNullSafe(F.col("__gone")), "left_anti")
