"""Bounded samples of labelled documents, the same whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlayer.llm.frames import fold, keep, plain_documents


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, folds: int, held_out: int, per_class: dict[int, int],
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(label, text) of at most ``per_class[label]`` documents of each label, outside the held-out fold.

    The ids are those with the least hashes; their number bounds what is broadcast. Of conflicting labels of an id
    the one with the least hash counts, and of several documents with one id the text with the least hash, so
    the sample holds one row an id at most.
    """
    usable = labels.filter(fold(id_col, folds) != held_out).select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("label"))
    usable = usable.filter("l_id is not null and label is not null").groupBy("l_id").agg(F.min(F.struct(F.xxhash64("label"), "label"))["label"].alias("label"))
    picked = None
    for label, most in per_class.items():
        some = usable.filter(F.col("label") == label).orderBy(F.xxhash64("l_id"), "l_id").limit(most)
        picked = some if picked is None else picked.union(some)
    picked = keep(picked, "picked")
    plain = plain_documents(docs, id_col, text_col)
    found = plain.join(F.broadcast(picked), F.col("doc_id") == F.col("l_id"))
    one = found.groupBy("l_id").agg(F.min(F.struct(F.xxhash64("text"), "text", "label")).alias("x"))
    return keep(one.select("x.label", "x.text"), "labelled")
