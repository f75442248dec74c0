"""Small Spark helpers that the training-data operators share."""

from __future__ import annotations

import atexit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlayer.session import ready, scratch_path

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts the lineage: a lost executor costs a reread, not a recomputation. The files go
    when the driver program ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.mode("overwrite").parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    sc = spark.sparkContext
    if sc._jsc is None:
        return
    try:
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001 - the session may be gone; its folder is then the platform's to clear
        pass


def text_of(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def plain_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only id and text, under fixed names: other columns can't clash with what operators add."""
    return docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id counts as empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(folds))
