"""File sources: CSV and JSON with explicit schemas (no inference, no driver pass).

* CSV: header row, permissive mode (a field that does not parse becomes null),
  CRLF or LF line ends, ``True``/``False`` booleans.
* JSON: by default a file is one JSON document (e.g. a pretty-printed array of
  objects), however it is broken into lines, and many tasks read one file (see
  :func:`read_json_documents`); pass ``multi_line=False`` for JSON lines.
"""

from __future__ import annotations

import configparser

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lendlayer.session import ready
from lendlayer.sources.json_ranges import FRAGMENT, OBJECT, SUMMARY, cut, sum_up


def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True) -> DataFrame:
    return (
        spark.read.option("header", header)
        .option("mode", "PERMISSIVE")
        .schema(schema)
        .csv(path)
    )


def read_json(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = True) -> DataFrame:
    if multi_line:
        return read_json_documents(spark, path, schema)
    return spark.read.schema(schema).json(path)


def read_json_documents(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The objects of JSON files that hold an array of objects (or one object, or several in a row).

    Files are cut at every ``}`` instead of at line ends, so Spark reads one file in many byte
    ranges. Whether a range begins inside a string, and how deep in brackets, is not known
    to the task that reads it. Each range is therefore summed up for both cases (quotes flip
    the one state, brackets outside strings move the other), the summaries of a file's
    ranges, a row each, are combined from its start, and then every range's place is known.
    Objects that lie in one range are put together and parsed where they are; only what a range
    begins and ends with, when that belongs to an object of several ranges, moves to another task.

    The files are read three times (summaries, whole objects, the ranges' first and last pieces), which costs
    far less than moving or sorting their text. Objects are parsed with ``from_json`` in permissive
    mode: a broken object is a row of nulls and its neighbours are unharmed. Elements of an array that are no objects are
    left out. In a file whose brackets don't balance, all from the fault on counts as one object.
    """
    raw = ready(spark).read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_block_length").alias("length"), "value",
    )
    along = Window.partitionBy("file").orderBy("block")
    past = along.rowsBetween(Window.unboundedPreceding, -1)
    ranges = raw.mapInArrow(sum_up, SUMMARY)
    ranges = ranges.withColumn("state", F.coalesce(F.sum("odd").over(past), F.lit(0)) % 2)
    ranges = ranges.withColumn("moved", F.when(F.col("state") == 0, F.col("outside")).otherwise(F.col("inside")))
    ranges = ranges.select(
        F.col("file").alias("r_file"), F.col("block").alias("r_block"), F.col("length").alias("r_length"),
        "state", F.coalesce(F.sum("moved").over(past), F.lit(0)).alias("depth"),
        F.when(F.first("array").over(along), 1).otherwise(0).alias("base"),
        F.lag("block").over(along).isNull().alias("opens"), F.lead("block").over(along).isNull().alias("last"),
    )
    same = (F.col("file") == F.col("r_file")) & (F.col("block") == F.col("r_block")) & (F.col("length") == F.col("r_length"))
    placed = raw.join(F.broadcast(ranges), same, "left").select("file", "block", "value", "state", "depth", "base", "opens", "last")

    # objects of several ranges: numbered by the ends before them in the file
    fragments = placed.mapInArrow(cut(False), FRAGMENT)
    before = Window.partitionBy("file").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, -1)
    fragments = fragments.withColumn("nth", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    joined = fragments.groupBy("file", "nth").agg(
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("block", "part", F.col("value").cast("string").alias("value")))), lambda x: x["value"])).alias("value")
    )
    text = placed.mapInArrow(cut(True), OBJECT).select(F.col("value").cast("string").alias("value")).unionByName(joined.select("value"))
    # what comes before an object: brackets, commas, elements that are no objects
    lead = r'^(?:[^"{]++|"(?:[^"\\]++|\\.)*+")*+'
    text = text.select(F.regexp_replace("value", lead, "").alias("value")).filter(F.startswith("value", F.lit("{")))
    parsed = text.select(F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("object"))
    return parsed.select("object.*")


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """CSV with a header; values are written as they are (no whitespace stripping)."""
    (
        df.write.mode("overwrite")
        .option("header", header)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines (one object per line); null fields are omitted as Spark does."""
    df.write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The table lists of an INI manifest: ``[tables]`` with comma-separated lists by name."""
    config = configparser.ConfigParser()
    config.read_string(spark.read.text(path, wholetext=True).first()["value"])
    return {name: [t.strip() for t in value.split(",") if t.strip()] for name, value in config["tables"].items()}
