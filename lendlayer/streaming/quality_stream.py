"""Incremental bronze -> silver: the same data-quality split over a landing folder, read once.

Files landing in a folder (parquet, CSV or JSON lines, with a declared schema) are
standardised and tagged by the rule registry in one streaming query. Each of its batches is
read once and feeds every sink:

* rejected rows with their reason -> ``reject_path``, and rows whose rule result is NULL
  (``on_unknown="drop"``) -> ``unknown_path`` if one is given, copies kept, in a folder of the batch
  (partition column ``dq_batch``). A batch that runs again after a failure replaces its own
  folder, so it adds nothing;
* clean rows -> a hand-over folder beside the checkpoint, from which a second query writes
  ``silver_path``, de-duplicated on whole rows *across* batches (streaming
  ``dropDuplicates``: each distinct row is emitted once, ever; the seen-rows state lives in RocksDB,
  snapshotted to the checkpoint). Rows that a replayed batch hands over again are copies like any other;
  files that have been taken over are deleted.

No row is ever dropped for being late. Both queries checkpoint to the shared folder, so a restarted or
failed query resumes exactly where it stopped. ``available_now=True`` processes
everything that has landed and then stops (incremental batch); otherwise the
queries keep running on ``processing_time``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from lendlayer.functions.standardize import add_officer_key, standardize
from lendlayer.operators.quality import DEFAULT_RULES, Rule, QualitySplit, split_quality

STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


#: Partition column of the reject and undecided sinks: the batch that wrote a row.
BATCH = "dq_batch"


@dataclass(frozen=True)
class QualityStreams:
    split: StreamingQuery
    silver: StreamingQuery

    @property
    def queries(self) -> tuple[StreamingQuery, ...]:
        return self.split, self.silver

    def await_termination(self, timeout: float | None = None) -> None:
        """Wait for the queries (``available_now`` runs end by themselves); with a
        ``timeout`` in seconds, queries still running then are stopped and an error raised."""
        for q in self.queries:
            if timeout is None:
                q.awaitTermination()
            elif not q.awaitTermination(timeout):
                self.stop()
                raise TimeoutError(f"streaming query {q.name or q.id} still running after {timeout}s")

    def stop(self) -> None:
        for q in self.queries:
            q.stop()


def read_landing(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def stream_split(
    stream: DataFrame,
    table: str | None,
    rules: Sequence[Rule] = DEFAULT_RULES,
    aliases: Mapping[str, str] | None = None,
    on_unknown: str = "drop",
) -> QualitySplit:
    """The batch split applied to a streaming frame (same tagger, same outputs)."""
    return split_quality(add_officer_key(standardize(stream)), table, rules, on_unknown, aliases)


def start_quality_streams(
    spark: SparkSession,
    landing_path: str,
    schema: StructType | str,
    table: str | None,
    silver_path: str,
    reject_path: str,
    checkpoint_path: str,
    fmt: str = "parquet",
    available_now: bool = True,
    processing_time: str = "1 minute",
    rules: Sequence[Rule] = DEFAULT_RULES,
    aliases: Mapping[str, str] | None = None,
    on_unknown: str = "drop",
    max_files_per_trigger: int | None = None,
    unknown_path: str | None = None,
) -> QualityStreams:
    """Start the split of one landing folder and the query that de-duplicates its clean rows.

    With ``available_now`` this returns when all that has landed is split and the clean
    rows' query runs over what it handed over.

    The de-duplication is exact over all time; its state is kept in RocksDB (off-heap,
    snapshotted to the checkpoint), set on a session of its own so that the caller's
    settings stay as they are.
    """
    own = spark.newSession()
    for key, value in STREAM_CONF.items():
        own.conf.set(key, value)
    split = stream_split(
        read_landing(own, landing_path, schema, fmt, max_files_per_trigger), table, rules, aliases, on_unknown
    )
    if BATCH in split.columns:
        raise ValueError(f"the landing folder already has a column {BATCH!r}")
    root = checkpoint_path.rstrip("/")
    handed = f"{root}/clean"
    clean_schema = split.valid_with_duplicates.schema
    own.createDataFrame([], clean_schema).write.mode("append").parquet(handed)  # the folder is there before its reader

    def started(writer: DataStreamWriter, name: str) -> StreamingQuery:
        writer = writer.option("checkpointLocation", f"{root}/{name}").outputMode("append")
        return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)).start()

    feed = batch_sinks(split, handed, reject_path, unknown_path)
    splitting = started(split.tagged.writeStream.foreachBatch(feed), "split")
    if available_now:
        splitting.awaitTermination()
    stream = own.readStream.schema(clean_schema).option("recursiveFileLookup", True).option("cleanSource", "delete").parquet(handed)
    writer = stream.dropDuplicates().writeStream.format("parquet").option("path", silver_path)
    return QualityStreams(splitting, started(writer, "silver"))


def batch_sinks(split: QualitySplit, clean_path: str, reject_path: str, unknown_path: str | None) -> Callable[[DataFrame, int], None]:
    """The writer of one tagged batch to all sinks: the batch is read once, kept while it is written, and let go."""

    def feed(batch: DataFrame, batch_id: int) -> None:
        kept = replace(split, tagged=batch.persist(StorageLevel.MEMORY_AND_DISK))
        try:
            kept.valid_with_duplicates.write.mode("append").parquet(clean_path)
            kept.reject.write.mode("overwrite").parquet(f"{reject_path.rstrip('/')}/{BATCH}={batch_id}")
            if unknown_path:
                kept.unknown.write.mode("overwrite").parquet(f"{unknown_path.rstrip('/')}/{BATCH}={batch_id}")
        finally:
            kept.tagged.unpersist()

    return feed
