"""Staging load as a stream of new raw files.

The same flatten step, the same choice among copies and the same append as the daily job:
a run processes the files that arrived since the last one, in bounded batches, and stops
(``availableNow``). Nothing is kept in memory between batches and no row is ever too late:
what the table already holds is skipped by the append, so restarting from a checkpoint,
or losing it, never duplicates or loses a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from playlens.config import FlattenSpec
from playlens.plans.flatten import flatten, unique_events
from playlens.schema import RAW_EVENT
from playlens.sinks.commits import append_raw, staging_table
from playlens.sinks.tables import append_new

FILES_PER_BATCH = 1000


def read_raw_stream(spark: SparkSession, root: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """New files as a stream, so many at a time; a backlog takes more batches, not larger ones."""
    return spark.readStream.schema(RAW_EVENT).option("maxFilesPerTrigger", files_per_batch).parquet(root)


def stream_flatten(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    spec: FlattenSpec,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Starts one catch-up run; wait for it with ``awaitTermination()``."""

    def load(batch: DataFrame, _: int) -> None:
        flat = flatten(batch, spec)
        append_new(batch.sparkSession, unique_events(flat, spec), target, days_from=flat)

    return (
        read_raw_stream(spark, source, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_flatten_marked(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    spec: FlattenSpec,
    files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """``stream_flatten`` into a marked table: each batch becomes visible as a whole.

    It may run beside the daily load of the same files: who commits second starts again from what the
    first one added, so each key arrives once.
    """

    def load(batch: DataFrame, _: int) -> None:
        append_raw(staging_table(batch.sparkSession, batch, target, spec), batch, spec)

    return (
        read_raw_stream(spark, source, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
