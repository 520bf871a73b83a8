"""Which source files were loaded, so that late files and unfinished days are found and nothing else is read.

The load windows look back a day or two; a file that arrives in an older shard, or is written again, is never in
them. The ledger keeps path, time of writing and size of every file a load has taken; what the source holds beyond that
is pending. A file is entered after its rows are in the table, so a load that dies repeats, and its keys are
skipped by then.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.config import DEFAULT_GAME, FlattenSpec, Game
from playlens.functions.dates import shard_of
from playlens.schema import RAW_EVENT
from playlens.sinks.commits import MarkedTable, Snapshot, append_raw, staging_table
from playlens.sinks.tables import build_day
from playlens.sources.shards import read_raw

FILES = T.StructType().add("path", T.StringType()).add("modified", T.TimestampType()).add("size", T.LongType())
BATCH_FILES = 1000


def source_files(spark: SparkSession, root: str) -> DataFrame:
    """``(path, modified, size)`` of the files below a folder; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    return files.select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))


def shard_of_path(path: str) -> Column:
    return F.regexp_extract(path, r"/shard=(\d{8})/", 1)


class Ledger:
    """The files whose content a target holds, as a marked table below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.table = spark, MarkedTable(spark, root, FILES, day=None)

    def pending(self, source: str) -> DataFrame:
        """Files not entered as they are now: new ones, and those written again."""
        return source_files(self.spark, source).join(self.table.read(), ["path", "modified", "size"], "left_anti")

    def enter(self, files: DataFrame) -> None:
        """Adds files that are not in the ledger yet."""

        def new(state: Snapshot) -> DataFrame:
            return files.select(*FILES.names).join(self.table.read(state), FILES.names, "left_anti")

        self.table.commit(new)


def _rows_of(spark: SparkSession, source: str, paths: list[str]) -> DataFrame:
    return spark.read.schema(RAW_EVENT).option("basePath", source).parquet(*paths)


def load_pending(spark: SparkSession, source: str, root: str, ledger: Ledger, spec: FlattenSpec, batch_files: int = BATCH_FILES) -> int:
    """Loads all files the ledger does not know into the staging table, so many at a time, whatever their shard."""
    waiting = sorted(tuple(r) for r in ledger.pending(source).collect())  # names of new files alone
    for low in range(0, len(waiting), batch_files):
        part = waiting[low : low + batch_files]
        rows = _rows_of(spark, source, [path for path, *_ in part])
        append_raw(staging_table(spark, rows, root, spec), rows, spec)
        ledger.enter(spark.createDataFrame(part, FILES))
    return len(waiting)


def resume_backfill(
    spark: SparkSession, source: str, root: str, ledger: Ledger, first: dt.date, last: dt.date, game: Game = DEFAULT_GAME
) -> list[dt.date]:
    """Rebuilds the days of a range whose files are not all in the ledger; returns them.

    A day is entered once it is written. So a range that was stopped goes on where it was, and a day
    with a late or rewritten file is built again as a whole.
    """
    day = F.to_date(shard_of_path("path"), "yyyyMMdd")
    files = ledger.pending(source).withColumn("day", day).where(F.col("day").between(F.lit(first), F.lit(last)))
    open_days = sorted(r[0] for r in files.select("day").distinct().collect())
    for one in open_days:
        taken = source_files(spark, f"{source}/shard={shard_of(one)}").collect()  # the files of one day
        build_day(read_raw(spark, source), root, one, game)
        ledger.enter(spark.createDataFrame(taken, FILES))
    return open_days
