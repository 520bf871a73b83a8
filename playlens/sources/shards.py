"""Scans of the raw export, a parquet dataset partitioned by ``shard``.

The shard bounds are literals, so Spark turns them into partition filters and
lists only the days it needs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.config import FlattenSpec
from playlens.functions.dates import shard_of
from playlens.schema import RAW_EVENT


def read_raw(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(RAW_EVENT).parquet(root)


def one_day(raw: DataFrame, day: dt.date) -> DataFrame:
    return raw.where(F.col("shard") == shard_of(day))


def since(raw: DataFrame, oldest: dt.date) -> DataFrame:
    return raw.where(F.col("shard") >= shard_of(oldest))


def between(raw: DataFrame, oldest: dt.date, newest: dt.date) -> DataFrame:
    return raw.where(F.col("shard").between(shard_of(oldest), shard_of(newest)))


def day_range(raw: DataFrame) -> tuple[dt.date, dt.date]:
    """First and last shard of the log; only the partition column is read."""
    days = raw.agg(F.min("shard"), F.max("shard")).first()
    return tuple(dt.datetime.strptime(str(d), "%Y%m%d").date() for d in days)


def load_window(
    raw: DataFrame, spec: FlattenSpec, run_date: dt.date, first_run: bool
) -> DataFrame:
    """The shards one flatten run reads, as configured for the game."""
    oldest, newest = spec.first_window if first_run else spec.later_window
    start = run_date - dt.timedelta(days=oldest)
    if newest is None:
        return since(raw, start)
    end = run_date - dt.timedelta(days=newest)
    return one_day(raw, start) if start == end else between(raw, start, end)
