"""Writers for day-partitioned parquet tables.

Every writer can be repeated after a failure: a day is replaced as a whole, and
an append skips keys that already arrived.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.config import DEFAULT_GAME, FlattenSpec, Game
from playlens.operators.keys import new_rows_only
from playlens.plans.flatten import KEY, event_base, flatten, unique_events
from playlens.plans.split import split_events
from playlens.sources.shards import load_window, one_day

DAY = "event_date"
CLUSTER = ("event_name", "user_pseudo_id")


def clustered(df: DataFrame, *columns: str) -> DataFrame:
    """Rows gathered by partition columns and sorted for row-group skipping.

    A rebalance (not a plain repartition) splits a partition value that holds a
    large share of the rows into several files and merges small ones.
    """
    order = dict.fromkeys((*columns, *[c for c in CLUSTER if c in df.columns]))
    return df.hint("rebalance", *columns).sortWithinPartitions(*order)


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def create_empty(df: DataFrame, root: str, partitions: Sequence[str] = (DAY,)) -> None:
    """An empty table with the columns of ``df``, unless one is there already."""
    df.limit(0).write.mode("ignore").partitionBy(*partitions).parquet(root)


def read_table(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The table, or an empty frame when nothing was written yet."""
    if is_first_run(spark, root):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(root)


class StrayRows(ValueError):
    """Rows of another day than the one that was written."""


def replace_day(events: DataFrame, root: str, day: dt.date) -> None:
    """Replace exactly one day of the typed event table.

    The day's folder is overwritten statically: event partitions that get no rows
    this time disappear (a dynamic overwrite would leave them), other days stay. Rows of
    another day, or of none, have no place in the folder: they are counted first, which reads
    the date alone, and raise ``StrayRows``, so none is lost unseen.
    """
    of_day = F.col(DAY).eqNullSafe(F.lit(day))
    if strays := events.where(~of_day).count():
        raise StrayRows(f"{strays} rows are not of {day.isoformat()}")
    rows = events.where(of_day).drop(DAY)
    (
        clustered(rows, "event_name")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("event_name")
        .parquet(f"{root}/{DAY}={day.isoformat()}")
    )


def write_events(events: DataFrame, root: str) -> None:
    """First load of the typed event table with all days at once."""
    (
        clustered(events, DAY, "event_name")
        .write.mode("overwrite")
        .partitionBy(DAY, "event_name")
        .parquet(root)
    )


def build_day(raw: DataFrame, root: str, day: dt.date, game: Game = DEFAULT_GAME) -> None:
    """Split one raw day into its typed tables: one scan, one write."""
    replace_day(split_events(one_day(raw, day), game), root, day)


def backfill(
    raw: DataFrame,
    root: str,
    first: dt.date,
    last: dt.date,
    game: Game = DEFAULT_GAME,
    parallel_days: int = 4,
) -> None:
    """Rebuild a range of days, some at a time.

    Each day is its own job on its own folder, so days do not wait for each
    other's stragglers and a failed range can be restarted at any day.
    """
    days = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
    build = inheritable_thread_target(raw.sparkSession)(
        lambda day: build_day(raw, root, day, game)
    )
    with ThreadPoolExecutor(parallel_days) as pool:
        for done in [pool.submit(build, day) for day in days]:
            done.result()


def append_days(df: DataFrame, root: str) -> None:
    clustered(df, DAY).write.mode("append").partitionBy(DAY).parquet(root)


def _days_near(rows: DataFrame, widen: int) -> list[dt.date]:
    """The days of the rows and their neighbours: a list as long as the calendar at most."""
    near = F.explode(F.array(*[F.date_add(DAY, n) for n in range(-widen, widen + 1)]))
    return [r[0] for r in rows.where(F.col(DAY).isNotNull()).select(near.alias(DAY)).distinct().collect()]


def append_new(
    spark: SparkSession,
    incoming: DataFrame,
    root: str,
    key: str = KEY,
    days_from: DataFrame | None = None,
) -> None:
    """Append rows whose key is not in the table; rows already there never change.

    Equal keys share their timestamp, so only the days the load touches (and
    their neighbours, as the two date rules differ by less than a day) are read
    back, keys only; one stray date adds its own days and not those between.
    ``days_from`` names a frame with the same days that is cheaper
    to read than ``incoming``, such as the rows before deduplication.
    """
    dated = incoming if days_from is None else days_from
    days = _days_near(dated.select(DAY), widen=1)
    target = read_table(spark, root, incoming.schema)
    known = target.where(F.col(DAY).isin(days) | F.col(DAY).isNull()).select(key)
    append_days(new_rows_only(incoming, known, key), root)


def is_first_run(spark: SparkSession, root: str) -> bool:
    """Whether nothing was ever written there. Any other trouble with the table is raised."""
    try:
        spark.read.schema("key string").parquet(root)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return True
    return False


def load_flatten(
    spark: SparkSession, raw: DataFrame, root: str, spec: FlattenSpec, run_date: dt.date
) -> None:
    """One daily run of the staging table."""
    first = is_first_run(spark, root)
    flat = flatten(load_window(raw, spec, run_date, first), spec)
    rows = unique_events(flat, spec)
    if first:
        append_days(rows, root)
    else:
        append_new(spark, rows, root, days_from=flat)


def load_base(
    spark: SparkSession, flat: DataFrame, root: str, spec: FlattenSpec, run_date: dt.date
) -> None:
    """One daily run of the base table."""
    if is_first_run(spark, root):
        append_days(event_base(flat, spec, run_date), root)
        return
    oldest, newest = spec.later_window
    schema = event_base(flat, spec, run_date).schema
    known = read_table(spark, root, schema).where(
        F.col(DAY) >= F.lit(run_date - dt.timedelta(days=oldest))
    )
    if newest is not None:
        known = known.where(F.col(DAY) <= F.lit(run_date - dt.timedelta(days=newest)))
    append_days(event_base(flat, spec, run_date, known.select(KEY)), root)


def rebuild_report(report: DataFrame, root: str) -> None:
    """Full rebuild of a report table."""
    report.write.mode("overwrite").parquet(root)
