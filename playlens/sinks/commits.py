"""Tables whose loads become visible all at once, or not at all.

A load writes its days into a folder of its own, ``load=<id>/event_date=<day>``, which nobody reads yet. A marker
file, numbered one higher than the last, then names for every day the loads it consists of: renaming it
into place is the commit. Readers follow the highest marker, so they see a load whole, and a load that dies between
files leaves the table as it was. Two writers may try the same number; the file system gives it to one, and the
other starts again from what the table holds by then. So a key that both would add is added once.

The rename must fail where the target exists, as it does on HDFS and on local disks.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from collections.abc import Callable, Iterable
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.config import FlattenSpec
from playlens.operators.keys import new_rows_only
from playlens.plans.flatten import KEY, event_base, flatten
from playlens.operators.narrow import unique_events_narrow
from playlens.sinks.tables import DAY, StrayRows, clustered
from playlens.sources.shards import load_window

MARKERS = "_commits"  # readers of the plain folder skip names with an underscore
WHOLE = "all"  # the one piece of a table without days
NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's name of a NULL partition


class Snapshot(NamedTuple):
    """What one marker says: the loads that make up each day."""

    version: int
    days: dict[str, list[str]]

    def folders(self, root: str, column: str | None, days: Iterable[str] | None = None) -> list[str]:
        wanted = self.days if days is None else [d for d in days if d in self.days]
        below = lambda day: f"/{column}={day}" if column else ""
        return [f"{root}/load={load}{below(day)}" for day in wanted for load in self.days[day]]


class LostRace(Exception):
    """Another writer committed first."""


class MarkedTable:
    """A table below ``root`` with markers, by days of the column ``day`` or (None) in one piece."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, day: str | None = DAY):
        self.spark, self.root, self.schema, self.day = spark, root.rstrip("/"), schema, day
        jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(hadoop)
        self._by_link = self._fs.getUri().getScheme() == "file"  # a local rename would replace its target

    # --- markers

    def _marker(self, version: int) -> str:
        return f"{self.root}/{MARKERS}/{version:012d}.json"

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest state, or that of one marker."""
        if version is None:
            folder = self._path(f"{self.root}/{MARKERS}")
            names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
            version = max((int(n[:12]) for n in names if n.endswith(".json")), default=0)
        if version == 0:
            return Snapshot(0, {})
        stream = self._fs.open(self._path(self._marker(version)))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Snapshot(version, json.loads(text))

    def _publish(self, version: int, days: dict[str, list[str]]) -> None:
        """Puts the marker in place, or raises ``LostRace`` if its number is taken."""
        target = self._marker(version)
        draft = f"{self.root}/{MARKERS}/_draft-{uuid.uuid4().hex}"
        stream = self._fs.create(self._path(draft), True)
        stream.write(bytearray(json.dumps(days, sort_keys=True).encode()))
        stream.close()
        try:
            if self._by_link:
                os.link(*[self._path(p).toUri().getPath() for p in (draft, target)])
            else:
                self._rename(draft, target)
        except FileExistsError:
            raise LostRace(target) from None
        except Py4JJavaError as failed:
            if "FileAlreadyExistsException" not in str(failed.java_exception.getClass()):
                raise
            raise LostRace(target) from None
        finally:
            self._fs.delete(self._path(draft), False)

    def _rename(self, source: str, target: str) -> None:
        """A rename that fails where the target exists."""
        fs, gateway = self.spark._jvm.org.apache.hadoop.fs, self.spark.sparkContext._gateway
        kind = getattr(fs, "Options$Rename")
        options = gateway.new_array(kind, 1)
        options[0] = kind.NONE
        context = fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(self._path(source), self._path(target), options)

    # --- reading

    def read(self, state: Snapshot | None = None, days: Iterable[dt.date] | None = None) -> DataFrame:
        """The table, or some days of it, as one marker describes it."""
        state = state or self.snapshot()
        wanted = None if days is None else [*sorted({d.isoformat() for d in days}), NO_DAY]
        folders = state.folders(self.root, self.day, wanted)
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        df = self.spark.read.schema(self.schema).option("basePath", self.root).parquet(*folders)
        return df.select(*self.schema.names)

    # --- writing

    def _stage(self, rows: DataFrame) -> tuple[str, list[str]]:
        """Writes rows into a load folder that no marker names yet; its id and days."""
        load = uuid.uuid4().hex
        folder = f"{self.root}/load={load}"
        if self.day is None:
            rows.select(*self.schema.names).write.parquet(folder)
            return load, [WHOLE]
        clustered(rows.select(*self.schema.names), self.day).write.partitionBy(self.day).parquet(folder)
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(folder)) if s.isDirectory()]
        return load, [n.split("=", 1)[1] for n in names if n.startswith(f"{self.day}=")]

    def commit(self, build: Callable[[Snapshot], DataFrame], replaces: Iterable[dt.date] | None = (), attempts: int = 20) -> Snapshot:
        """Adds what ``build`` makes of a snapshot, in place of the days in ``replaces`` (None: of all days).

        ``build`` runs again if another writer was first.
        """
        for _ in range(attempts):
            state = self.snapshot()
            load, days = self._stage(build(state))
            gone = set(state.days) if replaces is None else {d.isoformat() for d in replaces}
            new = {day: loads for day, loads in state.days.items() if day not in gone}
            for day in days:
                new[day] = [*new.get(day, []), load]
            try:
                self._publish(state.version + 1, new)
            except LostRace:
                self._fs.delete(self._path(f"{self.root}/load={load}"), True)
                continue
            return Snapshot(state.version + 1, new)
        raise LostRace(f"{attempts} times at {self.root}")

    def append_new(self, incoming: DataFrame, days: list[dt.date] | None = None, key: str = KEY) -> Snapshot:
        """Adds rows whose key the table does not hold (a first load: all); rows already there never change.

        ``days`` are those the incoming rows can fall into; keys are read back for these and their neighbours.
        """
        near = None if days is None else {d + dt.timedelta(days=n) for d in days for n in (-1, 0, 1)}

        def new(state: Snapshot) -> DataFrame:
            return new_rows_only(incoming, self.read(state, near).select(key), key) if state.version else incoming

        return self.commit(new)

    def replace_all(self, rows: DataFrame) -> Snapshot:
        """Other rows in place of the whole table; who reads the old ones goes on reading them."""
        return self.commit(lambda _: rows, replaces=None)

    def replace_day(self, rows: DataFrame, day: dt.date) -> Snapshot:
        """One day's rows in place of what the table holds of it; other days stay, and so do readers' snapshots."""
        if strays := rows.where(~F.col(self.day).eqNullSafe(F.lit(day))).count():
            raise StrayRows(f"{strays} rows are not of {day.isoformat()}")
        return self.commit(lambda _: rows, replaces=[day])

    def vacuum(self, keep: int = 10) -> int:
        """Deletes load folders that none of the last ``keep`` markers names, and older markers.

        Loads still being written have no marker, so this must not run beside a writer.
        """
        newest = self.snapshot()
        versions = range(max(1, newest.version - keep + 1), newest.version + 1)
        used = {load for v in versions for loads in self.snapshot(v).days.values() for load in loads}
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.root))]
        unused = [n for n in names if n.startswith("load=") and n.split("=", 1)[1] not in used]
        for name in unused:
            self._fs.delete(self._path(f"{self.root}/{name}"), True)
        for version in range(1, versions.start):
            self._fs.delete(self._path(self._marker(version)), False)
        return len(unused)


def staging_table(spark: SparkSession, raw: DataFrame, root: str, spec: FlattenSpec) -> MarkedTable:
    return MarkedTable(spark, root, flatten(raw, spec).schema)


def _days_of(flat: DataFrame) -> list[dt.date]:
    """The days of the rows: as many as the calendar has at most."""
    return [r[0] for r in flat.select(DAY).where(F.col(DAY).isNotNull()).distinct().collect()]


def load_flatten(spark: SparkSession, raw: DataFrame, root: str, spec: FlattenSpec, run_date: dt.date) -> Snapshot:
    """One daily run of the staging table, visible as a whole."""
    table = staging_table(spark, raw, root, spec)
    window = load_window(raw, spec, run_date, table.snapshot().version == 0)
    return append_raw(table, window, spec)


def append_raw(table: MarkedTable, raw: DataFrame, spec: FlattenSpec) -> Snapshot:
    """Flat rows of raw events with keys the table does not hold; also the body of the streaming load."""
    return table.append_new(unique_events_narrow(raw, spec), _days_of(flatten(raw, spec)))


def load_base(spark: SparkSession, flat: DataFrame, root: str, spec: FlattenSpec, run_date: dt.date) -> Snapshot:
    """One daily run of the base table, visible as a whole."""
    table = MarkedTable(spark, root, event_base(flat, spec, run_date).schema)

    def new(state: Snapshot) -> DataFrame:
        if state.version == 0:
            return event_base(flat, spec, run_date)
        oldest, newest = spec.later_window
        last = 0 if newest is None else newest
        ahead = [run_date - dt.timedelta(days=n) for n in range(last, oldest + 1)]
        if newest is None:  # the window is open: later days the table holds count too
            ahead += [d for d in map(_date, state.days) if d is not None and d > run_date]
        return event_base(flat, spec, run_date, table.read(state, ahead).select(KEY))

    return table.commit(new)


def _date(day: str) -> dt.date | None:
    return None if day == NO_DAY else dt.date.fromisoformat(day)
