"""The keys of a table, kept in buckets, so that checking new rows against them shuffles the new rows alone."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.operators.keys import new_rows_only
from playlens.plans.flatten import KEY
from playlens.sinks.tables import DAY

BUCKETS = 64


class KnownKeys:
    """A catalog table of (key, day), by days and in ``buckets`` of the key, beside a loaded table.

    New rows are dealt into the same number of parts by the same hash, and each meets its bucket where it
    lies. Choose ``buckets`` so that one bucket of the days a load touches fits a task; it cannot change later.
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int = BUCKETS, key: str = KEY, day: str = DAY):
        self.spark, self.name, self.buckets, self.key, self.day = spark, name, buckets, key, day

    def add(self, rows: DataFrame) -> None:
        """Notes the keys of rows that were loaded; rows without a key are left out."""
        keys = rows.where(F.col(self.key).isNotNull()).select(self.key, self.day)
        # Dealt by bucket first, or every task would write a file into every bucket.
        dealt = keys.repartition(self.buckets, self.key)
        dealt.write.mode("append").format("parquet").partitionBy(self.day).bucketBy(self.buckets, self.key).saveAsTable(self.name)

    def known(self, days: Iterable[dt.date] | None = None) -> DataFrame:
        """The keys of some days and their neighbours, or of all days."""
        keys = self.spark.table(self.name)
        if days is None:
            return keys
        near = sorted({d + dt.timedelta(days=n) for d in days for n in (-1, 0, 1)})
        return keys.where(F.col(self.day).isin(near))

    def new_rows(self, incoming: DataFrame, days: Iterable[dt.date] | None = None) -> DataFrame:
        """Incoming rows whose key is not known yet; rows without a key are dropped."""
        if not self.spark.catalog.tableExists(self.name):
            return incoming.dropna(subset=[self.key])
        return new_rows_only(incoming, self.known(days), self.key)
