"""Cohort reports kept up to date a day at a time (SK4, K6, K8).

Three small tables stand between the events and a report: who opened a version on a day, what each user earned (or that
they were active) on a day, and each user's first day per version. When days are replaced, users whose openings changed
get new first days, and only cohorts are computed again that hold or held such a user or that look at a
replaced day within their horizon. Their rows replace the old ones in one commit, so readers see the report of before or
after, and the events of other days are never read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.config import DEFAULT_EXCLUDED_GEO
from playlens.functions.numbers import ratio
from playlens.operators.ads import user_day_revenue
from playlens.operators.cohorts import USER, VERSION, active_days
from playlens.operators.filters import drop_listed
from playlens.plans.ltv import HORIZONS
from playlens.plans.retention import WEEK, mature
from playlens.session import scratch_dir
from playlens.sinks.commits import MarkedTable
from playlens.sinks.tables import DAY

JOINED, COHORT = "join_date", "cohort_date"
OPENS = T.StructType().add(USER, T.StringType()).add(VERSION, T.StringType()).add(DAY, T.DateType())
DAILY = T.StructType().add(USER, T.StringType()).add("amount", T.DoubleType()).add(DAY, T.DateType())
FIRSTS = (
    T.StructType().add(USER, T.StringType()).add(VERSION, T.StringType()).add("copies", T.LongType()).add(JOINED, T.DateType())
)


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _of_users(rows: DataFrame, users: DataFrame) -> DataFrame:
    same = F.col(f"r.{USER}").eqNullSafe(F.col(f"u.{USER}"))
    return rows.alias("r").join(users.alias("u"), same, "left_semi")


class CohortReport:
    """Lifetime value (``kind="ltv"``) or retention (``"retention"``) by version and cohort, below ``root``."""

    def __init__(self, spark: SparkSession, root: str, kind: str, exclude_geo: Sequence[str] = DEFAULT_EXCLUDED_GEO):
        if kind not in ("ltv", "retention"):
            raise ValueError(f"unknown kind {kind!r}")
        self.kind, self.exclude_geo = kind, exclude_geo if kind == "ltv" else ()
        self.names = [f"ltv_d{h}" for h in HORIZONS] if kind == "ltv" else [f"d{n}_retention" for n in WEEK]
        self.horizon = max(HORIZONS if kind == "ltv" else WEEK)
        shape = T.StructType().add("version", T.StringType()).add("new_users", T.LongType())
        for name in self.names:
            shape.add(name, T.DoubleType())
        self.opens = MarkedTable(spark, f"{root}/opens", OPENS)
        self.daily = MarkedTable(spark, f"{root}/daily", DAILY)
        self.firsts = MarkedTable(spark, f"{root}/firsts", FIRSTS, day=JOINED)
        self.pending = MarkedTable(spark, f"{root}/pending", T.StructType().add(JOINED, T.DateType()), day=None)
        self.report = MarkedTable(spark, f"{root}/report", shape.add(COHORT, T.DateType()), day=COHORT)

    def replace_days(self, events: DataFrame, first: dt.date, last: dt.date) -> list[dt.date]:
        """Takes the typed events of a range of days in place of what is stored of them; the cohorts computed again.

        If it dies between two commits, running it again for the same days brings all tables in line: the openings
        are replaced last, and cohorts whose members moved are noted before they do.
        """
        days = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
        rows = events.where(F.col(DAY).between(F.lit(first), F.lit(last)))
        opened = drop_listed(rows.where("event_name = 'first_open'"), "geo_country", self.exclude_geo)
        opened = _kept(opened.select(USER, VERSION, DAY).distinct(), "opens")
        if self.kind == "ltv":
            daily = user_day_revenue(rows).select(USER, F.col("day_rev").cast("double").alias("amount"), DAY)
        else:
            daily = active_days(rows).select(USER, F.lit(1.0).alias("amount"), DAY)
        users = _kept(self.opens.read(days=days).select(USER).union(opened.select(USER)).distinct(), "users")
        others = self.opens.read().where(~F.col(DAY).isin(days))
        moved = self._renew_firsts(users, others.union(opened))
        self.daily.commit(lambda _: daily, replaces=days)
        near = {d for d in self._dates(self.firsts) if first - dt.timedelta(days=self.horizon) <= d <= last}
        touched = sorted(moved | near)
        self.report.commit(lambda _: self.cohorts(touched), replaces=touched)
        self.opens.commit(lambda _: opened, replaces=days)
        self.pending.replace_all(self.pending.read().limit(0))
        return touched

    @staticmethod
    def _dates(table: MarkedTable) -> set[dt.date]:
        """Days of a table by its newest marker."""
        return {dt.date.fromisoformat(d) for d in table.snapshot().days}

    def _renew_firsts(self, users: DataFrame, opens: DataFrame) -> set[dt.date]:
        """First days of some users from all openings; the join dates they have or had."""
        per_user = W.partitionBy(USER)
        new = _of_users(opens, users).groupBy(USER, VERSION).agg(F.min(DAY).alias(JOINED))
        new = _kept(new.withColumn("copies", F.count(F.lit(1)).over(per_user)).select(*FIRSTS.names), "firsts")
        old = _kept(_of_users(self.firsts.read(), users), "old-firsts")
        changed = new.exceptAll(old).union(old.exceptAll(new)).select(JOINED).distinct()
        changed = changed.union(self.pending.read()).distinct()
        moved = {r[0] for r in changed.collect()}  # days of the calendar
        if moved:
            self.pending.replace_all(self.pending.spark.createDataFrame([(d,) for d in sorted(moved)], self.pending.schema))
            same = F.col(f"r.{USER}").eqNullSafe(F.col(f"u.{USER}"))
            stay = self.firsts.read(days=moved).alias("r").join(users.alias("u"), same, "left_anti")
            rest = new.where(F.col(JOINED).isin(list(moved)))
            self.firsts.commit(lambda _: stay.select(*FIRSTS.names).union(rest), replaces=moved)
        return moved

    def cohorts(self, dates: Sequence[dt.date]) -> DataFrame:
        """Report rows of some cohorts, from their members and the days within their horizon alone."""
        seen = {d + dt.timedelta(days=n) for d in dates for n in range(self.horizon + 1)}
        members, daily = self.firsts.read(days=dates), self.daily.read(days=seen).withColumnRenamed(USER, "payer")
        day = F.datediff(DAY, JOINED)
        both = members.join(daily, (F.col(USER) == F.col("payer")) & day.between(0, self.horizon), "left")
        if self.kind == "ltv":
            credited = F.col("amount") * F.col("copies")
            sums = [F.sum(F.when(day.between(0, h), credited).otherwise(0.0)).alias(f"s{h}") for h in HORIZONS]
        else:
            sums = [F.sum(F.when(day == n, 1).otherwise(0)).alias(f"s{n}") for n in WEEK]
        per_user = both.groupBy(USER, VERSION, JOINED).agg(*sums)
        total = per_user.groupBy(VERSION, JOINED).agg(
            F.count(USER).alias("new_users"), *[F.sum(c).alias(c) for c in per_user.columns[3:]]
        )
        if self.kind == "ltv":
            total = total.where(F.col(VERSION).isNotNull())
            values = [F.round(ratio(F.col(f"s{h}"), F.col("new_users")), 6) for h in HORIZONS]
        else:
            came = sum(F.col(f"s{n}") for n in WEEK)
            shown = (came > 0) & F.col(VERSION).isNotNull()
            values = [F.when(shown, F.round(ratio(F.col(f"s{n}"), F.col("new_users")) * F.lit(100.0), 2)) for n in WEEK]
        named = [v.alias(n) for v, n in zip(values, self.names)]
        return total.select(F.col(VERSION).alias("version"), "new_users", *named, F.col(JOINED).alias(COHORT))

    def read(self, as_of: dt.date) -> DataFrame:
        """The report as stored, with the maturity of its cohorts on a day."""
        return self.report.read().select("version", COHORT, "new_users", *self.names, mature(COHORT, self.horizon, as_of))
