"""Distinct users as stored bitmaps, so that retention and reach need no second look at the events.

Users get numbers from an append-only dictionary; who joined a version on a day, and who was active on it, is kept as
bitmaps of these numbers, 32,768 to a piece. Sets are united and intersected piece by piece, so a day costs the same
whether its users sent one event or millions, and any period is counted exactly from what its days stored.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlens.functions.numbers import ratio
from playlens.operators.cohorts import USER, VERSION, active_days, cohort_identity
from playlens.plans.retention import WEEK, mature
from playlens.session import scratch_dir
from playlens.sinks.commits import MarkedTable, Snapshot
from playlens.sinks.tables import DAY

NUMBERS = T.StructType().add(USER, T.StringType()).add("number", T.LongType())
FIRSTS = T.StructType().add(USER, T.StringType()).add(VERSION, T.StringType()).add(DAY, T.DateType())
PIECES = T.StructType().add("piece", T.LongType()).add("bits", T.BinaryType()).add(DAY, T.DateType())
JOINED = T.StructType([T.StructField(VERSION, T.StringType()), *PIECES.fields])
LOCAL_BITS = 33  # of ``monotonically_increasing_id``: the row within its task


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def as_sets(numbered: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(*by, piece, bits)`` of rows with a ``number``; those without one leave an empty set."""
    piece = F.bitmap_bucket_number("number").alias("piece")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    return numbered.groupBy(*by, piece).agg(bits)


class UserSets:
    """The dictionary, first days and daily sets below ``root``; days are added in order, one or many at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.numbers = MarkedTable(spark, f"{root}/numbers", NUMBERS, day=None)
        self.firsts = MarkedTable(spark, f"{root}/firsts", FIRSTS)
        self.joined = MarkedTable(spark, f"{root}/joined", JOINED)
        self.active = MarkedTable(spark, f"{root}/active", PIECES)

    def days(self) -> list[dt.date]:
        """The days with active users, from the newest marker alone."""
        return sorted(dt.date.fromisoformat(d) for d in self.active.snapshot().days)

    def add_days(self, events: DataFrame, first: dt.date, last: dt.date) -> None:
        """Adds typed events of a range of days, or replaces the newest days by them.

        Every step can be repeated after a failure: known users keep their numbers and days are replaced whole. Days
        before the newest stored one cannot be added alone, as they could change who is new later.
        """
        stored = self.days()
        if stored and stored[-1] > last:
            raise ValueError(f"{stored[-1]} is stored already: add the days from {first} on up to it")
        rows = events.where(F.col(DAY).between(F.lit(first), F.lit(last)))
        known = self.firsts.read().where(F.col(DAY) < F.lit(first))
        came = cohort_identity(rows).withColumnRenamed("join_date", DAY)
        same = [F.col(f"new.{c}").eqNullSafe(F.col(f"known.{c}")) for c in (USER, VERSION)]
        came = _kept(came.alias("new").join(known.alias("known"), same, "left_anti"), "joined")
        seen = _kept(active_days(rows), "active")
        self._number(came.select(USER).union(seen.select(USER)).where(F.col(USER).isNotNull()).distinct())
        numbers = self.numbers.read()
        range_ = [first + dt.timedelta(days=n) for n in range((last - first).days + 1)]
        self.firsts.commit(lambda _: came.select(USER, VERSION, DAY), replaces=range_)
        joined = as_sets(came.join(numbers, USER, "left"), [VERSION, DAY])
        self.joined.commit(lambda _: joined, replaces=range_)
        active = as_sets(seen.join(numbers, USER), [DAY])
        self.active.commit(lambda _: active, replaces=range_)

    def _number(self, users: DataFrame) -> None:
        """Numbers from 1 on without gaps for users that have none yet."""

        def more(state: Snapshot) -> DataFrame:
            known = self.numbers.read(state)
            highest = known.agg(F.max("number")).first()[0] or 0
            new = _kept(users.join(known, USER, "left_anti").withColumn("at_", F.monotonically_increasing_id()), "new-users")
            task = F.shiftright("at_", LOCAL_BITS)
            counts = sorted(tuple(r) for r in new.groupBy(task.alias("task_")).count().collect())  # a row for each task
            starts, total = [], highest
            for number, count in counts:
                starts.append((number, total))
                total += count
            offsets = F.broadcast(self.spark.createDataFrame(starts, "task_ long, start_ long"))
            within = F.col("at_").bitwiseAND(F.lit((1 << LOCAL_BITS) - 1))
            return new.withColumn("task_", task).join(offsets, "task_").select(USER, (F.col("start_") + within + 1).alias("number"))

        self.numbers.commit(more)


def _members(sets: DataFrame, by: Sequence[str]) -> DataFrame:
    """Users of each set: pieces do not overlap, so their counts add up."""
    return sets.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).cast("long").alias("users"))


def _within(active: DataFrame, joined: DataFrame, spans: list[tuple[str, int, int]], last: dt.date) -> DataFrame:
    """``(join_date, name, piece, bits)``: who was active ``low`` to ``high`` days after each join date."""
    wanted = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(a).alias("low"), F.lit(b).alias("high")) for n, a, b in spans]))
    dates = joined.select("join_date").distinct().select("join_date", wanted.alias("w"))
    start, end = F.date_add("join_date", F.col("w.low")), F.least(F.date_add("join_date", F.col("w.high")), F.lit(last))
    days = dates.where(start <= end).select("join_date", "w.name", F.explode(F.sequence(start, end)).alias(DAY))
    return days.join(active, DAY).groupBy("join_date", "name", "piece").agg(F.bitmap_or_agg("bits").alias("bits"))


def _from_on(active: DataFrame, joined: DataFrame, after: list[tuple[str, int]], days: list[dt.date]) -> DataFrame:
    """``(join_date, name, piece, bits)``: who was active so many days after each join date or later.

    The union of a day and all later ones is carried backwards once, piece by piece; a join date takes that of
    the first stored day that is late enough.
    """
    pieces = active.select("piece").distinct().select("piece", F.explode(F.lit(days)).alias(DAY))
    later = W.partitionBy("piece").orderBy(F.col(DAY).desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = pieces.join(active, ["piece", DAY], "left").withColumn("bits", F.bitmap_or_agg("bits").over(later))
    wanted = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(a).alias("low")) for n, a in after]))
    dates = joined.select("join_date").distinct().select("join_date", wanted.alias("w"))
    enough = F.filter(F.lit(days), lambda d: d >= F.date_add("join_date", F.col("w.low")))
    dates = dates.select("join_date", "w.name", F.get(enough, F.lit(0)).alias(DAY))
    return dates.join(whole, DAY).select("join_date", "name", "piece", "bits")


def retention_from_sets(
    sets: UserSets, *, as_of: dt.date, days: Sequence[int] = WEEK, mode: str = "exact", until: int | None = None
) -> DataFrame:
    """The report of ``retention_curve`` by version, from stored sets alone."""
    if mode not in ("exact", "rolling"):
        raise ValueError(f"unknown mode {mode!r}")
    joined = sets.joined.read().withColumnRenamed(DAY, "join_date")
    active, stored = sets.active.read(), sets.days()
    last, newest = max(days), (stored or [as_of])[-1]
    if mode == "rolling" and until is None:
        came = _from_on(active, joined, [("back", 1), *((f"d{n}", max(n, 1)) for n in days)], stored or [as_of])
    else:
        end = last if mode == "exact" else until
        spans = [("back", 1, end), *((f"d{n}", n if mode == "exact" else max(n, 1), n if mode == "exact" else end) for n in days)]
        came = _within(active, joined, spans, newest)
    both = joined.join(came.withColumnRenamed("bits", "came"), ["join_date", "piece"])
    both = both.select(VERSION, "join_date", "name", "piece", F.explode(F.array("bits", "came")).alias("bits"))
    both = both.groupBy(VERSION, "join_date", "name", "piece").agg(F.bitmap_and_agg("bits").alias("bits"))
    hits = _members(both, [VERSION, "join_date", "name"]).groupBy(VERSION, "join_date")
    hits = hits.agg(*[F.sum(F.when(F.col("name") == n, F.col("users"))).alias(n) for n in ("back", *(f"d{n}" for n in days))])
    sizes = _members(joined, [VERSION, "join_date"]).withColumnRenamed("users", "new_users")
    same = F.col(f"s.{VERSION}").eqNullSafe(F.col(f"h.{VERSION}")) & (F.col("s.join_date") == F.col("h.join_date"))
    rows = sizes.alias("s").join(hits.alias("h"), same, "left").select("s.*", *[f"h.{c}" for c in hits.columns[2:]])
    shown = (F.col("back") > 0) & F.col(VERSION).isNotNull()
    rate = lambda n: F.round(ratio(F.coalesce(F.col(f"d{n}"), F.lit(0)), F.col("new_users")) * F.lit(100.0), 2)
    return rows.select(
        F.col(VERSION).alias("version"),
        F.col("join_date").alias("cohort_date"),
        "new_users",
        *[F.when(shown, rate(n)).alias(f"d{n}_retention") for n in days],
        mature("join_date", last, as_of),
    )


def trailing_active(sets: UserSets, days: int) -> DataFrame:
    """``(event_date, users)``: who was active on a day or in the ``days`` - 1 before it."""
    stored = sets.days()
    spread = F.explode(F.sequence(F.col(DAY), F.date_add(DAY, days - 1)))
    pieces = sets.active.read().select("piece", "bits", spread.alias("to_"))
    of_day = pieces.where(F.col("to_").isin(stored)).groupBy("to_", "piece").agg(F.bitmap_or_agg("bits").alias("bits"))
    return _members(of_day, ["to_"]).withColumnRenamed("to_", DAY)
