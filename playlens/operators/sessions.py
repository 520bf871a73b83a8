"""Sessions between consecutive starts, without an interval join.

A start opens a session for its key until the next start of the same key; an
event with that key belongs to the session it falls into. Instead of joining
events to intervals, starts and member events go through one stream and each row
looks up the latest start at or before it.

A single user may hold a large share of all rows, so no step puts a whole key
into one task:

1. rows are dealt once, by key and time bucket, which spreads a hot key;
2. inside a bucket, rows of equal timestamp are collapsed and the lookup runs;
3. only the edges of a bucket - its rows before the first start and its last
   open session, two rows at most - are carried on from bucket to bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET_SECONDS = 3600
BUCKET_ROWS = 1_000_000  # of a hot key, where buckets follow its density
MOST_CUTS = 1024
ACCURACY = 10_000  # of the measured quantiles: one in so many rows


def bucket_of(ts: str, seconds: int) -> Column:
    """Start of the time bucket (epoch micros) a timestamp falls into."""
    width = F.lit(seconds * 1_000_000)
    return F.col(ts) - F.pmod(F.col(ts), width)


Bucketing = Callable[[DataFrame, Sequence[str], str], DataFrame]


def by_time(seconds: int = BUCKET_SECONDS) -> Bucketing:
    """Buckets of equal time."""
    return lambda rows, keys, ts: rows.withColumn("bucket", bucket_of(ts, seconds))


def cut_points(rows: DataFrame, keys: Sequence[str], ts: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``(*keys, cuts)``: timestamps that cut a hot key's rows into parts of about ``bucket_rows``.

    A first pass counts rows per key, a second one measures the quantiles of those keys alone; both
    combine before the shuffle, so a key with most of the rows sends a sketch of fixed size a task.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > bucket_rows)
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
    of_hot = rows.select(*keys, ts).alias("r").join(counts.alias("c"), same, "left_semi")
    points = F.percentile_approx(ts, [i / MOST_CUTS for i in range(1, MOST_CUTS)], F.lit(ACCURACY))
    found = of_hot.groupBy(*keys).agg(points.alias("_points"), F.count(F.lit(1)).alias("_n"))
    # Every so-many-th point, for parts of the size asked for; equal timestamps stay together.
    step = F.greatest(F.lit(1), F.floor(F.lit(MOST_CUTS) * F.lit(bucket_rows) / F.col("_n"))).cast("int")
    chosen = F.filter("_points", lambda _, i: F.pmod(i + 1, F.col("_step")) == 0)
    return found.withColumn("_step", step).select(*keys, F.array_distinct(chosen).alias("cuts"))


def by_density(bucket_rows: int = BUCKET_ROWS) -> Bucketing:
    """Buckets of about equal numbers of rows, however close in time: measured per key.

    A key with fewer rows is one bucket; a hot one has ``MOST_CUTS`` buckets at most.
    """

    def bucket(rows: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
        cuts = cut_points(rows, keys, ts, bucket_rows).alias("c")
        same = [F.col(f"r.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys]
        place = F.size(F.filter("c.cuts", lambda c: c <= F.col(f"r.{ts}")))
        number = F.when(F.col("c.cuts").isNull(), 0).otherwise(place).cast("long")
        return rows.alias("r").join(cuts, same, "left").select("r.*", number.alias("bucket"))

    return bucket


def interval_sessions(
    rows: DataFrame,
    keys: Sequence[str],
    ts: str,
    measures: Mapping[str, Column],
    bucket_seconds: int = BUCKET_SECONDS,
    bucketing: Bucketing | None = None,
) -> DataFrame:
    """One row per start: (*keys, start_ts, last_ts, members, *measures).

    Buckets have ``bucket_seconds``, unless ``bucketing`` deals them otherwise (``by_density``): a number
    ``bucket`` that follows from key and time and never falls as time goes on.

    ``rows`` holds boundary rows (``is_start`` = 1) and member rows
    (``is_member`` = 1). ``measures`` are summed over member rows. A start
    without any member event is returned with ``members`` = 0 and NULL ``last_ts``.
    """
    sums = [F.sum(c).alias(n) for n, c in measures.items()]
    resum = [F.sum(n).alias(n) for n in measures]
    moments = (
        (bucketing or by_time(bucket_seconds))(rows, keys, ts)
        .repartition(*keys, "bucket")
        .groupBy(*keys, "bucket", ts)
        .agg(F.max("is_start").alias("is_start"), F.sum("is_member").alias("members"), *sums)
    )
    inside = W.partitionBy(*keys, "bucket")
    running = inside.orderBy(ts).rowsBetween(W.unboundedPreceding, W.currentRow)
    started = F.when(F.col("is_start") == 1, F.col(ts))
    pieces = (
        moments.withColumn("opened", F.max(started).over(running))
        .groupBy(*keys, "bucket", "opened")
        .agg(
            F.max(F.when(F.col("members") > 0, F.col(ts))).alias("last_ts"),
            F.sum("members").alias("members"),
            *resum,
        )
        .withColumn("newest", F.max("opened").over(inside))
    )
    # Edge pieces of all buckets of a key meet (NULL route); the others are
    # complete and stay with their bucket.
    is_edge = F.col("opened").isNull() | (F.col("opened") == F.col("newest"))
    carried = (
        W.partitionBy(*keys, "route")
        .orderBy(F.col("bucket"), F.col("opened").asc_nulls_first())
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    return (
        pieces.withColumn("route", F.when(~is_edge, F.col("bucket")))
        .withColumn("start_ts", F.max("opened").over(carried))
        .where(F.col("start_ts").isNotNull())
        .groupBy(*keys, "start_ts")
        .agg(F.max("last_ts").alias("last_ts"), F.sum("members").alias("members"), *resum)
    )


def next_start(starts: DataFrame, keys: Sequence[str], ts: str, bucketing: Bucketing | None = None) -> DataFrame:
    """Each distinct start with the next one of its key (NULL for the last).

    Written as two narrow passes so that one key's starts need not meet in one
    task: neighbours inside a time bucket, then the first start of the key's
    following bucket for the last one of each bucket.
    """
    bucketed = (bucketing or by_time())(starts.select(*keys, ts).distinct(), keys, ts)
    inside = W.partitionBy(*keys, "bucket").orderBy(ts)
    local = bucketed.withColumn("next_in", F.lead(ts).over(inside)).withColumn(
        "rank_in", F.row_number().over(inside)
    )
    edge = (F.col("rank_in") == 1) | F.col("next_in").isNull()
    routed = local.withColumn("route", F.when(~edge, F.col("bucket")))
    across = W.partitionBy(*keys, "route").orderBy(ts)
    return routed.withColumn(
        "next_start_ts", F.coalesce("next_in", F.lead(ts).over(across))
    ).select(*keys, ts, "next_start_ts")
