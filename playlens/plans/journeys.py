"""First-session journeys of new users."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playlens.functions.numbers import pct
from playlens.operators.cohorts import USER, VERSION, cohort_identity, no_null
from playlens.operators.filters import keep_listed
from playlens.operators.sessions import BUCKET_SECONDS, bucket_of

TS = "event_timestamp"
FIRST_SESSION = "1"


def journey_edges(
    events: DataFrame,
    *,
    step: str = "event_name",
    versions: Sequence[str] = (),
    new_users_only: bool = False,
    session_number: str = FIRST_SESSION,
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Transitions between consecutive steps: (from_step, to_step, transitions, users).

    ``new_users_only`` keeps users with a first open; ``versions`` keeps those whose first
    open was in one of them. Events of a user at the same instant are ordered by step. Equal events are
    collapsed to one row with a count, and a user's stream is cut into time
    buckets whose ends are linked afterwards, so a hot user is spread over tasks.
    """
    moments = (
        events.where(
            (F.col("ga_session_number") == session_number)
            & F.col(USER).isNotNull()
            & F.col(step).isNotNull()
        )
        .groupBy(USER, TS, F.col(step).alias("step"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bucket", bucket_of(TS, bucket_seconds))
    )
    inside = W.partitionBy(USER, "bucket").orderBy(TS, "step")
    local = moments.withColumn("next_in", F.lead("step").over(inside)).withColumn(
        "rank_in", F.row_number().over(inside)
    )
    # Only the ends of buckets meet per user; the other rows already know what follows.
    ends = (F.col("rank_in") == 1) | F.col("next_in").isNull()
    across = W.partitionBy(USER, "route").orderBy(TS, "step")
    linked = local.withColumn("route", F.when(~ends, F.col("bucket"))).withColumn(
        "to_step", F.coalesce("next_in", F.lead("step").over(across))
    )
    # n equal events in a row are n - 1 transitions of the step to itself.
    hops = F.array(
        F.struct(F.col("to_step").alias("to_step"), F.lit(1).cast("long").alias("n")),
        F.struct(F.col("step").alias("to_step"), (F.col("n") - 1).alias("n")),
    )
    per_user = (
        linked.select(USER, F.col("step").alias("from_step"), F.explode(hops).alias("hop"))
        .where("hop.to_step IS NOT NULL AND hop.n > 0")
        .groupBy(USER, "from_step", F.col("hop.to_step").alias("to_step"))
        .agg(F.sum("hop.n").alias("n"))
    )
    if versions or new_users_only:
        # Users are looked up after their hops are summed, so the join sees no events.
        users = cohort_identity(events, versions=versions).select(USER).distinct()
        per_user = per_user.join(users, USER, "left_semi")
    return (
        per_user.groupBy("from_step", "to_step")
        .agg(F.sum("n").alias("transitions"), F.count(USER).alias("users"))
    )


def event_reach(
    events: DataFrame,
    *,
    versions: Sequence[str] = (),
    session_number: str = FIRST_SESSION,
) -> DataFrame:
    """Share of a version's new users that reach each event in their first session."""
    identity = no_null(
        cohort_identity(events, versions=versions).where(F.col(USER).isNotNull()), (VERSION,)
    ).select(USER, VERSION)
    sizes = identity.groupBy(VERSION).agg(F.count(USER).alias("new_users"))
    reached = (
        keep_listed(events, "ga_session_number", [session_number])
        .select(USER, "event_name")
        .distinct()
    )
    counts = (
        identity.join(reached, USER)
        .groupBy(VERSION, "event_name")
        .agg(F.count(USER).alias("users"))
    )
    return counts.join(sizes, VERSION).select(
        F.col(VERSION).alias("version"),
        "event_name",
        "users",
        "new_users",
        pct(F.col("users"), F.col("new_users")).alias("reach_pct"),
    )
