"""Minigame reports: play sessions (R2) and results (R8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playlens.config import DEFAULT_MAX_SESSION_MIN, NOT_IN_SESSION_REPORT
from playlens.functions.numbers import flag, pct, per_mille, ratio
from playlens.operators.ads import IMPRESSION
from playlens.operators.cohorts import USER, VERSION, user_version
from playlens.operators.filters import in_game, keep_listed
from playlens.operators.sessions import BUCKET_SECONDS, Bucketing, interval_sessions

MINIGAME = "minigame_id"
TS = "event_timestamp"
# Results a finished minigame can have.
RESULTS = ("win", "lose", "quit")


def session_rows(
    events: DataFrame, exclude: Sequence[str] = NOT_IN_SESSION_REPORT
) -> DataFrame:
    """Boundary rows (starts) and member rows (events on a minigame's screen).

    A start on another screen bounds its own minigame and is a member of the
    other one, so the two roles are separate rows. Starts of the home screen are
    kept as boundaries: the report's base counts them.
    """
    name, screen = F.col("event_name"), F.col("current_screen")
    shown = name == IMPRESSION

    def role(start: int, minigame: Column, imps: Column, rev: Column) -> Column:
        return F.struct(
            minigame.alias(MINIGAME),
            F.lit(start).alias("is_start"),
            F.lit(1 - start).alias("is_member"),
            imps.alias("shown"),
            rev.alias("earned"),
        )

    is_member = ~name.isin(list(exclude)) & in_game(screen)
    is_start = (name == "level_start") & F.col(MINIGAME).isNotNull()
    earned = F.when(shown, F.coalesce("value", F.lit(0.0))).otherwise(0.0)
    roles = F.array(
        F.when(is_member, role(0, screen, F.when(shown, 1).otherwise(0), earned)),
        F.when(is_start, role(1, F.col(MINIGAME), F.lit(0), F.lit(0.0))),
    )
    # Both roles come out of one scan.
    return (
        events.where(F.col(USER).isNotNull() & (is_member | is_start))
        .select(USER, TS, F.explode(F.array_compact(roles)).alias("role"))
        .select(USER, TS, "role.*")
    )


def minigame_sessions(
    events: DataFrame,
    exclude: Sequence[str] = NOT_IN_SESSION_REPORT,
    bucket_seconds: int = BUCKET_SECONDS,
    bucketing: Bucketing | None = None,
) -> DataFrame:
    """One row per start: member count, length in minutes, impressions, revenue."""
    sessions = interval_sessions(
        session_rows(events, exclude),
        [USER, MINIGAME],
        TS,
        {"imps": F.col("shown"), "rev": F.col("earned")},
        bucket_seconds,
        bucketing,
    )
    minutes = (F.col("last_ts") - F.col("start_ts")) / F.lit(1e6) / F.lit(60)
    return sessions.withColumn("minutes", minutes)


def minigame_sessions_report(
    events: DataFrame,
    *,
    versions: Sequence[str] = (),
    max_session_min: float = DEFAULT_MAX_SESSION_MIN,
    exclude: Sequence[str] = NOT_IN_SESSION_REPORT,
    bucket_seconds: int = BUCKET_SECONDS,
) -> DataFrame:
    """Start rate, play time and ad revenue per (version, minigame).

    The length limit looks at the exact length, the sums at lengths rounded to
    four digits. The version is joined after sessions are summed per user and
    minigame, so the join never sees event-level rows.
    """
    kept = (F.col("members") > 0) & (F.col("minutes") <= max_session_min)

    def total(value: Column) -> Column:
        return F.sum(F.when(kept, value).otherwise(0))

    per_user = (
        minigame_sessions(events, exclude, bucket_seconds)
        .groupBy(USER, MINIGAME)
        .agg(
            F.count_if(kept).alias("sessions"),
            total(F.round("minutes", 4)).alias("playtime"),
            total(F.col("imps")).alias("imps"),
            total(F.col("rev")).alias("rev"),
        )
    )
    versioned = keep_listed(user_version(events, "session_start"), VERSION, versions)
    one_of_user = F.row_number().over(W.partitionBy(USER).orderBy(MINIGAME)) == 1
    groups = (
        per_user.join(versioned.dropna(subset=[VERSION]), USER)
        .withColumn("starters", F.when(one_of_user, 1).otherwise(0))
        .groupBy(VERSION, MINIGAME)
        .agg(
            F.count(F.lit(1)).alias("start_user"),
            F.sum("starters").alias("starters"),
            F.nullif(F.count_if(F.col("sessions") > 0), F.lit(0)).alias("unique_users"),
            F.nullif(F.sum("sessions"), F.lit(0)).alias("total_sessions"),
            F.sum("playtime").alias("playtime"),
            F.sum("imps").alias("imps"),
            F.sum("rev").alias("rev"),
        )
        # Users with any start, home included; one row per version and minigame here.
        .withColumn("total_user", F.sum("starters").over(W.partitionBy(VERSION)))
    )
    return groups.where(in_game(F.col(MINIGAME))).select(
        F.col(VERSION).alias("version"),
        MINIGAME,
        "start_user",
        F.round(ratio(F.col("start_user"), F.col("total_user")) * F.lit(100.0), 2)
        .alias("start_rate_pct"),
        "unique_users",
        "total_sessions",
        F.round(ratio(F.col("playtime"), F.col("unique_users")), 2)
        .alias("avg_playtime_per_user_min"),
        F.round(ratio(F.col("playtime"), F.col("total_sessions")), 2)
        .alias("avg_playtime_per_session_min"),
        F.col("imps").alias("total_ad_impressions"),
        F.round("rev", 2).alias("total_revenue_usd"),
        F.round(ratio(F.col("rev"), F.col("unique_users")), 4).alias("avg_revenue_per_user_usd"),
        per_mille(F.col("rev"), F.col("imps"), 2).alias("ecpm"),
    )


def play_results(
    events: DataFrame,
    *,
    versions: Sequence[str] = (),
    key: str = MINIGAME,
    only: Sequence[str] = (),
    level_range: tuple[int, int] | None = None,
    extra_means: Sequence[str] = (),
    results: Sequence[str] = RESULTS,
) -> DataFrame:
    """Completion, results and durations per (version, minigame).

    Durations are sums over plays divided by distinct players. ``only`` limits
    the minigames; ``level_range`` reads ``key`` as a level number in that range;
    ``results`` are the values of ``result_by`` that get a rate and a duration;
    ``extra_means`` adds ``avg_<param>`` of integer parameters of the ends.
    """
    name = F.col("event_name")
    plays = events.where(name.isin("level_start", "level_end"))
    if level_range:
        plays = plays.withColumn(key, F.col(key).try_cast("bigint"))
        plays = plays.where(F.col(key).between(*level_range))
    else:
        plays = keep_listed(plays.where(in_game(F.col(key))), key, only)
    ended = name == "level_end"
    result = F.when(ended, F.col("result_by"))
    duration = F.when(ended, F.col("play_duration").try_cast("double"))
    # One row per user and minigame first; a user in k versions is then counted in
    # each of them, and flags replace distinct counts.
    per_user = plays.groupBy(USER, key).agg(
        flag(~ended).alias("started"),
        flag(ended).alias("ended"),
        F.count(result).alias("results"),
        F.sum(duration).alias("secs"),
        *[F.count_if(result == r).alias(f"{r}_n") for r in results],
        *[F.sum(F.when(result == r, duration)).alias(f"{r}_secs") for r in results],
        *[
            agg(F.when(ended, F.col(p).try_cast("bigint"))).alias(f"{p}_{what}")
            for p in extra_means
            for what, agg in (("sum", F.sum), ("n", F.count))
        ],
    )
    cohort = keep_listed(events.where(name == "first_open"), VERSION, versions)
    groups = (
        per_user.join(cohort.select(USER, VERSION).distinct(), USER)
        .groupBy(VERSION, key)
        .agg(
            F.sum("started").alias("users_start"),
            F.nullif(F.sum("ended"), F.lit(0)).alias("users_end"),
            F.sum("results").alias("results"),
            F.sum("secs").alias("secs"),
            *[F.sum(f"{r}_n").alias(f"{r}_n") for r in results],
            *[F.sum(f"{r}_secs").alias(f"{r}_secs") for r in results],
            *[F.count_if(F.col(f"{r}_n") > 0).alias(f"{r}_users") for r in results],
            *[F.sum(f"{p}_{w}").alias(f"{p}_{w}") for p in extra_means for w in ("sum", "n")],
        )
    )
    # A NULL version has no matching ends in the report.
    ends = F.col(VERSION).isNotNull()
    return groups.where("users_start > 0").select(
        F.col(VERSION).alias("version"),
        key,
        "users_start",
        F.when(ends, F.col("users_end")).alias("users_end"),
        F.when(ends, pct(F.col("users_end"), F.col("users_start"))).alias("complete_rate_pct"),
        *[
            F.when(ends, pct(F.col(f"{r}_n"), F.col("results"))).alias(f"{r}_rate_pct")
            for r in results
        ],
        F.when(ends, F.round(ratio(F.col("secs"), F.col("users_end")), 2))
        .alias("avg_duration_per_user_s"),
        *[
            F.when(ends, F.round(ratio(F.col(f"{r}_secs"), F.col(f"{r}_users")), 2))
            .alias(f"avg_duration_{r}_s")
            for r in results
        ],
        *[
            F.when(ends, F.round(ratio(F.col(f"{p}_sum"), F.col(f"{p}_n")), 2)).alias(f"avg_{p}")
            for p in extra_means
        ],
    )
