"""Retention curve per cohort (report R6)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.functions.numbers import flag, ratio
from playlens.operators.cohorts import USER, VERSION, active_days, cohort_identity

WEEK = (1, 2, 3, 4, 5, 6, 7)


def renamed(dims: Sequence[str]) -> list:
    """Dimension columns under their report names (the version is ``version``)."""
    return [F.col(d).alias("version" if d == VERSION else d) for d in dims]


def mature(cohort: str, days: int, as_of: dt.date):
    """Whether the cohort has been observable for ``days`` days on ``as_of``."""
    return (F.datediff(F.lit(as_of), F.col(cohort)) >= days).alias(f"is_d{days}_mature")


def retention_curve(
    events: DataFrame,
    *,
    as_of: dt.date,
    versions: Sequence[str] = (),
    days: Sequence[int] = WEEK,
    mode: str = "exact",
    dims: Sequence[str] = (VERSION,),
    until: int | None = None,
) -> DataFrame:
    """Share of a cohort's users active on day N (or, rolling, on day >= N).

    A cohort nobody of which came back within the window has NULL rates. The window is the
    days asked for; in rolling mode it has no end unless ``until`` names its last day, so a rate does
    not depend on which other days are asked for.
    """
    if mode not in ("exact", "rolling"):
        raise ValueError(f"unknown mode {mode!r}")
    last = max(days)
    identity = cohort_identity(events, versions=versions, dims=dims)
    activity = active_days(events)
    day = F.datediff("event_date", "join_date")
    end = last if mode == "exact" else until
    came_back = day >= 1 if end is None else day.between(1, end)

    def hit(n: int):
        return day == n if mode == "exact" else came_back & (day >= n)

    # One row per cohort member with its flags; the join already partitions by
    # user, and no distinct counting (row expansion) is needed afterwards.
    members = (
        identity.join(activity, USER, "left")
        .groupBy(USER, *dims, "join_date")
        .agg(flag(came_back).alias("back"), *[flag(hit(n)).alias(f"d{n}") for n in days])
    )
    cohorts = members.groupBy(*dims, "join_date").agg(
        F.count(USER).alias("new_users"),
        F.max("back").alias("back"),
        *[F.sum(f"d{n}").alias(f"d{n}") for n in days],
    )
    # Rates match cohorts by equality, which a NULL dimension never meets.
    shown = F.col("back") == 1
    for d in dims:
        shown = shown & F.col(d).isNotNull()
    return cohorts.select(
        *renamed(dims),
        F.col("join_date").alias("cohort_date"),
        "new_users",
        *[
            F.when(shown, F.round(ratio(F.col(f"d{n}"), F.col("new_users")) * F.lit(100.0), 2))
            .alias(f"d{n}_retention")
            for n in days
        ],
        mature("join_date", last, as_of),
    )
