"""Who joined when, and who was active on which day.

Every function reduces events to at most one row per user and day (or user and
dimension) with map-side combining before anything is joined, so a user who
produces a large share of all events contributes a bounded number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.operators.filters import drop_listed, keep_listed

USER = "user_pseudo_id"
VERSION = "app_version"


def cohort_identity(
    events: DataFrame,
    *,
    versions: Sequence[str] = (),
    exclude_geo: Sequence[str] = (),
    event: str = "first_open",
    dims: Sequence[str] = (VERSION,),
) -> DataFrame:
    """First day per user and dimension values: (user, *dims, join_date)."""
    rows = events.where(F.col("event_name") == event)
    rows = drop_listed(keep_listed(rows, VERSION, versions), "geo_country", exclude_geo)
    return rows.groupBy(USER, *dims).agg(F.min("event_date").alias("join_date"))


def cohort_size(identity: DataFrame, dims: Sequence[str] = (VERSION,)) -> DataFrame:
    """Users per cohort. An identity row is unique per user, so counting is exact."""
    return identity.groupBy(*dims, "join_date").agg(F.count(USER).alias("new_users"))


def active_days(
    events: DataFrame,
    *,
    event: str = "session_start",
    versions: Sequence[str] = (),
    by: Sequence[str] = (),
) -> DataFrame:
    """Distinct days a user was active: (user, *by, event_date)."""
    rows = keep_listed(events.where(F.col("event_name") == event), VERSION, versions)
    return rows.select(USER, *by, "event_date").distinct()


def user_version(events: DataFrame, event: str) -> DataFrame:
    """One version per user, the smallest, where any would do.

    Distinct pairs first: they hash-aggregate, while a minimum of text sorts its
    input, which should not be all events.
    """
    pairs = events.where(F.col("event_name") == event).select(USER, VERSION).distinct()
    return pairs.groupBy(USER).agg(F.min(VERSION).alias(VERSION))


def no_null(df: DataFrame, dims: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(dims)) if dims else df
