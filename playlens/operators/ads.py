"""Ad metrics per user and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.functions.labels import ad_format_group
from playlens.functions.numbers import flag, sum_where
from playlens.operators.cohorts import USER

IMPRESSION = "ad_impression"
# Column prefix -> ad format group.
FORMATS = {"banner": "BANNER", "mrec": "MREC", "inter": "INTER", "reward": "REWARDED"}
ExtraFormats = dict[str, tuple[str, ...]]


def formats_with(extra: ExtraFormats | None) -> dict[str, str]:
    return {**FORMATS, **{name.lower(): name for name in extra or {}}}


def metric_names(extra: ExtraFormats | None = None) -> list[str]:
    prefixes = ["total", *formats_with(extra)]
    return [f"{p}_{m}" for p in prefixes for m in ("imps", "rev", "seen")]


def format_metrics(extra: ExtraFormats | None = None) -> list[Column]:
    """Impressions, revenue and a seen flag, in total and per format group.

    Expects ``grp`` (NULL on rows that are no impression) and ``rev``.
    """
    grp, rev = F.col("grp"), F.coalesce(F.col("rev"), F.lit(0.0))
    shown = {"total": grp.isNotNull()}
    shown.update({p: grp == F.lit(name) for p, name in formats_with(extra).items()})
    out: list[Column] = []
    for prefix, cond in shown.items():
        out += [
            F.count_if(cond).alias(f"{prefix}_imps"),
            sum_where(cond, rev).alias(f"{prefix}_rev"),
            flag(cond).alias(f"{prefix}_seen"),
        ]
    return out


def active_and_ads(
    events: DataFrame, active_event: str = "session_start", extra: ExtraFormats | None = None
) -> DataFrame:
    """Activity and impressions as one stream of (user, event_date, is_active, grp, rev)."""
    name = F.col("event_name")
    shown = name == IMPRESSION
    return events.where(name.isin(active_event, IMPRESSION)).select(
        USER,
        "event_date",
        F.when(shown, 0).otherwise(1).alias("is_active"),
        F.when(shown, ad_format_group(F.col("ad_format"), extra)).alias("grp"),
        F.when(shown, F.col("value")).alias("rev"),
    )


def user_day_ads(events: DataFrame, extra: ExtraFormats | None = None) -> DataFrame:
    """Ad metrics of each user-day with at least one impression.

    ``day_rev`` is the plain sum, NULL when no impression of the day has a value.
    """
    return (
        events.where(F.col("event_name") == IMPRESSION)
        .select(
            USER,
            "event_date",
            ad_format_group(F.col("ad_format"), extra).alias("grp"),
            F.col("value").alias("rev"),
        )
        .groupBy(USER, "event_date")
        .agg(F.sum("rev").alias("day_rev"), *format_metrics(extra))
    )


def user_day_metrics(
    events: DataFrame,
    active_event: str = "session_start",
    extra: ExtraFormats | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Activity flag and ad metrics of each user-day, in one aggregation."""
    return (
        active_and_ads(events, active_event, extra)
        .groupBy(USER, "event_date", *by)
        .agg(F.max("is_active").alias("is_active"), *format_metrics(extra))
    )


def user_day_revenue(
    events: DataFrame, event: str = IMPRESSION, column: str = "value"
) -> DataFrame:
    """Revenue of each user-day; NULL when no row of the day has a value."""
    return (
        events.where(F.col("event_name") == event)
        .groupBy(USER, "event_date")
        .agg(F.sum(column).alias("day_rev"))
    )
