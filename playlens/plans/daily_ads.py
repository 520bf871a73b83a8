"""Daily ad dashboard (report R5) and its breakdowns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlens.functions.labels import variant_label
from playlens.functions.numbers import pct, per_mille, ratio
from playlens.operators.ads import ExtraFormats, formats_with, metric_names, user_day_metrics
from playlens.operators.cohorts import USER, VERSION, cohort_identity, user_version
from playlens.operators.filters import keep_listed
from playlens.plans.funnel import IMP_DIGITS
from playlens.plans.split import VARIANT


def daily_ads(
    events: DataFrame,
    *,
    versions: Sequence[str] = (),
    cohort_event: str = "first_open",
    active_event: str = "session_start",
    extra_formats: ExtraFormats | None = None,
    cohort_only: bool = True,
    by_version: bool = False,
) -> DataFrame:
    """Impressions, viewers, revenue per active user and day-1 return, per day.

    Days on which a user only saw ads do not count. ``cohort_only=False`` counts
    all active users, also those without a join date or a known version; with a
    version list, only users of a listed version.
    """
    joined_on = cohort_identity(events, versions=versions, event=cohort_event, dims=())
    known = keep_listed(user_version(events, "first_open"), VERSION, versions)
    everyone = not cohort_only and not versions
    users = known.join(joined_on, USER, "full" if everyone else "inner" if cohort_only else "left")
    active = user_day_metrics(events, active_event, extra_formats).where("is_active = 1")
    dims = [VERSION] if by_version else []
    metrics = metric_names(extra_formats)
    # (user, day) is unique, so plain counts are distinct counts.
    offset = F.datediff("event_date", "join_date")
    daily = (
        active.join(users, USER, "left" if everyone else "inner")
        .groupBy(*dims, "event_date")
        .agg(
            F.count(USER).alias("active_user"),
            F.count_if(offset == 0).alias("joined"),
            F.count_if(offset == 1).alias("returned"),
            *[F.sum(m).alias(m) for m in metrics],
        )
    )
    # Each day also hands its joiners on to the following day, where they are the
    # base of the return rate; a day nobody was active on drops out again.
    figures = ["active_user", "returned", *metrics]
    ahead = F.col("ahead") == 1
    dated = (
        daily.withColumn("ahead", F.explode(F.array(F.lit(0), F.lit(1))))
        .groupBy(*dims, F.date_add("event_date", F.col("ahead")).alias("event_date"))
        .agg(
            F.sum(F.when(ahead, F.col("joined"))).alias("base"),
            *[F.sum(F.when(~ahead, F.col(c))).alias(c) for c in figures],
        )
        .where(F.col("active_user").isNotNull())
    )
    base = F.nullif(F.col("base"), F.lit(0))
    dau = F.col("active_user")
    prefixes = list(formats_with(extra_formats))
    return dated.select(
        *[F.col(d).alias("version") for d in dims],
        F.col("event_date").alias("date"),
        dau,
        *[
            F.round(ratio(F.col(f"{p}_imps"), dau), IMP_DIGITS.get(p, 2)).alias(f"{p}_imp_per_dau")
            for p in (*prefixes, "total")
        ],
        *[pct(F.col(f"{p}_seen"), dau).alias(f"{p}_viewer_rate") for p in prefixes],
        pct(F.col("total_seen"), dau).alias("total_ad_viewer_rate"),
        *[per_mille(F.col(f"{p}_rev"), F.col(f"{p}_imps")).alias(f"{p}_ecpm") for p in prefixes],
        F.round(ratio(F.col("total_rev"), dau), 6).alias("arpdau"),
        pct(F.col("returned"), base).alias("cohort_rr_d1"),
    )


def variant_summary(
    events: DataFrame, *, versions: Sequence[str] = (), active_event: str = "session_start"
) -> DataFrame:
    """Ad revenue per experiment arm: per active user-day, per mille, per user.

    A user's arm is the largest one reported; users without any are left out.
    """
    arms = (
        keep_listed(user_version(events, "first_open"), VERSION, versions)
        .select(USER)
        .join(
            events.where(F.col(VARIANT).isNotNull())
            .select(USER, VARIANT)
            .distinct()
            .groupBy(USER)
            .agg(F.max(VARIANT).alias("arm")),
            USER,
        )
        .select(USER, variant_label(F.col("arm")).alias("variant"))
    )
    per_user = (
        user_day_metrics(events, active_event)
        .where("is_active = 1")
        .groupBy(USER)
        .agg(
            F.count(F.lit(1)).alias("days"),
            F.sum("total_imps").alias("imps"),
            F.sum("total_rev").alias("rev"),
        )
    )
    return (
        per_user.join(arms, USER)
        .groupBy("variant")
        .agg(
            F.count(USER).alias("users"),
            F.sum("days").alias("active_user_days"),
            F.sum("imps").alias("impressions"),
            F.sum("rev").alias("rev"),
        )
        .select(
            "variant",
            "users",
            "active_user_days",
            "impressions",
            F.round("rev", 2).alias("revenue"),
            F.round(ratio(F.col("rev"), F.col("active_user_days")), 6).alias("arpdau"),
            per_mille(F.col("rev"), F.col("impressions")).alias("ecpm"),
            F.round(ratio(F.col("rev"), F.col("users")), 6).alias("arpu"),
        )
    )
