"""New-user funnel monetization per version (report R3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playlens.config import DEFAULT_EXCLUDED_GEO
from playlens.functions.numbers import per_mille, ratio
from playlens.operators.ads import ExtraFormats, formats_with, metric_names, user_day_ads
from playlens.operators.cohorts import USER, VERSION, active_days, cohort_identity
from playlens.plans.ltv import with_copies

FUNNEL_HORIZONS = (0, 3, 7)
# Rewarded ads are rare, so their impressions per user get a third digit.
IMP_DIGITS = {"reward": 3}


def funnel_monetization(
    events: DataFrame,
    *,
    versions: Sequence[str] = (),
    exclude_geo: Sequence[str] = DEFAULT_EXCLUDED_GEO,
    cohort_event: str = "first_open",
    extra_formats: ExtraFormats | None = None,
    horizons: Sequence[int] = FUNNEL_HORIZONS,
    fanout: str = "compat",
) -> DataFrame:
    """Impressions, viewers, revenue per active cohort user, and lifetime value.

    Per-user figures are unweighted means of daily ratios; revenue per thousand
    impressions is a ratio of sums; lifetime value is the mean over cohorts.
    """
    identity = cohort_identity(
        events, versions=versions, exclude_geo=exclude_geo, event=cohort_event
    )
    metrics = metric_names(extra_formats)
    days = _member_days(events, identity, versions, extra_formats, fanout, max(horizons))
    active, counted = F.col("active") == 1, F.col("counted")
    offset = F.datediff("event_date", "join_date")
    # Daily figures and cohort values come out of one aggregation, so impressions
    # are read and joined once. (user, version, day) is unique: counts are distinct.
    facts = days.select(
        VERSION,
        "event_date",
        "join_date",
        "member",
        F.when(active, 1).otherwise(0).alias("dau"),
        F.when(active & (offset == 0), 1).otherwise(0).alias("new_users"),
        *[F.when(active, F.coalesce(F.col(m), F.lit(0))).otherwise(0).alias(m) for m in metrics],
        # As in a sum over ad days within the longest horizon: those past the shorter one count
        # 0, those without a value nothing, a member without such days 0 once.
        *[
            F.when(counted & offset.between(0, h), F.col("credited"))
            .when(counted | ((F.col("member") == 1) & (F.col("counted_days") == 0)), F.lit(0.0))
            .alias(f"rev_d{h}")
            for h in horizons
        ],
    )
    sums = ("member", "dau", "new_users", *metrics, *[f"rev_d{h}" for h in horizons])
    both = facts.groupingSets(
        [[VERSION, "event_date"], [VERSION, "join_date"]], VERSION, "event_date", "join_date"
    ).agg(F.grouping("event_date").alias("is_cohort"), *[F.sum(c).alias(c) for c in sums])
    is_day = (F.col("is_cohort") == 0) & (F.col("dau") > 0)
    prefixes = list(formats_with(extra_formats))

    def of_days(column: Column) -> Column:
        return F.when(is_day, column)

    def per_dau(metric: str) -> Column:
        return F.avg(of_days(ratio(F.col(metric), F.col("dau"))))

    def viewers(prefix: str) -> Column:
        return F.avg(of_days(ratio(F.col(f"{prefix}_seen") * F.lit(100.0), F.col("dau"))))

    def ecpm(prefix: str) -> Column:
        rev, imps = F.col(f"{prefix}_rev"), F.col(f"{prefix}_imps")
        return per_mille(F.sum(of_days(rev)), F.sum(of_days(imps)))

    def value(horizon: int) -> Column:
        per_user = ratio(F.col(f"rev_d{horizon}"), F.col("member"))
        return F.round(F.avg(F.when(F.col("is_cohort") == 1, per_user)), 6)

    return (
        both.groupBy(F.col(VERSION).alias("version"))
        .agg(
            F.min(of_days(F.col("event_date"))).alias("date_from"),
            F.max(of_days(F.col("event_date"))).alias("date_to"),
            F.count_if(is_day).alias("num_days"),
            F.round(F.avg(of_days(F.col("dau"))), 1).alias("avg_dau"),
            F.round(F.avg(of_days(F.col("new_users"))), 1).alias("avg_new_users"),
            *[
                F.round(per_dau(f"{p}_imps"), IMP_DIGITS.get(p, 2)).alias(f"{p}_imp_per_dau")
                for p in ("total", *prefixes)
            ],
            F.round(viewers("total"), 2).alias("ad_viewer_rate"),
            *[F.round(viewers(p), 2).alias(f"{p}_viewer_rate") for p in prefixes],
            F.round(per_dau("total_rev"), 6).alias("arpdau"),
            ecpm("total").alias("ecpm"),
            *[ecpm(p).alias(f"{p}_ecpm") for p in prefixes],
            *[value(h).alias(f"ltv_d{h}") for h in horizons],
        )
        .where("num_days > 0")
    )


def _member_days(
    events: DataFrame,
    identity: DataFrame,
    versions: Sequence[str],
    extra_formats: ExtraFormats | None,
    fanout: str,
    horizon: int,
) -> DataFrame:
    """One row per cohort member and day with activity or impressions.

    Activity counts for the member of the same version, impressions for every
    version of the user. A member without any such day keeps one row with a NULL
    day. ``member`` is 1 on one row of each member; ``counted`` marks days with impressions up
    to ``horizon`` days after the join, ``counted_days`` is the member's number of them.
    """
    metrics = metric_names(extra_formats)
    active = active_days(events, versions=versions, by=(VERSION,)).select(
        F.col(USER).alias("who"), "event_date", F.col(VERSION).alias("seen_in"),
        F.lit(1).alias("active"),
    )
    ads = user_day_ads(events, extra_formats).withColumnRenamed(USER, "who")
    facts = active.where(F.col("seen_in").isNotNull()).unionByName(ads, allowMissingColumns=True)
    mine = F.col("seen_in").isNull() | (F.col("seen_in") == F.col(VERSION))
    days = (
        with_copies(identity, fanout)
        .dropna(subset=[VERSION])
        .join(facts, (F.col(USER) == F.col("who")) & mine, "left")
        .groupBy(USER, VERSION, "join_date", "copies", "event_date")
        .agg(
            F.max("active").alias("active"),
            F.max("day_rev").alias("day_rev"),
            *[F.max(m).alias(m) for m in metrics],
        )
    )
    order = F.row_number().over(W.partitionBy(USER, VERSION).orderBy("event_date"))
    near = F.datediff("event_date", "join_date").between(0, horizon)
    counted = F.coalesce(F.col("total_imps").isNotNull() & near, F.lit(False))
    return days.select(
        counted.alias("counted"),
        F.count_if(counted).over(W.partitionBy(USER, VERSION)).alias("counted_days"),
        VERSION,
        "join_date",
        "event_date",
        "active",
        (F.col("day_rev") * F.col("copies")).alias("credited"),
        *metrics,
        F.when((order == 1) & F.col(USER).isNotNull(), 1).otherwise(0).alias("member"),
    )
