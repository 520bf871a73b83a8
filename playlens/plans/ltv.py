"""Cohort lifetime value (report R4 and the value part of R3)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playlens.config import DEFAULT_EXCLUDED_GEO
from playlens.functions.numbers import ratio, sum_where
from playlens.operators.ads import IMPRESSION, user_day_revenue
from playlens.operators.cohorts import USER, VERSION, cohort_identity, no_null
from playlens.plans.retention import mature, renamed

HORIZONS = (0, 1, 3, 7)


def with_copies(identity: DataFrame, fanout: str) -> DataFrame:
    """How often a cohort row counts its user's revenue, as ``copies``.

    ``fanout="compat"`` keeps the reports' rule: each of a user's k cohort rows is
    credited k times the user's daily revenue. ``"fix"`` credits it once to each.
    """
    if fanout not in ("compat", "fix"):
        raise ValueError(f"unknown fanout {fanout!r}")
    per_user = W.partitionBy(USER)
    copies = F.count(F.lit(1)).over(per_user) if fanout == "compat" else F.lit(1)
    return identity.withColumn("copies", copies)


def cohort_revenue(
    events: DataFrame,
    identity: DataFrame,
    *,
    horizons: Sequence[int] = HORIZONS,
    dims: Sequence[str] = (VERSION,),
    revenue: tuple[str, str] = (IMPRESSION, "value"),
    fanout: str = "compat",
) -> DataFrame:
    """Users and cumulated revenue per cohort: (*dims, join_date, new_users, rev_d*).

    A user seen in k versions belongs to k cohorts; see ``with_copies``.
    """
    members = with_copies(identity, fanout)
    daily = user_day_revenue(events, *revenue).withColumnRenamed(USER, "payer")
    day = F.datediff("event_date", "join_date")
    credited = F.col("day_rev") * F.col("copies")
    per_user = (
        members.join(
            daily, (F.col(USER) == F.col("payer")) & day.between(0, max(horizons)), "left"
        )
        .groupBy(USER, *dims, "join_date")
        .agg(*[sum_where(day.between(0, h), credited).alias(f"rev_d{h}") for h in horizons])
    )
    return no_null(
        per_user.groupBy(*dims, "join_date").agg(
            F.count(USER).alias("new_users"),
            *[F.sum(f"rev_d{h}").alias(f"rev_d{h}") for h in horizons],
        ),
        dims,
    )


def cohort_ltv(
    events: DataFrame,
    *,
    as_of: dt.date,
    versions: Sequence[str] = (),
    exclude_geo: Sequence[str] = DEFAULT_EXCLUDED_GEO,
    horizons: Sequence[int] = HORIZONS,
    dims: Sequence[str] = (VERSION,),
    revenue: tuple[str, str] = (IMPRESSION, "value"),
    fanout: str = "compat",
) -> DataFrame:
    """Lifetime value per user up to each horizon, one row per cohort."""
    identity = cohort_identity(events, versions=versions, exclude_geo=exclude_geo, dims=dims)
    cohorts = cohort_revenue(
        events, identity, horizons=horizons, dims=dims, revenue=revenue, fanout=fanout
    )
    return cohorts.select(
        *renamed(dims),
        F.col("join_date").alias("cohort_date"),
        "new_users",
        *[
            F.round(ratio(F.col(f"rev_d{h}"), F.col("new_users")), 6).alias(f"ltv_d{h}")
            for h in horizons
        ],
        mature("join_date", max(horizons), as_of),
    )
