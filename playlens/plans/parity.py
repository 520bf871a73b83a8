"""Raw log against typed tables: the same figures from both (job K10)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from playlens.config import DEFAULT_EXCLUDED_GEO
from playlens.functions.bags import Bag
from playlens.functions.numbers import per_mille, ratio
from playlens.operators.ads import IMPRESSION
from playlens.operators.cohorts import USER, VERSION
from playlens.sources.shards import between

FIGURES = ("new_users", "dau", "total_imps", "total_rev", "ecpm", "ltv_d0")


def _figures(rows: DataFrame, source: str, exclude_geo: Sequence[str]) -> DataFrame:
    """Figures per version from (user, version, country, event_name, rev) rows.

    One pass: flags and sums per user and version, then the user's sums over all versions.
    """
    name = F.col("event_name")
    listed = ~F.col("country").isin(list(exclude_geo)) if exclude_geo else F.lit(True)
    shown = name == IMPRESSION
    of_user = W.partitionBy(USER)
    per_version = (
        rows.where(name.isin("first_open", "session_start", IMPRESSION) & F.col(USER).isNotNull())
        .groupBy(USER, VERSION)
        .agg(
            F.max(F.when((name == "first_open") & listed, 1)).alias("opened"),
            F.max(F.when((name == "session_start") & F.col(VERSION).isNotNull(), 1)).alias("active"),
            F.nullif(F.count_if(shown), F.lit(0)).alias("imps"),
            F.sum(F.when(shown, F.col("rev"))).alias("rev"),
        )
        .withColumn("imps", F.sum("imps").over(of_user))
        .withColumn("rev", F.sum("rev").over(of_user))
    )
    none = F.lit(0.0)
    return (
        per_version.where("opened = 1")
        .groupBy(VERSION)
        .agg(
            F.count(USER).alias("new_users"),
            F.count("active").alias("dau"),
            F.sum(F.coalesce("imps", F.lit(0))).alias("total_imps"),
            F.sum(F.coalesce("rev", none)).alias("rev"),
            F.sum("imps").alias("imps"),
            F.sum("rev").alias("known_rev"),
        )
        .select(
            F.lit(source).alias("src"),
            F.col(VERSION).alias("version"),
            "new_users",
            "dau",
            "total_imps",
            F.round("rev", 6).alias("total_rev"),
            per_mille(F.col("known_rev"), F.col("imps")).alias("ecpm"),
            F.round(ratio(F.col("rev"), F.col("new_users")), 6).alias("ltv_d0"),
        )
    )


def parity_report(
    raw: DataFrame,
    events: DataFrame,
    *,
    days: tuple[dt.date, dt.date] | None = None,
    exclude_geo: Sequence[str] = DEFAULT_EXCLUDED_GEO,
) -> DataFrame:
    """Both sources stacked, over all days or a range of them. The raw side reads only the double slot of the value,
    so rows whose value arrives in another slot show up as a difference."""
    if days:
        raw = between(raw, *days)
        events = events.where(F.col("event_date").between(*map(F.lit, days)))
    raw_rows = raw.select(
        USER,
        F.col("app_info.version").alias(VERSION),
        F.col("geo.country").alias("country"),
        "event_name",
        Bag("event_params").first_slot("value", "double_value").alias("rev"),
    )
    typed_rows = events.select(
        USER, VERSION, F.col("geo_country").alias("country"), "event_name",
        F.col("value").alias("rev"),
    )
    return _figures(raw_rows, "RAW", exclude_geo).unionByName(
        _figures(typed_rows, "L2", exclude_geo)
    )


def parity_diff(report: DataFrame) -> DataFrame:
    """Typed minus raw per version and figure, from a parity report."""

    def side(src: str, figure: str):
        return F.max(F.when(F.col("src") == src, F.col(figure)))

    return report.groupBy("version").agg(
        *[F.round(side("L2", f) - side("RAW", f), 6).alias(f"{f}_diff") for f in FIGURES]
    )
