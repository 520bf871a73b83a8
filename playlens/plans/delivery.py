"""Row order of delivered reports. Stored tables carry no order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Sort columns of each report; a leading minus sorts downwards.
REPORT_ORDER = {
    "minigame_sessions_report": ("version", "-start_user"),
    "funnel_monetization": ("version",),
    "cohort_ltv": ("version", "cohort_date"),
    "daily_ads": ("-date",),
    "retention_curve": ("version", "cohort_date"),
    "play_results": ("version", "-users_start"),
    "parity_report": ("version", "src"),
}


def _order(name: str) -> list:
    return [F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in REPORT_ORDER[name]]


def with_position(report: DataFrame, name: str, within: Sequence[str]) -> DataFrame:
    """The report with each row's ``position`` in delivery order among rows of equal ``within``.

    Unlike a total order this needs no single task: each group is numbered by itself.
    """
    place = F.row_number().over(W.partitionBy(*within).orderBy(*_order(name)))
    return report.withColumn("position", place)


def ordered(report: DataFrame, name: str) -> DataFrame:
    """The report in its delivery order, by the name of the function that made it."""
    return report.orderBy(*_order(name))
