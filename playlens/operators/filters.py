"""Row filters with the list semantics of the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.config import HOME


def keep_listed(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Allow-list; an empty list means no restriction."""
    return df.where(F.col(column).isin(list(allowed))) if allowed else df


def drop_listed(df: DataFrame, column: str, denied: Sequence[str]) -> DataFrame:
    """Deny-list; with a non-empty list a NULL value is dropped as well."""
    return df.where(~F.col(column).isin(list(denied))) if denied else df


def in_game(column: Column) -> Column:
    """Set and not the home screen."""
    return column != F.lit(HOME)
