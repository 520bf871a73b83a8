"""Deduplication, load-once filtering and keyed lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def dedup_first(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The first row per key. ``order`` should be total to be reproducible.

    Spark applies the row limit before the shuffle too (``WindowGroupLimit``),
    so many copies of one key send one row per task.
    """
    ranked = W.partitionBy(key).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def new_rows_only(incoming: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Incoming rows whose key is not known yet; rows without a key are dropped.

    A literal NOT IN would need to broadcast every known key and would reject
    everything once a single known key is NULL; the keyed anti join does neither. Keys
    hardly compress, so Spark's guess from the size of the files is far too low: without
    the hint all known keys may pass through the driver.
    """
    return incoming.dropna(subset=[key]).join(
        known.select(key).dropna(subset=[key]).hint("merge"), key, "left_anti"
    )


def one_per_key(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str]) -> DataFrame:
    """Earliest row per key as an aggregation, so copies combine before the shuffle."""
    picked = F.min(F.struct(order, *columns)).alias("_row")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_row.{c}") for c in columns])


def enrich(
    events: DataFrame,
    context: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: Sequence[str],
) -> DataFrame:
    """Events with ``columns`` looked up in ``context``; misses stay NULL.

    The context is reduced to one row per key first, so no event multiplies.
    """
    usable = context.dropna(subset=list(keys))
    return events.join(one_per_key(usable, keys, order, columns), list(keys), "left")


def missing_parents(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child keys without a parent, with the number of child rows each has."""
    return (
        child.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .join(parent.select(key), key, "left_anti")
    )
