"""Deduplication that shuffles whole rows only where a key may repeat.

Most keys occur once. A first pass over the key columns alone counts 64-bit hashes of the keys, combined
before the shuffle, and keeps those seen more than once; a bitmap of these tells in the second pass which rows can
have a double. Only these are dealt out by key, and all others go straight through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.config import FlattenSpec
from playlens.functions.labels import surrogate_key
from playlens.operators.sieve import Sieve
from playlens.plans.flatten import flatten, unique_events
from playlens.session import scratch_dir


def repeated_hashes(rows: DataFrame, hashed: Column) -> DataFrame:
    """The hashes seen more than once, written: 8 bytes a row are shuffled."""
    spark, path = rows.sparkSession, scratch_dir(rows.sparkSession, "repeated")
    counts = rows.select(hashed.alias("hash")).groupBy("hash").count().where(F.col("count") > 1).select("hash")
    counts.write.parquet(path)
    return spark.read.schema(counts.schema).parquet(path)


def dedup_narrow(rows: DataFrame, hashed: Column, once: Callable[[DataFrame], DataFrame], ready: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``once`` of the rows whose hash may repeat, and ``ready`` of all others.

    Equal keys must have equal hashes; other keys that share a hash, or a bit of the bitmap, are only
    shuffled for nothing. ``once`` removes the doubles.
    """
    sieve = Sieve(repeated_hashes(rows, hashed))
    return ready(sieve.not_among(rows, hashed)).unionByName(once(sieve.among(rows, hashed)))


def unique_events_narrow(raw: DataFrame, spec: FlattenSpec) -> DataFrame:
    """Flat rows of raw events, one per key: the same rows as ``unique_events`` of all of them."""
    return dedup_narrow(
        raw,
        F.xxhash64(surrogate_key("user_pseudo_id", "event_timestamp", "event_name")),
        lambda some: unique_events(flatten(some, spec), spec),
        lambda rest: flatten(rest, spec),
    )
