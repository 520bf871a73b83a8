"""Two layers compared row by row, reading again only where they differ (DQ5, K10).

Both sides are summed up to a count and a checksum per day, event and bucket of the key, in one pass each. Buckets
whose sums agree are done with. Of the others the days and events become partition filters and the buckets a
filter on the key's hash, and only their rows are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlens.operators.cohorts import USER
from playlens.session import scratch_dir

PLACE = ("event_date", "event_name")
KEYS = (USER, "event_timestamp", "event_name")
BUCKETS = 64


def bucket_of_key(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def content_hash(columns: Sequence[str]) -> Column:
    """Tells rows apart by all their values; a NULL differs from every value and moves nothing."""
    return F.xxhash64(*[c for name in columns for c in (F.col(name), F.isnull(name))])


def checksums(rows: DataFrame, keys: Sequence[str] = KEYS, place: Sequence[str] = PLACE, buckets: int = BUCKETS) -> DataFrame:
    """``(*place, bucket, n, total)``: sums do not depend on the order of rows, and repeats count."""
    total = F.sum(content_hash(sorted(rows.columns)).cast("decimal(20,0)")).alias("total")
    return rows.groupBy(*place, bucket_of_key(keys, buckets).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), total)


def differing_buckets(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = KEYS, place: Sequence[str] = PLACE, buckets: int = BUCKETS
) -> DataFrame:
    """``(*place, bucket, left_n, right_n)`` of the buckets whose rows are not the same on both sides."""
    a, b = (checksums(df, keys, place, buckets) for df in (left, right))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*place, "bucket")]
    both = a.alias("a").join(b.alias("b"), same, "full")
    equal = F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.total").eqNullSafe(F.col("b.total"))
    names = [F.when(F.col("a.n").isNull(), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in (*place, "bucket")]
    counts = [F.coalesce(f"{side}.n", F.lit(0)).alias(name) for side, name in (("a", "left_n"), ("b", "right_n"))]
    return both.where(~equal).select(*names, *counts)


def _restricted(rows: DataFrame, where: DataFrame, parts: list[tuple], keys, place, buckets) -> DataFrame:
    """Rows of differing buckets: by literals of their partitions first, then by the bucket itself."""
    listed = F.lit(False)
    for part in parts:
        one = F.lit(True)
        for column, value in zip(place, part):
            one = one & (F.col(column).isNull() if value is None else F.col(column) == F.lit(value))
        listed = listed | one
    own = rows.where(listed).withColumn("bucket_", bucket_of_key(keys, buckets)).alias("r")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"w.{c}")) for c in place] + [F.col("r.bucket_") == F.col("w.bucket")]
    return own.join(where.alias("w"), same, "left_semi").drop("bucket_")


def differing_rows(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = KEYS, place: Sequence[str] = PLACE, buckets: int = BUCKETS
) -> DataFrame:
    """``(*place, *keys, status, columns, left_copies, right_copies)`` of the keys whose rows differ.

    ``status`` is ``left only``, ``right only`` or ``changed``; ``columns`` names what changed, by name, where each side
    has one row of the key, and is NULL where a side has more: then their contents or their numbers differ. Both
    frames have the same columns; a NULL key is one like any other.
    """
    spark, path = left.sparkSession, scratch_dir(left.sparkSession, "differing")
    differing_buckets(left, right, keys, place, buckets).write.parquet(path)
    where = spark.read.parquet(path)
    # As many as the calendar has days and the game events, at most.
    parts = [tuple(r) for r in where.select(*place).distinct().collect()]
    whole = list(dict.fromkeys((*place, *keys)))
    values = sorted(c for c in left.columns if c not in whole)

    def side(rows: DataFrame) -> DataFrame:
        some = _restricted(rows, where, parts, keys, place, buckets)
        one = [F.first(c).alias(c) for c in values]
        total = F.sum(content_hash(sorted(rows.columns)).cast("decimal(20,0)")).alias("total_")
        return some.groupBy(*whole).agg(F.count(F.lit(1)).alias("copies_"), total, *one)

    a, b = side(left).alias("a"), side(right).alias("b")
    both = a.join(b, [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in whole], "full")
    changed = [F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in values]
    single = (F.col("a.copies_") == 1) & (F.col("b.copies_") == 1)
    status = F.when(F.col("b.copies_").isNull(), "left only").when(F.col("a.copies_").isNull(), "right only").otherwise("changed")
    unequal = ~(F.col("a.copies_").eqNullSafe(F.col("b.copies_")) & F.col("a.total_").eqNullSafe(F.col("b.total_")))
    names = [F.when(F.col("a.copies_").isNull(), F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c) for c in whole]
    return both.where(unequal).select(
        *names,
        status.alias("status"),
        F.when(single, F.array_join(F.array_compact(F.array(*changed)), ",")).alias("columns"),
        F.coalesce("a.copies_", F.lit(0)).alias("left_copies"),
        F.coalesce("b.copies_", F.lit(0)).alias("right_copies"),
    )
