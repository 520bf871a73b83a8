"""The stored sample: dealt while narrow, the same nested rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from playlens.sources import sample

KINDS = ["signup", "view", "click", "error", "purchase", None]


@pytest.fixture
def one_file(spark, tmp_path):
    """A sample in a single file: 200 events, most of them in one instant, some twice, some with nulls."""
    rows = []
    for n in range(190):
        ts = None if n % 50 == 7 else dt.datetime(2024, 1, 1 + (n % 3 if n % 10 == 0 else 0), 12)
        props = None if n % 31 == 3 else f'{{"k": {n % 60}}}'
        rows.append((n, ts, None if n % 41 == 5 else n % 17, KINDS[n % 6], None if n % 7 == 2 else n / 4, props))
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows + rows[:10], schema).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_one_day_in_one_file_is_dealt_to_many_tasks(spark, one_file):
    rows = sample.sample_rows(spark, one_file)
    dealt = sample.by_shard(rows, piece_rows=20)
    sizes = [r[0] for r in dealt.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) >= 8 and max(sizes) <= 60
    assert dealt.exceptAll(rows).isEmpty() and rows.exceptAll(dealt).isEmpty()


def test_nested_rows_are_neither_shuffled_nor_sorted(spark, one_file):
    nested = sample.nested(sample.by_shard(sample.sample_rows(spark, one_file), piece_rows=20))
    plan = nested._jdf.queryExecution().executedPlan().toString()
    above = plan[: plan.index("Sort [shard")]
    assert "array" in above and "Exchange" not in above and "array_compact" not in plan and "isnotnull(lambda" not in plan


@pytest.mark.parametrize("variant", [{}, {"some_without_session": True, "purchases": True}])
def test_the_store_holds_all_raw_events(spark, one_file, variant):
    stored = sample.raw_store(spark, one_file, **variant)
    raw = sample.raw_events(spark, one_file, **variant).select(*stored.columns)
    as_text = lambda df: sorted(r[0] or "" for r in df.select(F.to_json(F.struct("*"))).collect())
    made, kept = raw.withColumn("shard", F.col("shard").cast("string")), stored.withColumn("shard", F.col("shard").cast("string"))
    assert as_text(made) == as_text(kept) and len(as_text(kept)) == 200


def test_bags_drop_entries_of_unmet_and_unknown_conditions(spark):
    bag = sample._bag([sample._entry("a")], [("x", [sample._entry("b"), sample._entry("c")]), ("NOT x", [sample._entry("d")])])
    rows = spark.createDataFrame([(True,), (False,), (None,)], "x boolean").selectExpr("x", f"{bag} AS bag")
    assert {r.x: [e.key for e in r.bag] for r in rows.collect()} == {True: ["a", "b", "c"], False: ["a", "d"], None: ["a"]}
