"""Retention and reach from stored sets equal those from events, which are not read again."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from playlens.plans.retention import retention_curve
from playlens.sinks.user_sets import UserSets, as_sets, retention_from_sets, trailing_active
from tests.conftest import DAY0

AS_OF = DAY0 + dt.timedelta(days=40)


def day(n):
    return DAY0 + dt.timedelta(days=n)


def log(typed, seed, days=14):
    rng = random.Random(seed)
    rows = []
    for user in [f"u{i}" for i in range(40)] + [None]:
        born = rng.randrange(days)
        for version in rng.choice([["1"], ["1", "2"], [None]]):
            rows.append(("first_open", user, min(days - 1, born + rng.randrange(3)), {"app_version": version}))
            rows.append(("first_open", user, days - 1, {"app_version": version}))
        for n in range(days):
            if rng.random() < 0.3 and user not in ("u1", "u2"):
                rows += [("session_start", user, n, {"app_version": "9"})] * rng.randint(1, 3)
    rows.append(("first_open", "late", days - 1, {"app_version": "3"}))
    return typed(*rows)


def plain(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("steps", [[13], [0, 1, 6, 13], [4, 4, 13, 13]])
def test_retention_equals_that_from_events(spark, typed, tmp_path, steps):
    events = log(typed, len(steps)).cache()
    sets = UserSets(spark, str(tmp_path))
    first = 0
    for last in steps:
        sets.add_days(events, day(min(first, last)), day(last))
        first = last + 1
    for options in ({}, {"mode": "rolling"}, {"mode": "rolling", "until": 9}, {"days": (1, 3, 14)}, {"days": (0, 2), "mode": "rolling"}):
        want = retention_curve(events, as_of=AS_OF, **options)
        assert plain(retention_from_sets(sets, as_of=AS_OF, **options)) == plain(want), options
    a = events.where("event_name = 'session_start' AND user_pseudo_id IS NOT NULL").select("user_pseudo_id", "event_date").distinct()
    b = a.select(F.col("event_date").alias("d")).distinct()
    near = F.datediff("d", "event_date").between(0, 6)
    want = b.join(a, near).groupBy(F.col("d").alias("event_date")).agg(F.count_distinct("user_pseudo_id").alias("users"))
    assert plain(trailing_active(sets, 7)) == plain(want)


def test_reports_read_the_sets_alone(spark, typed, tmp_path):
    sets = UserSets(spark, str(tmp_path / "sets"))
    sets.add_days(log(typed, 1), day(0), day(13))
    for mode in ("exact", "rolling"):
        report = retention_from_sets(sets, as_of=AS_OF, mode=mode)
        assert all("/sets/joined/" in f or "/sets/active/" in f for f in report.inputFiles())
        plan = report._jdf.queryExecution().executedPlan().toString()
        for bad in ("user_pseudo_id", "event_name", "CartesianProduct", "NestedLoopJoin", "SinglePartition"):
            assert bad not in plan, bad


def test_numbers_are_dense_and_kept(spark, typed, tmp_path):
    events = log(typed, 2).cache()
    sets = UserSets(spark, str(tmp_path))
    sets.add_days(events, day(0), day(5))
    old = {r[0]: r[1] for r in sets.numbers.read().collect()}
    sets.add_days(events, day(6), day(13))
    new = {r[0]: r[1] for r in sets.numbers.read().collect()}
    assert sorted(new.values()) == list(range(1, len(new) + 1)) and old.items() <= new.items()
    with pytest.raises(ValueError, match="stored already"):
        sets.add_days(events, day(2), day(3))


def test_sets_of_many_pieces(spark):
    sets = as_sets(spark.range(1, 100_001).select(F.col("id").alias("number"), (F.col("id") % 2).alias("k")), ["k"])
    assert sets.count() == 8
    counts = sets.groupBy("k").agg(F.sum(F.bitmap_count("bits")).alias("n"))
    assert {tuple(r) for r in counts.collect()} == {(0, 50_000), (1, 50_000)}


def test_no_events(spark, typed, tmp_path):
    sets = UserSets(spark, str(tmp_path))
    sets.add_days(typed(("loading", "a", 0, {})), day(0), day(0))
    assert retention_from_sets(sets, as_of=AS_OF).collect() == []
    assert retention_from_sets(sets, as_of=AS_OF, mode="rolling").collect() == []
    assert trailing_active(sets, 7).collect() == []
