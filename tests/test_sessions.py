"""The session rewrite against the literal interval join, by brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from playlens.operators.sessions import by_density, cut_points, interval_sessions, next_start
from playlens.plans.journeys import journey_edges
from tests.conftest import micros


def literal_sessions(starts, members):
    """(user, key, start) -> (last, count, sum) by checking every interval."""
    out = {}
    for user, key in {(u, k) for u, k, _ in starts}:
        times = sorted({t for u, k, t in starts if (u, k) == (user, key)})
        for i, start in enumerate(times):
            end = times[i + 1] if i + 1 < len(times) else None
            inside = [
                (t, x)
                for u, k, t, x in members
                if (u, k) == (user, key) and t >= start and (end is None or t < end)
            ]
            last = max((t for t, _ in inside), default=None)
            out[(user, key, start)] = (last, len(inside), sum(x for _, x in inside))
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("bucket_seconds", [1, 60, 3600])
def test_equals_interval_join(spark, seed, bucket_seconds):
    rng = random.Random(seed)
    span = rng.choice([20, 400, 20_000])
    starts = [
        (rng.choice("aab"), rng.choice("xy"), rng.randrange(span) * 1_000_000) for _ in range(60)
    ]
    members = [
        (rng.choice("aabc"), rng.choice("xyz"), rng.randrange(span) * 1_000_000, rng.randrange(9))
        for _ in range(200)
    ]
    members += members[:40]
    rows = [(u, k, t, 1, 0, 0) for u, k, t in starts] + [(u, k, t, 0, 1, x) for u, k, t, x in members]
    df = spark.createDataFrame(rows, "u string, k string, ts long, is_start int, is_member int, x int")
    got = interval_sessions(df, ["u", "k"], "ts", {"x": F.col("x")}, bucket_seconds)
    found = {
        (r.u, r.k, r.start_ts): (r.last_ts, r.members, r.x if r.members else 0)
        for r in got.collect()
    }
    assert found == literal_sessions(starts, members)


def test_next_start_is_the_following_distinct_start(spark):
    hour = 3_600_000_000
    times = [0, 0, 5, hour - 1, hour, 7 * hour, 7 * hour + 3, 40 * hour]
    df = spark.createDataFrame([("a", t) for t in times] + [("b", 9)], "u string, ts long")
    got = {(r.u, r.ts): r.next_start_ts for r in next_start(df, ["u"], "ts").collect()}
    distinct = sorted(set(times))
    expected = {("a", t): n for t, n in zip(distinct, [*distinct[1:], None])}
    assert got == {**expected, ("b", 9): None}


@pytest.mark.parametrize("bucket_seconds", [1, 30, 3600])
def test_journey_edges_equal_a_plain_walk(typed, bucket_seconds):
    rng = random.Random(bucket_seconds)
    names = ["loading", "enter_home", "level_start"]
    events = []
    for _ in range(150):
        user, second = rng.choice(["u", "u", "v"]), rng.randrange(300)
        events.append(
            (rng.choice(names), user, 0, {"event_timestamp": micros(0, second), "ga_session_number": "1"})
        )
    events.append(("loading", "u", 0, {"ga_session_number": "2"}))
    expected = {}
    for user in "uv":
        walk = sorted(
            (c["event_timestamp"], n)
            for n, u, _, c in events
            if u == user and c["ga_session_number"] == "1"
        )
        for (_, a), (_, b) in zip(walk, walk[1:]):
            hops, users = expected.setdefault((a, b), [0, set()])
            expected[(a, b)][0] = hops + 1
            users.add(user)
    got = {
        (r.from_step, r.to_step): (r.transitions, r.users)
        for r in journey_edges(typed(*events), bucket_seconds=bucket_seconds).collect()
    }
    assert got == {k: (n, len(users)) for k, (n, users) in expected.items()}


@pytest.mark.parametrize("rows", [1, 7, 10_000])
def test_density_cuts_give_the_same_sessions(spark, rows):
    rng = random.Random(rows)
    starts = [(rng.choice("aab"), rng.choice("xy"), rng.randrange(400)) for _ in range(60)]
    members = [(rng.choice("aab"), rng.choice("xyz"), rng.randrange(400), rng.randrange(9)) for _ in range(300)]
    members += [("a", "x", 77, 1)] * 50  # many rows of one moment stay together
    data = [(u, k, t, 1, 0, 0) for u, k, t in starts] + [(u, k, t, 0, 1, x) for u, k, t, x in members]
    df = spark.createDataFrame(data, "u string, k string, t long, is_start int, is_member int, x long")
    got = interval_sessions(df, ["u", "k"], "t", {"x": F.col("x")}, bucketing=by_density(rows))
    want = literal_sessions(starts, members)
    found = {(r.u, r.k, r.start_ts): (r.last_ts, r.members, r.x or 0) for r in got.collect()}
    assert found == {k: v for k, v in want.items()}
    plain = df.where("is_start = 1").select("u", "k", "t")
    pairs = next_start(plain, ["u", "k"], "t", by_density(rows))
    assert sorted(map(str, pairs.collect())) == sorted(map(str, next_start(plain, ["u", "k"], "t").collect()))


def test_a_hot_user_inside_one_hour_is_cut_evenly(spark):
    """A third of all rows are one user's, within an hour and mostly within a minute of it."""
    dense = (F.pow(F.rand(3), 6) * 3600e6).cast("long")
    hot = spark.range(60_000).select(F.lit("bot").alias("u"), dense.alias("t"))
    other = spark.range(120_000).select((F.col("id") % 400).cast("string").alias("u"), (F.rand(4) * 86_400e6).cast("long").alias("t"))
    rows = hot.union(other)
    sizes = by_density(1000)(rows, ["u"], "t").groupBy("u", "bucket").count().collect()
    bot = [r["count"] for r in sizes if r["u"] == "bot"]
    assert len(bot) >= 55 and max(bot) < 2 * sorted(bot)[len(bot) // 2]
    assert {r["bucket"] for r in sizes if r["u"] != "bot"} == {0}
    dealt = by_density(1000)(rows, ["u"], "t").repartition(16, "u", "bucket")
    tasks = sorted(r["count"] for r in dealt.groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert tasks[-1] < 2 * tasks[len(tasks) // 2]
    assert cut_points(rows, ["u"], "t", 1_000_000).collect() == []
