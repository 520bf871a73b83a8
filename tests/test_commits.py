"""Loads that become visible as a whole, narrow deduplication and bucketed keys."""

from __future__ import annotations

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from playlens.config import FLATTEN_A, FLATTEN_B
from playlens.operators.narrow import unique_events_narrow
from playlens.operators.sieve import Sieve
from playlens.plans.flatten import flatten, unique_events
from playlens.sinks import commits
from playlens.sinks.commits import LostRace, MarkedTable, load_base, load_flatten, staging_table
from playlens.sinks.known_keys import KnownKeys
from playlens.sinks.tables import StrayRows, create_namespace
from playlens.streaming.ingest import stream_flatten_marked
from tests.conftest import DAY0
from tests.test_tables import counts, event

RUN = DAY0 + dt.timedelta(days=3)


def users(df):
    return counts(df, "user_pseudo_id")


def test_daily_runs_add_each_event_once(spark, raw, tmp_path):
    root, base_root = str(tmp_path / "flat"), str(tmp_path / "base")
    log = [event("loading", "a", day=d) for d in range(4)]
    late = event("loading", "late", day=1, shard_day=2)
    for _ in range(2):
        load_flatten(spark, raw(*log, *log), root, FLATTEN_B, RUN)
    table = staging_table(spark, raw(*log), root, FLATTEN_B)
    assert users(table.read()) == {("a",): 3}
    load_flatten(spark, raw(*log, late), root, FLATTEN_B, RUN)
    load_flatten(spark, raw(*log, late), root, FLATTEN_B, RUN + dt.timedelta(days=1))
    assert users(table.read()) == {("a",): 3, ("late",): 1}
    for _ in range(2):
        load_base(spark, table.read(), base_root, FLATTEN_B, RUN)
    assert spark.read.option("basePath", base_root).parquet(f"{base_root}/load=*").count() == 4


@pytest.mark.parametrize("dies", ["before the marker", "between files"])
def test_a_load_that_dies_leaves_the_old_day_readable(spark, raw, tmp_path, monkeypatch, dies):
    root = str(tmp_path / "flat")
    old = raw(event("loading", "a"), event("loading", "b", day=1))
    table = staging_table(spark, old, root, FLATTEN_B)
    commits.append_raw(table, old, FLATTEN_B)
    more = raw(event("loading", "c"), event("loading", "d", day=1))
    broken = flatten(more, FLATTEN_B)
    with monkeypatch.context() as patch:
        if dies == "between files":
            bad = F.when(F.col("user_pseudo_id") == "d", F.raise_error(F.lit("lost"))).otherwise(F.col("platform"))
            broken = broken.withColumn("platform", bad.cast("string"))
        else:
            patch.setattr(MarkedTable, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception, match="lost"):
            table.append_new(broken)
    assert users(table.read()) == {("a",): 1, ("b",): 1} and table.snapshot().version == 1
    commits.append_raw(table, more, FLATTEN_B)
    assert users(table.read()) == {(u,): 1 for u in "abcd"}
    before = table.snapshot(1)
    assert table.vacuum(keep=2) == (dies == "before the marker") and users(table.read(before)) == {("a",): 1, ("b",): 1}
    assert table.vacuum(keep=1) == 0 and users(table.read()) == {(u,): 1 for u in "abcd"}


def test_two_writers_add_each_key_once(spark, raw, tmp_path):
    root = str(tmp_path / "flat")
    rows = [raw(event("loading", "both"), event("loading", u, day=1)) for u in "ab"]
    flat = [flatten(r, FLATTEN_B).cache() for r in rows]
    tables = [MarkedTable(spark, root, f.schema) for f in flat]
    tables[0].append_new(flatten(raw(event("loading", "old")), FLATTEN_B))
    start, built, lost = threading.Barrier(2), [0, 0], []

    def write(i):
        table = tables[i]
        publish = table._publish

        def once(version, days):
            if built[i] == 0:
                built[i] = 1
                start.wait(60)  # both have written against the same snapshot
            try:
                publish(version, days)
            except LostRace:
                lost.append(i)
                raise

        table._publish = once
        table.append_new(flat[i])

    threads = [threading.Thread(target=write, args=(i,)) for i in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert users(tables[0].read()) == {("old",): 1, ("both",): 1, ("a",): 1, ("b",): 1}
    assert len(lost) == 1 and tables[0].snapshot().version == 3
    assert tables[0].vacuum(keep=3) == 0  # the loser removed what it had written


def test_the_rename_used_on_a_cluster_never_replaces_a_marker(spark, tmp_path):
    table = MarkedTable(spark, str(tmp_path / "t"), spark.range(1).schema, day=None)
    table._by_link = False
    assert table.replace_all(spark.range(3)).version == 1
    with pytest.raises(LostRace):
        table._publish(1, {"all": ["other"]})
    assert table.read().count() == 3
    assert [r.id for r in table.read(table.replace_all(spark.range(7, 8))).collect()] == [7]


def test_readers_keep_their_snapshot_and_days_are_replaced_whole(spark, raw, tmp_path):
    log = raw(event("loading", "a"), event("loading", "b", day=1))
    table = staging_table(spark, log, str(tmp_path / "flat"), FLATTEN_B)
    commits.append_raw(table, log, FLATTEN_B)
    held = table.read()
    table.replace_day(flatten(raw(event("loading", "c")), FLATTEN_B), DAY0)
    assert users(held) == {("a",): 1, ("b",): 1} and users(table.read()) == {("c",): 1, ("b",): 1}
    assert users(table.read(days=[DAY0])) == {("c",): 1}
    table.replace_day(flatten(raw(event("loading", "c")), FLATTEN_B).limit(0), DAY0)
    assert users(table.read()) == {("b",): 1}
    with pytest.raises(StrayRows):
        table.replace_day(flatten(log, FLATTEN_B), DAY0)


def test_stream_and_daily_load_of_the_same_files(spark, raw, tmp_path):
    source, root = str(tmp_path / "raw"), str(tmp_path / "flat")
    log = raw(*[event("loading", u, day=d) for d in range(3) for u in ("a", "b")])
    log.write.partitionBy("shard").parquet(source)
    query = stream_flatten_marked(spark, source, root, str(tmp_path / "checkpoint"), FLATTEN_B, files_per_batch=1)
    load_flatten(spark, log, root, FLATTEN_B, RUN)
    query.awaitTermination()
    load_flatten(spark, log, root, FLATTEN_B, RUN)
    table = staging_table(spark, log, root, FLATTEN_B)
    assert users(table.read()) == {("a",): 3, ("b",): 3}
    assert table.read().select("surrogate_key").distinct().count() == 6


def test_narrow_deduplication_gives_the_same_rows(spark, raw):
    hot = [event("loading", "hot", platform=f"p{i}") for i in range(100)]
    rows = hot + [event("loading", f"u{i % 150}", seconds=i % 150) for i in range(200)]
    # Other columns, equal key text; a NULL user is the text null; no time, no key.
    rows += [event("loading", "1", seconds=0), event("loading", None), event("loading", "null"), event(None, "x")]
    for user in ("n1", "n2"):
        rows.append({**event("loading", user), "event_timestamp": None})
    log = raw(*rows)
    for spec in (FLATTEN_A, FLATTEN_B):
        plain, narrow = unique_events(flatten(log, spec), spec), unique_events_narrow(log, spec)
        assert sorted(map(str, plain.collect())) == sorted(map(str, narrow.collect()))


def test_rows_without_a_double_are_not_shuffled(spark, raw, tmp_path):
    log = raw(*[event("loading", f"u{i}") for i in range(50)], event("loading", "u1"))
    log.write.parquet(str(tmp_path / "raw"))
    df = unique_events_narrow(spark.read.schema(log.schema).parquet(str(tmp_path / "raw")), FLATTEN_A)
    plan = df._jdf.queryExecution().executedPlan().toString()
    rest, some = plan[plan.index("Union") :].split("Window [", 1)
    assert "Exchange hashpartitioning" not in rest and "Exchange hashpartitioning(surrogate_key" in some
    assert df.count() == 50


def test_a_sieve_lets_every_key_through(spark):
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("word"))
    hashed = F.xxhash64("word")
    sieve = Sieve(rows.where("word % 7 = 0").select(hashed))
    passed = sieve.among(rows, hashed)
    assert passed.where("word % 7 = 0").count() == 2858 and passed.count() < 4500
    assert passed.count() + sieve.not_among(rows, hashed).count() == 20_000
    none = Sieve(rows.limit(0).select(hashed))
    assert none.among(rows, hashed).count() == 0 and none.not_among(rows, hashed).count() == 20_000


def test_known_keys_are_not_shuffled(spark, raw, tmp_path):
    create_namespace(spark, "playlens_keys", str(tmp_path / "catalog"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = KnownKeys(spark, "playlens_keys.known", buckets=4)
        old = flatten(raw(*[event("loading", f"u{i}", day=i % 3) for i in range(60)], {**event("loading", "n"), "event_timestamp": None}), FLATTEN_B)
        assert known.new_rows(old).count() == 60
        known.add(old)
        known.add(old.limit(0))
        later = flatten(raw(*[event("loading", f"u{i}", day=i % 3) for i in range(50, 70)]), FLATTEN_B)
        fresh = known.new_rows(later, days=[DAY0 + dt.timedelta(days=d) for d in range(3)])
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        known_side = plan[plan.index("FileScan parquet") - 400 :]
        assert plan.count("Exchange hashpartitioning") == 1 and "SelectedBucketsCount: 4 out of 4" in plan, plan
        assert "Exchange" not in known_side.split("FileScan")[1]
        assert sorted(r.user_pseudo_id for r in fresh.collect()) == [f"u{i}" for i in range(60, 70)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
        spark.sql("DROP DATABASE IF EXISTS playlens_keys CASCADE")
