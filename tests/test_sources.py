"""Ledger of source files, census of parameters, row-level reconciliation."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from playlens.config import FLATTEN_B, Game
from playlens.plans.census import compare_census, extended, key_census
from playlens.plans.reconcile import differing_buckets, differing_rows
from playlens.plans.split import read_events, split_events
from playlens.sinks import ledger as module
from playlens.sinks.commits import staging_table
from playlens.sinks.ledger import Ledger, load_pending, resume_backfill
from playlens.sinks.tables import build_day, write_events
from playlens.sources.shards import read_raw
from tests.conftest import DAY0, entry
from tests.test_tables import counts, event

LAST = DAY0 + dt.timedelta(days=3)


@pytest.fixture
def source(raw, tmp_path):
    root = str(tmp_path / "raw")

    def add(*events):
        raw(*events).coalesce(1).write.mode("append").partitionBy("shard").parquet(root)
        return root

    return add


def test_a_late_file_of_an_old_shard_arrives_once(spark, source, tmp_path):
    root, ledger = source(*[event("loading", "a", day=d) for d in range(4)]), Ledger(spark, str(tmp_path / "ledger"))
    target = str(tmp_path / "flat")
    assert load_pending(spark, root, target, ledger, FLATTEN_B, batch_files=3) == 4
    assert load_pending(spark, root, target, ledger, FLATTEN_B) == 0
    source(event("loading", "late", day=0), event("loading", "a", day=0))
    assert ledger.pending(root).count() == 1
    assert load_pending(spark, root, target, ledger, FLATTEN_B) == 1
    table = staging_table(spark, read_raw(spark, root), target, FLATTEN_B)
    assert counts(table.read(), "user_pseudo_id") == {("a",): 4, ("late",): 1}


def test_a_load_that_dies_before_it_is_entered_adds_nothing_twice(spark, source, tmp_path, monkeypatch):
    root, ledger = source(event("loading", "a")), Ledger(spark, str(tmp_path / "ledger"))
    target = str(tmp_path / "flat")
    with monkeypatch.context() as patch:
        patch.setattr(Ledger, "enter", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            load_pending(spark, root, target, ledger, FLATTEN_B)
    assert load_pending(spark, root, target, ledger, FLATTEN_B) == 1
    assert staging_table(spark, read_raw(spark, root), target, FLATTEN_B).read().count() == 1


def test_a_stopped_backfill_goes_on_where_it_was(spark, source, tmp_path, monkeypatch):
    root, ledger = source(*[event("loading", "a", day=d) for d in range(4)]), Ledger(spark, str(tmp_path / "ledger"))
    target, built = str(tmp_path / "events"), []

    def build(raw, where, day, game):
        if len(built) == 2:
            raise RuntimeError("lost")
        built.append(day)
        build_day(raw, where, day, game)

    with monkeypatch.context() as patch:
        patch.setattr(module, "build_day", build)
        with pytest.raises(RuntimeError):
            resume_backfill(spark, root, target, ledger, DAY0, LAST)
    rest = resume_backfill(spark, root, target, ledger, DAY0, LAST)
    assert built + rest == [DAY0 + dt.timedelta(days=d) for d in range(4)]
    assert resume_backfill(spark, root, target, ledger, DAY0, LAST) == []
    source(event("loading", "late", day=1))
    assert resume_backfill(spark, root, target, ledger, DAY0, LAST) == [DAY0 + dt.timedelta(days=1)]
    assert counts(read_events(spark, target), "event_date")[(DAY0 + dt.timedelta(days=1),)] == 2


GAME = Game(events={"tap": ("power", "gone"), "end": ()}, context_events=(), numeric_params=("power",))


def test_census_tells_what_the_game_does_not_declare(spark, raw, tmp_path):
    old = raw(event("tap", "a", event_params=[entry("power", real=1.0)]))
    new = raw(
        event("tap", "a", day=1, event_params=[entry("power", text="2"), entry("skin", text="red"), entry("skin", text="blue")]),
        event("end", "a", day=1, event_params=[entry("score", number=4), entry("score", real=0.5), entry("void")]),
        event("other", "a", day=1, event_params=[entry("x", text="y")]),
        event("end", "b", day=1),
    )
    both = key_census(old.union(new))
    rows = {(r.event_name, r.key): (r.status, r.slots, r.n_rows) for r in compare_census(both, GAME).collect()}
    assert rows == {
        ("tap", "power"): ("mixed slots", "double,string", 2),
        ("tap", "gone"): ("never seen", "", 0),
        ("tap", "skin"): ("undeclared", "string", 2),
        ("end", "score"): ("undeclared", "double,int", 2),
        ("end", "void"): ("undeclared", "", 1),
    }
    wider = extended(GAME, both, exclude=("void",))
    assert wider.events == {"tap": ("power", "gone", "skin"), "end": ("score",)}
    assert set(wider.numeric_params) == {"power", "score"}
    # The next day has the new columns; the day stored before reads NULL.
    root = str(tmp_path / "events")
    write_events(split_events(old, GAME), root)
    build_day(new, root, DAY0 + dt.timedelta(days=1), wider)
    stored = {(r.event_date, r.event_name, r.user_pseudo_id): (r.skin, r.score) for r in read_events(spark, root, wider).collect()}
    assert stored[DAY0, "tap", "a"] == (None, None)
    assert stored[DAY0 + dt.timedelta(days=1), "tap", "a"] == ("red", None)
    assert stored[DAY0 + dt.timedelta(days=1), "end", "a"] == (None, 0.5) or stored[DAY0 + dt.timedelta(days=1), "end", "a"] == (None, 4.0)


def changed(df, user, **columns):
    for name, value in columns.items():
        df = df.withColumn(name, F.when(F.col("user_pseudo_id") == user, F.lit(value)).otherwise(F.col(name)))
    return df


def test_single_row_changes_are_found(spark, raw, tmp_path):
    log = raw(*[event("loading", f"u{i}", day=i % 3, seconds=i) for i in range(90)], event("loading", None), event(None, "x"))
    events = split_events(log).unionByName(split_events(log).where("user_pseudo_id IS NULL OR event_name IS NULL"))
    extra = split_events(raw(event("loading", None, seconds=7)))
    events = events.unionByName(extra).cache()
    assert differing_buckets(events, events).count() == differing_rows(events, events).count() == 0
    other = changed(events.where("user_pseudo_id IS NULL OR user_pseudo_id <> 'u5'"), "u7", current_screen="X", ga_session_id="p")
    other = other.unionByName(events.where("user_pseudo_id = 'u9'")).unionByName(changed(events.where("user_pseudo_id = 'u11'"), "u11", user_pseudo_id="new"))
    other = other.where("user_pseudo_id IS NOT NULL")
    found = {r.user_pseudo_id: (r.status, r.columns, r.left_copies, r.right_copies) for r in differing_rows(events, other).collect()}
    assert found == {
        "u5": ("left only", None, 1, 0),
        "u7": ("changed", "current_screen,ga_session_id", 1, 1),
        "u9": ("changed", None, 1, 2),
        "new": ("right only", None, 0, 1),
        None: ("left only", None, 1, 0),
    }


def test_agreeing_days_are_not_read_again(spark, raw, tmp_path):
    log = raw(*[event("loading", f"u{i}", day=i % 4, seconds=i) for i in range(80)])
    roots = [str(tmp_path / n) for n in "ab"]
    events = split_events(log)
    write_events(events, roots[0])
    write_events(changed(events, "u6", ga_session_id="p"), roots[1])
    rows = differing_rows(*[read_events(spark, r) for r in roots])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert [(r.user_pseudo_id, r.columns) for r in rows.collect()] == [("u6", "ga_session_id")]
    scans = [p for p in plan.split("FileScan parquet")[1:] if "PartitionFilters" in p and "ga_session_id" in p.split("\n")[0]]
    assert len(scans) == 2 and all("event_date" in p.split("PartitionFilters: [")[1].split("]")[0] for p in scans)
