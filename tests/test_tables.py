"""Writers: repeatable loads, whole-day replacement, late rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from playlens.config import FLATTEN_A, FLATTEN_B, Game
from playlens.operators.keys import dedup_first, enrich, new_rows_only
from playlens.plans.flatten import base_columns, event_base, flatten, flatten_new
from playlens.plans.split import event_table, read_events, split_events
from playlens.sinks import tables
from playlens.sources import shards
from tests.conftest import DAY0, entry, micros

NEXT = DAY0 + dt.timedelta(days=1)


def event(name, user, day=0, seconds=0.0, shard_day=None, **more):
    shard = DAY0 + dt.timedelta(days=day if shard_day is None else shard_day)
    return {
        "shard": shard.strftime("%Y%m%d"),
        "event_date": (DAY0 + dt.timedelta(days=day)).strftime("%Y%m%d"),
        "event_timestamp": micros(day, seconds),
        "event_name": name,
        "user_pseudo_id": user,
        **more,
    }


def counts(df, *by):
    return {tuple(r)[:-1]: r[-1] for r in df.groupBy(*by).count().collect()}


def test_replacing_a_day_clears_it_and_leaves_others(spark, raw, tmp_path):
    root = str(tmp_path / "events")
    log = raw(
        event("first_open", "a"), event("loading", "a"), event("unknown", "a"),
        event("loading", "b", day=1),
    )
    tables.backfill(log, root, DAY0, NEXT)
    full = {(DAY0, "first_open"): 1, (DAY0, "loading"): 1, (NEXT, "loading"): 1}
    assert counts(read_events(spark, root), "event_date", "event_name") == full
    tables.build_day(log, root, DAY0)
    assert counts(read_events(spark, root), "event_date", "event_name") == full
    tables.build_day(raw(event("loading", "c")), root, DAY0)
    assert counts(read_events(spark, root), "event_date", "event_name") == {
        (DAY0, "loading"): 1, (NEXT, "loading"): 1,
    }
    tables.build_day(raw(event("unknown", "c")), root, DAY0)
    assert counts(read_events(spark, root), "event_date") == {(NEXT,): 1}


def test_event_table_shows_only_its_own_columns(spark, raw):
    log = raw(
        event(
            "level_start", "a",
            event_params=[entry("minigame_id", text="G"), entry("value", real=1.0)],
            geo={"country": "X", "region": None, "city": None, "continent": None},
        )
    )
    events = split_events(log)
    row = events.first()
    assert (row.minigame_id, row.value, row.geo_country) == ("G", None, None)
    names = event_table(events, "level_start").columns
    assert names[-2:] == ["minigame_id", "attempt"] and "app_version" not in names
    assert len(event_table(events, "first_open").columns) == 8 + 20


def test_new_game_is_a_config_value(raw):
    game = Game(events={"tap": ("power",)}, context_events=("tap",), numeric_params=("power",))
    events = split_events(raw(event("tap", "a", event_params=[entry("power", text="2.5")])), game)
    assert events.first().power == 2.5


def test_partition_filters_reach_the_scan(spark, raw, tmp_path):
    log = raw(event("loading", "a"), event("loading", "b", day=1))
    log.write.partitionBy("shard").parquet(str(tmp_path / "raw"))
    plan = shards.one_day(shards.read_raw(spark, str(tmp_path / "raw")), DAY0)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in text and "20240101" in text
    assert plan.count() == 1


def test_load_windows(raw):
    log = raw(*[event("loading", "a", day=d) for d in range(5)])

    def days(spec, first):
        rows = shards.load_window(log, spec, DAY0 + dt.timedelta(days=3), first).collect()
        return sorted(int(r.shard[-2:]) - 1 for r in rows)

    assert days(FLATTEN_A, True) == days(FLATTEN_A, False) == [2]
    assert days(FLATTEN_B, True) == [1, 2]
    assert days(FLATTEN_B, False) == [1, 2, 3, 4]


def test_daily_runs_add_each_event_once(spark, raw, tmp_path):
    root, base_root = str(tmp_path / "flat"), str(tmp_path / "base")
    log = [event("loading", "a", day=d) for d in range(4)]
    late = event("loading", "late", day=1, shard_day=2)
    run = DAY0 + dt.timedelta(days=3)
    twice = raw(*log, *log)
    for _ in range(2):
        tables.load_flatten(spark, twice, root, FLATTEN_B, run)
    assert counts(spark.read.parquet(root), "user_pseudo_id") == {("a",): 3}
    tables.load_flatten(spark, raw(*log, late), root, FLATTEN_B, run)
    tables.load_flatten(spark, raw(*log, late), root, FLATTEN_B, run + dt.timedelta(days=1))
    flat = spark.read.parquet(root)
    assert counts(flat, "user_pseudo_id") == {("a",): 3, ("late",): 1}
    for _ in range(2):
        tables.load_base(spark, flat, base_root, FLATTEN_B, run)
    base = spark.read.parquet(base_root)
    assert base.count() == 4 and set(base.columns) == set(base_columns(flat))
    assert len(base.columns) == 22


def test_first_version_of_a_row_wins(spark, raw, tmp_path):
    root = str(tmp_path / "flat")
    for platform in ("first", "second"):
        flat = flatten_new(raw(event("loading", "a", platform=platform)), FLATTEN_B)
        tables.append_new(spark, flat, root)
    assert [r.platform for r in spark.read.parquet(root).collect()] == ["first"]


def test_known_null_key_does_not_stop_the_feed(spark):
    incoming = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    known = spark.createDataFrame([("a",), (None,)], "k string")
    assert [r.k for r in new_rows_only(incoming, known, "k").collect()] == ["b"]


def test_known_keys_do_not_pass_through_the_driver(spark, tmp_path):
    # However small their files look, the keys are met where they lie.
    spark.range(20).selectExpr("string(id) AS k", "id AS other").write.parquet(f"{tmp_path}/known")
    incoming = spark.range(30).selectExpr("string(id) AS k")
    new = new_rows_only(incoming, spark.read.parquet(f"{tmp_path}/known"), "k")
    assert new.count() == 10
    assert "Broadcast" not in new._jdf.queryExecution().executedPlan().toString()


def test_dedup_is_reproducible_for_tied_rows(raw):
    same = [event("loading", "a", platform=p) for p in ("x", "y", "z")]
    picks = {
        flatten_new(raw(*order), FLATTEN_A).first().platform
        for order in (same, same[::-1], [same[1], same[0], same[2]])
    }
    assert len(picks) == 1


def test_first_run_keeps_one_row_without_key(raw):
    rows = [event("loading", "a"), event("loading", "b")]
    for r in rows:
        r["event_timestamp"] = None
    flat = flatten_new(raw(*rows), FLATTEN_B)
    assert [r.surrogate_key for r in flat.collect()] == [None]
    assert flatten_new(raw(*rows), FLATTEN_B, flat.limit(0)).count() == 0


def test_event_date_rules_differ_by_game(raw):
    late_evening = raw(event("loading", "a", seconds=20 * 3600))
    assert flatten(late_evening, FLATTEN_A).first().event_date == NEXT
    assert flatten(late_evening, FLATTEN_B).first().event_date == DAY0


def test_dates_do_not_depend_on_the_session_zone(spark, raw):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        row = flatten(raw(event("loading", "a", seconds=20 * 3600)), FLATTEN_A).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.event_date == NEXT


def test_flatten_column_counts(raw):
    assert len(FLATTEN_A.columns) == len(FLATTEN_B.columns) == 50
    flat = flatten(raw(event("loading", "a")), FLATTEN_A)
    assert flat.columns == list(FLATTEN_A.columns)
    assert len(base_columns(flat)) == 21


def test_base_takes_recent_days_only_on_later_runs(raw):
    flat = flatten(raw(*[event("loading", "a", day=d) for d in range(4)]), FLATTEN_B)
    run = DAY0 + dt.timedelta(days=3)
    assert event_base(flat, FLATTEN_B, run).count() == 4
    assert event_base(flat, FLATTEN_B, run, flat.limit(0)).count() == 3


def test_enrich_keeps_every_event_once(spark):
    events = spark.createDataFrame([("a", "1"), ("a", None), ("b", "9")], "u string, s string")
    context = spark.createDataFrame(
        [("a", "1", 5, "late"), ("a", "1", 2, "early"), ("a", None, 1, "none")],
        "u string, s string, ts int, geo string",
    )
    got = enrich(events, context, ["u", "s"], "ts", ["geo"]).collect()
    assert sorted((r.u, r.s or "", r.geo or "") for r in got) == [
        ("a", "", ""), ("a", "1", "early"), ("b", "9", ""),
    ]


def test_dedup_limits_copies_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("key"), "id")
    text = dedup_first(df, "key", [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    below = text[text.index("Exchange hashpartitioning(key"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_create_empty_keeps_an_existing_table(spark, raw, tmp_path):
    root = str(tmp_path / "t")
    flat = flatten_new(raw(event("loading", "a")), FLATTEN_B)
    tables.append_new(spark, flat, root)
    tables.create_empty(flat, root)
    assert tables.read_table(spark, root, flat.schema).count() == 1
    assert tables.read_table(spark, str(tmp_path / "none"), flat.schema).count() == 0


def test_namespace_is_created_once(spark):
    for _ in range(2):
        tables.create_namespace(spark, "playlens_test")
    try:
        assert spark.catalog.databaseExists("playlens_test")
    finally:
        spark.sql("DROP DATABASE playlens_test")


def test_report_rebuild_replaces_everything(spark, tmp_path):
    root = str(tmp_path / "report")
    for rows in ([(1,), (2,)], [(3,)]):
        tables.rebuild_report(spark.createDataFrame(rows, "a int"), root)
    assert [r.a for r in spark.read.parquet(root).collect()] == [3]


def test_a_stray_date_does_not_widen_the_read(spark, raw, tmp_path, monkeypatch):
    root = str(tmp_path / "flat")
    load = lambda *events: flatten_new(raw(*events), FLATTEN_B)
    tables.append_new(spark, load(*[event("loading", "a", day=d) for d in range(9)]), root)
    seen = []

    def spy(incoming, known, key):
        seen.append(known)
        return new_rows_only(incoming, known, key)

    monkeypatch.setattr(tables, "new_rows_only", spy)
    old = (dt.date(1970, 1, 1) - DAY0).days
    tables.append_new(spark, load(event("loading", "b", day=8), event("loading", "a", day=old)), root)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [", 1)[1].split("]")[0]
    assert seen[0].count() == 2  # days 7 and 8 of nine
    assert spark.read.parquet(root).count() == 11


def test_rows_of_another_day_are_not_lost_unseen(spark, raw, tmp_path):
    events = split_events(raw(event("loading", "a"), event("loading", "b", day=1)))
    with pytest.raises(tables.StrayRows, match="1 rows"):
        tables.replace_day(events, str(tmp_path / "events"), DAY0)


def test_only_a_missing_path_is_a_first_run(spark, raw, tmp_path):
    assert tables.is_first_run(spark, str(tmp_path / "none"))
    tables.create_empty(flatten_new(raw(event("loading", "a")), FLATTEN_B), str(tmp_path / "empty"))
    assert not tables.is_first_run(spark, str(tmp_path / "empty"))
    with pytest.raises(Exception, match="nosuch"):  # any other trouble is not taken for a first run
        tables.is_first_run(spark, "nosuch://host/table")


def test_each_game_has_its_own_store(spark):
    from playlens.sources.sample import event_store

    other = Game(events={"first_open": ("foo",)})
    sf = "/root/testdata/sf0.001"
    assert "foo" in event_store(spark, sf, other).columns
    assert "foo" not in event_store(spark, sf).columns


def test_text_of_whole_doubles(raw):
    """A whole number in the double slot reads as a double does."""
    from playlens.functions.bags import Bag

    rows = raw(event("loading", "a", event_params=[entry("x", real=3.0), entry("y", real=0.5)]))
    texts = Bag("event_params").with_texts(rows)
    found = texts.select(Bag("event_params").first_str("x"), Bag("event_params").first_str("y")).first()
    assert tuple(found) == ("3", "0.5") or tuple(found) == ("3.0", "0.5")
