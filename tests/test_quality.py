from __future__ import annotations

import pytest

from playlens.plans import quality
from playlens.plans.parity import parity_diff, parity_report
from playlens.plans.split import split_events
from tests.conftest import entry


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [("a", "x"), ("a", None), ("b", "y"), (None, "x"), (None, "z")], "k string, v string"
    )


def statuses(df):
    return {(r["check"], r.column_name): (r.failures, r.status) for r in df.collect()}


def test_seeded_violations_are_found(spark, rows):
    parent = spark.createDataFrame([("b",)], "k string")
    report = (
        quality.unique(rows, "k")
        .unionByName(quality.not_null(rows, {"k": "error", "v": "warn"}))
        .unionByName(quality.relationship(rows, parent, "k"))
        .unionByName(quality.accepted_values(rows, "v", ["x", "y"]))
    )
    assert statuses(report) == {
        ("unique", "k"): (1, "error"),
        ("not_null", "k"): (2, "error"),
        ("not_null", "v"): (1, "warn"),
        ("relationship", "k"): (2, "error"),
        ("accepted_values", "v"): (1, "error"),
    }


def test_clean_tables_pass(spark):
    clean = spark.createDataFrame([("a",), ("b",)], "k string")
    report = quality.report_checks(clean, "k").unionByName(quality.relationship(clean, clean, "k"))
    assert all(status == (0, "pass") for status in statuses(report).values())


def test_empty_table_passes(spark):
    empty = spark.createDataFrame([], "k string")
    assert set(statuses(quality.report_checks(empty, "k")).values()) == {(0, "pass")}


def test_parity_differs_only_by_values_outside_the_double_slot(raw):
    common = {"event_date": "20240101", "event_timestamp": 1, "user_pseudo_id": "a"}
    context = {
        "app_info": {"version": "1", "id": None, "install_store": None, "install_source": None},
        "geo": {"country": "X", "region": None, "city": None, "continent": None},
    }
    log = raw(
        {**common, **context, "event_name": "first_open"},
        {**common, **context, "event_name": "session_start"},
        {**common, "event_name": "ad_impression", "event_params": [entry("value", real=1.5)]},
        {**common, "event_name": "ad_impression", "event_params": [entry("value", number=2)]},
    )
    report = parity_report(log, split_events(log))
    got = {r.src: (r.new_users, r.dau, r.total_imps, r.total_rev) for r in report.collect()}
    assert got == {"RAW": (1, 1, 2, 1.5), "L2": (1, 1, 2, 3.5)}
    diff = parity_diff(report).first()
    assert (diff.total_imps_diff, diff.total_rev_diff) == (0, 2.0)
