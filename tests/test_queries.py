"""Every registered query against its SQL, and the shape of the report plans."""

from __future__ import annotations

import pytest

from checks.compare import canonical, connect
from checks.registry import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("key", list(QUERIES))
def test_equals_sql(spark, con, key):
    df = QUERIES[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    result = con.execute(SQL[key])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert canonical(df.columns, rows) == canonical(columns, result.fetchall())


# Reports about all kinds of events, which therefore read every partition.
EVERY_EVENT = {
    "v7_all_events": "the view over all events",
    "v8_variant_summary": "a user's arm may be reported with any event",
    "v9_journey_edges": "a journey passes all events",
    "v9_journey_screens": "a journey passes all events",
    "v9_journey_versions": "a journey passes all events",
    "v10_event_reach": "reach is computed for every event",
}
REPORTS = [k for k in QUERIES if k[0] in "rv" and k[1].isdigit()]


@pytest.mark.parametrize("key", REPORTS)
def test_report_plans_stay_distributed_and_in_the_jvm(spark, key):
    plan = QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "NestedLoopJoin", "SinglePartition", "Python", "MapInPandas"):
        assert bad not in plan, bad
    if "event_name" in plan and key not in EVERY_EVENT:
        assert "PartitionFilters: []" not in plan


def test_parity_reads_each_source_once_and_only_its_days(spark):
    plan = QUERIES["parity_raw_l2"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
    assert "PartitionFilters: [isnotnull(shard" in plan and "PartitionFilters: [isnotnull(event_date" in plan


def test_session_report_deals_events_out_once(spark):
    plan = QUERIES["r2_minigame"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") <= 8


def test_staging_checks_flatten_once(spark):
    plan = QUERIES["dq_staging"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


@pytest.mark.parametrize("key", ["r6_retention", "r5_daily_ads", "r8_play", "r4_ltv"])
def test_distinct_counts_need_no_row_expansion(spark, key):
    plan = QUERIES[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
