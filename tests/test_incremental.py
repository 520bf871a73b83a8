"""Reports kept a day at a time equal full rebuilds."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from playlens.plans.incremental import CohortReport
from playlens.plans.ltv import cohort_ltv
from playlens.plans.retention import retention_curve
from tests.conftest import DAY0

AS_OF = DAY0 + dt.timedelta(days=40)


def day(n):
    return DAY0 + dt.timedelta(days=n)


def day_rows(rng, n, users):
    rows = []
    for user in users:
        if rng.random() < 0.25:
            geo = rng.choice(["Vietnam", "China", None, "Brazil"])
            rows.append(("first_open", user, n, {"app_version": rng.choice(["1", "2", None]), "geo_country": geo}))
        if rng.random() < 0.4:
            rows += [("session_start", user, n, {})] * 2
        if rng.random() < 0.4:
            rows += [("ad_impression", user, n, {"value": rng.choice([None, 0.25, 1.5])})] * rng.randint(1, 2)
    return rows


def plain(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("kind", ["ltv", "retention"])
def test_a_replaced_day_gives_the_report_of_a_full_rebuild(spark, typed, tmp_path, kind):
    rng = random.Random(kind)
    users = [f"u{i}" for i in range(25)] + [None]
    log = {n: day_rows(rng, n, users) for n in range(16)}
    full = cohort_ltv if kind == "ltv" else retention_curve
    report = CohortReport(spark, str(tmp_path), kind)
    report.replace_days(typed(*sum(log.values(), [])), day(0), day(15))
    for n in (9, 0, 15):
        log[n] = day_rows(rng, n, users) if n else []
        events = typed(*sum(log.values(), []))
        report.replace_days(events, day(n), day(n))
        assert plain(report.read(AS_OF)) == plain(full(events, as_of=AS_OF))
    assert report.replace_days(events, day(15), day(15)) == [d for d in map(day, range(8, 16)) if d in CohortReport._dates(report.firsts)]


def test_only_touched_cohorts_and_their_days_are_read(spark, typed, tmp_path):
    rows = [("first_open", f"u{n}", n, {}) for n in range(30)] + [("ad_impression", f"u{n}", n, {"value": 1.0}) for n in range(30)]
    report = CohortReport(spark, str(tmp_path), "ltv")
    report.replace_days(typed(*rows), day(0), day(29))
    seen = []
    cohorts = report.cohorts

    def spy(dates):
        seen.append(cohorts(dates))
        return seen[-1]

    report.cohorts = spy
    more = typed(*rows, ("ad_impression", "u10", 12, {"value": 5.0}))
    assert report.replace_days(more, day(12), day(12)) == [day(n) for n in range(5, 13)]
    read = {f.split("_date=")[1][:10] for f in seen[0].inputFiles()}
    assert read == {day(n).isoformat() for n in range(5, 20)}
    row = report.read(AS_OF).where(f"cohort_date = '{day(10)}'").first()
    assert (row.ltv_d1, row.ltv_d3) == (1.0, 6.0)


@pytest.mark.parametrize("step", ["firsts", "daily", "report", "opens"])
def test_a_run_that_died_is_repeated(spark, typed, tmp_path, step):
    """Users who move between cohorts, and one whose only opening goes."""
    rows = [("first_open", "b", 1, {}), ("session_start", "a", 2, {}), ("first_open", "gone", 0, {})]
    first, after = typed(("first_open", "a", 0, {}), *rows), typed(("first_open", "b", 0, {}), *rows[:2])
    report = CohortReport(spark, str(tmp_path), "retention")
    report.replace_days(first, day(0), day(2))
    table = getattr(report, step)
    commit = table.commit
    table.commit = lambda *_, **__: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError):
        report.replace_days(after, day(0), day(0))
    table.commit = commit
    report.replace_days(after, day(0), day(0))
    assert plain(report.read(AS_OF)) == plain(retention_curve(after, as_of=AS_OF))
