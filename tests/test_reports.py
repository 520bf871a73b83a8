"""Report rules that the sample data alone would not pin down."""

from __future__ import annotations

import datetime as dt

import pytest

from playlens.operators.filters import drop_listed, keep_listed
from playlens.plans.daily_ads import daily_ads
from playlens.plans.delivery import ordered
from playlens.plans.funnel import funnel_monetization
from playlens.plans.ltv import cohort_ltv
from playlens.plans.minigames import minigame_sessions_report, play_results
from playlens.plans.retention import retention_curve
from tests.conftest import DAY0, micros

AS_OF = DAY0 + dt.timedelta(days=7)


def test_retention_null_without_any_return_else_zero(typed):
    events = typed(
        ("first_open", "a", 0, {}),
        ("first_open", "b", 1, {}),
        ("session_start", "a", 2, {}),
        ("session_start", "b", 1, {}),
    )
    rows = {r.cohort_date: r for r in retention_curve(events, as_of=AS_OF).collect()}
    came_back, did_not = rows[DAY0], rows[DAY0 + dt.timedelta(days=1)]
    assert (came_back.d1_retention, came_back.d2_retention) == (0.0, 100.0)
    assert did_not.d1_retention is None and did_not.new_users == 1
    assert came_back.is_d7_mature and not did_not.is_d7_mature


def test_rolling_retention_never_rises(typed):
    events = typed(
        ("first_open", "a", 0, {}),
        ("first_open", "b", 0, {}),
        ("session_start", "a", 5, {}),
        ("session_start", "b", 2, {}),
    )
    row = retention_curve(events, as_of=AS_OF, mode="rolling").first()
    assert [row[f"d{n}_retention"] for n in range(1, 8)] == [100, 100, 50, 50, 50, 0, 0]


def test_lists(typed):
    events = typed(
        ("first_open", "a", 0, {"geo_country": None}),
        ("first_open", "b", 0, {"geo_country": "China"}),
        ("first_open", "c", 0, {}),
    )

    def users(df):
        return {r.user_pseudo_id for r in df.collect()}

    assert users(drop_listed(events, "geo_country", ["China"])) == {"c"}
    assert users(drop_listed(events, "geo_country", [])) == {"a", "b", "c"}
    assert users(keep_listed(events, "app_version", [])) == {"a", "b", "c"}
    assert users(keep_listed(events, "app_version", ["2"])) == set()


def test_revenue_fanout_of_users_in_two_versions(typed):
    events = typed(
        ("first_open", "a", 0, {"app_version": "1"}),
        ("first_open", "a", 0, {"app_version": "2"}),
        ("ad_impression", "a", 0, {"value": 3.0}),
    )
    compat = {r.version: r.ltv_d0 for r in cohort_ltv(events, as_of=AS_OF).collect()}
    fixed = {r.version: r.ltv_d0 for r in cohort_ltv(events, as_of=AS_OF, fanout="fix").collect()}
    assert compat == {"1": 6.0, "2": 6.0}
    assert fixed == {"1": 3.0, "2": 3.0}


def test_ltv_grows_with_the_horizon_and_ignores_other_days(typed):
    events = typed(
        ("first_open", "a", 1, {}),
        *[("ad_impression", "a", d, {"value": 1.0}) for d in (0, 1, 2, 4, 8, 9)],
    )
    row = cohort_ltv(events, as_of=AS_OF).first()
    assert (row.ltv_d0, row.ltv_d1, row.ltv_d3, row.ltv_d7) == (1.0, 2.0, 3.0, 4.0)


def test_ltv_of_impressions_without_value_is_null(typed):
    events = typed(("first_open", "a", 0, {}), ("ad_impression", "a", 0, {"value": None}))
    assert cohort_ltv(events, as_of=AS_OF).first().ltv_d0 is None
    events = typed(("first_open", "a", 0, {}), ("ad_impression", "a", 9, {"value": 1.0}))
    assert cohort_ltv(events, as_of=AS_OF).first().ltv_d0 == 0.0


@pytest.mark.parametrize("impressions", [0, 2])
def test_funnel_without_impressions_has_no_ecpm(typed, impressions):
    events = typed(
        ("first_open", "a", 0, {}),
        ("session_start", "a", 0, {}),
        ("session_start", "a", 3, {}),
        *[("ad_impression", "a", 3, {"value": 0.5, "ad_format": "BANNER"})] * impressions,
    )
    row = funnel_monetization(events).first()
    assert (row.num_days, row.avg_dau, row.avg_new_users) == (2, 1.0, 0.5)
    if impressions:
        assert (row.banner_ecpm, row.inter_ecpm, row.total_imp_per_dau) == (500.0, None, 1.0)
        assert (row.ltv_d0, row.ltv_d3, row.ad_viewer_rate) == (0.0, 1.0, 50.0)
    else:
        assert (row.ecpm, row.arpdau, row.ltv_d7) == (None, 0.0, 0.0)


def test_funnel_counts_silent_members_in_the_cohort_value(typed):
    events = typed(
        ("first_open", "a", 0, {}),
        ("session_start", "a", 0, {}),
        ("ad_impression", "a", 0, {"value": 4.0, "ad_format": "BANNER"}),
        ("first_open", "quiet", 0, {}),
        ("first_open", "other day", 2, {}),
    )
    # (4 / 2 users + 0 / 1 user) / 2 cohorts
    assert funnel_monetization(events).first().ltv_d0 == 1.0


def test_day_one_rate_may_exceed_100_and_needs_the_day_before(typed):
    events = typed(
        ("first_open", "a", 0, {}),
        ("first_open", "b", 0, {}),
        ("session_start", "a", 0, {}),
        ("session_start", "a", 1, {}),
        ("session_start", "b", 1, {}),
        ("session_start", "a", 3, {}),
        ("ad_impression", "b", 2, {"value": 1.0, "ad_format": "BANNER"}),
    )
    rows = {r.date.day: r for r in daily_ads(events).collect()}
    assert set(rows) == {1, 2, 4}, "a day with ads only does not count"
    assert rows[2].cohort_rr_d1 == 200.0
    assert rows[1].cohort_rr_d1 is None and rows[4].cohort_rr_d1 is None


def minute(m):
    return {"event_timestamp": micros(0, m * 60)}


def test_session_report_rules(typed):
    game = {"minigame_id": "G"}
    on, off = {"current_screen": "G"}, {"current_screen": "Home"}
    events = typed(
        ("session_start", "a", 0, {**minute(0), **off}),
        ("level_start", "a", 0, {**minute(1), **game, **off}),
        ("ad_impression", "a", 0, {**minute(3), **on, "value": 2.0}),
        ("level_start", "a", 0, {**minute(10), **game, **off}),  # no member: no session
        ("session_start", "b", 0, {**minute(0), **off}),
        ("level_start", "b", 0, {**minute(5), "minigame_id": "Home", **off}),
        ("level_start", "c", 0, {**minute(5), **game, **on}),  # no version: left out
        ("session_start", "d", 0, {**minute(0), **off}),
        ("level_start", "d", 0, {**minute(0), **game, **on}),
        ("loading", "d", 0, {**minute(60), **on}),  # too long
        ("app_remove", "a", 0, {**minute(4), **on}),  # not part of the report
    )
    row = minigame_sessions_report(events).first()
    assert (row.start_user, row.start_rate_pct) == (2, 66.67)
    assert (row.unique_users, row.total_sessions) == (1, 1)
    assert row.avg_playtime_per_session_min == 2.0
    assert (row.total_ad_impressions, row.total_revenue_usd, row.ecpm) == (1, 2.0, 2000.0)


def test_session_report_without_valid_session(typed):
    events = typed(
        ("session_start", "d", 0, {**minute(0)}),
        ("level_start", "d", 0, {**minute(0), "minigame_id": "G", "current_screen": "G"}),
        ("ad_impression", "d", 0, {**minute(60), "current_screen": "G", "value": 1.0}),
    )
    row = minigame_sessions_report(events).first()
    assert (row.start_user, row.unique_users, row.total_sessions) == (1, None, None)
    assert (row.total_ad_impressions, row.total_revenue_usd, row.ecpm) == (0, 0.0, None)


def test_play_results_without_ends_and_bad_durations(typed):
    events = typed(
        ("first_open", "a", 0, {}),
        ("level_start", "a", 0, {"minigame_id": "only started"}),
        ("level_start", "a", 0, {"minigame_id": "G"}),
        ("level_end", "a", 0, {"minigame_id": "G", "result_by": "win", "play_duration": "bad"}),
        ("level_end", "a", 0, {"minigame_id": "G", "result_by": None, "play_duration": "8"}),
        ("level_end", "a", 0, {"minigame_id": "never started", "result_by": "win"}),
    )
    rows = {r.minigame_id: r for r in play_results(events).collect()}
    assert set(rows) == {"only started", "G"}
    assert rows["only started"].users_end is None and rows["only started"].win_rate_pct is None
    g = rows["G"]
    assert (g.complete_rate_pct, g.win_rate_pct, g.lose_rate_pct) == (100.0, 100.0, 0.0)
    assert (g.avg_duration_per_user_s, g.avg_duration_win_s) == (8.0, None)


def test_delivery_order(typed):
    events = typed(
        *[("first_open", u, 0, {}) for u in "abc"],
        *[("level_start", u, 0, {"minigame_id": "often"}) for u in "abc"],
        ("level_start", "a", 0, {"minigame_id": "rare"}),
        ("session_start", "a", 0, {}),
        ("session_start", "b", 4, {}),
    )
    played = ordered(play_results(events), "play_results").collect()
    assert [r.minigame_id for r in played] == ["often", "rare"]
    assert [r.date.day for r in ordered(daily_ads(events), "daily_ads").collect()] == [5, 1]


def two_cohorts(typed, *more):
    """A cohort whose only impression has no value, and one with a value on its first day."""
    return typed(
        ("first_open", "a", 0, {}),
        ("session_start", "a", 0, {}),
        ("ad_impression", "a", 1, {"ad_format": "BANNER"}),
        ("first_open", "b", 1, {}),
        ("session_start", "b", 1, {}),
        ("ad_impression", "b", 1, {"ad_format": "BANNER", "value": 2.0}),
        *more,
    )


def test_funnel_value_leaves_out_cohorts_without_any_value(typed):
    row = funnel_monetization(two_cohorts(typed)).first()
    # The valueless day lies past the first horizon, where it counts 0.
    assert (row.ltv_d0, row.ltv_d3, row.ltv_d7) == (1.0, 2.0, 2.0)


@pytest.mark.parametrize("fanout", ["compat", "fix"])
def test_funnel_value_is_the_mean_of_cohort_values(typed, fanout):
    more = [("first_open", "c", 1, {}), ("first_open", "c", 2, {"app_version": "2"})]
    more += [("ad_impression", "c", d, {"value": 0.25 * d}) for d in (2, 4, 9)]
    more += [("first_open", "d", 3, {}), ("ad_impression", "d", 20, {"value": 9.0})]
    more += [("session_start", u, 3, {"app_version": v}) for u, v in (("c", "1"), ("c", "2"), ("d", "1"))]
    events = two_cohorts(typed, *more)
    cohorts = cohort_ltv(events, as_of=AS_OF, horizons=(0, 3, 7), fanout=fanout).collect()
    for row in funnel_monetization(events, fanout=fanout).collect():
        for h in (0, 3, 7):
            own = [r[f"ltv_d{h}"] for r in cohorts if r.version == row.version and r[f"ltv_d{h}"] is not None]
            assert row[f"ltv_d{h}"] == pytest.approx(sum(own) / len(own), abs=2e-6)


def test_all_active_users_count_without_a_first_open(typed):
    events = typed(("first_open", "a", 0, {}), ("session_start", "a", 0, {}), ("session_start", "old", 0, {}))
    count = lambda **more: daily_ads(events, **more).first().active_user
    assert count() == 1 and count(cohort_only=False) == 2
    assert count(cohort_only=False, versions=("1",)) == 1
    by_version = daily_ads(events, cohort_only=False, by_version=True).collect()
    assert {r.version: r.active_user for r in by_version} == {"1": 1, None: 1}


def test_rolling_rates_do_not_depend_on_other_days(typed):
    events = typed(("first_open", "a", 0, {}), ("session_start", "a", 9, {}))
    rate = lambda days, **more: retention_curve(
        events, as_of=AS_OF, days=days, mode="rolling", **more
    ).first().d1_retention
    assert rate((1, 7)) == rate((1, 14)) == 100.0
    assert rate((1, 7), until=7) is None


def test_results_of_play_are_an_argument(typed):
    ends = [("level_end", "a", 0, {"minigame_id": "m", "result_by": r}) for r in ("win", "draw", "draw", "lose")]
    events = typed(("first_open", "a", 0, {}), ("level_start", "a", 0, {"minigame_id": "m"}), *ends)
    row = play_results(events, results=("draw",)).first()
    assert row.draw_rate_pct == 50.0 and "win_rate_pct" not in row
