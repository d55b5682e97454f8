"""Outcomes, lead hours, and the sweep against single runs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators import replay as R
from tallyline.operators.baseline import cluster_day_cost, rolling_baseline
from tallyline.params import Thresholds

HOURS = "workspace_id bigint, usage_date date, hour_ts timestamp, hour_of_day int, cluster_id string, dbus double, dollars double"


def hours(make, days):
    """{(cluster, day): {hour: dollars}}"""
    return make(
        [(1, d, f"{d} {h:02d}:00:00", h, c, 1.0, float(x)) for (c, d), spend in days.items() for h, x in spend.items()], HOURS
    )


def no_baseline(make):
    return make([], "workspace_id bigint, as_of_date date, baseline_mean double, baseline_stddev double, baseline_mean_log double, baseline_stddev_log double, baseline_n bigint")


def test_all_five_outcomes(make):
    """Three of them cannot come out of a replay, so the classifier is tested by itself."""
    rows = make([(1, None, 5), (2, 3, None), (3, 3, 5), (4, 5, 5), (5, 7, 5), (6, None, None)], "i int, alert int, crossed int")
    out = rows.select("i", R.outcome(F.col("alert"), F.col("crossed")).alias("o"))
    assert [r.o for r in out.orderBy("i").collect()] == ["MISS", "CAUGHT_EARLY", "CAUGHT_EARLY", "CAUGHT_AT_CROSSING", "CAUGHT_LATE", "MISS"]


def test_budget_only_replay(make):
    days = {("early", "2024-01-03"): {2: 10, 5: 60, 9: 60}, ("at", "2024-01-03"): {4: 1, 6: 200}, ("fine", "2024-01-03"): {1: 1},
            ("edge", "2024-01-03"): {1: 50, 2: 50}}
    out = {r.cluster_id: r for r in R.backtest(hours(make, days), no_baseline(make), Thresholds(budget=100.0)).collect()}
    assert set(out) == {"early", "at"}  # exactly the budget is not over it
    early, at = out["early"], out["at"]
    # 10 dollars in the first active hour project to 240 a day.
    assert (early.first_alert_hour, early.budget_crossed_hour, early.last_active_hour, early.lead_hours) == (2, 9, 9, 7)
    assert (early.outcome, early.actual_daily_dollars, early.z_score) == ("CAUGHT_EARLY", 130.0, None)
    assert (at.first_alert_hour, at.budget_crossed_hour, at.outcome, at.lead_hours) == (6, 6, "CAUGHT_AT_CROSSING", 0)


def test_active_hours_not_elapsed_hours(make):
    run = {r.hour_of_day: r for r in R.running_spend(hours(make, {("a", "2024-01-03"): {3: 1, 20: 2, 21: 4}})).collect()}
    assert [(run[h].hours_observed, run[h].cumulative_dollars, run[h].cumulative_dbus) for h in (3, 20, 21)] == [(1, 1, 1), (2, 3, 2), (3, 7, 3)]


@pytest.mark.parametrize("n, spent", [(3, 12.5), (6, 25.0), (12, 50.0), (21, 87.5)])
def test_a_pace_a_hair_over_the_budget_fires(make, n, spent):
    """As the SQL has it: dollars times 24 by hours; a pace of exactly the budget does not fire."""
    spend = {c: {h: x if h == n - 1 else 0.0 for h in range(n)} for c, x in (("at", spent), ("over", math.nextafter(spent, math.inf)))}
    run = R.running_spend(hours(make, {(c, "2024-01-03"): by_hour for c, by_hour in spend.items()}))
    out = {r.cluster_id: r.first_alert_hour for r in R.first_fire(R.simulate(run, no_baseline(make)), Thresholds(budget=100.0)).collect()}
    assert out == {"at": None, "over": n - 1}


@pytest.fixture(scope="module")
def month(make):
    rng = random.Random(5)
    days = {
        (c, f"2024-01-{d:02d}"): {h: rng.choice([0.0, 1.0, 4.0, 40.0]) for h in rng.sample(range(24), rng.randint(1, 6))}
        for c in "abcdef" for d in range(1, 29)
    }
    return hours(make, days).cache()


def test_backtest_is_bad_days_joined_to_first_fires(month):
    limits = Thresholds(50.0, 0.5, 1.5)
    base = rolling_baseline(cluster_day_cost(month), 7)
    keys = list(R.CLUSTER_DAY)
    long_way = R.bad_cluster_days(month, 50.0).join(R.first_fire(R.simulate(R.running_spend(month), base), limits), keys, "left")
    columns = [*keys, "actual_daily_dollars", "z_score", "first_alert_hour", "first_critical_hour", "budget_crossed_hour", "last_active_hour"]
    want = sorted(map(str, long_way.select(*columns).collect()))
    got = sorted(map(str, R.backtest(month, base, limits).select(*columns).collect()))
    assert got == want and len(got) > 20


def test_sweep_equals_single_runs(month):
    base = rolling_baseline(cluster_day_cost(month), 7)
    grid = [Thresholds(30.0, 1.0, 2.0), Thresholds(80.0, 0.2, 0.4), Thresholds(80.0, 2.0, 3.0)]
    columns = [*R.CLUSTER_DAY, "first_alert_hour", "first_critical_hour", "budget_crossed_hour", "outcome", "lead_hours"]
    swept = R.backtest_sweep(month, base, grid)
    for limits in grid:
        mine = swept.filter((F.col("budget") == limits.budget) & (F.col("z_warning") == limits.z_warning))
        alone = R.backtest(month, base, limits)
        assert sorted(map(str, mine.select(*columns).collect())) == sorted(map(str, alone.select(*columns).collect()))


def test_weekend_days_only_have_the_budget_rule(month):
    base = rolling_baseline(cluster_day_cost(month), 7)
    bad = R.backtest(month, base, Thresholds(50.0))
    assert bad.filter("weekday(usage_date) >= 5 and z_score is not null").count() == 0
    assert bad.filter("weekday(usage_date) < 5 and z_score is not null").count() > 0


def test_summary_and_metadata(month, make):
    results = R.backtest(month, no_baseline(make), Thresholds(30.0))
    summary = {r.outcome: r for r in R.backtest_summary(results).collect()}
    assert sum(r.cluster_days for r in summary.values()) == results.count()
    assert summary["CAUGHT_AT_CROSSING"].max_lead_hours == 0
    scd = make([(1, "a", "old", "o1", "2024-01-01"), (1, "a", "new", "o2", "2024-02-01"), (2, "b", "other", "o", "2024-02-01")],
               "workspace_id bigint, cluster_id string, cluster_name string, creator string, change_time timestamp")
    named = R.backtest(month, no_baseline(make), Thresholds(50.0), scd)
    assert {(r.cluster_id, r.cluster_name) for r in named.filter("cluster_id in ('a','b')").collect()} == {("a", "new"), ("b", None)}
