"""Threshold sets as lookups in staircases: one by one and a thousand at once."""

import random

from tallyline.operators import replay as R
from tallyline.params import Thresholds

HOURS = "workspace_id bigint, usage_date date, cluster_id string, hour_ts timestamp, hour_of_day int, dbus double, dollars double"
PAST = "workspace_id bigint, as_of_date date, baseline_mean double, baseline_stddev double, baseline_mean_log double, baseline_stddev_log double, n_cluster_days bigint"
COLUMNS = ("workspace_id", "usage_date", "cluster_id", "first_alert_hour", "first_critical_hour", "budget_crossed_hour", "outcome", "lead_hours")


def history(make):
    rng = random.Random(11)
    rows = [
        (w, f"2024-01-{d:02d}", c, f"2024-01-{d:02d} {h:02d}:00:00", h, 1.0, rng.choice([0.0, 1.0, 5.0, 40.0, -3.0]))
        for w in (1, 2) for d in range(8, 14) for c in "abc" for h in sorted(rng.sample(range(24), rng.randint(1, 20)))
    ]
    past = [(1, f"2024-01-{d:02d}", 50.0, 10.0, 3.5, 0.6, 9) for d in range(8, 13)] + [(2, f"2024-01-{d:02d}", 50.0, 0.0, 3.5, 0.0, 9) for d in range(8, 11)]
    return make(rows, HOURS), make(past, PAST)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_every_set_is_its_own_backtest(make):
    hours, past = history(make)
    grid = [Thresholds(20.0, 0.5, 1.0), Thresholds(60.0, 2.0, 1.0), Thresholds(100.0, 1.5, 2.5), Thresholds(0.0, -5.0, 0.0)]
    swept = R.backtest_sweep(hours, past, grid).collect()
    for g in grid:
        mine = sorted(tuple(r[c] for c in COLUMNS) for r in swept if (r.budget, r.z_warning, r.z_critical) == (g.budget, g.z_warning, g.z_critical))
        want = sorted(tuple(r[c] for c in COLUMNS) for r in R.backtest(hours, past, g).collect())
        assert mine and list(map(str, mine)) == list(map(str, want))


def test_a_thousand_sets_have_the_plan_of_one(make):
    hours, past = history(make)
    grid = [Thresholds(20.0 + i % 50, 0.1 * (i % 20), 0.2 * (i % 25)) for i in range(1000)]
    many, one = R.backtest_sweep(hours, past, grid), R.backtest_sweep(hours, past, grid[:1])
    assert len(plan(many).splitlines()) == len(plan(one).splitlines())
    assert len(plan(many)) < 1.5 * len(plan(one))
    budget = {g.budget: sum(x.budget == g.budget for x in grid) for g in grid}
    totals = {}
    for r in hours.groupBy("workspace_id", "usage_date", "cluster_id").sum("dollars").collect():
        totals[tuple(r)[:3]] = r[3]
    assert many.count() == sum(n for b, n in budget.items() for t in totals.values() if t > b)


def test_staircases_keep_records_only(make):
    hours, past = history(make)
    scored = R.simulate(R._bad_hours(hours, 10.0), past)
    for r in R.record_hours(scored).collect():
        for records, value in ((r.pace_records, "pace"), (r.spent_records, "spent")):
            values = [h[value] for h in records]
            assert values == sorted(set(values))
