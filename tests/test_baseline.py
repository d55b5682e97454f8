"""Population statistics against plain Python, on random and degenerate data."""

import datetime as dt
import math
import statistics

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyline.functions.percentiles import exact_percentiles
from tallyline.operators.baseline import cluster_day_cost, hourly_spend, rolling_baseline, workspace_baseline

DAYS = "workspace_id bigint, usage_date date, cluster_id string, daily_dollars double"
PROBS = {"p0": 0.0, "p50": 0.5, "p90": 0.9, "p99": 0.99, "p100": 1.0}


def percentiles(make, groups, **options):
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    out = exact_percentiles(make(rows, "g bigint, v double"), ["g"], "v", PROBS, **options)
    return {r.g: [r[p] for p in PROBS] for r in out.collect()}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.dictionaries(
        st.integers(0, 3),
        st.lists(st.one_of(st.floats(-1e6, 1e6, allow_subnormal=False), st.sampled_from([0.0, 24.0, 24.0, -3.5])), min_size=1, max_size=60),
        min_size=1,
        max_size=3,
    )
)
def test_percentiles_equal_numpy(make, groups):
    got = percentiles(make, groups)
    for g, values in groups.items():
        want = np.percentile(values, [p * 100 for p in PROBS.values()])
        assert got[g] == pytest.approx(list(want), rel=1e-9, abs=1e-9)


def test_percentiles_of_one_hot_value_and_coarse_buckets(make):
    values = [24.0] * 5000 + [1.0] * 10 + [24.01] * 3000 + list(np.linspace(20, 30, 777))
    want = np.percentile(values, [p * 100 for p in PROBS.values()])
    for resolution in (1, 64, 4096):
        assert percentiles(make, {7: values}, per_e_fold=resolution)[7] == pytest.approx(list(want))


def test_percentiles_ignore_null(make):
    df = make([(1, None), (1, 2.0), (2, None)], "g bigint, v double")
    assert [(r.g, r.p50) for r in exact_percentiles(df, ["g"], "v", {"p50": 0.5}).collect()] == [(1, 2.0)]


def test_workspace_baseline_leaves_out_zero_days(make):
    values = [5.0, 1.0, 0.0, 100.0, 7.5]
    days = make([(1, "2024-01-02", str(i), v) for i, v in enumerate(values)], DAYS)
    row = workspace_baseline(days, "2024-01-31", 30).first()
    used = [v for v in values if v > 0]
    assert row.n_cluster_days == 4 and row.lookback_days == 30
    assert row.mean_daily_dollars == pytest.approx(statistics.fmean(used))
    assert row.stddev_daily_dollars == pytest.approx(statistics.pstdev(used))
    assert row.stddev_log_daily_dollars == pytest.approx(statistics.pstdev(map(math.log, used)))
    assert row.p90_daily_dollars == pytest.approx(np.percentile(used, 90))
    assert row.max_daily_dollars == 100.0


def brute(rows, lookback, weekday_dates):
    weekday = lambda d: d.weekday() < 5
    out = {}
    for ws in {r[0] for r in rows}:
        mine = [(r[1], r[3]) for r in rows if r[0] == ws]
        for day in {d for d, _ in mine if weekday(d) or not weekday_dates}:
            used = [v for d, v in mine if weekday(d) and v > 0 and dt.timedelta(1) <= day - d <= dt.timedelta(lookback)]
            if used:
                logs = [math.log(v) for v in used]
                out[(ws, day)] = (statistics.fmean(used), statistics.pstdev(used), statistics.fmean(logs), statistics.pstdev(logs), len(used))
    return out


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.integers(1, 2), st.integers(0, 20), st.sampled_from("abc"), st.sampled_from([0.0, 0.01, 3.0, 3.0, 250.5, 1e6])),
        min_size=1,
        max_size=40,
        unique_by=lambda t: t[:3],
    ),
    st.integers(1, 9),
    st.sampled_from(["weekday", "all"]),
)
def test_rolling_equals_self_join(spark, rows, lookback, dates):
    rows = [(w, dt.date(2024, 1, 1) + dt.timedelta(d), c, v) for w, d, c, v in rows]
    got = {}
    for r in rolling_baseline(spark.createDataFrame(rows, DAYS), lookback, dates).collect():
        got[(r.workspace_id, r.as_of_date)] = (r.baseline_mean, r.baseline_stddev, r.baseline_mean_log, r.baseline_stddev_log, r.baseline_n)
    want = brute(rows, lookback, dates == "weekday")
    assert set(got) == set(want)
    for key in want:
        assert got[key] == pytest.approx(want[key], rel=1e-9, abs=1e-9)


def test_equal_days_have_exactly_zero_spread(make):
    days = make([(1, f"2024-01-{d:02d}", c, 0.1) for d in (1, 2, 3, 4) for c in "xyz"], DAYS)
    for r in rolling_baseline(days, 7).collect():
        assert r.baseline_stddev == 0.0 and r.baseline_stddev_log == 0.0


def test_weekend_as_of_dates_are_an_option(make):
    days = make([(1, "2024-01-05", "a", 2.0), (1, "2024-01-06", "a", 9.0), (1, "2024-01-08", "a", 4.0)], DAYS)  # Fri, Sat, Mon
    weekday = {r.as_of_date.day: r.baseline_n for r in rolling_baseline(days, 7).collect()}
    every = {r.as_of_date.day: (r.baseline_n, r.baseline_mean) for r in rolling_baseline(days, 7, "all").collect()}
    assert weekday == {8: 1}
    assert every == {6: (1, 2.0), 8: (1, 2.0)}
    with pytest.raises(ValueError):
        rolling_baseline(days, 7, "sometimes")


def test_reference_edge_before_the_window(make):
    """A day exactly ``lookback`` days before counts, one more does not, the day itself never."""
    days = make([(1, "2024-01-01", "a", 1.0), (1, "2024-01-02", "a", 2.0), (1, "2024-01-09", "a", 9.0)], DAYS)
    row = {r.as_of_date.day: r for r in rolling_baseline(days, 7).collect()}[9]
    assert (row.baseline_n, row.baseline_mean) == (1, 2.0)


def test_hourly_and_daily_sums(make):
    rows = [(1, "2024-01-05", "2024-01-05 01:10:00", "a", 1.0, 2.0), (1, "2024-01-05", "2024-01-05 01:50:00", "a", 1.0, 3.0),
            (1, "2024-01-06", "2024-01-06 00:00:00", "a", 1.0, 5.0)]
    priced = make(rows, "workspace_id bigint, usage_date date, usage_start_time timestamp, cluster_id string, dbus double, dollars double")
    assert sorted((r.hour_of_day, r.dbus, r.dollars) for r in hourly_spend(priced).collect()) == [(0, 1.0, 5.0), (1, 2.0, 5.0)]
    assert [r.daily_dollars for r in cluster_day_cost(priced).collect()] == [5.0]
    assert cluster_day_cost(priced, weekdays_only=False).agg(F.sum("daily_dollars")).first()[0] == 10.0
