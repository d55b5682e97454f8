"""Hour-by-hour replay: would the monitor have caught the days that broke the budget?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyline.functions.exprs import tier_signal
from tallyline.functions.scale import latest_per_key, local_frame
from tallyline.operators.scoring import log_z
from tallyline.params import Thresholds

CLUSTER_DAY = ("workspace_id", "usage_date", "cluster_id")


def running_spend(hourly: DataFrame) -> DataFrame:
    """Dollars, units and active hours so far, per cluster-day (at most 24 rows each)."""
    day = Window.partitionBy(*CLUSTER_DAY).orderBy("hour_of_day")
    so_far = day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hourly.select(
        *CLUSTER_DAY,
        "hour_of_day",
        "hour_ts",
        F.sum("dollars").over(so_far).alias("cumulative_dollars"),
        F.sum("dbus").over(so_far).alias("cumulative_dbus"),
        F.row_number().over(day).alias("hours_observed"),
    )


def bad_cluster_days(hourly: DataFrame, budget: float) -> DataFrame:
    """Ground truth: cluster-days strictly over budget."""
    return (
        hourly.groupBy(*CLUSTER_DAY)
        .agg(F.sum("dollars").alias("actual_daily_dollars"))
        .filter(F.col("actual_daily_dollars") > budget)
    )


def simulate(running: DataFrame, baseline: DataFrame) -> DataFrame:
    """Extrapolate every hour to a day and score it against the baseline known that morning."""
    past = baseline.withColumnRenamed("as_of_date", "usage_date")
    # multiplied before it is divided: dividing first can round a pace just over a budget down to it
    projected = F.col("cumulative_dollars") * 24.0 / F.col("hours_observed")
    return (
        running.join(past, ["workspace_id", "usage_date"], "left")
        .withColumn("projected_daily_dollars", projected)
        .withColumn(
            "z_score", log_z(F.col("projected_daily_dollars"), F.col("baseline_mean_log"), F.col("baseline_stddev_log"))
        )
    )


def _fires(limits: Thresholds) -> list[Column]:
    signal = tier_signal(F.col("projected_daily_dollars"), F.col("z_score"), limits)
    hour = F.col("hour_of_day")
    return [
        F.min(F.when(signal != "OK", hour)).alias("first_alert_hour"),
        F.min(F.when(signal == "CRITICAL", hour)).alias("first_critical_hour"),
        F.min(F.when(F.col("cumulative_dollars") > limits.budget, hour)).alias("budget_crossed_hour"),
    ]


def first_fire(simulated: DataFrame, limits: Thresholds) -> DataFrame:
    """The hours at which alerts first fire and the budget is crossed, per cluster-day."""
    return simulated.groupBy(*CLUSTER_DAY).agg(
        F.max("z_score").alias("z_score"), *_fires(limits), F.max("hour_of_day").alias("last_active_hour")
    )


def outcome(alert: Column, crossed: Column) -> Column:
    return (
        F.when(alert.isNull(), "MISS")
        .when(crossed.isNull() | (alert < crossed), "CAUGHT_EARLY")
        .when(alert == crossed, "CAUGHT_AT_CROSSING")
        .otherwise("CAUGHT_LATE")
    )


def _with_outcome(fires: DataFrame) -> DataFrame:
    alert, crossed = F.col("first_alert_hour"), F.col("budget_crossed_hour")
    return fires.withColumn("outcome", outcome(alert, crossed)).withColumn("lead_hours", crossed - alert)


def _bad_hours(hourly: DataFrame, budget: float) -> DataFrame:
    """Running spend of over-budget cluster-days only, with the day's total on every hour.

    The total uses the same window partitions as the running sums, so finding
    the bad days costs no further shuffle and everything after sees only them.
    """
    whole_day = F.sum("dollars").over(Window.partitionBy(*CLUSTER_DAY))
    marked = hourly.withColumn("actual_daily_dollars", whole_day)
    day = Window.partitionBy(*CLUSTER_DAY).orderBy("hour_of_day")
    so_far = day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return marked.filter(F.col("actual_daily_dollars") > budget).select(
        *CLUSTER_DAY,
        "hour_of_day",
        "actual_daily_dollars",
        F.sum("dollars").over(so_far).alias("cumulative_dollars"),
        F.row_number().over(day).alias("hours_observed"),
    )


def backtest(
    hourly: DataFrame, baseline: DataFrame, limits: Thresholds, meta: DataFrame | None = None
) -> DataFrame:
    """One row per over-budget cluster-day: when the monitor would have fired and how early."""
    scored = simulate(_bad_hours(hourly, limits.budget), baseline)
    fires = scored.groupBy(*CLUSTER_DAY).agg(
        F.max("actual_daily_dollars").alias("actual_daily_dollars"),
        F.max("z_score").alias("z_score"),
        *_fires(limits),
        F.max("hour_of_day").alias("last_active_hour"),
    )
    result = _with_outcome(fires)
    if meta is None:
        return result
    named = enrich_latest_meta(result, meta, ["workspace_id", "cluster_id"], ["cluster_name", "creator"])
    return named.select(
        *CLUSTER_DAY, "cluster_name", "creator", "actual_daily_dollars", "z_score", "first_alert_hour",
        "first_critical_hour", "budget_crossed_hour", "last_active_hour", "outcome", "lead_hours",
    )


def record_hours(scored: DataFrame) -> DataFrame:
    """The staircases of every cluster-day: hours whose pace, and hours whose spend so far, exceed all earlier ones.

    Whatever the threshold, it is first passed at one of these.  Within a
    cluster-day the z-score rises with the pace, so one staircase serves both.
    """
    hours = F.sort_array(
        F.collect_list(F.struct("hour_of_day", F.col("projected_daily_dollars").alias("pace"), "z_score", F.col("cumulative_dollars").alias("spent")))
    )
    days = scored.groupBy(*CLUSTER_DAY).agg(F.max("actual_daily_dollars").alias("actual_daily_dollars"), hours.alias("hours"))  # 24 at most

    def records(value: str) -> Column:
        def higher(hour: Column, i: Column) -> Column:
            before = F.transform(F.slice("hours", F.lit(1), i), lambda h: h[value])
            return (i == 0) | (hour[value] > F.array_max(before))

        return F.filter("hours", higher)

    return days.select(*CLUSTER_DAY, "actual_daily_dollars", records("pace").alias("pace_records"), records("spent").alias("spent_records"))


def backtest_sweep(hourly: DataFrame, baseline: DataFrame, grid: Sequence[Thresholds]) -> DataFrame:
    """``backtest`` for any number of threshold sets in one pass.

    The replay keeps the record hours of each cluster-day once; the sets come
    from one small table, and each looks up the first record beyond its limits.
    So the plan does not grow with the sets, and the hours are aggregated once.
    """
    scored = simulate(_bad_hours(hourly, min(g.budget for g in grid)), baseline)
    sets = local_frame(hourly.sparkSession, [(float(g.budget), float(g.z_warning), float(g.z_critical)) for g in grid], "budget double, z_warning double, z_critical double")
    packed = sets.agg(F.collect_list(F.struct("budget", "z_warning", "z_critical")))
    days = record_hours(scored).withColumn("sets", packed.scalar())
    rows = days.select("*", F.inline(F.filter("sets", lambda s: F.col("actual_daily_dollars") > s["budget"])))

    def first(records: str, value: str, limit: str) -> Column:
        beyond = F.filter(records, lambda h: h[value] > F.col(limit))
        return F.get(beyond, F.lit(0))["hour_of_day"]

    over, warning, critical = first("pace_records", "pace", "budget"), first("pace_records", "z_score", "z_warning"), first("pace_records", "z_score", "z_critical")
    return _with_outcome(
        rows.select(
            *CLUSTER_DAY, "actual_daily_dollars", "budget", "z_warning", "z_critical",
            F.least(over, warning, critical).alias("first_alert_hour"),
            F.least(over, critical).alias("first_critical_hour"),
            first("spent_records", "spent", "budget").alias("budget_crossed_hour"),
        )
    )


def backtest_summary(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts, dollars and lead-time spread per outcome (lead hours have at most 24 values)."""
    return results.groupBy(*by, "outcome").agg(
        F.count("*").alias("cluster_days"),
        F.sum("actual_daily_dollars").alias("dollars"),
        F.avg("lead_hours").alias("mean_lead_hours"),
        F.percentile("lead_hours", F.lit(0.5)).alias("p50_lead_hours"),
        F.percentile("lead_hours", F.lit(0.9)).alias("p90_lead_hours"),
        F.max("lead_hours").alias("max_lead_hours"),
    )


def enrich_latest_meta(
    df: DataFrame,
    scd: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    order: Sequence[str] = ("change_time",),
    tie: Sequence[str] = (),
) -> DataFrame:
    """Left-join the newest dimension row of every key, after the heavy work is done."""
    ties = tie or [c for c in columns]
    newest = latest_per_key(scd, list(keys), [F.desc(c) for c in (*order, *ties)]).select(*keys, *columns)
    return df.join(newest, list(keys), "left")
