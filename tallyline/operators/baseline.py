"""What a normal cluster-day costs, now and as it looked on every past day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyline.functions.exprs import weekday_only
from tallyline.functions.percentiles import exact_percentiles
from tallyline.params import AsOf, as_of_ts


def cluster_day_cost(priced: DataFrame, weekdays_only: bool = True) -> DataFrame:
    rows = priced.filter(weekday_only(F.col("usage_date"))) if weekdays_only else priced
    return rows.groupBy("workspace_id", "usage_date", "cluster_id").agg(F.sum("dollars").alias("daily_dollars"))


def hourly_spend(priced: DataFrame) -> DataFrame:
    return priced.groupBy(
        "workspace_id",
        "usage_date",
        F.date_trunc("hour", "usage_start_time").alias("hour_ts"),
        F.hour("usage_start_time").alias("hour_of_day"),
        "cluster_id",
    ).agg(F.sum("dbus").alias("dbus"), F.sum("dollars").alias("dollars"))


def workspace_baseline(cluster_days: DataFrame, as_of: AsOf, lookback_days: int) -> DataFrame:
    """One row of population statistics per workspace over its positive cluster-days.

    ``cluster_days`` is read three times; pass a stored table, which is also the
    place to leave out excluded clusters.
    """
    days = cluster_days.filter(F.col("daily_dollars") > 0)
    dollars, log = F.col("daily_dollars"), F.ln("daily_dollars")
    stats = days.groupBy("workspace_id").agg(
        F.count("*").alias("n_cluster_days"),
        F.avg(dollars).alias("mean_daily_dollars"),
        F.stddev_pop(dollars).alias("stddev_daily_dollars"),
        F.max(dollars).alias("max_daily_dollars"),
        F.avg(log).alias("mean_log_daily_dollars"),
        F.stddev_pop(log).alias("stddev_log_daily_dollars"),
    )
    ranks = {f"p{p}_daily_dollars": p / 100 for p in (50, 90, 95, 99)}
    points = exact_percentiles(days, ["workspace_id"], "daily_dollars", ranks)
    return stats.join(points, "workspace_id").select(
        "workspace_id",
        as_of_ts(as_of).alias("computed_at"),
        F.lit(lookback_days).alias("lookback_days"),
        "n_cluster_days",
        "mean_daily_dollars",
        "stddev_daily_dollars",
        *ranks,
        "max_daily_dollars",
        "mean_log_daily_dollars",
        "stddev_log_daily_dollars",
    )


def rolling_baseline(cluster_days: DataFrame, lookback_days: int, as_of_dates: str = "weekday") -> DataFrame:
    """The baseline each day would have been scored against: weekday cluster-days of the
    ``lookback_days`` days before it.

    Cluster-days shrink to one summary row per workspace and day, and a range
    frame over those few rows merges the summaries (count, mean, squared
    deviations), so no cluster-day is ever repeated per as-of date.

    ``as_of_dates="weekday"`` gives rows for weekdays only, ``"all"`` for every
    date of ``cluster_days`` (which must then include weekends).
    """
    if as_of_dates not in ("weekday", "all"):
        raise ValueError(f"as_of_dates must be 'weekday' or 'all', not {as_of_dates!r}")
    days = cluster_days if as_of_dates == "all" else cluster_days.filter(weekday_only(F.col("usage_date")))
    used = F.when(weekday_only(F.col("usage_date")) & (F.col("daily_dollars") > 0), F.col("daily_dollars"))
    daily = days.groupBy("workspace_id", "usage_date").agg(
        F.count(used).alias("n"),
        F.avg(used).alias("mean"),
        (F.var_pop(used) * F.count(used)).alias("m2"),
        F.avg(F.ln(used)).alias("mean_log"),
        (F.var_pop(F.ln(used)) * F.count(used)).alias("m2_log"),
        F.min(used).alias("lo"),
        F.max(used).alias("hi"),
    )
    frame = (
        Window.partitionBy("workspace_id")
        .orderBy(F.unix_date("usage_date"))
        .rangeBetween(-lookback_days, -1)
    )
    summary = F.when(F.col("n") > 0, F.struct("n", "mean", "m2", "mean_log", "m2_log"))
    framed = daily.select(
        "workspace_id",
        F.col("usage_date").alias("as_of_date"),
        F.collect_list(summary).over(frame).alias("parts"),
        F.sum("n").over(frame).alias("baseline_n"),
        (F.min("lo").over(frame) == F.max("hi").over(frame)).alias("constant"),
    ).filter(F.col("baseline_n") > 0)
    # Equal values have no spread; without the check rounding would leave 1e-16 and huge z-scores.
    spread = lambda mean, m2: F.when(F.col("constant"), 0.0).otherwise(
        F.sqrt(_pooled_m2("parts", mean, m2) / F.col("baseline_n"))
    )
    return framed.select(
        "workspace_id",
        "as_of_date",
        _pooled_mean("parts", "mean").alias("baseline_mean"),
        spread("mean", "m2").alias("baseline_stddev"),
        _pooled_mean("parts", "mean_log").alias("baseline_mean_log"),
        spread("mean_log", "m2_log").alias("baseline_stddev_log"),
        "baseline_n",
    )


def _pooled_mean(parts: str, mean: str) -> Column:
    total = F.aggregate(parts, F.lit(0.0), lambda acc, p: acc + p["n"] * p[mean])
    return total / F.col("baseline_n")


def _pooled_m2(parts: str, mean: str, m2: str) -> Column:
    """Squared deviations of the union: within each part, plus between part means."""
    centre = _pooled_mean(parts, mean)
    return F.aggregate(
        parts, F.lit(0.0), lambda acc, p: acc + p[m2] + p["n"] * (p[mean] - centre) * (p[mean] - centre)
    )
