"""Projected daily dollars, z-scores and signals of running clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.exprs import exclusion_reason, plain_number, sha_hex, tier_signal
from tallyline.params import AsOf, ExclusionRules, Thresholds, as_of_ts
from tallyline.schemas import SCORES, conform_schema


def _by_node(rates: DataFrame) -> DataFrame:
    """One row per workspace and node type with its plain and accelerated rate."""
    rate = F.struct("dbu_per_hour", "dollars_per_hour")
    return rates.groupBy("workspace_id", "node_type").agg(
        F.max(F.when(~F.col("photon"), rate)).alias("plain"), F.max(F.when(F.col("photon"), rate)).alias("fast")
    )


def lookup_rates(live: DataFrame, rates: DataFrame) -> DataFrame:
    """Hourly rates of each cluster's driver and worker node.

    The rate for the cluster's own acceleration flag is preferred; where the
    node has only the opposite one, that is used.
    """
    nodes = _by_node(rates)
    out = live
    for role, column in (("driver", "driver_node_type"), ("worker", "node_type")):
        side = nodes.select(
            "workspace_id",
            F.col("node_type").alias(column),
            F.col("plain").alias("_plain"),
            F.col("fast").alias("_fast"),
        )
        pick = F.when(F.col("photon"), F.coalesce("_fast", "_plain")).otherwise(F.coalesce("_plain", "_fast"))
        out = (
            out.join(side, ["workspace_id", column], "left")
            .withColumn(f"{role}_dbu_per_hour", pick["dbu_per_hour"])
            .withColumn(f"{role}_dollars_per_hour", pick["dollars_per_hour"])
            .drop("_plain", "_fast")
        )
    return out


def sku_by_flag(rates: DataFrame) -> DataFrame:
    """The SKU billed for each acceleration flag of a workspace."""
    return rates.groupBy("workspace_id", "photon").agg(F.max("sku_name").alias("sku_name"))


def _reason(projected: Column, z: Column, limits: Thresholds) -> Column:
    over_budget = F.when(
        projected > limits.budget,
        F.concat(
            F.lit("projected_daily $"), F.format_number(projected, 0), F.lit(f" > budget ${limits.budget:,.0f}")
        ),
    )
    z_text = plain_number(z, 1)
    over_z = F.when(
        z > limits.z_critical, F.concat(F.lit("log-z="), z_text, F.lit(f" > critical {limits.z_critical}"))
    ).when(z > limits.z_warning, F.concat(F.lit("log-z="), z_text, F.lit(f" > warning {limits.z_warning}")))
    joined = F.concat_ws("; ", over_budget, over_z)
    return F.when(joined == "", "within thresholds").otherwise(joined)


def score_clusters(
    live: DataFrame,
    rates: DataFrame,
    baseline: DataFrame,
    rules: ExclusionRules,
    limits: Thresholds,
    as_of: AsOf | Column,
) -> DataFrame:
    """One score row per running cluster.

    Excluded clusters and clusters without a node rate keep a row, so every
    snapshot is complete.  ``as_of`` may be a column for streamed snapshots.
    """
    now = as_of if isinstance(as_of, Column) else as_of_ts(as_of)
    spend = baseline.select(
        "workspace_id",
        F.col("mean_daily_dollars").alias("_mean"),
        F.col("stddev_daily_dollars").alias("_std"),
        F.col("mean_log_daily_dollars").alias("_mean_log"),
        F.col("stddev_log_daily_dollars").alias("_std_log"),
    )
    rows = (
        lookup_rates(live, rates)
        .join(sku_by_flag(rates), ["workspace_id", "photon"], "left")
        .join(spend, "workspace_id", "left")
        .withColumn("_excluded", exclusion_reason(rules, F.col("cluster_id"), F.col("cluster_name"), F.col("creator")))
    )
    excluded = F.col("_excluded").isNotNull()
    priced = F.col("driver_dbu_per_hour").isNotNull() & F.col("worker_dbu_per_hour").isNotNull()

    def fleet(unit: str) -> Column:
        return F.when(
            ~excluded & priced,
            F.col(f"driver_{unit}_per_hour") + F.col("num_workers") * F.col(f"worker_{unit}_per_hour"),
        )

    rows = (
        rows.withColumn("dbu_per_hour", fleet("dbu"))
        .withColumn("dollars_per_hour", fleet("dollars"))
        .withColumn("projected_daily_dollars", F.col("dollars_per_hour") * 24.0)
        .withColumn("z_score", log_z(F.col("projected_daily_dollars"), F.col("_mean_log"), F.col("_std_log")))
    )
    projected, z = F.col("projected_daily_dollars"), F.col("z_score")
    unknown = F.concat(
        F.lit("Missing pricing for driver="),
        F.coalesce("driver_node_type", F.lit("None")),
        F.lit(" worker="),
        F.coalesce("node_type", F.lit("None")),
        F.when(F.col("photon"), " photon=True").otherwise(" photon=False"),
    )
    signal = F.when(excluded, "EXCLUDED").when(~priced, "UNKNOWN").otherwise(tier_signal(projected, z, limits))
    reason = F.when(excluded, F.col("_excluded")).when(~priced, unknown).otherwise(_reason(projected, z, limits))
    scored = rows.withColumns(
        {
            "snapshot_ts": now,
            "record_id": sha_hex(F.col("workspace_id"), F.col("cluster_id"), F.unix_micros(now)),
            "baseline_mean": F.coalesce("_mean", F.lit(0.0)),
            "baseline_stddev": F.coalesce("_std", F.lit(0.0)),
            "signal": signal,
            "reason": reason,
        }
    )
    return conform_schema(scored, SCORES)


def log_z(projected: Column, mean_log: Column, std_log: Column) -> Column:
    """Distance of ln(projected) from the log-space mean; NULL without spread or dollars."""
    centre, spread = F.coalesce(mean_log, F.lit(0.0)), F.when(std_log > 0, std_log)
    return F.when(projected > 0, (F.ln(projected) - centre) / spread)


def signal_summary(scores: DataFrame) -> DataFrame:
    return scores.groupBy("signal").agg(F.count("*").alias("clusters")).orderBy("signal")
