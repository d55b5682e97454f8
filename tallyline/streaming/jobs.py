"""Structured Streaming forms of scoring, hourly spend and suppression."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyline.functions.scale import local_frame
from tallyline.functions.storage import children, complete, delete, exists, move
from tallyline.operators.alerts import alerts_latest, suppress_alerts
from tallyline.operators.baseline import hourly_spend
from tallyline.operators.pricing import price_usage
from tallyline.operators.scoring import score_clusters
from tallyline.params import DETECTOR, ExclusionRules, SuppressionWindows, Thresholds, as_of_ts


def stream_score(
    live: DataFrame, rates: DataFrame, baseline: DataFrame, rules: ExclusionRules, limits: Thresholds
) -> DataFrame:
    """Score streamed snapshots (``snapshot_ts`` column) against static rates and baseline.

    Stream-static joins only, so there is no state and the sink may append.
    """
    return score_clusters(live, rates, baseline, rules, limits, F.col("snapshot_ts"))


def stream_hourly_spend(usage: DataFrame, book: DataFrame, delay: str) -> DataFrame:
    """Hourly units and dollars per cluster, emitted once the watermark has passed the hour.

    Rows later than ``delay`` are left to the batch correction window, or to ``stream_hour_parts``.
    """
    priced = price_usage(usage.withWatermark("usage_start_time", delay), book, unpriced="zero")
    hourly = priced.groupBy("workspace_id", "cluster_id", F.window("usage_start_time", "1 hour").alias("w")).agg(
        F.sum("dbus").alias("dbus"), F.sum("dollars").alias("dollars")
    )
    return hourly.select(
        "workspace_id",
        F.to_date("w.start").alias("usage_date"),
        F.col("w.start").alias("hour_ts"),
        F.hour("w.start").alias("hour_of_day"),
        "cluster_id",
        "dbus",
        "dollars",
    )


HOURS_SCHEMA = (
    "workspace_id bigint, usage_date date, hour_ts timestamp, hour_of_day int, cluster_id string, dbus double, dollars double, "
    "late boolean, run string, batch bigint"
)
_SEEN_SCHEMA = "newest timestamp, run string, batch bigint"


def stream_hour_parts(usage: DataFrame, book: DataFrame, path: str, checkpoint: str, delay: str) -> StreamingQuery:
    """Hourly spend of every row, also of those behind the watermark: each micro-batch adds its part of the hours that it touches.

    A part is marked ``late`` where its hour was closed before the batch, that
    is, where the newest time of all earlier batches lies more than ``delay``
    after the hour's end; these are the rows that ``stream_hourly_spend`` drops.
    ``hours_of_parts`` merges on-time parts, corrections and the hours that are
    still open, which together are the batch result.  A replayed batch
    overwrites its own parts.  A path belongs to one checkpoint: with another
    one the input would count twice, so that is an error.
    """
    spark = usage.sparkSession
    local_frame(spark, [], HOURS_SCHEMA).write.mode("append").partitionBy("run", "batch").parquet(f"{path}/hours")
    local_frame(spark, [], _SEEN_SCHEMA).write.mode("append").partitionBy("run", "batch").parquet(f"{path}/seen")

    def handle(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        run = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        seen = session.read.schema(_SEEN_SCHEMA).parquet(f"{path}/seen")
        if not seen.filter(F.col("run") != run).isEmpty():
            raise ValueError(f"{path} belongs to another checkpoint")
        closed = seen.filter(F.col("batch") < batch_id).agg(F.max("newest") - F.expr(f"INTERVAL {delay}")).scalar()
        hours = hourly_spend(price_usage(batch, book, unpriced="zero").withColumn("usage_date", F.to_date("usage_start_time")))
        late = F.coalesce(F.col("hour_ts") + F.expr("INTERVAL 1 HOUR") <= closed, F.lit(False))
        hours.withColumn("late", late).write.mode("overwrite").parquet(f"{path}/hours/run={run}/batch={batch_id}")
        newest = batch.agg(F.max("usage_start_time").alias("newest")).filter("newest IS NOT NULL")
        newest.write.mode("overwrite").parquet(f"{path}/seen/run={run}/batch={batch_id}")

    return usage.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hours_of_parts(spark: SparkSession, path: str) -> DataFrame:
    """Hourly spend over all parts, with the share that came late."""
    parts = spark.read.schema(HOURS_SCHEMA).parquet(f"{path}/hours")
    return parts.groupBy("workspace_id", "usage_date", "hour_ts", "hour_of_day", "cluster_id").agg(
        F.sum("dbus").alias("dbus"), F.sum("dollars").alias("dollars"),
        F.sum(F.when(F.col("late"), F.col("dollars")).otherwise(0.0)).alias("late_dollars"),
    )


LOG_SCHEMA = (
    "workspace_id bigint, asset_id string, severity string, event_ts timestamp, record_id string, "
    "detector_name string, event_type string, run string, batch bigint"
)


#: Columns by which the send log is stored: the day of the sends, and the batch (or fold of batches) that wrote them.
LOG_PARTITIONS = "event_date date, part string"
#: Parts of one day from which earlier batches are folded into one.
FOLD_AT = 16


def read_log(spark: SparkSession, path: str, since: Column | None = None) -> DataFrame:
    """The send log; with ``since``, no day before that time's is listed for reading."""
    log = spark.read.schema(f"{LOG_SCHEMA}, {LOG_PARTITIONS}").parquet(path)
    return log if since is None else log.filter(F.col("event_date") >= F.to_date(since))


def _finish_folds(spark: SparkSession, path: str) -> None:
    """Put finished folds in the place of their parts.  Rows come before their parts go, so a stop in between loses none, and the next call goes on."""
    for name in children(spark, f"{path}/_fold"):
        fold = f"{path}/_fold/{name}"
        if complete(spark, f"{fold}/parts"):
            day = name.rsplit("_", 1)[0]
            if exists(spark, f"{fold}/rows"):
                move(spark, f"{fold}/rows", f"{path}/event_date={day}/part=fold-{name}")
            for row in spark.read.schema("part string").parquet(f"{fold}/parts").collect():  # FOLD_AT names or little more
                delete(spark, f"{path}/event_date={day}/{row.part}")
        delete(spark, fold)


def _fold(spark: SparkSession, path: str, day: str, current: str, at: int) -> None:
    """Fold the day's parts of earlier batches into one, once there are ``at`` of them."""
    parts = [p for p in children(spark, f"{path}/event_date={day}") if p.startswith("part=") and p != f"part={current}"]
    if len(parts) < at:
        return
    fold = f"{path}/_fold/{day}_{uuid.uuid4().hex}"
    rows = spark.read.schema(LOG_SCHEMA).parquet(*[f"{path}/event_date={day}/{p}" for p in parts])
    rows.coalesce(1).write.parquet(f"{fold}/rows")
    local_frame(spark, [(p,) for p in parts], "part string").write.parquet(f"{fold}/parts")
    _finish_folds(spark, path)


def stream_suppress(
    scores: DataFrame,
    log_path: str,
    checkpoint: str,
    minutes: int = 30,
    windows: SuppressionWindows = SuppressionWindows(),
    detector: str = DETECTOR,
    fold_at: int = FOLD_AT,
) -> StreamingQuery:
    """One routing run per micro-batch, with the send log itself as the state.

    The run's time is the newest snapshot of its batch.  A batch overwrites only
    the part of its own query (whose id lives in the checkpoint) and number,
    and reads everything but that and later ones of the query.  So a replayed
    batch neither sends twice nor suppresses itself, and under a new checkpoint
    all earlier sends stay and count.  Parts lie below the day of their sends:
    a batch reads the days of the longest window alone, and folds earlier parts
    of its day into one whenever there are ``fold_at``.  One query writes a log
    at a time.
    """
    spark = scores.sparkSession
    local_frame(spark, [], f"{LOG_SCHEMA}, {LOG_PARTITIONS}").write.mode("append").partitionBy("event_date", "part").parquet(log_path)
    longest = max(windows.hours().values())

    def handle(batch: DataFrame, batch_id: int) -> None:
        now = batch.agg(F.max("snapshot_ts").cast("string")).first()[0]
        if now is None:
            return
        session = batch.sparkSession
        run = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        _finish_folds(session, log_path)
        log = read_log(session, log_path, as_of_ts(now) - F.make_dt_interval(hours=F.lit(longest)))
        log = log.filter((F.col("run") != run) | (F.col("batch") < batch_id)).select("workspace_id", "asset_id", "severity", "event_ts", "record_id", "detector_name", "event_type")
        sends = suppress_alerts(alerts_latest(batch, now, minutes), log, now, windows, detector)
        part = f"{run}-{batch_id}"
        sends.select(
            "workspace_id",
            F.col("cluster_id").alias("asset_id"),
            F.col("signal").alias("severity"),
            as_of_ts(now).alias("event_ts"),
            "record_id",
            F.lit(detector).alias("detector_name"),
            F.lit("message_sent").alias("event_type"),
            F.lit(run).alias("run"),
            F.lit(batch_id).cast("bigint").alias("batch"),
        ).write.mode("overwrite").parquet(f"{log_path}/event_date={now[:10]}/part={part}")
        _fold(session, log_path, now[:10], part, fold_at)

    return (
        scores.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
