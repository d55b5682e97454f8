"""Registered queries: table maintenance, sinks, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.functions.scale import local_frame
from tallyline.operators import costs as C
from tallyline.operators import state as T
from tallyline.operators.baseline import cluster_day_cost
from tallyline.plans import bindings as b
from tallyline.plans.alert_queries import LIVE_COLUMNS, SCORE_SQL, live, score_columns
from tallyline.plans.bindings import AS_OF, r6, scratch, text_time, with_sql
from tallyline.plans.cost_queries import HOURLY, PRICED, baseline, priced
from tallyline.plans.mart_queries import LENS, PLAN_SQL, enabled_lenses, fallback_priced, lensed, plan, refresh_state
from tallyline.plans.registry import query
from tallyline.schemas import conform_schema
from tallyline.streaming.jobs import LOG_SCHEMA, hours_of_parts, stream_hour_parts, stream_hourly_spend, stream_score, stream_suppress

# --- table algebra ----------------------------------------------------------

WINDOW_DAYS = {"cluster": 5, "job": 10, "serving_endpoint": 400, "warehouse": 0}
SCOPE = [(str(w), kind, days) for w in range(2) for kind, days in WINDOW_DAYS.items()]


@query(
    "replace_window",
    with_sql(*LENS, b.lensed_sql(AS_OF, dict.fromkeys(b.TYPES, 365)), b.COST_SQL)
    + f""", scope AS (SELECT * FROM (VALUES {b.values_sql(SCOPE)}) t(workspace_id, asset_type, days)),
      new AS (SELECT c.* FROM cost c JOIN scope s USING (workspace_id, asset_type)
        WHERE c.usage_date >= DATE '2024-01-31' - s.days AND c.usage_date <> DATE '2024-01-28')
      SELECT workspace_id, asset_type, asset_id, usage_date, 'old' AS version, round(sum(dollars), 6) AS dollars FROM cost c
        WHERE NOT EXISTS (SELECT 1 FROM scope s WHERE s.workspace_id = c.workspace_id AND s.asset_type = c.asset_type
          AND c.usage_date >= DATE '2024-01-31' - s.days) GROUP BY ALL
      UNION ALL SELECT workspace_id, asset_type, asset_id, usage_date, 'new', round(sum(dollars), 6) FROM new GROUP BY ALL""",
)
def q_replace_window(spark, sf):
    """Rebuild recent days; one rebuilt day comes back empty and must vanish."""
    full = C.lens_usage(
        C.daily_priced(fallback_priced(spark, sf, AS_OF)),
        local_frame(spark, [(w, t, 365) for w in range(3) for t in b.TYPES], "workspace_id bigint, asset_type string, lookback_days int"),
        AS_OF,
    )
    keys = ["workspace_id", "asset_type", "asset_id", "usage_date"]
    cost = C.asset_cost_daily(full).groupBy(*keys).agg(F.sum("actual_daily_dollars").alias("dollars"))
    scope = local_frame(spark, SCOPE, "workspace_id string, asset_type string, lookback_days int")
    rebuilt = cost.join(scope, ["workspace_id", "asset_type"]).filter(
        (F.col("usage_date") >= F.date_sub(F.lit("2024-01-31").cast("date"), F.col("lookback_days")))
        & (F.col("usage_date") != F.lit("2024-01-28").cast("date"))
    )
    old = cost.withColumn("version", F.lit("old"))
    out = T.replace_window(old, rebuilt.withColumn("version", F.lit("new")), scope, AS_OF)
    return out.select(*keys, "version", r6("dollars"))


@query(
    "replace_snapshot",
    with_sql(b.INVENTORY_SQL)
    + """ SELECT workspace_id, CAST(snapshot_ts AS DATE) AS snapshot_date, asset_type, asset_id, run AS collection_run_id FROM inventory
        WHERE NOT (workspace_id <> '2' AND run = 'r2')
      UNION ALL SELECT workspace_id, CAST(snapshot_ts AS DATE), asset_type, asset_id, 'rerun' FROM inventory
        WHERE workspace_id <> '2' AND run = 'r2' AND asset_type = 'job'""",
)
def q_replace_snapshot(spark, sf):
    """Two workspaces rerun one day and find only jobs."""
    columns = ["workspace_id", "snapshot_date", "asset_type", "asset_id", "collection_run_id"]
    old = b.inventory(spark, sf).select(*columns)
    rerun = old.filter((F.col("workspace_id") != "2") & (F.col("collection_run_id") == "r2") & (F.col("asset_type") == "job"))
    return T.replace_snapshot(old, rerun.withColumn("collection_run_id", F.lit("rerun")))


@query(
    "upsert_refresh_state",
    with_sql(PLAN_SQL)
    + """ SELECT CAST(workspace_id AS VARCHAR) AS workspace_id, asset_type,
        CASE WHEN workspace_id < 2 THEN least(DATE '2023-06-01', DATE '2024-01-31' - lookback_days) ELSE DATE '2024-01-31' - lookback_days END
          AS history_start_date, '2024-01-31 00:00:00' AS last_success_ts FROM plan
      UNION ALL SELECT '9', 'cluster', DATE '2023-06-01', '2024-01-01 00:00:00'""",
)
def q_upsert_refresh_state(spark, sf):
    """One state row belongs to a workspace that did not run."""
    p = plan(spark, sf)
    run = p.select(
        F.col("workspace_id").cast("string").alias("workspace_id"), "asset_type",
        F.date_sub(F.lit("2024-01-31").cast("date"), F.col("lookback_days")).alias("history_start_date"),
        F.to_timestamp(F.lit(AS_OF)).alias("last_success_ts"), "resolver_hash",
    )
    idle = local_frame(
        spark, [("9", "cluster", "2023-06-01", "2024-01-01 00:00:00")],
        "workspace_id string, asset_type string, start string, success string",
    ).select(
        "workspace_id", "asset_type", F.to_date("start").alias("history_start_date"),
        F.to_timestamp("success").alias("last_success_ts"), F.lit("h").alias("resolver_hash"),
    )
    state = refresh_state(spark).withColumn("workspace_id", F.col("workspace_id").cast("string")).unionByName(idle)
    out = T.upsert_refresh_state(state, run)
    return out.select("workspace_id", "asset_type", "history_start_date", text_time("last_success_ts").alias("last_success_ts"))


@query(
    "conform_schema",
    """SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS region, value AS amount_unused,
      CAST(ts AS DATE) AS snapshot_date FROM (SELECT event_id, user_id, ts, CAST(NULL AS DOUBLE) AS value FROM events)""",
)
def q_conform_schema(spark, sf):
    e = b.table(spark, sf, "events").withColumnRenamed("ts", "snapshot_ts")
    return conform_schema(e, "event_id bigint, user_id string, region string, amount_unused double, snapshot_date date")


@query(
    "sink_append_merge",
    with_sql(b.SCORES_SQL)
    + """ SELECT record_id, cluster_id, signal, CAST(NULL AS VARCHAR) AS team FROM scores WHERE signal = 'OK'
      UNION ALL SELECT record_id, cluster_id, signal, 'core' FROM scores WHERE signal <> 'OK'""",
)
def q_sink_append_merge(spark, sf):
    """Append rows with a new column to a stored table; old rows read NULL there."""
    scores = b.score_history(spark, sf).select("record_id", "cluster_id", "signal")
    path = scratch(spark, "append")
    T.append_table(scores.filter("signal = 'OK'"), path)
    T.append_table(T.append_merge(scores.filter("false"), scores.filter("signal <> 'OK'").withColumn("team", F.lit("core"))), path)
    return T.read_merged(spark, path, "record_id string, cluster_id string, signal string, team string")


@query(
    "sink_overwrite",
    with_sql(*PRICED, b.BASELINE_SQL)
    + " SELECT workspace_id, usage_date, cluster_id, round(daily_dollars, 6) AS daily_dollars FROM cday",
)
def q_sink_overwrite(spark, sf):
    """The second write replaces both the rows and the schema of the first."""
    path = scratch(spark, "overwrite")
    days = cluster_day_cost(priced(spark, sf))
    T.overwrite_table(days.select("cluster_id", F.lit(1).alias("dropped_column")), path)
    return T.overwrite_table(days, path).select("workspace_id", "usage_date", "cluster_id", r6("daily_dollars"))


@query(
    "sink_partitioned",
    with_sql(b.SCORES_SQL) + " SELECT CAST(snapshot_ts AS DATE) AS snapshot_date, record_id, cluster_id, signal FROM scores",
)
def q_sink_partitioned(spark, sf):
    path = scratch(spark, "partitioned")
    T.write_by_snapshot_date(b.score_history(spark, sf).drop("snapshot_date"), path)
    return spark.read.parquet(path).select("snapshot_date", "record_id", "cluster_id", "signal")


@query(
    "cached_priced_usage",
    with_sql(*PRICED, b.BASELINE_SQL)
    + """ SELECT d.workspace_id, d.cluster_days, d.dollars, r.skus FROM
        (SELECT workspace_id, count(*) AS cluster_days, round(sum(daily_dollars), 4) AS dollars FROM cday GROUP BY 1) d
        JOIN (SELECT workspace_id, count(DISTINCT sku_name) AS skus FROM priced GROUP BY 1) r ON r.workspace_id = d.workspace_id""",
)
def q_cached_priced_usage(spark, sf):
    """Priced usage shared by two consumers through one written table, which outlives lost executors."""
    shared = T.overwrite_table(priced(spark, sf), scratch(spark, "priced"))
    days = cluster_day_cost(shared).groupBy("workspace_id").agg(
        F.count("*").alias("cluster_days"), F.round(F.sum("daily_dollars"), 4).alias("dollars")
    )
    skus = shared.groupBy("workspace_id").agg(F.count_distinct("sku_name").alias("skus"))
    return days.join(skus, "workspace_id")


# --- streams ----------------------------------------------------------------


@query("stream_score", SCORE_SQL)
def q_stream_score(spark, sf):
    """Snapshots stored as files, scored as a stream into a file sink."""
    inbox, out, checkpoint = (scratch(spark, f"score-{part}") for part in ("in", "out", "checkpoint"))
    snapshots = live(spark, sf).select(*LIVE_COLUMNS, F.to_timestamp(F.lit(AS_OF)).alias("snapshot_ts"))
    T.overwrite_table(snapshots, inbox)
    base = T.overwrite_table(baseline(spark, sf), scratch(spark, "score-baseline"))
    stream = spark.readStream.schema(snapshots.schema).parquet(inbox)
    scored = stream_score(stream, b.node_rates(spark), base, b.LIVE_RULES, b.SCORE_LIMITS)
    job = scored.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    job.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return score_columns(spark.read.schema(scored.schema).parquet(out))


@query(
    "stream_hourly_spend",
    with_sql(*HOURLY)
    + """ SELECT workspace_id, usage_date, strftime(hour_ts, '%Y-%m-%d %H:%M:%S') AS hour_ts, hour_of_day, cluster_id,
      round(dbus, 6) AS dbus, round(dollars, 6) AS dollars FROM hourly
      WHERE hour_ts + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR""",
)
def q_stream_hourly_spend(spark, sf):
    """The usage stream: every hour the watermark has passed, at the end of the input."""
    out, checkpoint = scratch(spark, "hourly-out"), scratch(spark, "hourly-checkpoint")
    schema = b.table(spark, sf, "events").sparkSession.read.parquet(f"{sf}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    kind = F.concat(
        F.upper("event_type"),
        b.when_mod("event_id", 3, F.lit("_PHOTON"), F.lit("")),
        b.when_mod("event_id", 11, F.lit("_SERVERLESS"), F.lit("")),
    )
    usage = events.select(
        (F.col("user_id") % 3).alias("workspace_id"),
        F.col("user_id").cast("string").alias("cluster_id"),
        F.col("ts").cast("timestamp").alias("usage_start_time"),
        kind.alias("sku_name"),
        F.col("value").alias("dbus"),
    )
    hourly = stream_hourly_spend(usage, b.price_book(spark), "2 hours")
    job = hourly.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    job.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(hourly.schema).parquet(out).select(
        "workspace_id", "usage_date", text_time("hour_ts").alias("hour_ts"), "hour_of_day", "cluster_id", r6("dbus"), r6("dollars")
    )


@query(
    "stream_hour_parts",
    with_sql(*HOURLY)
    + """, arrived AS (SELECT workspace_id, usage_date, date_trunc('hour', usage_start_time) AS hour_ts, cluster_id, dollars,
          CASE WHEN event_id % 4 <> 3 THEN 0 ELSE 1 END AS batch, usage_start_time FROM lpriced),
        closed AS (SELECT max(usage_start_time) - INTERVAL 2 HOUR AS until FROM arrived WHERE batch = 0)
      SELECT h.workspace_id, h.usage_date, strftime(h.hour_ts, '%Y-%m-%d %H:%M:%S') AS hour_ts, h.hour_of_day, h.cluster_id, round(h.dbus, 6) AS dbus,
        round(h.dollars, 6) AS dollars, round(coalesce((SELECT sum(a.dollars) FROM arrived a, closed WHERE a.batch = 1 AND a.workspace_id = h.workspace_id
          AND a.cluster_id = h.cluster_id AND a.hour_ts = h.hour_ts AND a.hour_ts + INTERVAL 1 HOUR <= until), 0), 6) AS late_dollars
      FROM hourly h""",
)
def q_stream_hour_parts(spark, sf):
    """A quarter of the usage arrives after its hours have closed: stream and corrections are the batch result on all hours."""
    inbox, path, checkpoint = (scratch(spark, f"parts-{part}") for part in ("in", "out", "checkpoint"))
    usage = b.usage(spark, sf).select(
        "event_id", "workspace_id", F.col("usage_metadata.cluster_id").alias("cluster_id"), "usage_start_time", "sku_name", F.col("usage_quantity").alias("dbus")
    )
    for share in (F.col("event_id") % 4 != 3, F.col("event_id") % 4 == 3):
        T.append_table(usage.filter(share).drop("event_id"), inbox)
        stream = spark.readStream.schema(usage.drop("event_id").schema).parquet(inbox)
        stream_hour_parts(stream, b.price_book(spark), path, checkpoint, "2 hours").awaitTermination()
    return hours_of_parts(spark, path).select(
        "workspace_id", "usage_date", text_time("hour_ts").alias("hour_ts"), "hour_of_day", "cluster_id", r6("dbus"), r6("dollars"), r6("late_dollars")
    )


# Three batches of scores, each one routing run at its newest snapshot.
CUTS = ("2024-01-10 12:00:00", "2024-01-11 00:00:00", "2024-01-31 00:00:00")
STARTS = ("2024-01-01 00:00:00", *CUTS[:-1])
STREAM_MINUTES = 1440


def _batch_sql(i: int) -> str:
    earlier = " UNION ALL ".join(f"SELECT * FROM sent{j}" for j in range(i))
    quiet = (
        f"""AND NOT EXISTS (SELECT 1 FROM ({earlier}) s WHERE s.workspace_id = a.workspace_id AND s.cluster_id = a.cluster_id
    AND s.signal = a.signal AND s.sent_at >= n.now - CASE a.signal WHEN 'CRITICAL' THEN INTERVAL 4 HOURS ELSE INTERVAL 24 HOURS END)"""
        if i
        else ""
    )
    return f"""
part{i} AS (SELECT * FROM scores WHERE snapshot_ts >= TIMESTAMP '{STARTS[i]}' AND snapshot_ts < TIMESTAMP '{CUTS[i]}'),
now{i} AS (SELECT max(snapshot_ts) AS now FROM part{i}),
top{i} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY workspace_id, cluster_id ORDER BY snapshot_ts DESC,
  record_id DESC NULLS LAST) AS rn FROM part{i}) WHERE rn = 1),
sent{i} AS (SELECT a.workspace_id, a.cluster_id, a.signal, a.record_id, n.now AS sent_at, {i} AS batch FROM top{i} a CROSS JOIN now{i} n
  WHERE a.signal <> 'OK' AND a.record_id IS NOT NULL AND a.snapshot_ts >= n.now - INTERVAL {STREAM_MINUTES} MINUTES {quiet})"""


@query(
    "stream_suppress",
    with_sql(b.SCORES_SQL, *map(_batch_sql, range(3)))
    + " UNION ALL ".join(
        f""" SELECT workspace_id, cluster_id AS asset_id, signal AS severity, record_id, strftime(sent_at, '%Y-%m-%d %H:%M:%S') AS event_ts,
        {i}::BIGINT AS batch FROM sent{i}"""
        for i in range(3)
    ),
)
def q_stream_suppress(spark, sf):
    """Scores arrive in three deliveries; the send log carries over between them."""
    inbox, log, checkpoint = (scratch(spark, f"suppress-{part}") for part in ("in", "log", "checkpoint"))
    scores = b.score_history(spark, sf)
    for start, end in zip(STARTS, CUTS):
        ts = F.col("snapshot_ts")
        arrived = scores.filter((ts >= F.lit(start).cast("timestamp")) & (ts < F.lit(end).cast("timestamp")))
        T.append_table(arrived, inbox)
        stream = spark.readStream.schema(scores.schema).parquet(inbox)
        stream_suppress(stream, log, checkpoint, STREAM_MINUTES).awaitTermination()
    return spark.read.schema(LOG_SCHEMA).parquet(log).select(
        "workspace_id", "asset_id", "severity", "record_id", text_time("event_ts").alias("event_ts"), "batch"
    )


__all__ = ["enabled_lenses", "lensed"]
