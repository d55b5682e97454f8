"""Registered queries: running clusters, scores, alerts, audit checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.functions.exprs import exclusion_reason, tier_signal
from tallyline.operators import alerts as A
from tallyline.operators import quality as Q
from tallyline.operators import scoring as S
from tallyline.params import Routing, SuppressionWindows
from tallyline.plans import bindings as b
from tallyline.plans.bindings import AS_OF, r6, text_time, with_sql
from tallyline.plans.cost_queries import PRICED, baseline
from tallyline.plans.registry import query
from tallyline.sources.live import decode_live_clusters

DAY_MINUTES = 1440
WINDOWS = SuppressionWindows(warning_hours=24, critical_hours=4)
LIVE_COLUMNS = (
    "workspace_id", "cluster_id", "cluster_name", "creator", "cluster_source", "node_type", "driver_node_type",
    "num_workers", "photon",
)


def live(spark, sf):
    return decode_live_clusters(b.live_payloads(spark, sf))


@query("decode_live_clusters", with_sql(b.LIVE_SQL) + f" SELECT {', '.join(LIVE_COLUMNS)} FROM live")
def q_decode_live_clusters(spark, sf):
    return live(spark, sf).select(*LIVE_COLUMNS)


REASON_SQL = f"""CASE WHEN cluster_id IN ('5', '11') THEN 'cluster_id ' || cluster_id || ' in exclusions'
  WHEN cluster_name GLOB '{b.LIVE_RULES.name_patterns[0]}' THEN 'cluster_name matches pattern ''{b.LIVE_RULES.name_patterns[0]}'''
  WHEN cluster_name GLOB '{b.LIVE_RULES.name_patterns[1]}' THEN 'cluster_name matches pattern ''{b.LIVE_RULES.name_patterns[1]}'''
  WHEN creator = 'NATION_3' THEN 'creator NATION_3 in exclusions' END"""


@query(
    "exclusion_reason",
    with_sql(b.LIVE_SQL) + f" SELECT cluster_id, cluster_name, creator, {REASON_SQL} AS reason FROM live",
)
def q_exclusion_reason(spark, sf):
    reason = exclusion_reason(b.LIVE_RULES, F.col("cluster_id"), F.col("cluster_name"), F.col("creator"))
    return live(spark, sf).select("cluster_id", "cluster_name", "creator", reason.alias("reason"))


RATED_SQL = """
rated AS (
  SELECT l.*, coalesce(d1.dbu, d2.dbu) AS driver_dbu, coalesce(d1.dph, d2.dph) AS driver_dph,
    coalesce(w1.dbu, w2.dbu) AS worker_dbu, coalesce(w1.dph, w2.dph) AS worker_dph
  FROM live l
  LEFT JOIN rates d1 ON d1.workspace_id = l.workspace_id AND d1.node_type = l.driver_node_type AND d1.photon = l.photon
  LEFT JOIN rates d2 ON d2.workspace_id = l.workspace_id AND d2.node_type = l.driver_node_type AND d2.photon <> l.photon
  LEFT JOIN rates w1 ON w1.workspace_id = l.workspace_id AND w1.node_type = l.node_type AND w1.photon = l.photon
  LEFT JOIN rates w2 ON w2.workspace_id = l.workspace_id AND w2.node_type = l.node_type AND w2.photon <> l.photon)"""


@query(
    "lookup_rates",
    with_sql(b.LIVE_SQL, b.RATES_SQL, RATED_SQL)
    + """ SELECT workspace_id, cluster_id, photon, round(driver_dbu, 6) AS driver_dbu_per_hour, round(driver_dph, 6) AS
      driver_dollars_per_hour, round(worker_dbu, 6) AS worker_dbu_per_hour, round(worker_dph, 6) AS worker_dollars_per_hour
      FROM rated""",
)
def q_lookup_rates(spark, sf):
    rows = S.lookup_rates(live(spark, sf), b.node_rates(spark))
    rates = [f"{role}_{unit}_per_hour" for role in ("driver", "worker") for unit in ("dbu", "dollars")]
    return rows.select("workspace_id", "cluster_id", "photon", *[r6(c) for c in rates])


L = b.SCORE_LIMITS
SCORED_SQL = f"""
facts AS (
  SELECT r.*, {REASON_SQL} AS excluded, coalesce(bl.mean_daily_dollars, 0) AS baseline_mean,
    coalesce(bl.stddev_daily_dollars, 0) AS baseline_stddev,
    coalesce(bl.mean_log_daily_dollars, 0) AS ml, coalesce(bl.stddev_log_daily_dollars, 0) AS sl,
    driver_dbu + num_workers * worker_dbu AS dbu, driver_dph + num_workers * worker_dph AS dph
  FROM rated r LEFT JOIN baseline bl ON bl.workspace_id = r.workspace_id),
zs AS (
  SELECT * REPLACE (CASE WHEN excluded IS NULL THEN dbu END AS dbu, CASE WHEN excluded IS NULL THEN dph END AS dph),
    CASE WHEN excluded IS NULL THEN dph * 24.0 END AS projected,
    CASE WHEN excluded IS NULL AND dph > 0 AND sl > 0 THEN (ln(dph * 24.0) - ml) / sl END AS z FROM facts),
scored AS (
  SELECT *, CASE WHEN excluded IS NOT NULL THEN 'EXCLUDED' WHEN dbu IS NULL THEN 'UNKNOWN'
      WHEN projected > {L.budget} OR z > {L.z_critical} THEN 'CRITICAL' WHEN z > {L.z_warning} THEN 'WARNING' ELSE 'OK' END AS signal,
    CASE WHEN excluded IS NOT NULL THEN excluded
      WHEN dbu IS NULL THEN 'Missing pricing for driver=' || driver_node_type || ' worker=' || node_type || ' photon='
        || CASE WHEN photon THEN 'True' ELSE 'False' END
      ELSE coalesce(nullif(concat_ws('; ',
        CASE WHEN projected > {L.budget} THEN 'projected_daily $' || format('{{:,.0f}}', projected) || ' > budget $1,000' END,
        CASE WHEN z > {L.z_critical} THEN 'log-z=' || format('{{:.1f}}', z) || ' > critical {L.z_critical}'
          WHEN z > {L.z_warning} THEN 'log-z=' || format('{{:.1f}}', z) || ' > warning {L.z_warning}' END), ''), 'within thresholds')
      END AS reason FROM zs)"""
SCORING = (b.LIVE_SQL, b.RATES_SQL, RATED_SQL, *PRICED, b.BASELINE_SQL, SCORED_SQL)


def scores(spark, sf):
    return S.score_clusters(
        live(spark, sf), b.node_rates(spark), baseline(spark, sf), b.LIVE_RULES, b.SCORE_LIMITS, AS_OF
    )


def score_columns(df):
    return df.select(
        "record_id", "workspace_id", text_time("snapshot_ts").alias("snapshot_ts"), "snapshot_date", "cluster_id",
        "cluster_name", "creator", "cluster_source", "node_type", "driver_node_type", "num_workers", "photon", "sku_name",
        r6("dbu_per_hour"), r6("dollars_per_hour"), r6("projected_daily_dollars"), r6("baseline_mean"),
        r6("baseline_stddev"), r6("z_score"), "signal", "reason",
    )


SCORE_SQL = (
    with_sql(*SCORING)
    + """ SELECT sha256(concat_ws('|', workspace_id, cluster_id, epoch_us(TIMESTAMP '2024-01-31'))) AS record_id, workspace_id,
      '2024-01-31 00:00:00' AS snapshot_ts, DATE '2024-01-31' AS snapshot_date, cluster_id, cluster_name, creator,
      cluster_source, node_type, driver_node_type, num_workers, photon,
      CASE WHEN photon THEN 'SKU_FAST' ELSE 'SKU_PLAIN' END AS sku_name, round(dbu, 6) AS dbu_per_hour,
      round(dph, 6) AS dollars_per_hour, round(projected, 6) AS projected_daily_dollars,
      round(baseline_mean, 6) AS baseline_mean, round(baseline_stddev, 6) AS baseline_stddev, round(z, 6) AS z_score, signal,
      reason FROM scored"""
)


@query("score_clusters", SCORE_SQL)
def q_score_clusters(spark, sf):
    return score_columns(scores(spark, sf))


@query("signal_summary", with_sql(*SCORING) + " SELECT signal, count(*) AS clusters FROM scored GROUP BY signal")
def q_signal_summary(spark, sf):
    return S.signal_summary(scores(spark, sf))


@query(
    "tier_signal",
    """SELECT event_id, CASE WHEN value * 10 > 1000 THEN 'CRITICAL' WHEN ln(value) > 4 THEN 'CRITICAL' WHEN ln(value) > 3
      THEN 'WARNING' ELSE 'OK' END AS signal FROM (SELECT event_id, CASE WHEN value > 0 THEN value END AS value FROM events)""",
)
def q_tier_signal(spark, sf):
    from tallyline.params import Thresholds

    v = F.when(F.col("value") > 0, F.col("value"))
    return b.table(spark, sf, "events").select(
        "event_id", tier_signal(v * 10, F.ln(v), Thresholds(1000.0, 3.0, 4.0)).alias("signal")
    )


# --- alerts -----------------------------------------------------------------


def alerts_sql(name: str, minutes: int, at: str = AS_OF) -> str:
    return f"""
{name} AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY workspace_id, cluster_id ORDER BY snapshot_ts DESC, record_id DESC NULLS LAST) AS rn
  FROM scores) WHERE rn = 1 AND signal IN ('WARNING', 'CRITICAL') AND record_id IS NOT NULL
  AND snapshot_ts >= TIMESTAMP '{at}' - INTERVAL {minutes} MINUTES)"""


ALERTS = (b.SCORES_SQL, alerts_sql("alerts", DAY_MINUTES))
ALERT_SELECT = """ SELECT record_id, workspace_id, strftime(snapshot_ts, '%Y-%m-%d %H:%M:%S') AS snapshot_ts, cluster_id,
  cluster_name, creator, round(projected, 6) AS projected_daily_dollars, round(z_score, 6) AS z_score, signal FROM """


def alerts(spark, sf, minutes=DAY_MINUTES):
    return A.alerts_latest(b.score_history(spark, sf), AS_OF, minutes)


def _alert_columns(df):
    return df.select(
        "record_id", "workspace_id", text_time("snapshot_ts").alias("snapshot_ts"), "cluster_id", "cluster_name", "creator",
        r6("projected_daily_dollars"), r6("z_score"), "signal",
    )


@query("alerts_latest", with_sql(b.SCORES_SQL, alerts_sql("alerts", 30)) + ALERT_SELECT + "alerts")
def q_alerts_latest(spark, sf):
    return _alert_columns(alerts(spark, sf, 30))


LAST_SEND_SQL = """
last_send AS (SELECT workspace_id, asset_id, severity, max(event_ts) AS last_sent_at FROM log
  WHERE detector_name = 'cluster_cost' AND event_type = 'message_sent' AND severity IN ('WARNING', 'CRITICAL') GROUP BY ALL)"""
KEPT_SQL = f"""
kept AS (SELECT a.* FROM alerts a LEFT JOIN last_send s ON s.workspace_id = a.workspace_id AND s.asset_id = a.cluster_id
    AND s.severity = a.signal
  WHERE s.last_sent_at IS NULL
    OR (a.signal = 'CRITICAL' AND s.last_sent_at < TIMESTAMP '{AS_OF}' - INTERVAL {WINDOWS.critical_hours} HOURS)
    OR (a.signal = 'WARNING' AND s.last_sent_at < TIMESTAMP '{AS_OF}' - INTERVAL {WINDOWS.warning_hours} HOURS))"""


@query(
    "last_send",
    with_sql(b.LOG_SQL, LAST_SEND_SQL)
    + " SELECT workspace_id, asset_id, severity, strftime(last_sent_at, '%Y-%m-%d %H:%M:%S') AS last_sent_at FROM last_send",
)
def q_last_send(spark, sf):
    return A.last_send(b.send_log(spark, sf)).select(
        "workspace_id", "asset_id", "severity", text_time("last_sent_at").alias("last_sent_at")
    )


def kept(spark, sf):
    return A.suppress_alerts(alerts(spark, sf), b.send_log(spark, sf), AS_OF, WINDOWS)


@query("suppress_alerts", with_sql(*ALERTS, b.LOG_SQL, LAST_SEND_SQL, KEPT_SQL) + ALERT_SELECT + "kept")
def q_suppress_alerts(spark, sf):
    return _alert_columns(kept(spark, sf))


OWNED_SQL = """
owned AS (SELECT a.*, p.user_id AS creator_user_id FROM alerts a LEFT JOIN people p
  ON p.email = trim(a.creator) AND contains(a.creator, '@'))"""


@query(
    "lookup_owner",
    with_sql(*ALERTS, b.DIRECTORY_SQL, OWNED_SQL) + " SELECT workspace_id, cluster_id, creator, creator_user_id FROM owned",
)
def q_lookup_owner(spark, sf):
    owned = A.lookup_owner(alerts(spark, sf), b.directory(spark, sf))
    return owned.select("workspace_id", "cluster_id", "creator", "creator_user_id")


ROUTINGS = {
    "channel": Routing("channel_only", "#ops"),
    "dm": Routing("dm_with_fallback", "#ops"),
    "dm_tee": Routing("dm_with_fallback", "#ops", tee_to_channel=True),
}


@query(
    "route_alerts",
    with_sql(*ALERTS, b.DIRECTORY_SQL, OWNED_SQL)
    + """ SELECT 'channel' AS mode, workspace_id, cluster_id, 0 AS target_no, '#ops' AS recipient, 'channel_only' AS routing FROM owned
      UNION ALL SELECT m, workspace_id, cluster_id, 0, coalesce(creator_user_id, '#ops'),
        CASE WHEN creator_user_id IS NULL THEN 'fallback_channel' ELSE 'dm' END FROM owned CROSS JOIN (VALUES ('dm'), ('dm_tee')) t(m)
      UNION ALL SELECT 'dm_tee', workspace_id, cluster_id, 1, '#ops', 'tee_channel' FROM owned WHERE creator_user_id IS NOT NULL""",
)
def q_route_alerts(spark, sf):
    owned = A.lookup_owner(alerts(spark, sf), b.directory(spark, sf))
    parts = [
        A.route_alerts(owned, routing).select(
            F.lit(mode).alias("mode"), "workspace_id", "cluster_id", "target_no", "recipient", "routing"
        )
        for mode, routing in ROUTINGS.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


PLAIN_SQL = """
plain AS (SELECT a.*, '$' || format('{:,.0f}', projected) AS formatted_dollars,
    CASE WHEN projected <> 0 AND bl.mean_daily_dollars > 0
      THEN format('{:,.0f}', (projected - bl.mean_daily_dollars) / bl.mean_daily_dollars * 100.0) || '%' ELSE '?' END AS formatted_percent
  FROM owned a LEFT JOIN baseline bl ON bl.workspace_id = a.workspace_id)"""
PLAIN = (*ALERTS, b.DIRECTORY_SQL, OWNED_SQL, *PRICED, b.BASELINE_SQL, PLAIN_SQL)
PLAIN_TEXT = "signal || ': cluster ' || cluster_name || ' projected at ' || formatted_dollars || '/day (' || formatted_percent || ' above average)'"


def plain(spark, sf):
    owned = A.lookup_owner(alerts(spark, sf), b.directory(spark, sf))
    return A.render_plain_text(owned, baseline(spark, sf))


@query(
    "render_plain_text",
    with_sql(*PLAIN) + f" SELECT workspace_id, cluster_id, formatted_dollars, formatted_percent, {PLAIN_TEXT} AS plain FROM plain",
)
def q_render_plain_text(spark, sf):
    return plain(spark, sf).select("workspace_id", "cluster_id", "formatted_dollars", "formatted_percent", "plain")


ROUTED_SQL = """
routed AS (
  SELECT *, coalesce(creator_user_id, '#ops') AS recipient,
    CASE WHEN creator_user_id IS NULL THEN 'fallback_channel' ELSE 'dm' END AS routing FROM plain
  UNION ALL SELECT *, '#ops', 'tee_channel' FROM plain WHERE creator_user_id IS NOT NULL)"""


def routed(spark, sf):
    return A.render_alert_json(A.route_alerts(plain(spark, sf), ROUTINGS["dm_tee"]), "workspace.example.com")


@query(
    "render_alert_json",
    with_sql(*PLAIN, ROUTED_SQL)
    + """ SELECT workspace_id, cluster_id, routing, json_extract_string(card, '$[0].text.text') AS title,
      json_extract_string(card, '$[1].text.text') AS summary, json_extract_string(card, '$[3].elements[0].url') AS url,
      CAST(json_array_length(card) AS INTEGER) AS parts
      FROM (SELECT *, to_json([
        {'text': {'text': CASE signal WHEN 'CRITICAL' THEN ':rotating_light:' ELSE ':warning:' END || ' Cluster Cost Alert (' || signal || ')'},
         'elements': NULL},
        {'text': {'text': CASE WHEN starts_with(recipient, 'U') THEN '<@' || recipient || '>: your cluster' ELSE 'Cluster of ' ||
           CASE WHEN creator_user_id IS NOT NULL THEN '<@' || creator_user_id || '>' WHEN trim(creator) <> '' THEN '`' || trim(creator) || '`'
             ELSE '_unknown owner_' END || ':' END || ' *' || cluster_name || '* is heading for *' || formatted_dollars || '/day*, *'
           || formatted_percent || '* above the workspace average.'}, 'elements': NULL},
        {'text': NULL, 'elements': NULL},
        {'text': NULL, 'elements': [{'url': 'https://workspace.example.com/compute/clusters/' || cluster_id}]},
        {'text': NULL, 'elements': NULL}]) AS card FROM routed)""",
)
def q_render_alert_json(spark, sf):
    path = lambda p: F.get_json_object("blocks", p)
    return routed(spark, sf).select(
        "workspace_id",
        "cluster_id",
        "routing",
        path("$[0].text.text").alias("title"),
        path("$[1].text.text").alias("summary"),
        path("$[3].elements[0].url").alias("url"),
        F.json_array_length("blocks").alias("parts"),
    )


@query(
    "event_log_rows",
    with_sql(*PLAIN, ROUTED_SQL)
    + f""" SELECT '2024-01-31 00:00:00' AS event_ts, 'message_sent' AS event_type, 'cluster_cost' AS detector_name, workspace_id,
      record_id, 'cluster' AS asset_type, cluster_id AS asset_id, cluster_name AS asset_name, signal AS severity, recipient,
      routing, '1706659200.000000' AS message_ts, {PLAIN_TEXT} AS plain, round(projected, 6) AS projected, round(z_score, 6) AS z_score,
      round(dollars_per_hour, 6) AS dollars_per_hour FROM routed""",
)
def q_event_log_rows(spark, sf):
    rows = A.event_log_rows(routed(spark, sf), AS_OF)
    detail = lambda name: F.get_json_object("details_json", f"$.{name}").cast("double")
    return rows.select(
        text_time("event_ts").alias("event_ts"), "event_type", "detector_name", "workspace_id", "record_id", "asset_type",
        "asset_id", "asset_name", "severity", "recipient", "routing", "message_ts", "plain",
        r6("projected", detail("projected_daily_dollars")), r6("z_score", detail("z_score")),
        r6("dollars_per_hour", detail("dollars_per_hour")),
    )


# --- checks -----------------------------------------------------------------


@query(
    "check_event_log",
    with_sql(b.LOG_SQL)
    + """, v AS (SELECT *, list_filter([CASE WHEN record_id IS NULL THEN 'record_id_required' END,
        CASE WHEN event_type = 'unheard_of' THEN 'event_type_recognized' END,
        CASE WHEN event_type = 'message_sent' AND NOT (has_ts AND has_details) THEN 'message_sent_complete' END,
        CASE WHEN event_type = 'message_failed' AND NOT has_details THEN 'message_failed_complete' END],
        lambda x: x IS NOT NULL) AS violations FROM log)
      SELECT strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f') AS event_ts, asset_id, event_type, len(violations) = 0 AS accepted,
      array_to_string(violations, ',') AS violations FROM v""",
)
def q_check_event_log(spark, sf):
    valid, rejected = Q.check_event_log(b.send_log(spark, sf))
    both = valid.withColumn("violations", F.array().cast("array<string>")).unionByName(rejected)
    return both.select(
        F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_ts"),
        "asset_id",
        "event_type",
        (F.size("violations") == 0).alias("accepted"),
        F.array_join("violations", ",").alias("violations"),
    )


@query(
    "check_price_overlap",
    """WITH book AS (SELECT DISTINCT 'sku' || (o_custkey % 40) AS sku, CAST(o_orderdate AS DATE) AS s,
        CAST(o_orderdate AS DATE) + CAST(1 + o_custkey % 30 AS INTEGER) AS e FROM orders),
      m AS (SELECT *, max(e) OVER (PARTITION BY sku ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM book)
      SELECT sku AS sku_name, s AS starts, e AS ends, pe AS previous_end FROM m WHERE s < pe""",
)
def q_check_price_overlap(spark, sf):
    """Orders as price changes: each order opens a price for its customer's SKU for some days."""
    o = b.table(spark, sf, "orders")
    start = F.to_date("o_orderdate")
    book = o.select(
        F.concat(F.lit("sku"), F.col("o_custkey") % 40).alias("sku_name"),
        start.alias("price_start_time"),
        F.date_add(start, (1 + F.col("o_custkey") % 30).cast("int")).alias("price_end_time"),
    ).distinct()
    return Q.check_price_overlap(book).select(
        "sku_name", F.col("price_start_time").alias("starts"), F.col("price_end_time").alias("ends"), "previous_end"
    )


@query(
    "check_heartbeat",
    with_sql(b.SCORES_SQL)
    + f""" SELECT workspace_id, strftime(max(snapshot_ts), '%Y-%m-%d %H:%M:%S') AS last_snapshot_ts,
      max(snapshot_ts) < TIMESTAMP '{AS_OF}' - INTERVAL 30 MINUTES AS stale FROM scores GROUP BY workspace_id""",
)
def q_check_heartbeat(spark, sf):
    return Q.check_heartbeat(b.score_history(spark, sf), AS_OF).select(
        "workspace_id", text_time("last_snapshot_ts").alias("last_snapshot_ts"), "stale"
    )


@query(
    "check_join_back",
    with_sql(b.LOG_SQL)
    + """, s AS (SELECT 'r' || event_id AS record_id FROM events WHERE event_id % 5 <> 0 UNION ALL
        SELECT 'r' || event_id FROM events WHERE event_id % 9 = 0)
      SELECT l.record_id, count(s.record_id) AS matches FROM (SELECT DISTINCT record_id FROM log WHERE event_type = 'message_sent') l
      LEFT JOIN s ON s.record_id = l.record_id GROUP BY l.record_id HAVING count(s.record_id) <> 1""",
)
def q_check_join_back(spark, sf):
    """Scores that miss some sent records and repeat others."""
    e = b.table(spark, sf, "events").withColumn("record_id", F.concat(F.lit("r"), F.col("event_id")))
    copies = F.array_repeat(F.lit(1), (F.col("event_id") % 5 != 0).cast("int") + (F.col("event_id") % 9 == 0).cast("int"))
    scores_ = e.select("record_id", F.to_date("ts").alias("snapshot_date"), F.explode(copies))
    return Q.check_join_back(b.send_log(spark, sf), scores_, slack_days=1)
