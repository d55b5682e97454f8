"""Fresh alerts, suppression, routing, messages and the audit log, all as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.exprs import dollars_text, filled, percent_above_text
from tallyline.functions.scale import latest_per_key
from tallyline.params import ALERT_SIGNALS, DETECTOR, AsOf, Routing, SuppressionWindows, as_of_ts
from tallyline.schemas import EVENT_LOG, conform_schema

ALERT_COLUMNS = (
    "record_id", "workspace_id", "snapshot_ts", "cluster_id", "cluster_name", "creator", "node_type", "num_workers",
    "photon", "sku_name", "dbu_per_hour", "dollars_per_hour", "projected_daily_dollars", "z_score", "signal", "reason",
)


def alerts_latest(scores: DataFrame, as_of: AsOf, minutes: int = 30) -> DataFrame:
    """Clusters whose newest score is a fresh WARNING or CRITICAL.

    The age limit is applied before ranking: a row newer than the limit outranks
    every older one, so the result is the same and old partitions are not read.
    The signal is tested after ranking, so a newer OK row resolves an alert.
    """
    oldest = as_of_ts(as_of) - F.make_dt_interval(mins=F.lit(minutes))
    fresh = scores.filter(F.col("snapshot_ts") >= oldest)
    if "snapshot_date" in scores.columns:
        fresh = fresh.filter(F.col("snapshot_date") >= F.to_date(oldest))
    newest = latest_per_key(
        fresh, ["workspace_id", "cluster_id"], [F.desc("snapshot_ts"), F.desc_nulls_last("record_id")]
    )
    return newest.filter(F.col("signal").isin(*ALERT_SIGNALS) & F.col("record_id").isNotNull()).select(*ALERT_COLUMNS)


def _sends(log: DataFrame, detector: str) -> DataFrame:
    return log.filter(
        (F.col("detector_name") == detector)
        & (F.col("event_type") == "message_sent")
        & F.col("severity").isin(*ALERT_SIGNALS)
    )


def last_send(log: DataFrame, detector: str = DETECTOR) -> DataFrame:
    return _sends(log, detector).groupBy("workspace_id", "asset_id", "severity").agg(
        F.max("event_ts").alias("last_sent_at")
    )


def suppress_alerts(
    alerts: DataFrame,
    log: DataFrame,
    as_of: AsOf,
    windows: SuppressionWindows = SuppressionWindows(),
    detector: str = DETECTOR,
) -> DataFrame:
    """Drop alerts whose tier was sent for the same cluster within the tier's window.

    A send suppresses exactly when it is not strictly older than the window, so
    only the log's last few hours are read and an anti join decides.
    """
    now = as_of_ts(as_of)
    still_quiet = F.lit(False)
    for tier, hours in windows.hours().items():
        since = now - F.make_dt_interval(hours=F.lit(hours))
        still_quiet = still_quiet | ((F.col("severity") == tier) & (F.col("event_ts") >= since))
    longest = now - F.make_dt_interval(hours=F.lit(max(windows.hours().values())))
    recent = (
        _sends(log.filter(F.col("event_ts") >= longest), detector)
        .filter(still_quiet)
        .select("workspace_id", F.col("asset_id").alias("cluster_id"), F.col("severity").alias("signal"))
        .distinct()
    )
    return alerts.join(recent, ["workspace_id", "cluster_id", "signal"], "left_anti").select(*alerts.columns).orderBy(
        "workspace_id", "cluster_id"
    )


def lookup_owner(alerts: DataFrame, directory: DataFrame) -> DataFrame:
    """Add ``creator_user_id`` from a directory of (email, user_id); blank or malformed emails match nothing."""
    email = F.trim("creator")
    people = directory.groupBy("email").agg(F.min("user_id").alias("creator_user_id"))
    return (
        alerts.withColumn("_email", F.when(email.contains("@"), email))
        .join(people, F.col("_email") == F.col("email"), "left")
        .select(*alerts.columns, "creator_user_id")
    )


def route_alerts(alerts: DataFrame, routing: Routing) -> DataFrame:
    """One row per destination, numbered in sending order."""
    if routing.mode not in ("channel_only", "dm_with_fallback"):
        raise ValueError(f"unknown routing mode {routing.mode!r}")
    owner = filled(F.col("creator_user_id"))

    def to(recipient: Column, how: str) -> Column:
        return F.struct(recipient.cast("string").alias("recipient"), F.lit(how).alias("routing"))

    channel = F.lit(routing.channel)
    if routing.mode == "channel_only":
        targets = F.array(to(channel, "channel_only"))
    else:
        direct = [to(owner, "dm")] + ([to(channel, "tee_channel")] if routing.tee_to_channel else [])
        targets = F.when(owner.isNotNull(), F.array(*direct)).otherwise(F.array(to(channel, "fallback_channel")))
    return alerts.select("*", F.posexplode(targets).alias("target_no", "_to")).select(
        *alerts.columns, "target_no", "_to.recipient", "_to.routing"
    )


def latest_baseline(baseline: DataFrame) -> DataFrame:
    """The newest baseline row of every workspace."""
    return latest_per_key(baseline, ["workspace_id"], [F.desc("computed_at"), F.desc("n_cluster_days")])


def render_plain_text(alerts: DataFrame, baseline: DataFrame) -> DataFrame:
    """Add the formatted amounts and the one-line message."""
    mean = latest_baseline(baseline).select("workspace_id", F.col("mean_daily_dollars").alias("_mean"))
    amount = F.col("projected_daily_dollars")
    rows = (
        alerts.join(mean, "workspace_id", "left")
        .withColumn("formatted_dollars", dollars_text(amount))
        .withColumn("formatted_percent", percent_above_text(amount, F.col("_mean")))
    )
    plain = F.concat(
        F.col("signal"), F.lit(": cluster "), F.col("cluster_name"), F.lit(" projected at "),
        F.col("formatted_dollars"), F.lit("/day ("), F.col("formatted_percent"), F.lit(" above average)"),
    )
    return rows.select(*alerts.columns, "formatted_dollars", "formatted_percent", plain.alias("plain"))


def _text(kind: str, text: Column) -> Column:
    return F.struct(F.lit(kind).alias("type"), text.alias("text"))


def render_alert_json(alerts: DataFrame, host: str, sender: str = "cost monitor") -> DataFrame:
    """Add ``blocks``: the message card as a JSON array (title, two paragraphs, link, footer)."""
    icon = F.when(F.col("signal") == "CRITICAL", ":rotating_light:").otherwise(":warning:")
    title = F.concat(icon, F.lit(" Cluster Cost Alert ("), F.col("signal"), F.lit(")"))
    # Member ids start with U; anything else is a channel.
    to_person = F.col("recipient").rlike("^U[A-Z0-9]{6,}$")
    owner = (
        F.when(filled(F.col("creator_user_id")).isNotNull(), F.concat(F.lit("<@"), F.col("creator_user_id"), F.lit(">")))
        .when(filled(F.trim("creator")).isNotNull(), F.concat(F.lit("`"), F.trim("creator"), F.lit("`")))
        .otherwise("_unknown owner_")
    )
    who = F.when(to_person, F.concat(F.lit("<@"), F.col("recipient"), F.lit(">: your cluster"))).otherwise(
        F.concat(F.lit("Cluster of "), owner, F.lit(":"))
    )
    summary = F.concat(
        who, F.lit(" *"), F.col("cluster_name"), F.lit("* is heading for *"), F.col("formatted_dollars"),
        F.lit("/day*, *"), F.col("formatted_percent"), F.lit("* above the workspace average."),
    )
    advice = F.lit("Check its size and idle time, or ask an administrator to exempt it if this is expected.")
    url = F.concat(F.lit(f"https://{host}/compute/clusters/"), F.col("cluster_id"))
    link = F.struct(
        F.lit("button").alias("type"), _text("plain_text", F.lit("Review cluster")).alias("text"), url.alias("url"),
        F.lit("primary").alias("style"),
    )
    parts = [
        F.struct(F.lit("header").alias("type"), _text("plain_text", title).alias("text")),
        F.struct(F.lit("section").alias("type"), _text("mrkdwn", summary).alias("text")),
        F.struct(F.lit("section").alias("type"), _text("mrkdwn", advice).alias("text")),
        F.struct(F.lit("actions").alias("type"), F.array(link).alias("elements")),
        F.struct(
            F.lit("context").alias("type"), F.array(_text("mrkdwn", F.lit(f"Sent by {sender}"))).alias("elements")
        ),
    ]
    card = F.concat(F.lit("["), F.concat_ws(",", *[F.to_json(p) for p in parts]), F.lit("]"))
    return alerts.withColumn("blocks", card)


def event_log_rows(
    routed: DataFrame, as_of: AsOf, message_ts: Column | None = None, detector: str = DETECTOR
) -> DataFrame:
    """Audit rows of delivered messages.

    ``message_ts`` is the delivery id a sender got back; without one the
    reference time in seconds stands in.
    """
    now = as_of_ts(as_of)
    stamp = F.format_string("%d.%06d", F.unix_seconds(now), F.lit(0)) if message_ts is None else message_ts
    details = F.to_json(
        F.struct("projected_daily_dollars", "z_score", "dollars_per_hour"), {"ignoreNullFields": "false"}
    )
    rows = routed.select(
        now.alias("event_ts"),
        F.lit("message_sent").alias("event_type"),
        F.lit(detector).alias("detector_name"),
        "workspace_id",
        "record_id",
        F.lit("cluster").alias("asset_type"),
        F.col("cluster_id").alias("asset_id"),
        F.col("cluster_name").alias("asset_name"),
        F.col("signal").alias("severity"),
        "recipient",
        "routing",
        stamp.alias("message_ts"),
        "plain",
        "blocks",
        details.alias("details_json"),
    )
    return conform_schema(rows, EVENT_LOG)
