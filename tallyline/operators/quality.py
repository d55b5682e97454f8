"""Contract, overlap, freshness and audit checks.  Each returns rows; none stops a job by itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyline.params import EVENT_TYPES, AsOf, as_of_ts

# Columns every event needs, and those each event type adds.
REQUIRED = (
    "event_ts", "event_type", "detector_name", "workspace_id", "record_id", "asset_type", "asset_id", "asset_name",
)
REQUIRED_BY_TYPE = {
    "message_sent": ("severity", "recipient", "message_ts", "routing", "plain", "blocks", "details_json"),
    "message_failed": ("severity", "recipient", "routing", "plain", "blocks", "details_json"),
}


def event_log_violations(df: DataFrame) -> DataFrame:
    """Add ``violations``: the names of the rules each row breaks, in order."""
    rules = [F.when(F.col(c).isNull(), f"{c}_required") for c in REQUIRED]
    rules.append(F.when(~F.col("event_type").isin(*EVENT_TYPES), "event_type_recognized"))
    for kind, columns in REQUIRED_BY_TYPE.items():
        some_null = F.greatest(*[F.col(c).isNull() for c in columns])
        rules.append(F.when((F.col("event_type") == kind) & some_null, f"{kind}_complete"))
    return df.withColumn("violations", F.array_compact(F.array(*rules)))


def check_event_log(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split into rows that honour the contract and rejected rows with their violations."""
    marked = event_log_violations(df)
    return marked.filter(F.size("violations") == 0).drop("violations"), marked.filter(F.size("violations") > 0)


def require_event_log(df: DataFrame) -> DataFrame:
    """Strict form for writers: the first violating row fails the job."""
    marked = event_log_violations(df)
    broken = F.concat(F.lit("event log contract broken: "), F.array_join("violations", ", "))
    # The guard sits in a filter, which no later projection can prune away.
    return marked.filter(F.when(F.size("violations") > 0, F.raise_error(broken).cast("boolean")).otherwise(True)).drop(
        "violations"
    )


def check_price_overlap(book: DataFrame, keys: Sequence[str] = ("sku_name",)) -> DataFrame:
    """Price rows that start before an earlier row of the same key has ended."""
    order = Window.partitionBy(*keys).orderBy("price_start_time", "price_end_time")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    return (
        book.withColumn("previous_end", F.max("price_end_time").over(earlier))
        .filter(F.col("price_start_time") < F.col("previous_end"))
        .select(*keys, "price_start_time", "price_end_time", "previous_end")
    )


def check_heartbeat(scores: DataFrame, as_of: AsOf, minutes: int = 30) -> DataFrame:
    """Per workspace: the newest snapshot, and whether it is older than it should be."""
    limit = as_of_ts(as_of) - F.make_dt_interval(mins=F.lit(minutes))
    return (
        scores.groupBy("workspace_id")
        .agg(F.max("snapshot_ts").alias("last_snapshot_ts"))
        .withColumn("stale", F.col("last_snapshot_ts") < limit)
    )


def check_join_back(log: DataFrame, scores: DataFrame, slack_days: int | None = None) -> DataFrame:
    """Sent record ids that do not match exactly one score row.

    Scores are held against the sent ids before they are counted, so only
    matches are shuffled when the ids are few, and Spark's runtime filter drops
    others when they are many.  With ``slack_days``, scores are read for the days
    of the sends and so many days before alone (a send follows its score within
    the alert age limit, so 1 is enough); both days are found at run time and
    prune the partitions of ``snapshot_date``.
    """
    sends = log.filter(F.col("event_type") == "message_sent")
    if slack_days is not None:
        first, last = (sends.agg(f(F.to_date("event_ts"))).scalar() for f in (F.min, F.max))
        scores = scores.filter((F.col("snapshot_date") >= F.date_sub(first, slack_days)) & (F.col("snapshot_date") <= last))
    sent = sends.select("record_id").distinct()
    counts = scores.select("record_id").join(sent, "record_id", "left_semi").groupBy("record_id").agg(F.count("*").alias("matches"))
    joined = sent.join(counts, "record_id", "left").withColumn("matches", F.coalesce("matches", F.lit(0)))
    return joined.filter(F.col("matches") != 1)
