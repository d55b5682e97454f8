"""Streams: watermark, replays, state across runs."""

import pytest
from pyspark.sql import functions as F
from test_alerts import score_rows
from test_pricing import book

from tallyline.operators.state import append_table
from tallyline.plans import bindings as b
from tallyline.functions.storage import children
from tallyline.streaming import jobs
from tallyline.streaming.jobs import HOURS_SCHEMA, LOG_SCHEMA, hours_of_parts, stream_hour_parts, stream_hourly_spend, stream_suppress

USAGE = "workspace_id bigint, cluster_id string, sku_name string, usage_start_time timestamp, dbus double"


def run_hourly(spark, inbox, schema, price, out, checkpoint):
    hourly = stream_hourly_spend(spark.readStream.schema(schema).parquet(inbox), price, "1 hour")
    job = hourly.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    job.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return sorted((r.hour_of_day, r.cluster_id, r.dollars) for r in spark.read.schema(hourly.schema).parquet(out).collect())


def test_hours_close_with_the_watermark_and_late_rows_drop(spark, make):
    inbox, out, checkpoint = (b.scratch(spark, n) for n in ("in", "out", "cp"))
    first = make([(1, "a", "S", "2024-01-10 01:10:00", 1.0), (1, "a", "S", "2024-01-10 01:50:00", 2.0), (1, "a", "X", "2024-01-10 02:10:00", 4.0),
                  (1, "a", "S", "2024-01-10 04:30:00", 8.0)], USAGE)
    append_table(first, inbox)
    assert run_hourly(spark, inbox, first.schema, book(make), out, checkpoint) == [(1, "a", 3.0), (2, "a", 0.0)]
    append_table(make([(1, "a", "S", "2024-01-10 01:20:00", 100.0), (1, "a", "S", "2024-01-10 04:40:00", 16.0), (1, "a", "S", "2024-01-10 07:00:00", 1.0)], USAGE), inbox)
    assert run_hourly(spark, inbox, first.schema, book(make), out, checkpoint) == [(1, "a", 3.0), (2, "a", 0.0), (4, "a", 24.0)]


def send(spark, make, inbox, log, checkpoint, rows):
    scores = score_rows(make, rows)
    append_table(scores, inbox)
    stream_suppress(spark.readStream.schema(scores.schema).parquet(inbox), log, checkpoint).awaitTermination()
    out = spark.read.schema(LOG_SCHEMA).parquet(log)
    return sorted((r.record_id, r.severity) for r in out.collect())


def test_suppression_state_survives_between_runs(spark, make):
    inbox, log, checkpoint = (b.scratch(spark, n) for n in ("in", "log", "cp"))
    go = lambda *rows: send(spark, make, inbox, log, checkpoint, rows)
    assert go(("1", "c", "2024-01-10 01:00:00", "WARNING"), ("2", "d", "2024-01-10 01:00:00", "OK")) == [("1", "WARNING")]
    # Same tier within a day is quiet; the higher tier is not.
    assert go(("3", "c", "2024-01-10 05:00:00", "WARNING")) == [("1", "WARNING")]
    assert go(("4", "c", "2024-01-10 05:15:00", "CRITICAL")) == [("1", "WARNING"), ("4", "CRITICAL")]
    assert go(("5", "c", "2024-01-10 09:15:00", "CRITICAL")) == [("1", "WARNING"), ("4", "CRITICAL")]
    assert go(("6", "c", "2024-01-10 09:15:01", "CRITICAL"))[-1] == ("6", "CRITICAL")
    # Nothing new arrived: nothing is sent.
    stream = spark.readStream.schema(score_rows(make, []).schema).parquet(inbox)
    stream_suppress(stream, log, checkpoint).awaitTermination()
    assert spark.read.schema(LOG_SCHEMA).parquet(log).count() == 3


def test_a_replayed_batch_sends_once(spark, make):
    """The same input under a fresh checkpoint replays batch 0 into the same log."""
    inbox, log = b.scratch(spark, "in"), b.scratch(spark, "log")
    rows = (("1", "c", "2024-01-10 01:00:00", "WARNING"), ("2", "d", "2024-01-10 01:00:00", "CRITICAL"))
    first = send(spark, make, inbox, log, b.scratch(spark, "cp"), rows)
    stream = spark.readStream.schema(score_rows(make, []).schema).parquet(inbox)
    stream_suppress(stream, log, b.scratch(spark, "cp")).awaitTermination()
    again = spark.read.schema(LOG_SCHEMA).parquet(log)
    assert sorted((r.record_id, r.severity) for r in again.collect()) == first
    assert again.select(F.max("batch")).first()[0] == 0


def test_a_new_checkpoint_keeps_earlier_sends(spark, make):
    inbox, log, checkpoint = (b.scratch(spark, n) for n in ("in", "log", "cp"))
    send(spark, make, inbox, log, checkpoint, [("1", "c", "2024-01-10 01:00:00", "WARNING")])
    send(spark, make, inbox, log, checkpoint, [("2", "d", "2024-01-10 01:15:00", "WARNING")])
    fresh = b.scratch(spark, "in")
    out = send(spark, make, fresh, log, b.scratch(spark, "cp"), [("3", "c", "2024-01-10 02:00:00", "WARNING"), ("4", "e", "2024-01-10 02:00:00", "WARNING")])
    assert out == [("1", "WARNING"), ("2", "WARNING"), ("4", "WARNING")]


def add_parts(spark, make, inbox, path, checkpoint, rows):
    usage = make(rows, USAGE)
    append_table(usage, inbox)
    stream_hour_parts(spark.readStream.schema(usage.schema).parquet(inbox), book(make), path, checkpoint, "1 hour").awaitTermination()
    return sorted((r.hour_of_day, r.cluster_id, r.dollars, r.late_dollars) for r in hours_of_parts(spark, path).collect())


def test_late_rows_become_corrections(spark, make):
    inbox, path, checkpoint = (b.scratch(spark, n) for n in ("in", "parts", "cp"))
    got = add_parts(spark, make, inbox, path, checkpoint, [(1, "a", "S", "2024-01-10 01:10:00", 1.0), (1, "a", "S", "2024-01-10 01:50:00", 2.0), (1, "a", "S", "2024-01-10 04:30:00", 8.0)])
    assert got == [(1, "a", 3.0, 0.0), (4, "a", 8.0, 0.0)]  # the open hour is there as well
    # hours up to 3:30 are closed: 1:20 comes late, 3:05 and 4:40 do not
    got = add_parts(spark, make, inbox, path, checkpoint, [(1, "a", "S", "2024-01-10 01:20:00", 100.0), (1, "a", "S", "2024-01-10 03:05:00", 5.0), (1, "a", "S", "2024-01-10 04:40:00", 16.0)])
    assert got == [(1, "a", 103.0, 100.0), (3, "a", 5.0, 0.0), (4, "a", 24.0, 0.0)]
    parts = spark.read.schema(HOURS_SCHEMA).parquet(f"{path}/hours")
    assert sorted((r.batch, r.hour_of_day, r.late) for r in parts.collect()) == [(0, 1, False), (0, 4, False), (1, 1, True), (1, 3, False), (1, 4, False)]
    # nothing new: nothing counts twice; another checkpoint is refused
    stream = spark.readStream.schema(make([], USAGE).schema).parquet(inbox)
    stream_hour_parts(stream, book(make), path, checkpoint, "1 hour").awaitTermination()
    assert sorted((r.hour_of_day, r.cluster_id, r.dollars, r.late_dollars) for r in hours_of_parts(spark, path).collect()) == got
    with pytest.raises(Exception, match="another checkpoint"):
        stream_hour_parts(stream, book(make), path, b.scratch(spark, "cp"), "1 hour").awaitTermination()


def parts(spark, log):
    return [f"{d}/{p}" for d in children(spark, log) if d.startswith("event_date=") for p in children(spark, f"{log}/{d}") if p.startswith("part=")]


def test_the_log_is_dated_and_folded(spark, make, monkeypatch):
    inbox, log, checkpoint = (b.scratch(spark, n) for n in ("in", "log", "cp"))

    def go(n, day="2024-01-10"):
        scores = score_rows(make, [(str(n), f"c{n % 5}", f"{day} {n % 20:02d}:00:00", "CRITICAL")])
        append_table(scores, inbox)
        stream_suppress(spark.readStream.schema(scores.schema).parquet(inbox), log, checkpoint, fold_at=3).awaitTermination()

    for n in range(5):
        go(n)
    assert len(parts(spark, log)) <= 4
    real, given = jobs.delete, list(range(5))

    def stopped(spark, path):
        if "/event_date=" in path:
            raise OSError("stopped")
        real(spark, path)

    monkeypatch.setattr(jobs, "delete", stopped)
    with pytest.raises(Exception):
        for n in range(5, 9):  # a fold stops after its rows are in place and before its parts are gone
            given.append(n)
            go(n)
    monkeypatch.setattr(jobs, "delete", real)
    for n in range(9, 12):
        go(n)
    go(40, "2024-01-13")
    got = sorted((r.record_id, r.batch) for r in spark.read.schema(LOG_SCHEMA).parquet(log).collect())
    assert len(got) == len(set(got)) and len(parts(spark, log)) <= 5
    ids = {int(i) for i, _ in got}
    assert ids == {*given, 9, 10, 11, 40}  # a cluster is sent again after five hours, as the window is four
    text = jobs.read_log(spark, log, jobs.as_of_ts("2024-01-13 05:00:00"))._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in text.split("PartitionFilters")[1].split("PushedFilters")[0]
