"""Sent records against scores: pruned days, matches counted only."""

from pyspark.sql import functions as F

from tallyline.operators import quality as Q


def test_only_the_days_of_the_sends_are_read(spark, make, tmp_path):
    scores = spark.range(4000).select(
        F.concat(F.lit("r"), F.col("id") % 3990).alias("record_id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("snapshot_date")
    )
    scores.write.partitionBy("snapshot_date").parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    log = make([("r24", "2024-01-25 10:00:00", "message_sent"), ("r25", "2024-01-26 10:00:00", "message_sent"), ("zz", "2024-01-26 11:00:00", "message_sent"),
                (None, "2024-01-26 11:00:00", "message_sent"), ("r1", "2024-01-02 00:00:00", "message_failed"), ("r3984", "2024-01-25 12:00:00", "message_sent")],
               "record_id string, event_ts timestamp, event_type string")
    out = Q.check_join_back(log, stored, slack_days=1)
    assert sorted((str(r.record_id), r.matches) for r in out.collect()) == [("None", 0), ("zz", 0)]
    assert sorted(map(str, out.collect())) == sorted(map(str, Q.check_join_back(log, stored).collect()))
    text = out._jdf.queryExecution().executedPlan().toString()
    line = next(x for x in text.splitlines() if "FileScan parquet" in x and "snapshot_date" in x)
    assert "ubquery" in line.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_repeated_scores_are_found(spark, make):
    log = make([("a", "2024-01-25 10:00:00", "message_sent"), ("a", "2024-01-25 11:00:00", "message_sent"), ("b", "2024-01-25 11:00:00", "message_sent")], "record_id string, event_ts timestamp, event_type string")
    scores = make([("a", "2024-01-25"), ("a", "2024-01-24"), ("b", "2024-01-25")], "record_id string, snapshot_date date")
    assert [tuple(r) for r in Q.check_join_back(log, scores, 1).collect()] == [("a", 2)]
