"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from tallyline.functions.percentiles import exact_percentiles
from tallyline.functions.scale import latest_per_key
from tallyline.operators import pricing as P
from tallyline.operators.baseline import cluster_day_cost, rolling_baseline
from tallyline.plans import all_queries  # noqa: F401
from tallyline.plans import bindings as b
from tallyline.plans.registry import QUERIES
from tallyline.sources.usage import scan_usage

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["latest_per_key", "discover_clusters", "discover_jobs", "alerts_latest", "enrich_latest_meta", "latest_run_inventory"])
def test_ranking_is_limited_before_the_shuffle(spark, name):
    assert re.search(r"row_number\(\), 1, Partial", plan(QUERIES[name](spark, SF)))


def test_scan_reads_few_columns_and_pushes_the_window(spark, tmp_path):
    b.usage(spark, SF).write.partitionBy("usage_date").parquet(str(tmp_path / "u"))
    stored = spark.read.parquet(str(tmp_path / "u"))
    text = plan(scan_usage(stored, b.AS_OF, 5, "ALL_PURPOSE", "%SERVERLESS%"))
    assert "PartitionFilters: [isnotnull(usage_date" in text
    scan = scan_usage(stored, b.AS_OF, 5, "ALL_PURPOSE", "%SERVERLESS%")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        full = plan(scan)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(billing_origin_product,ALL_PURPOSE)" in full
    schema = full[full.index("ReadSchema") :]
    assert "usage_metadata:struct<cluster_id:string>" in schema
    for unused in ("custom_tags", "event_id", "account_id", "usage_unit", "job_id"):
        assert unused not in schema


def test_price_join_broadcasts_the_book_not_the_usage(spark):
    text = plan(P.price_usage(scan_usage(b.usage(spark, SF), b.AS_OF, 30), b.price_book(spark)))
    assert "BuildRight" in text and "Exchange hashpartitioning" not in text


def final_plan(df):
    df.collect()
    text = plan(df)
    return text[: text.index("== Initial Plan ==")]


@pytest.mark.parametrize("name", ["workspace_baseline", "workspace_baseline_large"])
def test_statistics_scan_usage_once(spark, name):
    """The statistics read stored cluster-days, never the usage again."""
    text = final_plan(QUERIES[name](spark, SF))
    assert "events.parquet" not in text and "lineitem.parquet" not in text


def test_replay_does_not_return_to_usage(spark):
    """Only the stored hours and the cluster dimension are read after the usage is reduced."""
    text = final_plan(QUERIES["backtest"](spark, SF))
    assert "events.parquet" not in text


def test_hot_key_results_are_whole(spark):
    """A third of all rows under one key: same numbers as the built-in functions."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 101)
    df = spark.range(60000).select(hot.alias("g"), (F.col("id") * 7919 % 10007 / 10.0).alias("v"), "id")
    got = exact_percentiles(df, ["g"], "v", {"p50": 0.5, "p99": 0.99})
    want = df.groupBy("g").agg(F.percentile("v", F.lit(0.5)).alias("w50"), F.percentile("v", F.lit(0.99)).alias("w99"))
    off = got.join(want, "g").filter((F.abs(F.col("p50") - F.col("w50")) > 1e-9) | (F.abs(F.col("p99") - F.col("w99")) > 1e-9))
    assert got.count() == want.count() and off.count() == 0
    newest = latest_per_key(df, ["g"], [F.desc("v"), F.desc("id")])
    top = df.groupBy("g").agg(F.max(F.struct("v", "id")).alias("t"))
    assert newest.join(top, "g").filter("id <> t.id").count() == 0 and newest.count() == top.count()


def test_rolling_window_sees_one_row_per_day(spark):
    """Cluster-days are summarised before the frame, so its partitions are bounded by the number of days."""
    df = spark.range(50000).select(
        F.lit(1).cast("bigint").alias("workspace_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")).alias("usage_date"),
        (F.col("id") % 1000).cast("string").alias("cluster_id"),
        (F.col("id") % 97 + 0.5).alias("dollars"),
    )
    days = cluster_day_cost(df)
    out = rolling_baseline(days, 10)
    assert out.count() == days.select("usage_date").distinct().count() - 1
    assert plan(out).index("collect_list") < plan(out).index("partial_count")
