"""Window replacement, snapshots, state rows, schema changes, writes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyline.functions.scale import cut_lineage, local_frame, shared_dir, written
from tallyline.operators import costs as C
from tallyline.operators import state as T
from tallyline.operators.pricing import price_with_fallback
from tallyline.plans import bindings as b
from tallyline.schemas import conform_schema

SF = "/root/testdata/sf0.001"
COST = "workspace_id string, asset_type string, asset_id string, usage_date date, dollars double"


def cost(make, rows):
    return make(rows, COST)


def scope(make, rows):
    return make(rows, "workspace_id bigint, asset_type string, lookback_days int")


def rows(df):
    return sorted((r.workspace_id, r.asset_type, r.asset_id, str(r.usage_date), r.dollars) for r in df.collect())


def test_emptied_days_vanish_and_everything_else_stays(make):
    old = cost(make, [("1", "job", "a", "2024-01-20", 1.0), ("1", "job", "a", "2024-01-28", 2.0), ("1", "job", "a", "2024-01-29", 3.0),
                      ("1", "cluster", "c", "2024-01-29", 4.0), ("2", "job", "a", "2024-01-29", 5.0)])
    new = cost(make, [("1", "job", "a", "2024-01-28", 20.0)])
    out = T.replace_window(old, new, scope(make, [(1, "job", 3)]), "2024-01-31")
    assert rows(out) == [("1", "cluster", "c", "2024-01-29", 4.0), ("1", "job", "a", "2024-01-20", 1.0), ("1", "job", "a", "2024-01-28", 20.0),
                         ("2", "job", "a", "2024-01-29", 5.0)]
    assert rows(T.replace_window(old, new.filter("false"), scope(make, [(1, "job", 3)]), "2024-01-31"))[1:2] == [("1", "job", "a", "2024-01-20", 1.0)]


def rollup(spark, usage, days):
    windows = local_frame(spark, [(w, t, days) for w in range(3) for t in b.TYPES], "workspace_id bigint, asset_type string, lookback_days int")
    source = C.lens_source(usage, b.AS_OF, days)
    priced = price_with_fallback(source, b.account_prices(spark), b.list_prices(spark))
    lensed = C.lens_usage(C.daily_priced(priced), windows, b.AS_OF)
    return C.asset_cost_daily(lensed), windows


def exact(df):
    keys = ["workspace_id", "asset_type", "asset_id", "usage_date", "pricing_source"]
    return sorted(map(str, df.select(*keys, F.round("actual_daily_dollars", 6), F.round("billing_tagged_daily_dollars", 6)).collect()))


def test_rerunning_a_refresh_changes_nothing(spark):
    usage = b.usage(spark, SF)
    full, _ = rollup(spark, usage, 365)
    full = T.overwrite_table(full, b.scratch(spark, "full"))
    recent, windows = rollup(spark, usage, 10)
    once = T.replace_window(full, recent, windows, b.AS_OF)
    assert exact(once) == exact(full)
    assert exact(T.replace_window(once, recent, windows, b.AS_OF)) == exact(full)


def test_late_duplicate_and_corrected_usage_change_only_the_window(spark):
    usage = b.usage(spark, SF)
    full = T.overwrite_table(rollup(spark, usage, 365)[0], b.scratch(spark, "full"))
    again = usage.filter("usage_date in (date'2024-01-05', date'2024-01-29') and event_id % 2 = 0")
    changed = usage.withColumn("usage_quantity", F.when(F.col("usage_date") == "2024-01-28", F.col("usage_quantity") * 2).otherwise(F.col("usage_quantity")))
    recent, windows = rollup(spark, changed.unionByName(again), 10)
    after = T.replace_window(full, recent, windows, b.AS_OF)
    old = F.col("usage_date") < "2024-01-21"
    assert exact(after.filter(old)) == exact(full.filter(old))
    assert exact(after.filter("usage_date = '2024-01-29'")) != exact(full.filter("usage_date = '2024-01-29'"))
    assert exact(after.filter("usage_date = '2024-01-28'")) != exact(full.filter("usage_date = '2024-01-28'"))
    untouched = ~F.col("usage_date").isin(dt.date(2024, 1, 28), dt.date(2024, 1, 29))
    assert exact(after.filter(untouched)) == exact(full.filter(untouched))


def test_snapshot_rerun_replaces_the_day(make):
    ddl = "workspace_id string, snapshot_date date, run string"
    old = make([("1", "2024-01-30", "a"), ("1", "2024-01-31", "a"), ("2", "2024-01-31", "a")], ddl)
    out = T.replace_snapshot(old, make([("1", "2024-01-31", "b"), ("1", "2024-01-31", "b2")], ddl))
    assert sorted((r.workspace_id, r.snapshot_date.day, r.run) for r in out.collect()) == [("1", 30, "a"), ("1", 31, "b"), ("1", 31, "b2"), ("2", 31, "a")]


def test_history_start_never_moves_forward(make):
    ddl = "workspace_id string, asset_type string, history_start_date date, last_success_ts timestamp, resolver_hash string"
    old = make([("1", "job", "2023-01-01", "2024-01-01", "h"), ("1", "idle", "2023-01-01", "2024-01-01", None), ("1", "older", "2024-01-10", "2024-01-01", "h")], ddl)
    run = make([("1", "job", "2024-01-01", "2024-01-31", "h2"), ("1", "older", "2023-06-01", "2024-01-31", None), ("1", "new", "2024-01-05", "2024-01-31", "n")], ddl)
    out = {r.asset_type: (str(r.history_start_date), r.last_success_ts.day, r.resolver_hash) for r in T.upsert_refresh_state(old, run).collect()}
    assert out == {"job": ("2023-01-01", 31, "h2"), "idle": ("2023-01-01", 1, None), "older": ("2023-06-01", 31, None), "new": ("2024-01-05", 31, "n")}


def test_conform(make):
    df = make([("5", "2024-01-31 23:30:00", 1)], "a string, snapshot_ts timestamp, extra int")
    row = conform_schema(df, "a bigint, snapshot_ts timestamp, snapshot_date date, b array<string>").first()
    assert (row.a, str(row.snapshot_date), row.b, len(row)) == (5, "2024-01-31", None, 4)


def test_append_with_new_and_missing_columns(spark, make, tmp_path):
    first, second = make([(1, "x")], "a int, old string"), make([(2, "y")], "a int, new string")
    assert {(r.a, r.old, r.new) for r in T.append_merge(first, second).collect()} == {(1, "x", None), (2, None, "y")}
    T.append_table(first, str(tmp_path))
    T.append_table(second, str(tmp_path))
    assert {(r.a, r.old, r.new) for r in T.read_merged(spark, str(tmp_path)).collect()} == {(1, "x", None), (2, None, "y")}


def test_partitioned_write_prunes(spark, make, tmp_path):
    df = make([("a", "2024-01-30 23:59:59"), ("b", "2024-01-31 00:00:00")], "k string, snapshot_ts timestamp")
    T.write_by_snapshot_date(df, str(tmp_path))
    out = spark.read.parquet(str(tmp_path)).filter("snapshot_date = date'2024-01-31'")
    assert [r.k for r in out.collect()] == ["b"]
    assert "PartitionFilters: [isnotnull(snapshot_date" in out._jdf.queryExecution().executedPlan().toString()


def test_an_operator_who_switched_broadcasting_off_is_heeded(spark):
    ids = written(spark.range(10).withColumnRenamed("id", "k"))
    big = spark.range(1000).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = big.join(ids, "k", "left_anti")
        assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 990
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_checkpoints_go_to_the_configured_folder(spark):
    folder = shared_dir(spark)
    assert folder == spark.sparkContext.getCheckpointDir()
    assert cut_lineage(spark.range(5)).count() == 5


@pytest.mark.parametrize("rows_, ddl", [([], "a string, b bigint"), ([("x", None), (None, 2)], "a string, b bigint"), ([(["p"],), ([],)], "a array<string>")])
def test_local_frame(spark, rows_, ddl):
    df = local_frame(spark, rows_, ddl)
    assert [tuple(r) for r in df.collect()] == [tuple(r) for r in rows_]
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString() or not rows_
