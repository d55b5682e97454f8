"""Versioned tables: one visible step for all tables, untouched files, retired partitions, failures, clean-up."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators import versions as V
from tallyline.operators.state import replace_snapshot, replace_window

COST = ("workspace_id string, asset_type string, asset_id string, usage_date date, dollars double", ["workspace_id", "asset_type", "usage_date"])
SNAPSHOT = ("workspace_id string, snapshot_date date, asset_id string, run string", ["workspace_id", "snapshot_date"])


def files(folder):
    return {os.path.join(p, f): os.path.getmtime(os.path.join(p, f)) for p, _, names in os.walk(folder) for f in names if f.endswith(".parquet") and "_versions" not in p}


def cost_rows(spark, seed, days, kinds=("cluster", "job"), mark=0.0):
    rng = random.Random(seed)
    rows = [(w, k, f"a{rng.randint(0, 3)}", dt.date(2024, 1, d), mark + rng.randint(1, 50)) for w in "01" for k in kinds for d in days for _ in range(rng.randint(0, 2))]
    return spark.createDataFrame(rows, COST[0])


def test_windows_are_replaced_like_the_algebra_says(spark, tmp_path):
    tables = V.VersionedTables(spark, str(tmp_path), {"cost": COST, "tags": COST})
    first = cost_rows(spark, 1, range(1, 29))
    change = tables.change("r1")
    for name in ("cost", "tags"):
        change.add(name, first)
    assert change.commit() == 1
    old = tables.read("cost")
    before = files(tmp_path)
    scope = spark.createDataFrame([("0", "cluster", 5), ("1", "job", 2)], "workspace_id string, asset_type string, lookback_days int")
    inside = ((F.col("workspace_id") == "0") & (F.col("asset_type") == "cluster") & (F.col("usage_date") >= "2024-01-20")) | (
        (F.col("workspace_id") == "1") & (F.col("asset_type") == "job") & (F.col("usage_date") >= "2024-01-23")
    )
    new = cost_rows(spark, 2, range(20, 26), mark=100.0).filter(inside & (F.col("usage_date") != "2024-01-23"))
    want = sorted(map(tuple, replace_window(old, new, scope, "2024-01-25").collect()))
    change = tables.change("r2")
    V.replace_window_partitions(change, "cost", new, scope, "2024-01-25")
    assert sorted(map(tuple, tables.read("cost").collect())) == sorted(map(tuple, first.collect()))  # not visible yet
    assert change.commit() == 2
    got = sorted(map(tuple, tables.read("cost").select(*old.columns).collect()))
    assert got == want and not tables.read("cost").filter(inside & (F.col("usage_date") == "2024-01-23")).count()
    after = files(tmp_path)
    assert all(after[f] == t for f, t in before.items())  # nothing old was written again
    added = [f for f in after if f not in before]
    assert added and all("/cost/" in f for f in added)
    assert sorted(map(tuple, tables.read("tags").collect())) == sorted(map(tuple, first.collect()))
    assert sorted(map(tuple, tables.read("cost", 1).collect())) == sorted(map(tuple, first.collect()))  # the old version still reads
    text = tables.read("cost").filter("usage_date >= '2024-01-27'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(usage_date" in text and "dynamicpruning" in text
    gone = tables.vacuum()
    assert gone > 0 and tables.versions() == [2]
    assert sorted(map(tuple, tables.read("cost").select(*old.columns).collect())) == want
    assert tables.vacuum() == 0


def test_snapshots_of_several_tables_change_at_once(spark, tmp_path):
    tables = V.VersionedTables(spark, str(tmp_path), {"inventory": SNAPSHOT, "tags": SNAPSHOT})
    day = dt.date(2024, 1, 5)
    first = spark.createDataFrame([(w, d, a, "r1") for w in "01" for d in (dt.date(2024, 1, 4), day) for a in "ab"], SNAPSHOT[0])
    change = tables.change("r1")
    for name in tables.tables:
        change.add(name, first)
    change.commit()
    again = spark.createDataFrame([("0", day, "c", "r2")], SNAPSHOT[0])
    change = tables.change("r2")
    run = spark.createDataFrame([("0", day)], "workspace_id string, snapshot_date date")
    V.replace_snapshot_partitions(change, "inventory", again, run)
    V.replace_snapshot_partitions(change, "tags", again.limit(0), run)  # the run found no tags
    change.commit()
    assert sorted(map(tuple, tables.read("inventory").collect())) == sorted(map(tuple, replace_snapshot(first, again).collect()))
    left = tables.read("tags").collect()
    assert len(left) == 6 and not any(r.workspace_id == "0" and r.snapshot_date == day for r in left)
    assert tables.runs() == {"r1", "r2"}


def test_a_failure_before_the_commit_changes_nothing(spark, tmp_path):
    tables = V.VersionedTables(spark, str(tmp_path), {"a": SNAPSHOT, "b": SNAPSHOT})
    assert tables.read("a").count() == 0 and tables.versions() == []
    rows = spark.createDataFrame([("0", dt.date(2024, 1, 5), "x", "r1")], SNAPSHOT[0])
    change = tables.change("r1")
    change.add("a", rows)
    change.commit()
    failing = tables.change("r2")
    failing.add("a", rows.withColumn("run", F.lit("r2")))
    with pytest.raises(Exception):
        failing.add("b", rows.withColumn("asset_id", F.raise_error(F.lit("lost"))))
    assert [r.run for r in tables.read("a").collect()] == ["r1"] and tables.read("b").count() == 0
    os.makedirs(f"{tmp_path}/_versions/{2:010d}")  # a commit that broke off
    assert tables.versions() == [1]
    change = tables.change("r3")
    change.add("b", rows)
    assert change.commit() == 2 and tables.read("b").count() == 1 and tables.read("a").count() == 1
    stale = V.Change(tables, "r4")
    other = tables.change("r5")
    other.commit()
    with pytest.raises(Exception):
        stale.commit()
    tables.vacuum()
    assert [r.run for r in tables.read("a").collect()] == ["r1"]
