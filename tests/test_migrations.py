"""Old layouts reach the new one, once."""

import os

import pytest
from pyspark.sql import functions as F

from tallyline.operators.migrations import Step, TableFolder

STEPS = [
    Step("asset_log", to="event_log"),
    Step("event_log", rename={"kind": "event_type"}, add="recipient string, tries bigint"),
    Step("event_log", cast="workspace_id string, amount decimal(20,4)"),
    Step("never_there", add="x int"),
    Step("runs", add="error_message string"),
]


def folder(spark, path):
    spark.createDataFrame([(1, "sent", 1.5), (2, "failed", None)], "workspace_id bigint, kind string, amount double").write.parquet(f"{path}/asset_log")
    spark.createDataFrame([("r1",)], "run string").write.parquet(f"{path}/runs")
    return TableFolder(spark, str(path))


def test_an_old_layout_reaches_the_new_one_once(spark, tmp_path):
    tables = folder(spark, tmp_path)
    assert tables.migrate(STEPS[:1]) == 1
    assert tables.paths()["event_log"] == "asset_log"  # a new name moves nothing
    assert tables.migrate(STEPS) == 4 and tables.level() == 5
    log = tables.read("event_log")
    assert log.schema.simpleString() == "struct<workspace_id:string,event_type:string,amount:decimal(20,4),recipient:string,tries:bigint>"
    assert sorted(map(str, log.select("workspace_id", "event_type", F.col("amount").cast("string"), "recipient").collect())) == sorted(
        map(str, spark.createDataFrame([("1", "sent", "1.5000", None), ("2", "failed", None, None)], "workspace_id string, event_type string, amount string, recipient string").collect())
    )
    assert sorted(tables.paths()) == ["event_log", "runs"]
    before = sorted(os.listdir(tmp_path))
    assert tables.migrate(STEPS) == 0 and sorted(os.listdir(tmp_path)) == before
    assert tables.migrate([*STEPS, Step("runs", add="error_message string, later date")]) == 1
    assert tables.read("runs").columns == ["run", "error_message", "later"]


def test_a_failing_step_leaves_the_layout_before_it(spark, tmp_path):
    tables = folder(spark, tmp_path)
    bad = [STEPS[0], Step("event_log", rename={"kind": "amount"})]
    with pytest.raises(ValueError):
        tables.migrate(bad)
    assert tables.level() == 1 and tables.read("event_log").count() == 2
    os.makedirs(f"{tmp_path}/_layout/000002")  # a record that broke off
    assert tables.level() == 1 and tables.migrate(STEPS[:2]) == 1 and tables.level() == 2
    with pytest.raises(ValueError):
        tables.migrate([*STEPS[:2], Step("runs", to="event_log")])
