"""Compliance, lenses, rollups, marts: hand-made cases and invariants on the driver tables."""

import pytest
from pyspark.sql import functions as F

from tallyline.operators import compliance as K
from tallyline.operators import costs as C
from tallyline.params import LENS_RULES
from tallyline.plans import bindings as b
from tallyline.plans import mart_queries as M
from tallyline.schemas import ASSET_COST, conform_schema

SF = "/root/testdata/sf0.001"
ASSETS = (
    "workspace_id string, collection_run_id string, asset_type string, asset_id string, tags map<string,string>, "
    "policies array<struct<policy_type:string,policy_id:string,policy_name:string>>, tag_observation_complete boolean, "
    "policy_observation_complete boolean"
)
RULES = (
    "workspace_id string, collection_run_id string, asset_type string, required_tags array<string>, required_policies array<string>, config_hash string"
)
NO_POLICY: list = []


@pytest.mark.parametrize(
    "tags, policies, need_tags, need_policies, seen, status, missing",
    [
        ({"a": "1"}, NO_POLICY, [], [], True, ("NOT_CONFIGURED", "NOT_CONFIGURED"), ([], [])),
        ({"a": "1"}, NO_POLICY, [], [], False, ("NOT_CONFIGURED", "NOT_CONFIGURED"), (None, None)),
        ({"Cost_Center": "1"}, NO_POLICY, ["cost_center"], ["budget_policy"], True, ("APPLIED", "NOT_APPLIED"), ([], ["budget_policy"])),
        ({"cost_center": "1"}, [("BUDGET_POLICY", "b", None)], ["cost_center", "owner"], ["budget_policy"], True, ("PARTIAL", "APPLIED"), (["owner"], [])),
        ({"owner": "  "}, NO_POLICY, ["owner"], [], True, ("NOT_APPLIED", "NOT_CONFIGURED"), (["owner"], [])),
        ({"owner": "x"}, NO_POLICY, ["owner"], ["P"], False, ("UNKNOWN", "UNKNOWN"), (None, None)),
        ({"owner": "x"}, NO_POLICY, ["owner"], ["P"], None, ("UNKNOWN", "UNKNOWN"), (None, None)),
    ],
)
def test_requirement_status(make, tags, policies, need_tags, need_policies, seen, status, missing):
    assets = make([("1", "r", "job", "a", tags, policies, seen, seen)], ASSETS)
    rules = make([("1", "r", "job", need_tags, need_policies, "h"), ("1", "later", "job", ["x"], ["y"], "h2")], RULES)
    row = K.evaluate_requirements(assets, rules).first()
    assert ((row.tag_status, row.policy_status), (row.missing_required_tags, row.missing_required_policies)) == (status, missing)


def test_later_rules_do_not_rewrite_history(make):
    assets = make([("1", run, "job", "a", {"owner": "x"}, [], True, True) for run in ("r1", "r2")], ASSETS)
    rules = make([("1", "r1", "job", ["owner"], [], "h1"), ("1", "r2", "job", ["owner", "team"], [], "h2")], RULES)
    assert {r.collection_run_id: r.tag_status for r in K.evaluate_requirements(assets, rules).collect()} == {"r1": "APPLIED", "r2": "PARTIAL"}


# --- lenses -----------------------------------------------------------------

PRICED = (
    "workspace_id bigint, usage_date date, billing_origin_product string, usage_unit string, cluster_id string, job_id string, "
    "endpoint_name string, warehouse_id string, custom_tags map<string,string>, currency_code string, pricing_source string, "
    "usage_quantity double, actual_dollars double"
)


def priced(make, rows):
    """(day, product, cluster, job, tags, dollars)"""
    return make([(1, d, p, "DBU", c, j, None, "w", t, "USD", "LIST_PRICE", 1.0, x) for d, p, c, j, t, x in rows], PRICED)


def windows(make, days):
    return make([(1, t, d) for t, d in days.items()], "workspace_id bigint, asset_type string, lookback_days int")


def test_one_row_fans_out_within_each_lookback(make):
    rows = priced(make, [("2024-01-30", "ALL_PURPOSE", "c", "j", None, 5.0), ("2024-01-20", "ALL_PURPOSE", "c", "j", None, 7.0), ("2024-01-30", "SQL", "c", None, None, 2.0)])
    out = C.lens_usage(rows, windows(make, {"cluster": 5, "job": 30, "warehouse": 30}), "2024-01-31")
    assert sorted((r.asset_type, r.asset_id, r.actual_dollars) for r in out.collect()) == [
        ("cluster", "c", 5.0), ("job", "j", 5.0), ("job", "j", 7.0), ("warehouse", "w", 2.0)
    ]


@pytest.mark.parametrize("reduce_first", [False, True])
def test_null_and_empty_tags_are_untagged(make, reduce_first):
    rows = priced(make, [("2024-01-30", "X", "c", "j", t, x) for t, x in ((None, 1.0), ({}, 2.0), ({"a": "1", "b": "2"}, 4.0), ({"b": "2", "a": "1"}, 8.0))])
    rows = C.daily_priced(rows) if reduce_first else rows
    assert not reduce_first or rows.count() == 3
    lensed = C.lens_usage(rows, windows(make, {"job": 30}), "2024-01-31")
    row = C.asset_cost_daily(lensed).first()
    assert (row.billing_untagged_daily_dollars, row.billing_tagged_daily_dollars, row.actual_daily_dollars) == (3.0, 12.0, 15.0)
    tags = {(r.tag_key, r.tag_value): r.actual_daily_dollars for r in C.asset_tag_cost_daily(lensed).collect()}
    assert tags == {("a", "1"): 12.0, ("b", "2"): 12.0}


def test_plan(make):
    hashes = C.resolver_hash(LENS_RULES[0])
    enabled = make([(1, "cluster"), (1, "job"), (1, "serving_endpoint"), (1, "warehouse"), (2, "cluster")], "workspace_id bigint, asset_type string")
    state = make([(1, "cluster", None), (1, "job", None), (1, "serving_endpoint", None), (1, "warehouse", "other")], "workspace_id bigint, asset_type string, resolver_hash string")
    state = state.withColumn("resolver_hash", F.when(F.col("asset_type") == "cluster", hashes).otherwise(F.col("resolver_hash")))
    plan = C.plan_refresh(enabled.withColumn("resolver_hash", hashes), state, 35, 365)
    assert {(r.workspace_id, r.asset_type): r.lookback_days for r in plan.collect()} == {
        (1, "cluster"): 35, (1, "job"): 35, (1, "serving_endpoint"): 365, (1, "warehouse"): 365, (2, "cluster"): 365
    }
    for correction, backfill in ((0, 10), (11, 10)):
        with pytest.raises(ValueError):
            C.plan_refresh(enabled, state, correction, backfill)


# --- marts ------------------------------------------------------------------

COST = (
    "workspace_id string, usage_date date, product string, asset_type string, asset_id string, usage_unit string, currency_code string, "
    "pricing_source string, actual_daily_dollars double"
)


def cost(make, rows):
    """(day, product, type, id, unit, dollars)"""
    return make([("1", d, p, t, i, u, "USD" if u == "DBU" else "EUR", "LIST_PRICE", x) for d, p, t, i, u, x in rows], COST)


def test_trailing_windows(make):
    days = {"2024-03-31": 1, "2024-03-30": 2, "2024-03-24": 4, "2024-03-23": 8, "2024-03-01": 16, "2024-02-29": 32, "2024-01-01": 64, "2023-12-31": 128}
    row = C.trailing_cost(cost(make, [(d, "P", "job", "a", "DBU" if x > 2 else "GB", float(x)) for d, x in days.items()]), "2024-03-31").first()
    assert (row.current_day_dollars, row.previous_day_dollars, row.trailing_7d_dollars, row.trailing_30d_dollars) == (1, 2, 6, 30)
    assert (row.trailing_90d_dollars, row.month_to_date_dollars, row.year_to_date_dollars, row.total_observed_dollars) == (126, 31, 127, 255)
    assert (str(row.first_cost_date), str(row.last_cost_date), row.currency_codes) == ("2023-12-31", "2024-03-31", ["EUR", "USD"])


def test_asset_with_several_cost_rows_counts_once(make):
    history = make([("1", "2024-01-30", "P", "job", "a", "APPLIED", "UNKNOWN"), ("1", "2024-01-30", "P", "job", "b", "APPLIED", "UNKNOWN")],
                   "workspace_id string, snapshot_date date, product string, asset_type string, asset_id string, tag_status string, policy_status string")
    rows = cost(make, [("2024-01-30", "P", "job", "a", u, 1.5) for u in ("DBU", "GB", "TB")])
    row = C.asset_daily(history, rows).first()
    assert (row.asset_count, row.actual_daily_dollars) == (2, 4.5)


def test_coverage_of_zero_dollars_is_null(make):
    rows = cost(make, [("2024-01-30", "P", "job", "a", "DBU", 0.0)])
    runs = make([("1", "job", "r", "SUCCESS", "2024-01-30"), ("1", "job", "bad", "FAILED", "2024-01-31")],
                "workspace_id string, asset_type string, collection_run_id string, status string, snapshot_ts timestamp")
    assets = make([("1", "job", "a", "r"), ("1", "job", "z", "bad")], "workspace_id string, asset_type string, asset_id string, collection_run_id string")
    row = C.cost_coverage(assets, runs, rows).first()
    assert (row.asset_coverage_pct, row.dollar_coverage_pct, row.billing_only_asset_count) == (100.0, None, 0)
    assert [r.asset_id for r in C.latest_run_inventory(assets, runs).collect()] == ["a"]


def test_decimal_money_flows_through_the_rollup(make):
    rows = priced(make, [("2024-01-30", "X", "c", "j", {"a": "1"}, 0.0)]).withColumns(
        {"usage_quantity": F.lit("0.123456789").cast("decimal(38,18)"), "actual_dollars": F.lit("1.123456789012").cast("decimal(38,17)")}
    )
    out = conform_schema(C.asset_cost_daily(C.lens_usage(C.daily_priced(rows), windows(make, {"job": 9}), "2024-01-31")), ASSET_COST)
    row = out.first()
    assert str(row.actual_daily_dollars) == "1.123456789012" and str(row.billing_untagged_daily_dollars) == "0E-12"
    assert str(row.actual_daily_usage_quantity) == "0.123456789000000000"


@pytest.fixture(scope="module")
def rollup(spark):
    return M.stored_cost(spark, SF)


def total(df, column):
    return df.agg(F.sum(column)).first()[0]


def test_lens_dollars_stay_within_the_bill(spark, rollup):
    bill = total(M.fallback_priced(spark, SF, b.MART_AS_OF), "actual_dollars")
    for row in rollup.groupBy("asset_type").agg(F.sum("actual_daily_dollars").alias("d")).collect():
        assert row.d <= bill + 1e-6


def test_tagged_and_untagged_make_the_total(rollup):
    gap = F.abs(F.col("actual_daily_dollars") - F.col("billing_tagged_daily_dollars") - F.col("billing_untagged_daily_dollars"))
    assert rollup.filter(gap > 1e-9).count() == 0


def test_matched_and_billing_only_make_the_bill(spark, rollup):
    out = C.cost_coverage(b.inventory(spark, SF), b.runs(spark), rollup)
    assert total(out, "total_billed_dollars") == pytest.approx(total(rollup, "actual_daily_dollars"))
    gap = F.abs(F.col("total_billed_dollars") - F.col("inventory_matched_dollars") - F.col("billing_only_dollars"))
    assert out.filter(gap > 1e-9).count() == 0
    assert out.filter("billed_asset_count <> inventory_matched_asset_count + billing_only_asset_count").count() == 0


def test_current_view_has_one_row_per_asset_and_the_whole_bill(spark, rollup):
    current = C.asset_current(M.history(spark, SF), b.runs(spark), b.requirements(spark), rollup, b.MART_AS_OF)
    keys = ["workspace_id", "asset_type", "asset_id", "product"]
    assert current.groupBy(*keys).count().filter("count > 1").count() == 0
    assert total(current, "total_observed_dollars") == pytest.approx(total(rollup, "actual_daily_dollars"))
    assert {r.tag_status for r in current.filter("inventory_status = 'BILLING_ONLY'").collect()} == {"UNKNOWN"}
