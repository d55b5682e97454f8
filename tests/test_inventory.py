"""Discovery, payloads, normalisation, merge, snapshot."""

import json

import pytest
from pyspark.sql import functions as F

from tallyline.functions import exprs as X
from tallyline.functions.scale import written
from tallyline.operators import inventory as I
from tallyline.schemas import INVENTORY
from tallyline.sources import discovery as D
from tallyline.sources import payloads as L
from tallyline.sources.config import asset_requirements

CLUSTERS = (
    "workspace_id bigint, cluster_id string, cluster_name string, owned_by string, tags map<string,string>, cluster_source string, "
    "policy_id string, create_time timestamp, delete_time timestamp, change_time timestamp"
)


def clusters(make, rows):
    """(id, name, source, deleted, changed)"""
    return make([(1, i, n, "o", {"k": "v"}, s, "p1", None, d, c) for i, n, s, d, c in rows], CLUSTERS)


def test_newest_delete_hides_the_asset(make):
    rows = [
        ("gone", "old", "UI", None, "2024-01-01"), ("gone", "new", "UI", "2024-01-02", "2024-01-02"),
        ("back", "old", "UI", "2024-01-01", "2024-01-01"), ("back", "new", "api", None, "2024-01-02"),
        ("tie", "live", "UI", None, "2024-01-01"), ("tie", "dead", "UI", "2024-01-01", "2024-01-01"),
        ("job", "n", "JOB", None, "2024-01-01"),
        ("moved", "ui", "UI", None, "2024-01-01"), ("moved", "job", "JOB", None, "2024-01-05"),
        ("blank", "", "UI", None, "2024-01-01"),
    ]
    out = {r.asset_id: r.asset_name for r in D.discover_clusters(clusters(make, rows)).collect()}
    # The source filter comes before ranking, so the newest UI/API row of "moved" counts.
    assert out == {"back": "new", "moved": "ui", "blank": "blank"}


def test_equal_change_times_are_decided_by_the_tie_columns(make):
    rows = [("c", name, "UI", None, "2024-01-01") for name in ("b", "z", "a")]
    for order in (rows, rows[::-1]):
        assert D.discover_clusters(clusters(make, order)).first().asset_name == "z"


def test_job_owner_precedence(make):
    ddl = (
        "workspace_id bigint, job_id string, name string, run_as_user_name string, creator_user_name string, run_as string, creator_id string, "
        "tags map<string,string>, paused boolean, create_time timestamp, delete_time timestamp, change_time timestamp"
    )
    people = [("r", "c", "x", "y"), (None, "c", "x", "y"), (None, None, "x", "y"), (None, None, None, "y"), (None, None, None, None)]
    rows = [(1, str(i), None, *p, None, i == 0, None, None, "2024-01-01") for i, p in enumerate(people)]
    out = D.discover_jobs(make(rows, ddl)).orderBy("asset_id").collect()
    assert [r.owner for r in out] == ["r", "c", "x", "y", None]
    assert [r.lifecycle_state for r in out][:2] == ["PAUSED", "ACTIVE"]
    assert out[0].tags == {} and not out[0].policy_observation_complete and json.loads(out[0].raw_payload)["job_id"] == "0"


def payload(make, value):
    return make([(1, json.dumps(value))], "workspace_id bigint, payload string")


def names(row):
    return [(p.policy_type, p.policy_id) for p in row.policies]


def test_cluster_payload(make):
    body = {"cluster_id": "c", "cluster_name": "n", "creator_user_name": "o", "cluster_source": "UI", "state": "RUNNING", "policy_id": "p1",
            "custom_tags": {"owner": " me ", " ": "x"}}
    row = L.payload_clusters(payload(make, body)).first()
    assert names(row) == [("COMPUTE_POLICY", "p1")] and row.tags == {"owner": "me"} and row.lifecycle_state == "RUNNING"
    assert L.payload_clusters(payload(make, {**body, "cluster_source": "JOB"})).count() == 0


def test_job_payload(make):
    body = {"job_id": 5, "creator_user_name": "c", "run_as_user_name": "r", "effective_budget_policy_id": "b1",
            "settings": {"name": "n", "tags": {"a": "1"}, "budget_policy_id": "ignored",
                         "job_clusters": [{"new_cluster": {"policy_id": "p2"}}, {"new_cluster": {}}, {}],
                         "tasks": [{"new_cluster": {"policy_id": "p1"}},
                                   {"for_each_task": {"task": {"for_each_task": {"task": {"new_cluster": {"policy_id": "deep"}}}}}}]}}
    row = L.payload_jobs(payload(make, body)).first()
    assert (row.asset_id, row.owner, row.lifecycle_state) == ("5", "r", "ACTIVE")
    assert names(row) == [("BUDGET_POLICY", "b1"), ("COMPUTE_POLICY", "deep"), ("COMPUTE_POLICY", "p1"), ("COMPUTE_POLICY", "p2")]
    bare = L.payload_jobs(payload(make, {"job_id": 6, "creator_user_name": "c", "run_as_user_name": ""})).first()
    assert (bare.asset_name, bare.owner, bare.policies, bare.tags) == ("6", "c", [], {})


@pytest.mark.parametrize("depth", [0, 1, 6, 17])
def test_job_payload_of_any_depth(make, depth):
    task = {"new_cluster": {"policy_id": f"p{depth}"}}
    for level in reversed(range(depth)):
        task = {"new_cluster": {"policy_id": f"p{level}"}, "for_each_task": {"task": task}}
    row = L.payload_jobs(payload(make, {"job_id": 1, "creator_user_name": "c", "settings": {"tasks": [{}, task]}})).first()
    assert names(row) == sorted(("COMPUTE_POLICY", f"p{i}") for i in range(depth + 1))


def test_a_repeated_payload_gives_one_asset(make):
    body = {"cluster_id": "c", "cluster_name": "n", "cluster_source": "UI"}
    api = L.payload_clusters(payload(make, body)).unionByName(L.payload_clusters(payload(make, {**body, "cluster_name": "other"})))
    assert I.merge_inventory(api.limit(0), api).count() == 1


def test_endpoint_and_warehouse_payloads(make):
    row = L.payload_endpoints(payload(make, {"id": "x", "name": "e", "creator": "c", "budget_policy_id": "b",
                                             "tags": [{"key": "k", "value": "v"}, {"key": "bare"}, {"key": "", "value": "z"}], "state": {"ready": "READY"}})).first()
    assert (row.asset_id, row.tags, names(row), row.lifecycle_state) == ("e", {"k": "v", "bare": ""}, [("BUDGET_POLICY", "b")], "READY")
    row = L.payload_warehouses(payload(make, {"id": "w", "name": "n", "creator_name": "c", "state": "RUNNING",
                                              "tags": {"custom_tags": [{"key": "a", "value": "b"}, {"key": " ", "value": "x"}]}})).first()
    assert (row.tags, row.policies) == ({"a": "b"}, [])
    assert L.payload_warehouses(payload(make, {"id": "w"})).first().lifecycle_state == "UNKNOWN"


def test_tag_normalisation_edges(spark):
    row = spark.range(1).select(
        X.normalize_tags(F.expr("map(' a ', '1', 'a', '2', 'n', cast(null as string), '\\u00a0', 'x', 'b', ' ')")).alias("m"),
        X.normalize_tags(F.expr("cast(null as map<string,string>)")).alias("none"),
        X.merge_tags(F.expr("map('a', '1', 'b', '2')"), F.expr("map('b', '3', 'c', cast(null as string))")).alias("merged"),
    ).first()
    assert row.m == {"a": "2", "b": ""} and row.none == {} and row.merged == {"a": "1", "b": "3"}


def asset(make, rows):
    """(id, name, owner, state, tags, policies)"""
    short = make([("1", "job", *r) for r in rows],
                 "workspace_id string, asset_type string, asset_id string, asset_name string, owner string, lifecycle_state string, "
                 "tags map<string,string>, policies array<struct<policy_type:string,policy_id:string,policy_name:string>>")  # fmt: skip
    return short.selectExpr("*", "'SYSTEM_TABLE' as discovery_source", "false as api_enriched", "true as tag_observation_complete",
                            "false as policy_observation_complete", "'raw' as raw_payload")


@pytest.fixture(scope="module")
def merged(make):
    found = asset(make, [("both", "", "", "ACTIVE", {"a": "1", "b": "1"}, [("P", "1", "old"), ("P", "0", None)]), ("only", "n", "o", "ACTIVE", {"x": "y"}, [])])
    api = asset(make, [("both", "api", "api-owner", "PAUSED", {"b": "2"}, [("P", "1", "new")]), ("api", "n", None, "X", {}, [])])
    return {r.asset_id: r for r in I.merge_inventory(found, api).collect()}


def test_merge_precedence(merged):
    both = merged["both"]
    assert (both.asset_name, both.owner, both.lifecycle_state, both.tags) == ("api", "api-owner", "PAUSED", {"a": "1", "b": "2"})
    assert [(p.policy_id, p.policy_name) for p in both.policies] == [("0", None), ("1", "new")]
    assert both.api_enriched and both.policy_observation_complete and both.discovery_source == "SYSTEM_TABLE"
    assert json.loads(both.raw_payload) == {"api": "raw", "system_table": "raw"}


def test_merge_one_sided(merged):
    assert not merged["only"].api_enriched and not merged["only"].policy_observation_complete and merged["only"].raw_payload == "raw"
    assert (merged["api"].discovery_source, merged["api"].api_enriched, merged["api"].policy_observation_complete) == ("API_ONLY", True, True)
    assert len(merged) == 3


def test_snapshot_runs_and_policy_names(spark, make):
    found = asset(make, [("j", "n", "o", "ACTIVE", {"t": "v"}, [("COMPUTE_POLICY", "known", None), ("COMPUTE_POLICY", "lost", "stale"), ("BUDGET_POLICY", "b", "kept")])])
    none = found.filter("false")
    rules = I.requirement_snapshot(asset_requirements(spark), make([("1",), ("1",)], "workspace_id string"), "r1", "2024-01-31")
    listed = make([("1", "known", "Known")], "workspace_id string, policy_id string, policy_name string")
    snap = I.inventory_snapshot([found], [none], rules, "r1", "2024-01-31 10:00:00", listed)
    assert [f"{n}" for n in snap.columns] == [f.split()[0] for f in INVENTORY.split(", ")]
    row = snap.first()
    assert {p.policy_id: p.policy_name for p in row.policies} == {"known": "Known", "lost": None, "b": "kept"}
    assert (row.product, str(row.snapshot_date)) == ("WORKFLOWS", "2024-01-31")
    errors = make([("job", "API enrichment failed: X")], "asset_type string, error_message string")
    runs = {r.asset_type: r for r in I.collection_runs(snap, rules, errors).collect()}
    assert len(runs) == 4 and {r.status for r in runs.values()} == {"SUCCESS"}
    assert (runs["job"].asset_count, runs["job"].error_message) == (1, "API enrichment failed: X")
    assert (runs["warehouse"].asset_count, runs["warehouse"].error_message) == (0, None)
    assert [(r.tag_key, r.tag_value) for r in I.asset_tags(snap).collect()] == [("t", "v")]


def test_assets_are_merged_once_where_policies_are_named(spark, make):
    found = asset(make, [("j", "n", "o", "ACTIVE", {"t": "v"}, [("COMPUTE_POLICY", "known", None)])])
    rules = I.requirement_snapshot(asset_requirements(spark), make([("1",)], "workspace_id string"), "r1", "2024-01-31")
    listed = make([("1", "known", "Known")], "workspace_id string, policy_id string, policy_name string")
    stored = []

    def store(df):
        stored.append(df)
        return written(df)

    snap = I.inventory_snapshot([found], [found], rules, "r1", "2024-01-31", listed, store=store)
    plan = snap._jdf.queryExecution().executedPlan().toString()
    assert len(stored) == 1 and "FullOuter" not in plan and "Window" not in plan
    assert [(r.asset_id, r.policies[0].policy_name) for r in snap.collect()] == [("j", "Known")]


def test_requirement_hash_follows_the_configuration(spark, make):
    ws = make([("1",), ("2",)], "workspace_id string")
    base = [("cluster", "COMPUTE", True, "clusters", "cluster", [" Owner"], ["compute_policy "])]
    other = [("cluster", "COMPUTE", False, "clusters", "cluster", [" Owner"], ["compute_policy "])]
    runs = [I.requirement_snapshot(asset_requirements(spark, c), ws, f"r{i}", f"2024-01-0{i + 1}") for i, c in enumerate((base, base, other))]
    rows = runs[0].unionByName(runs[1]).unionByName(runs[2])
    first = rows.filter("collection_run_id = 'r0'").first()
    assert (first.required_tags, first.required_policies, first.enabled) == (["owner"], ["COMPUTE_POLICY"], True)
    changed = {(r.workspace_id, r.collection_run_id): r.config_changed for r in I.config_history(rows).collect()}
    assert [changed[("1", f"r{i}")] for i in range(3)] == [False, False, True]


def test_payloads_are_parsed_once(spark):
    from tallyline.plans.asset_queries import cluster_payloads, job_payloads

    for make_rows, read in ((cluster_payloads, L.payload_clusters), (job_payloads, L.payload_jobs)):
        text = read(make_rows(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("from_json") == 1 and "get_json_object" not in text, read.__name__


def test_odd_tasks(make):
    tasks = [None, 5, "x", {"new_cluster": "none"}, {"for_each_task": {"task": [1]}}, {"new_cluster": {"policy_id": 7}}, {"new_cluster": {"policy_id": " "}}]
    row = L.payload_jobs(payload(make, {"job_id": 1, "creator_user_name": "for_each_task", "settings": {"tasks": tasks, "job_clusters": None}})).first()
    assert [p.policy_id for p in row.policies] == ["7"]


def test_payloads_are_dealt_out_before_they_are_parsed(spark, tmp_path):
    """One file of one row group is read by one task, and parsed by more."""
    rows = spark.range(2000).select((F.col("id") % 3).alias("workspace_id"), F.format_string('{"job_id": %d, "settings": {"name": "n"}}', "id").alias("payload"))
    rows.coalesce(1).write.parquet(str(tmp_path / "p"))
    plan = L.payload_jobs(spark.read.parquet(str(tmp_path / "p")))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("from_json") < plan.index("RoundRobinPartitioning") < plan.index("FileScan")
    assert L.payload_jobs(spark.read.parquet(str(tmp_path / "p"))).select("asset_id").distinct().count() == 2000
