"""Jobs that break off between any two steps and run again end like jobs that did not."""

import pytest
from pyspark.sql import functions as F

from tallyline.operators import jobs as J
from tallyline.operators import versions as V
from tallyline.operators.costs import resolver_hash
from tallyline.params import LENS_RULES
from tallyline.plans import bindings as b
from tallyline.sources.config import asset_requirements

SF = "/root/testdata/sf0.001"


class Stopped(Exception):
    pass


def stop_at(monkeypatch, owner, name, call):
    """Let the ``call``-th use of a method fail."""
    real, seen = getattr(owner, name), []

    def wrapped(self, *args, **kwargs):
        seen.append(1)
        if len(seen) == call:
            raise Stopped
        return real(self, *args, **kwargs)

    monkeypatch.setattr(owner, name, wrapped)
    return lambda: monkeypatch.setattr(owner, name, real)


def content(tables):
    drop = {"raw_payload"}
    return {name: sorted(str([r[c] for c in schema.fieldNames() if c not in drop]) for r in tables.read(name).collect()) for name, (schema, _) in tables.tables.items()}


@pytest.fixture(scope="module")
def inputs(spark):
    usage = b.usage(spark, SF).filter("usage_date >= '2024-01-23' AND workspace_id < 1")
    rules = F.array(*[F.struct(F.lit(r.asset_type).alias("asset_type"), resolver_hash(r).alias("resolver_hash")) for r in LENS_RULES[:2]])
    enabled = usage.select("workspace_id").distinct().select("workspace_id", F.inline(rules))
    return usage, b.account_prices(spark), b.list_prices(spark), enabled


def refresh(tables, inputs, run, as_of, usage=None):
    given, contract, list_, enabled = inputs
    return J.refresh_costs(tables, given if usage is None else usage, contract, list_, enabled, as_of, run, 3, 40)


@pytest.fixture(scope="module")
def smooth(spark, inputs, tmp_path_factory):
    tables = J.cost_tables(spark, str(tmp_path_factory.mktemp("smooth")), double=True)
    early = inputs[0].filter("event_id % 4 <> 0")
    assert refresh(tables, inputs, "a", "2024-01-25", early) == 1
    assert refresh(tables, inputs, "b", "2024-01-28") == 2
    return content(tables)


@pytest.mark.parametrize("owner, name, call", [(J.Journal, "step", 2), (V.Change, "add", 3), (V.Change, "commit", 1), (J.Journal, "close", 1)])
def test_cost_refresh_resumes(spark, inputs, smooth, tmp_path, monkeypatch, owner, name, call):
    tables = J.cost_tables(spark, str(tmp_path), double=True)
    refresh(tables, inputs, "a", "2024-01-25", inputs[0].filter("event_id % 4 <> 0"))
    before = content(tables) if name != "close" else smooth
    heal = stop_at(monkeypatch, owner, name, call)
    with pytest.raises(Stopped):
        refresh(tables, inputs, "b", "2024-01-28")
    heal()
    assert content(tables) == before
    assert refresh(tables, inputs, "b", "2024-01-28") == 2
    assert content(tables) == smooth
    assert refresh(tables, inputs, "b", "2024-01-28") == 2 and tables.versions() == [1, 2]  # published once


def test_a_resumed_run_does_not_repeat_finished_steps(spark, inputs, tmp_path, monkeypatch):
    tables = J.cost_tables(spark, str(tmp_path), double=True)
    heal = stop_at(monkeypatch, V.Change, "commit", 1)
    with pytest.raises(Stopped):
        refresh(tables, inputs, "a", "2024-01-28")
    heal()
    lost = inputs[0].withColumn("usage_quantity", F.raise_error(F.lit("read again")).cast("double"))
    assert refresh(tables, inputs, "a", "2024-01-28", lost) == 1
    assert tables.read("asset_cost_daily").count() > 0


def test_nothing_enabled_changes_nothing(spark, inputs, tmp_path):
    tables = J.cost_tables(spark, str(tmp_path), double=True)
    usage, contract, list_, enabled = inputs
    assert J.refresh_costs(tables, usage, contract, list_, enabled.limit(0), "2024-01-28", "a", 3, 40) == 0
    assert tables.versions() == []


ASSET = (
    "workspace_id string, asset_type string, asset_id string, asset_name string, owner string, lifecycle_state string, tags map<string,string>, "
    "policies array<struct<policy_type:string,policy_id:string,policy_name:string>>, discovery_source string, api_enriched boolean, "
    "tag_observation_complete boolean, policy_observation_complete boolean, raw_payload string"
)
CONFIG = [("cluster", "COMPUTE", True, "clusters", "cluster", ["owner"], [])]


def asset(ident, tags):
    return ("0", "cluster", ident, ident, "me", "ACTIVE", tags, [("COMPUTE_POLICY", "p1", None)], "SYSTEM_TABLE", False, True, True, None)


def test_inventory_run_is_all_or_nothing(spark, tmp_path, monkeypatch):
    tables = J.inventory_tables(spark, str(tmp_path))
    workspaces = spark.createDataFrame([("0",)], "workspace_id string")
    policies = spark.createDataFrame(
        [("0", "p1", "small", None, '{"a":{"type":"fixed","value":1}}', "f1", '{"b":2}')],
        "workspace_id string, policy_id string, name string, description string, definition string, policy_family_id string, policy_family_definition_overrides string",
    )
    families = spark.createDataFrame([("f1", '{"c":3}')], "policy_family_id string, definition string")
    config = asset_requirements(spark, CONFIG)

    def run(assets, ident, **more):
        found = spark.createDataFrame(assets, ASSET)
        return J.run_inventory(tables, [more.get("first", found)], [found.limit(0)], config, workspaces, policies, families, ident, "2024-01-05 06:00:00")

    assert run([asset("a", {"k": "v"}), asset("b", {"k": "w"})], "r1") == 1
    before = content(tables)
    broken = spark.createDataFrame([asset("c", {})], ASSET).withColumn("owner", F.raise_error(F.lit("no access")))
    with pytest.raises(Exception, match="no access"):
        run([asset("c", {})], "r2", first=broken)
    assert content(tables) == before
    heal = stop_at(monkeypatch, V.Change, "add", 5)
    with pytest.raises(Stopped):
        run([asset("c", {})], "r3")
    heal()
    assert content(tables) == before
    assert run([asset("c", {})], "r3") == 2
    rows = tables.read("asset_inventory_snapshot").collect()
    assert [(r.asset_id, r.policies[0].policy_name) for r in rows] == [("c", "small")]
    assert tables.read("asset_tag_snapshot").count() == 0  # the rerun has no tags, so the day has none
    assert [(r.status, r.asset_count) for r in tables.read("collection_run").collect()] == [("SUCCESS", 1)]
    payload = tables.read("policy_snapshot").first()
    assert '"resolved_policy_family":{"definition":"{\\"c\\":3}","policy_family_id":"f1"}' in payload.raw_payload
    assert payload.definition_json == '{"b":2,"c":3}'
    assert sorted(r.definition_path for r in tables.read("policy_term_snapshot").collect()) == ["b", "c"]
