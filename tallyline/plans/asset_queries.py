"""Registered queries: discovery, payloads, merging, policies."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.functions.exprs import merge_tags, normalize_policies, normalize_tags, parse_policy, tags_from_pairs
from tallyline.operators import inventory as I
from tallyline.operators import policy as Y
from tallyline.plans import bindings as b
from tallyline.plans.bindings import AS_OF, policy_text, tag_text, text_time, with_sql
from tallyline.plans.registry import query
from tallyline.sources import discovery as D
from tallyline.sources import payloads as L

ASSET = ("workspace_id", "asset_type", "asset_id", "asset_name", "owner", "lifecycle_state")
FLAGS = ("discovery_source", "api_enriched", "tag_observation_complete", "policy_observation_complete")


def asset_columns(df):
    return df.select(*ASSET, tag_text("tags").alias("tags"), policy_text("policies").alias("policies"), *FLAGS)


# --- discovery --------------------------------------------------------------


@query(
    "discover_clusters",
    with_sql(b.CLUSTERS_SQL)
    + """ SELECT CAST(workspace_id AS VARCHAR) AS workspace_id, 'cluster' AS asset_type, cluster_id AS asset_id,
      cluster_name AS asset_name, owned_by AS owner, 'ACTIVE' AS lifecycle_state, 'prio=' || prio || ',st=' || st AS tags,
      CASE WHEN policy_id IS NULL THEN '' ELSE 'COMPUTE_POLICY:' || policy_id || ':-' END AS policies,
      'SYSTEM_TABLE' AS discovery_source, FALSE AS api_enriched, TRUE AS tag_observation_complete,
      TRUE AS policy_observation_complete
      FROM (SELECT *, row_number() OVER (PARTITION BY workspace_id, cluster_id ORDER BY change_time DESC,
        delete_time DESC NULLS LAST, change_id DESC) AS rn FROM scd WHERE upper(cluster_source) IN ('UI', 'API'))
      WHERE rn = 1 AND delete_time IS NULL""",
)
def q_discover_clusters(spark, sf):
    return asset_columns(D.discover_clusters(b.clusters_scd(spark, sf), tie=("change_id",)))


def jobs_scd(spark, sf):
    """Line items as job change rows: the largest dimension at hand, with many equal change times."""
    k = F.col("l_orderkey")
    return b.table(spark, sf, "lineitem").select(
        (F.col("l_partkey") % 5).alias("workspace_id"),
        F.col("l_partkey").cast("string").alias("job_id"),
        F.when(k % 3 != 0, F.concat(F.lit("job "), F.col("l_partkey"))).alias("name"),
        F.when(k % 2 == 0, F.concat(F.lit("runas"), k % 9)).alias("run_as_user_name"),
        F.when(k % 3 == 0, F.concat(F.lit("maker"), k % 9)).alias("creator_user_name"),
        F.when(k % 5 == 0, F.concat(F.lit("sp"), k % 9)).alias("run_as"),
        F.when(k % 7 != 0, F.concat(F.lit("id"), k % 9)).alias("creator_id"),
        F.create_map(F.lit("flag"), F.col("l_returnflag")).alias("tags"),
        (k % 2 == 0).alias("paused"),
        F.lit(None).cast("timestamp").alias("create_time"),
        F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")).alias("delete_time"),
        F.col("l_shipdate").alias("change_time"),
        "l_orderkey", "l_linenumber", "l_extendedprice",
    )


@query(
    "discover_jobs",
    """SELECT CAST(l_partkey % 5 AS VARCHAR) AS workspace_id, 'job' AS asset_type, CAST(l_partkey AS VARCHAR) AS asset_id,
      CASE WHEN k % 3 <> 0 THEN 'job ' || l_partkey ELSE CAST(l_partkey AS VARCHAR) END AS asset_name,
      CASE WHEN k % 2 = 0 THEN 'runas' || (k % 9) WHEN k % 3 = 0 THEN 'maker' || (k % 9) WHEN k % 5 = 0 THEN 'sp' || (k % 9)
        WHEN k % 7 <> 0 THEN 'id' || (k % 9) END AS owner,
      CASE WHEN k % 2 = 0 THEN 'PAUSED' ELSE 'ACTIVE' END AS lifecycle_state, 'flag=' || l_returnflag AS tags, '' AS policies,
      'SYSTEM_TABLE' AS discovery_source, FALSE AS api_enriched, TRUE AS tag_observation_complete,
      FALSE AS policy_observation_complete
      FROM (SELECT *, l_orderkey AS k, row_number() OVER (PARTITION BY l_partkey % 5, l_partkey ORDER BY l_shipdate DESC,
        CASE WHEN l_returnflag = 'R' THEN l_shipdate END DESC NULLS LAST, l_orderkey DESC, l_linenumber DESC,
        l_extendedprice DESC) AS rn FROM lineitem)
      WHERE rn = 1 AND l_returnflag <> 'R'""",
)
def q_discover_jobs(spark, sf):
    scd = jobs_scd(spark, sf)
    return asset_columns(D.discover_jobs(scd, tie=("l_orderkey", "l_linenumber", "l_extendedprice")))


def endpoints_scd(spark, sf):
    k = F.col("o_orderkey")
    return b.table(spark, sf, "orders").select(
        (F.col("o_custkey") % 3).alias("workspace_id"),
        F.concat(F.lit("ep-"), F.col("o_custkey") % 300).alias("endpoint_name"),
        F.concat(F.lit("id"), k).alias("endpoint_id"),
        F.concat(F.lit("user"), k % 11).alias("created_by"),
        (k % 5).alias("endpoint_config_version"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("endpoint_delete_time"),
        F.col("o_orderdate").alias("change_time"),
        "o_orderkey",
    )


@query(
    "discover_endpoints",
    """SELECT CAST(o_custkey % 3 AS VARCHAR) AS workspace_id, 'serving_endpoint' AS asset_type, 'ep-' || (o_custkey % 300) AS asset_id,
      'ep-' || (o_custkey % 300) AS asset_name, 'user' || (o_orderkey % 11) AS owner, 'ACTIVE' AS lifecycle_state, '' AS tags,
      '' AS policies, 'SYSTEM_TABLE' AS discovery_source, FALSE AS api_enriched, FALSE AS tag_observation_complete,
      FALSE AS policy_observation_complete
      FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey % 3, o_custkey % 300 ORDER BY o_orderdate DESC, o_orderkey % 5 DESC,
        CASE WHEN o_orderstatus = 'F' THEN o_orderdate END DESC NULLS LAST, o_orderkey DESC) AS rn FROM orders)
      WHERE rn = 1 AND o_orderstatus <> 'F'""",
)
def q_discover_endpoints(spark, sf):
    return asset_columns(D.discover_endpoints(endpoints_scd(spark, sf), tie=("o_orderkey",)))


def warehouses_scd(spark, sf):
    k = F.col("o_orderkey")
    return b.table(spark, sf, "orders").select(
        (F.col("o_custkey") % 3).alias("workspace_id"),
        F.concat(F.lit("wh-"), F.col("o_custkey")).alias("warehouse_id"),
        F.concat(F.lit("Warehouse "), F.col("o_custkey")).alias("warehouse_name"),
        F.lit("PRO").alias("warehouse_type"),
        F.lit("SMALL").alias("warehouse_size"),
        F.concat(F.lit("user"), k % 11).alias("created_by"),
        F.when(k % 4 != 0, F.create_map(F.lit("prio"), F.col("o_orderpriority"))).alias("tags"),
        F.col("o_orderdate").alias("change_time"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("delete_time"),
        "o_orderkey",
    )


@query(
    "discover_warehouses",
    """SELECT CAST(o_custkey % 3 AS VARCHAR) AS workspace_id, 'warehouse' AS asset_type, 'wh-' || o_custkey AS asset_id,
      'Warehouse ' || o_custkey AS asset_name, 'user' || (o_orderkey % 11) AS owner, 'ACTIVE' AS lifecycle_state,
      CASE WHEN o_orderkey % 4 <> 0 THEN 'prio=' || o_orderpriority ELSE '' END AS tags, '' AS policies,
      'SYSTEM_TABLE' AS discovery_source, FALSE AS api_enriched, TRUE AS tag_observation_complete,
      TRUE AS policy_observation_complete
      FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC,
        CASE WHEN o_orderstatus = 'F' THEN o_orderdate END DESC NULLS LAST, o_orderkey DESC) AS rn FROM orders)
      WHERE rn = 1 AND o_orderstatus <> 'F'""",
)
def q_discover_warehouses(spark, sf):
    return asset_columns(D.discover_warehouses(warehouses_scd(spark, sf), tie=("o_orderkey",)))


# --- payloads ---------------------------------------------------------------

API_FLAGS = "'API' AS discovery_source, TRUE AS api_enriched, TRUE AS tag_observation_complete, TRUE AS policy_observation_complete"


def cluster_payloads(spark, sf):
    k = F.col("c_custkey")
    payload = F.struct(
        k.cast("string").alias("cluster_id"),
        F.when(k % 5 != 0, F.col("c_name")).alias("cluster_name"),
        F.concat(F.lit("user"), k % 13).alias("creator_user_name"),
        F.element_at(F.array(*map(F.lit, ("UI", "api", "JOB"))), (k % 3 + 1).cast("int")).alias("cluster_source"),
        F.when(k % 4 != 0, "RUNNING").alias("state"),
        F.when(k % 2 == 0, F.concat(F.lit("p"), k % 6)).alias("policy_id"),
        F.create_map(
            F.lit(" segment "), F.concat(F.lit(" "), F.col("c_mktsegment")), F.lit(" "), F.lit("dropped"), F.lit("blank"),
            F.lit(""),
        ).alias("custom_tags"),
    )
    return b.table(spark, sf, "customer").select((k % 3).alias("workspace_id"), F.to_json(payload).alias("payload"))


PAYLOAD_CLUSTERS_SQL = f"""
api_clusters AS (SELECT CAST(c_custkey % 3 AS VARCHAR) AS workspace_id, 'cluster' AS asset_type, CAST(c_custkey AS VARCHAR) AS asset_id,
  CASE WHEN c_custkey % 5 <> 0 THEN c_name ELSE CAST(c_custkey AS VARCHAR) END AS asset_name, 'user' || (c_custkey % 13) AS owner,
  CASE WHEN c_custkey % 4 <> 0 THEN 'RUNNING' ELSE 'UNKNOWN' END AS lifecycle_state, 'blank=,segment=' || c_mktsegment AS tags,
  CASE WHEN c_custkey % 2 = 0 THEN 'COMPUTE_POLICY:p' || (c_custkey % 6) || ':-' ELSE '' END AS policies, {API_FLAGS}
  FROM customer WHERE c_custkey % 3 <> 2)"""


@query("payload_clusters", with_sql(PAYLOAD_CLUSTERS_SQL) + " SELECT * FROM api_clusters")
def q_payload_clusters(spark, sf):
    return asset_columns(L.payload_clusters(cluster_payloads(spark, sf)))


def job_payloads(spark, sf):
    """Orders as job payloads: policies at the top, in settings, on job clusters and in nested tasks."""
    k = F.col("o_orderkey")
    new = lambda ident: F.struct(ident.alias("policy_id")).alias("new_cluster")
    pid = lambda prefix, n: F.concat(F.lit(prefix), k % n)
    inner = F.struct(new(pid("deep", 3)))
    middle = F.struct(new(F.when(k % 2 == 0, pid("mid", 4))), F.struct(inner.alias("task")).alias("for_each_task"))
    outer = F.struct(new(pid("top", 2)), F.when(k % 3 == 0, F.struct(middle.alias("task"))).alias("for_each_task"))
    settings = F.struct(
        F.when(k % 4 != 0, F.concat(F.lit("job"), k)).alias("name"),
        F.create_map(F.lit("prio"), F.col("o_orderpriority")).alias("tags"),
        F.when(k % 3 == 1, pid("bs", 5)).alias("budget_policy_id"),
        F.when(k % 7 == 0, pid("us", 5)).alias("usage_policy_id"),
        F.when(k % 5 == 0, F.array(F.struct(new(pid("jc", 2))), F.struct(new(pid("jc", 2))))).alias("job_clusters"),
        F.array(outer).alias("tasks"),
    )
    payload = F.struct(
        k.alias("job_id"),
        F.concat(F.lit("maker"), F.col("o_custkey") % 7).alias("creator_user_name"),
        F.when(k % 2 == 0, F.lit("")).when(k % 5 != 0, F.concat(F.lit("run"), k % 7)).alias("run_as_user_name"),
        F.when(k % 3 == 0, pid("be", 5)).alias("effective_budget_policy_id"),
        F.when(k % 8 == 0, F.struct(F.lit("PAUSED").alias("pause_status"))).alias("trigger_state"),
        settings.alias("settings"),
    )
    return b.table(spark, sf, "orders").select((F.col("o_custkey") % 3).alias("workspace_id"), F.to_json(payload).alias("payload"))


@query(
    "payload_jobs",
    f"""WITH j AS (SELECT *, o_orderkey AS k FROM orders)
      SELECT CAST(o_custkey % 3 AS VARCHAR) AS workspace_id, 'job' AS asset_type, CAST(k AS VARCHAR) AS asset_id,
      CASE WHEN k % 4 <> 0 THEN 'job' || k ELSE CAST(k AS VARCHAR) END AS asset_name,
      CASE WHEN k % 2 <> 0 AND k % 5 <> 0 THEN 'run' || (k % 7) ELSE 'maker' || (o_custkey % 7) END AS owner,
      CASE WHEN k % 8 = 0 THEN 'PAUSED' ELSE 'ACTIVE' END AS lifecycle_state, 'prio=' || o_orderpriority AS tags,
      array_to_string(list_filter([
        CASE WHEN k % 3 = 0 THEN 'BUDGET_POLICY:be' || (k % 5) || ':-' WHEN k % 3 = 1 THEN 'BUDGET_POLICY:bs' || (k % 5) || ':-' END,
        CASE WHEN k % 3 = 0 THEN 'COMPUTE_POLICY:deep' || (k % 3) || ':-' END,
        CASE WHEN k % 5 = 0 THEN 'COMPUTE_POLICY:jc' || (k % 2) || ':-' END,
        CASE WHEN k % 3 = 0 AND k % 2 = 0 THEN 'COMPUTE_POLICY:mid' || (k % 4) || ':-' END,
        'COMPUTE_POLICY:top' || (k % 2) || ':-',
        CASE WHEN k % 7 = 0 THEN 'USAGE_POLICY:us' || (k % 5) || ':-' END], lambda x: x IS NOT NULL), ',') AS policies, {API_FLAGS}
      FROM j""",
)
def q_payload_jobs(spark, sf):
    return asset_columns(L.payload_jobs(job_payloads(spark, sf)))


def _pairs(*pairs):
    return F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs])


def endpoint_payloads(spark, sf):
    k = F.col("p_partkey")
    state = F.struct(F.when(k % 3 == 0, "READY").alias("ready"), F.when(k % 2 == 0, "UPDATING").alias("config_update"))
    payload = F.struct(
        F.concat(F.lit("ep-"), k).alias("name"),
        F.col("p_brand").alias("creator"),
        F.when(k % 2 == 0, F.concat(F.lit("b"), k % 4)).alias("budget_policy_id"),
        F.when(k % 5 == 0, F.concat(F.lit("u"), k % 3)).alias("usage_policy_id"),
        _pairs(("type", F.col("p_type")), ("", F.lit("x")), ("bare", F.lit(None).cast("string")), ("type", F.col("p_brand"))).alias("tags"),
        state.alias("state"),
    )
    return b.table(spark, sf, "part").select((k % 3).alias("workspace_id"), F.to_json(payload).alias("payload"))


@query(
    "payload_endpoints",
    f"""SELECT CAST(p_partkey % 3 AS VARCHAR) AS workspace_id, 'serving_endpoint' AS asset_type, 'ep-' || p_partkey AS asset_id,
      'ep-' || p_partkey AS asset_name, p_brand AS owner,
      CASE WHEN p_partkey % 3 = 0 THEN 'READY' WHEN p_partkey % 2 = 0 THEN 'UPDATING' ELSE 'UNKNOWN' END AS lifecycle_state,
      'bare=,type=' || p_brand AS tags,
      concat_ws(',', CASE WHEN p_partkey % 2 = 0 THEN 'BUDGET_POLICY:b' || (p_partkey % 4) || ':-' END,
        CASE WHEN p_partkey % 5 = 0 THEN 'USAGE_POLICY:u' || (p_partkey % 3) || ':-' END) AS policies, {API_FLAGS} FROM part""",
)
def q_payload_endpoints(spark, sf):
    return asset_columns(L.payload_endpoints(endpoint_payloads(spark, sf)))


def warehouse_payloads(spark, sf):
    k = F.col("s_suppkey")
    tags = F.struct(_pairs(("owner", F.col("s_name")), (" ", F.lit("x")), ("k", F.lit(" v "))).alias("custom_tags"))
    payload = F.struct(
        F.concat(F.lit("wh-"), k).alias("id"),
        F.col("s_name").alias("name"),
        F.when(k % 3 != 0, F.lit("boss")).alias("creator_name"),
        F.when(k % 2 == 0, "STOPPED").alias("state"),
        F.when(k % 5 != 0, tags).alias("tags"),
    )
    return b.table(spark, sf, "supplier").select((k % 3).alias("workspace_id"), F.to_json(payload).alias("payload"))


@query(
    "payload_warehouses",
    f"""SELECT CAST(s_suppkey % 3 AS VARCHAR) AS workspace_id, 'warehouse' AS asset_type, 'wh-' || s_suppkey AS asset_id,
      s_name AS asset_name, CASE WHEN s_suppkey % 3 <> 0 THEN 'boss' END AS owner,
      CASE WHEN s_suppkey % 2 = 0 THEN 'STOPPED' ELSE 'UNKNOWN' END AS lifecycle_state,
      CASE WHEN s_suppkey % 5 <> 0 THEN 'k=v,owner=' || s_name ELSE '' END AS tags, '' AS policies, {API_FLAGS} FROM supplier""",
)
def q_payload_warehouses(spark, sf):
    return asset_columns(L.payload_warehouses(warehouse_payloads(spark, sf)))


# --- normalisation ----------------------------------------------------------


@query(
    "normalize_tags",
    """SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN '' ELSE 'blank=,k=' || (CASE WHEN c_custkey % 2 = 0 THEN 'late' ELSE c_name END)
      || ',segment=' || c_mktsegment END AS from_map,
      CASE WHEN c_custkey % 2 = 0 THEN 'k=second' ELSE 'k=first' END || ',plain=' AS from_pairs FROM customer""",
)
def q_normalize_tags(spark, sf):
    k = F.col("c_custkey")
    late = F.when(k % 2 == 0, "late")
    raw = F.map_from_arrays(
        F.array(F.lit("k"), F.lit(" segment"), F.lit(""), F.lit("none"), F.lit("blank"), F.lit("k ")),
        F.array("c_name", F.concat("c_mktsegment", F.lit("\t")), F.lit("x"), F.lit(None), F.lit("  "), late),
    )
    pair = lambda key, value: F.create_map(F.lit("key"), F.lit(key), F.lit("value"), value)
    second = F.when(k % 2 == 0, "second").otherwise("first")
    pairs = F.array(
        pair("k", F.lit("first")), pair(" k", second), F.create_map(F.lit("key"), F.lit("plain")), pair("gone", F.lit(None).cast("string"))
    )
    return b.table(spark, sf, "customer").select(
        "c_custkey",
        tag_text(normalize_tags(F.when(k % 9 != 0, raw))).alias("from_map"),
        tag_text(tags_from_pairs(pairs)).alias("from_pairs"),
    )


@query(
    "normalize_policies",
    """SELECT c_custkey, 'BUDGET:b' || (c_custkey % 3) || ':late,COMPUTE:' || c_custkey || ':-' AS policies FROM customer""",
)
def q_normalize_policies(spark, sf):
    k = F.col("c_custkey")
    item = lambda t, i, n: F.struct(F.lit(t).alias("policy_type"), i.alias("policy_id"), F.lit(n).cast("string").alias("policy_name"))
    ident = F.concat(F.lit("b"), k % 3)
    raw = F.array(
        item(" compute ", k.cast("string"), None), item("Budget", ident, "early"), item("budget", F.concat(ident, F.lit(" ")), "late"),
        item("", k.cast("string"), "x"), item("usage", F.lit(" "), "x"),
    )
    return b.table(spark, sf, "customer").select("c_custkey", policy_text(normalize_policies(raw)).alias("policies"))


@query(
    "merge_tags",
    """SELECT c_custkey, 'a=' || c_name || ',b=' || CASE WHEN c_custkey % 2 = 0 THEN 'api' ELSE c_mktsegment END
      || CASE WHEN c_custkey % 3 = 0 THEN ',c=' || c_custkey ELSE '' END AS tags FROM customer""",
)
def q_merge_tags(spark, sf):
    k = F.col("c_custkey")
    base = F.create_map(F.lit("a"), F.col("c_name"), F.lit("b"), F.col("c_mktsegment"))
    extra = F.map_filter(
        F.create_map(F.lit("b"), F.when(k % 2 == 0, "api"), F.lit("c"), F.when(k % 3 == 0, k.cast("string"))),
        lambda _, v: v.isNotNull(),
    )
    return b.table(spark, sf, "customer").select("c_custkey", tag_text(merge_tags(base, extra)).alias("tags"))


# --- merge and snapshot -----------------------------------------------------

# Clusters from change rows meet clusters from payloads; customers are in both, in either, or in none.
DISCOVERED_SQL = """
disc AS (SELECT CAST(workspace_id AS VARCHAR) AS workspace_id, cluster_id, cluster_name, owned_by, prio, st, policy_id
  FROM (SELECT *, row_number() OVER (PARTITION BY workspace_id, cluster_id ORDER BY change_time DESC, delete_time DESC NULLS LAST,
    change_id DESC) AS rn FROM scd WHERE upper(cluster_source) IN ('UI', 'API')) WHERE rn = 1 AND delete_time IS NULL)"""
MERGED_SQL = """
merged AS (SELECT coalesce(d.workspace_id, e.workspace_id) AS workspace_id, 'cluster' AS asset_type,
  coalesce(d.cluster_id, e.asset_id) AS asset_id, coalesce(d.cluster_name, e.asset_name) AS asset_name,
  coalesce(d.owned_by, e.owner) AS owner, coalesce(e.lifecycle_state, 'ACTIVE') AS lifecycle_state,
  concat_ws(',', CASE WHEN e.asset_id IS NOT NULL THEN 'blank=' END, CASE WHEN d.cluster_id IS NOT NULL THEN 'prio=' || prio END,
    CASE WHEN e.asset_id IS NOT NULL THEN 'segment=' || c.c_mktsegment END, CASE WHEN d.cluster_id IS NOT NULL THEN 'st=' || st END) AS tags,
  concat_ws(',', nullif(e.policies, ''), CASE WHEN d.policy_id IS NOT NULL THEN 'COMPUTE_POLICY:' || d.policy_id || ':-' END) AS policies,
  CASE WHEN d.cluster_id IS NULL THEN 'API_ONLY' ELSE 'SYSTEM_TABLE' END AS discovery_source, e.asset_id IS NOT NULL AS api_enriched,
  TRUE AS tag_observation_complete, TRUE AS policy_observation_complete
  FROM disc d FULL OUTER JOIN api_clusters e ON e.workspace_id = d.workspace_id AND e.asset_id = d.cluster_id
  LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = e.asset_id)"""
MERGE = (b.CLUSTERS_SQL, DISCOVERED_SQL, PAYLOAD_CLUSTERS_SQL, MERGED_SQL)


def _sides(spark, sf):
    return D.discover_clusters(b.clusters_scd(spark, sf), tie=("change_id",)), L.payload_clusters(cluster_payloads(spark, sf))


@query("merge_inventory", with_sql(*MERGE) + " SELECT * FROM merged")
def q_merge_inventory(spark, sf):
    return asset_columns(I.merge_inventory(*_sides(spark, sf)))


RUN_CONFIG = [
    ("cluster", "COMPUTE", True, "clusters", "cluster", ["Owner ", "cost_center"], [" compute_policy"]),
    ("job", "WORKFLOWS", True, "jobs", "job", ["owner"], []),
    ("warehouse", "SQL", False, "warehouses", "warehouse", [], []),
]


def run_requirements(spark, sf):
    from tallyline.sources.config import asset_requirements

    workspaces = b.table(spark, sf, "customer").select((F.col("c_custkey") % 3).cast("string").alias("workspace_id"))
    return I.requirement_snapshot(asset_requirements(spark, RUN_CONFIG), workspaces, "run-1", AS_OF)


@query(
    "requirement_snapshot",
    f"""WITH w AS (SELECT DISTINCT CAST(c_custkey % 3 AS VARCHAR) AS workspace_id FROM customer),
      c AS (SELECT * FROM (VALUES ('cluster', 'COMPUTE', TRUE, 'owner,cost_center', 'COMPUTE_POLICY'), ('job', 'WORKFLOWS', TRUE, 'owner', ''),
        ('warehouse', 'SQL', FALSE, '', '')) t(asset_type, product, enabled, required_tags, required_policies))
      SELECT workspace_id, 'run-1' AS collection_run_id, '{AS_OF}' AS snapshot_ts, DATE '2024-01-31' AS snapshot_date, asset_type, product,
      enabled, required_tags, required_policies, 64 AS hash_length, 3::BIGINT AS distinct_hashes FROM w CROSS JOIN c""",
)
def q_requirement_snapshot(spark, sf):
    from pyspark.sql.window import Window

    rows = run_requirements(spark, sf)
    hashes = F.size(F.collect_set("config_hash").over(Window.partitionBy("workspace_id"))).cast("bigint")
    return rows.select(
        "workspace_id", "collection_run_id", text_time("snapshot_ts").alias("snapshot_ts"), "snapshot_date", "asset_type",
        "product", "enabled", F.array_join("required_tags", ",").alias("required_tags"),
        F.array_join("required_policies", ",").alias("required_policies"), F.length("config_hash").alias("hash_length"),
        hashes.alias("distinct_hashes"),
    )


def listed_policies(spark, sf):
    """Every customer number below the nation count names a policy: p0.. and pol-0.. for each workspace."""
    n = b.table(spark, sf, "nation")
    ids = F.explode(F.array(F.concat(F.lit("p"), "n_nationkey"), F.concat(F.lit("pol-"), "n_nationkey")))
    ws = F.explode(F.array(*map(F.lit, ("0", "1", "2"))))
    named = n.select("n_name", ids.alias("policy_id")).select("n_name", "policy_id", ws.alias("workspace_id"))
    return named.filter(~F.col("policy_id").endswith("5")).select(
        "workspace_id", "policy_id", F.concat("n_name", F.lit(" rules")).alias("policy_name")
    )


LISTED_SQL = """
listed AS (SELECT w AS workspace_id, pre || n_nationkey AS policy_id, n_name || ' rules' AS policy_name FROM nation
  CROSS JOIN (VALUES ('p'), ('pol-')) p(pre) CROSS JOIN (VALUES ('0'), ('1'), ('2')) w(w) WHERE n_nationkey % 10 <> 5)"""


def snapshot(spark, sf):
    disc, api = _sides(spark, sf)
    jobs = D.discover_jobs(jobs_scd(spark, sf), tie=("l_orderkey", "l_linenumber", "l_extendedprice"))
    return I.inventory_snapshot(
        [disc, jobs], [api], run_requirements(spark, sf), "run-1", AS_OF, listed_policies(spark, sf)
    )


@query(
    "inventory_snapshot",
    with_sql(*MERGE, LISTED_SQL)
    + """, att AS (SELECT m.workspace_id, m.asset_id, string_agg(replace(p, ':-', ':' || coalesce(l.policy_name, '-')), ','
          ORDER BY p) AS policies
        FROM (SELECT workspace_id, asset_id, unnest(string_split(policies, ',')) AS p FROM merged WHERE policies <> '') m
        LEFT JOIN listed l ON l.workspace_id = m.workspace_id AND l.policy_id = split_part(m.p, ':', 2) GROUP BY ALL),
      live_jobs AS (SELECT l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC,
          CASE WHEN l_returnflag = 'R' THEN l_shipdate END DESC NULLS LAST, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC)
          AS rn FROM lineitem) WHERE rn = 1 AND l_returnflag <> 'R')
      SELECT m.workspace_id, 'run-1' AS collection_run_id, DATE '2024-01-31' AS snapshot_date, 'COMPUTE' AS product, asset_type, m.asset_id,
        asset_name, tags, coalesce(att.policies, '') AS policies, discovery_source
      FROM merged m LEFT JOIN att ON att.workspace_id = m.workspace_id AND att.asset_id = m.asset_id
      UNION ALL SELECT CAST(l_partkey % 5 AS VARCHAR), 'run-1', DATE '2024-01-31', 'WORKFLOWS', 'job', CAST(l_partkey AS VARCHAR), '', '',
        '', 'SYSTEM_TABLE' FROM live_jobs""",
)
def q_inventory_snapshot(spark, sf):
    job = F.col("asset_type") == "job"
    return snapshot(spark, sf).select(
        "workspace_id", "collection_run_id", "snapshot_date", "product", "asset_type", "asset_id",
        F.when(job, "").otherwise(F.col("asset_name")).alias("asset_name"),
        F.when(job, "").otherwise(tag_text("tags")).alias("tags"),
        policy_text("policies").alias("policies"), "discovery_source",
    )


@query(
    "collection_runs",
    with_sql(*MERGE)
    + """, live_jobs AS (SELECT CAST(l_partkey % 5 AS VARCHAR) AS workspace_id FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
          ORDER BY l_shipdate DESC, CASE WHEN l_returnflag = 'R' THEN l_shipdate END DESC NULLS LAST, l_orderkey DESC,
          l_linenumber DESC, l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1 AND l_returnflag <> 'R'),
      counts AS (SELECT workspace_id, 'cluster' AS asset_type, count(*) AS n FROM merged GROUP BY ALL
        UNION ALL SELECT workspace_id, 'job', count(*) FROM live_jobs GROUP BY ALL)
      SELECT w.workspace_id, 'run-1' AS collection_run_id, t.asset_type, 'SUCCESS' AS status, coalesce(n, 0) AS asset_count,
        CASE WHEN t.asset_type = 'job' THEN 'API enrichment failed' END AS error_message
      FROM (VALUES ('0'), ('1'), ('2')) w(workspace_id) CROSS JOIN (VALUES ('cluster'), ('job')) t(asset_type)
      LEFT JOIN counts c ON c.workspace_id = w.workspace_id AND c.asset_type = t.asset_type""",
)
def q_collection_runs(spark, sf):
    from tallyline.functions.scale import local_frame

    errors = local_frame(spark, [("job", "API enrichment failed")], "asset_type string, error_message string")
    runs = I.collection_runs(snapshot(spark, sf), run_requirements(spark, sf), errors)
    return runs.select("workspace_id", "collection_run_id", "asset_type", "status", "asset_count", "error_message")


@query(
    "asset_tags",
    with_sql(b.INVENTORY_SQL)
    + """ SELECT workspace_id, run AS collection_run_id, asset_type, asset_id, tag_key, tag_value FROM (
        SELECT *, 'segment' AS tag_key, segment AS tag_value FROM inventory UNION ALL SELECT *, 'Cost_Center', cost_center FROM inventory
        UNION ALL SELECT *, 'owner', owner_tag FROM inventory)""",
)
def q_asset_tags(spark, sf):
    return I.asset_tags(b.inventory(spark, sf)).select(
        "workspace_id", "collection_run_id", "asset_type", "asset_id", "tag_key", "tag_value"
    )


@query(
    "config_history",
    """WITH r AS (SELECT o_custkey % 50 AS ws, CAST(o_orderdate AS DATE) AS d, max(o_orderpriority) AS h FROM orders GROUP BY ALL)
      SELECT CAST(ws AS VARCHAR) AS workspace_id, d AS snapshot_ts, h AS config_hash,
      coalesce(lag(h) OVER (PARTITION BY ws ORDER BY d) <> h, FALSE) AS config_changed FROM r""",
)
def q_config_history(spark, sf):
    """Orders as requirement rows: one configuration per workspace and day."""
    rows = b.table(spark, sf, "orders").groupBy(
        (F.col("o_custkey") % 50).cast("string").alias("workspace_id"), F.to_date("o_orderdate").alias("snapshot_ts")
    ).agg(F.max("o_orderpriority").alias("config_hash"))
    history = I.config_history(rows.withColumns({"asset_type": F.lit("cluster"), "collection_run_id": F.lit("r")}))
    return history.select("workspace_id", "snapshot_ts", "config_hash", "config_changed")


# --- policies ---------------------------------------------------------------


def policies(spark, sf):
    """Parts as policies; some belong to a family, some have broken definitions."""
    k = F.col("p_partkey")
    definition = F.concat(
        F.lit('{"spark.conf":{"type":"fixed","value":"'), F.col("p_brand"), F.lit('"},"node_type_id":{"hidden":true,"type":"range","maxValue":'),
        F.col("p_size"), F.lit('},"workers":'), F.col("p_size"), F.lit("}"),
    )
    override = F.concat(F.lit('{"autotermination":{"isOptional":true,"value":'), F.col("p_size"), F.lit("}}"))
    return b.table(spark, sf, "part").select(
        (k % 3).cast("string").alias("workspace_id"),
        F.concat(F.lit("p"), k).alias("policy_id"),
        F.col("p_name").alias("name"),
        F.when(k % 2 == 0, F.col("p_type")).alias("description"),
        F.when(k % 7 == 0, "[1, 2]").when(k % 11 == 0, "not json").when(k % 13 != 0, definition).alias("definition"),
        F.when(k % 5 == 0, F.concat(F.lit("fam"), k % 4)).alias("policy_family_id"),
        F.when(k % 10 == 0, override).alias("policy_family_definition_overrides"),
    )


def families(spark, sf):
    n = F.col("n_nationkey")
    text = F.concat(
        F.lit('{"autotermination":{"type":"range","value":'), n, F.lit('},"zone":{"type":"fixed","value":"'), F.col("n_name"), F.lit('"}}')
    )
    return b.table(spark, sf, "nation").select(F.concat(F.lit("fam"), n).alias("policy_family_id"), text.alias("definition"))


# Rules as (path, JSON text) per policy, straight from the columns.
TERMS_SQL = """
own AS (SELECT p_partkey AS k, CAST(p_partkey % 3 AS VARCHAR) AS workspace_id, 'p' || p_partkey AS policy_id, p_name, p_type, p_brand, p_size,
  CASE WHEN p_partkey % 5 = 0 THEN 'fam' || (p_partkey % 4) END AS family FROM part),
terms AS (
  SELECT k, workspace_id, policy_id, 'spark.conf' AS path, 'fixed' AS rule_type, '{"type":"fixed","value":"' || p_brand || '"}' AS rule, FALSE AS hidden,
    FALSE AS optional FROM own WHERE family IS NULL AND k % 7 <> 0 AND k % 11 <> 0 AND k % 13 <> 0
  UNION ALL SELECT k, workspace_id, policy_id, 'node_type_id', 'range', '{"hidden":true,"maxValue":' || p_size || ',"type":"range"}', TRUE, FALSE
    FROM own WHERE family IS NULL AND k % 7 <> 0 AND k % 11 <> 0 AND k % 13 <> 0
  UNION ALL SELECT k, workspace_id, policy_id, 'workers', 'UNKNOWN', CAST(p_size AS VARCHAR), FALSE, FALSE
    FROM own WHERE family IS NULL AND k % 7 <> 0 AND k % 11 <> 0 AND k % 13 <> 0
  UNION ALL SELECT k, workspace_id, policy_id, 'autotermination', CASE WHEN k % 10 = 0 THEN 'UNKNOWN' ELSE 'range' END,
    CASE WHEN k % 10 = 0 THEN '{"isOptional":true,"value":' || p_size || '}' ELSE '{"type":"range","value":' || (k % 4) || '}' END, FALSE, k % 10 = 0
    FROM own WHERE family IS NOT NULL
  UNION ALL SELECT k, workspace_id, policy_id, 'zone', 'fixed', '{"type":"fixed","value":"' || n_name || '"}', FALSE, FALSE
    FROM own JOIN nation ON n_nationkey = k % 4 WHERE family IS NOT NULL)"""


@query(
    "parse_policy",
    with_sql(TERMS_SQL)
    + """ SELECT o.policy_id, CASE WHEN k % 7 = 0 OR k % 11 = 0 OR k % 13 = 0 THEN '' ELSE 'node_type_id={"hidden":true,"maxValue":' || p_size
      || ',"type":"range"},spark.conf={"type":"fixed","value":"' || p_brand || '"},workers=' || p_size END AS rules FROM own o""",
)
def q_parse_policy(spark, sf):
    return policies(spark, sf).select("policy_id", tag_text(parse_policy(F.col("definition"))).alias("rules"))


@query(
    "merge_policy",
    with_sql(TERMS_SQL)
    + """ SELECT o.workspace_id, o.policy_id, coalesce(string_agg(t.path || '=' || t.rule, ',' ORDER BY t.path), '') AS rules
      FROM own o LEFT JOIN terms t ON t.policy_id = o.policy_id GROUP BY ALL""",
)
def q_merge_policy(spark, sf):
    merged = Y.merge_policy(policies(spark, sf), families(spark, sf))
    return merged.select("workspace_id", "policy_id", tag_text("rules").alias("rules"))


FLAT_SQL = """ SELECT workspace_id, policy_id, path AS definition_path, rule_type,
  CASE WHEN path = 'workers' THEN '{"value":' || rule || '}' ELSE rule END AS rule_json, hidden, optional AS is_optional FROM terms"""


@query("flatten_policy_terms", with_sql(TERMS_SQL) + FLAT_SQL)
def q_flatten_policy_terms(spark, sf):
    terms = Y.flatten_policy_terms(Y.merge_policy(policies(spark, sf), families(spark, sf)).select("workspace_id", "policy_id", "rules"))
    return terms.select("workspace_id", "policy_id", "definition_path", "rule_type", "rule_json", "hidden", "is_optional")


ATTACHED_SQL = """
known AS (SELECT CAST(p_partkey % 3 AS VARCHAR) AS workspace_id, 'COMPUTE_POLICY' AS policy_type, 'p' || p_partkey AS policy_id,
  p_name AS policy_name FROM part),
attached AS (SELECT DISTINCT workspace_id, policy_type, policy_id FROM inventory WHERE policy_type IS NOT NULL),
catalogue AS (SELECT *, TRUE AS listed FROM known UNION ALL SELECT workspace_id, policy_type, policy_id, NULL, FALSE FROM attached a
  WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.workspace_id = a.workspace_id AND k.policy_type = a.policy_type AND k.policy_id = a.policy_id))"""


@query("policy_catalogue", with_sql(b.INVENTORY_SQL, ATTACHED_SQL) + " SELECT * FROM catalogue")
def q_policy_catalogue(spark, sf):
    listed = policies(spark, sf).select("workspace_id", "policy_id", F.col("name").alias("policy_name"), F.lit(True).alias("listed"))
    out = Y.policy_catalogue(listed, b.inventory(spark, sf))
    return out.select("workspace_id", "policy_type", "policy_id", "policy_name", F.coalesce("listed", F.lit(False)).alias("listed"))


@query(
    "policy_snapshot",
    with_sql(b.INVENTORY_SQL, ATTACHED_SQL, TERMS_SQL)
    + """ SELECT c.workspace_id, 'run-1' AS collection_run_id, DATE '2024-01-31' AS snapshot_date, c.policy_type, c.policy_id, c.policy_name,
      CASE WHEN o.k % 2 = 0 THEN o.p_type END AS description,
      CASE WHEN c.listed THEN '{' || coalesce((SELECT string_agg('"' || path || '":' || rule, ',' ORDER BY path) FROM terms t
        WHERE t.policy_id = c.policy_id), '') || '}' END AS definition_json, o.family AS policy_family_id,
      (SELECT count(*) FROM terms t WHERE t.policy_id = c.policy_id AND c.listed) AS terms
      FROM catalogue c LEFT JOIN own o ON o.policy_id = c.policy_id AND c.listed""",
)
def q_policy_snapshot(spark, sf):
    rows, terms = Y.policy_snapshot(policies(spark, sf), families(spark, sf), b.inventory(spark, sf), "run-1", AS_OF)
    counts = terms.groupBy("policy_type", "policy_id").agg(F.count("*").alias("terms"))
    known = F.col("definition_json").isNotNull()
    return rows.join(counts, ["policy_type", "policy_id"], "left").select(
        "workspace_id", "collection_run_id", "snapshot_date", "policy_type", "policy_id", "policy_name", "description",
        "definition_json", "policy_family_id", F.when(known, F.coalesce("terms", F.lit(0))).otherwise(0).alias("terms"),
    )
