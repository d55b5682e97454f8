"""Registered queries: whole jobs over versioned tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.functions.scale import local_frame
from tallyline.operators import costs as C
from tallyline.operators import jobs as J
from tallyline.operators import running as R
from tallyline.operators.migrations import Step, TableFolder
from tallyline.operators import versions as V
from tallyline.params import LENS_RULES
from tallyline.plans import bindings as b
from tallyline.plans import asset_queries as A
from tallyline.plans.bindings import AS_OF, MART_AS_OF, policy_text, r6, scratch, tag_text, text_time, with_sql
from tallyline.plans import mart_queries as M
from tallyline.plans.mart_queries import BACKFILL, CORRECTION, LENS, TAG_COST_SQL
from tallyline.plans.registry import ORACLES, query
from tallyline.sources import discovery as D
from tallyline.sources import payloads as L
from tallyline.sources.config import asset_requirements
from tallyline.plans.state_queries import SCOPE

# --- windows by partitions ----------------------------------------------------------

WINDOW_TABLE = ("workspace_id string, asset_type string, asset_id string, usage_date date, version string, dollars double", ["workspace_id", "asset_type", "usage_date"])


@query("replace_window_partitions", ORACLES["replace_window"])
def q_replace_window_partitions(spark, sf):
    """The same replacement, by partitions: two versions of one table, of which the second touches its windows only."""
    full = C.lens_usage(
        C.daily_priced(_priced(spark, sf)), local_frame(spark, [(w, t, 365) for w in range(3) for t in b.TYPES], "workspace_id bigint, asset_type string, lookback_days int"), AS_OF,
    )
    keys = ["workspace_id", "asset_type", "asset_id", "usage_date"]
    cost = C.asset_cost_daily(full).groupBy(*keys).agg(F.sum("actual_daily_dollars").alias("dollars"))
    tables = V.VersionedTables(spark, scratch(spark, "windows"), {"cost": WINDOW_TABLE})
    first = tables.change("first")
    first.add("cost", cost.withColumn("version", F.lit("old")))
    first.commit()
    scope = local_frame(spark, SCOPE, "workspace_id string, asset_type string, lookback_days int")
    since = F.date_sub(F.lit("2024-01-31").cast("date"), F.col("lookback_days"))
    rebuilt = tables.read("cost").join(scope, ["workspace_id", "asset_type"]).filter((F.col("usage_date") >= since) & (F.col("usage_date") != F.lit("2024-01-28").cast("date")))
    second = tables.change("second")
    V.replace_window_partitions(second, "cost", rebuilt.withColumn("version", F.lit("new")), scope, AS_OF)
    second.commit()
    return tables.read("cost").select(*keys, "version", r6("dollars"))


def _priced(spark, sf):
    from tallyline.plans.mart_queries import fallback_priced

    return fallback_priced(spark, sf, AS_OF)


# --- cost refresh ---------------------------------------------------------------------

FIRST_AS_OF = "2024-01-20 00:00:00"
FIRST_TYPES = ("cluster", "job")


def exact(book):
    """A book with prices as the widest decimals that billing uses."""
    return book.withColumn("unit_price", F.col("unit_price").cast("decimal(38,18)"))


def refreshed_costs(spark, sf):
    """Two refreshes: clusters and jobs while a fifth of the usage is still missing, then all types, corrected."""
    usage = b.usage(spark, sf).withColumn("usage_quantity", F.col("usage_quantity").cast("decimal(38,18)"))
    rules = [F.struct(F.lit(r.asset_type).alias("asset_type"), C.resolver_hash(r).alias("resolver_hash")) for r in LENS_RULES]
    enabled = usage.select("workspace_id").distinct().select("workspace_id", F.inline(F.array(*rules)))
    tables = J.cost_tables(spark, scratch(spark, "refresh"))
    books = exact(b.account_prices(spark)), exact(b.list_prices(spark))
    early = usage.filter((F.col("event_id") % 5 != 0) & (F.col("usage_date") <= F.lit(FIRST_AS_OF[:10]).cast("date")))
    J.refresh_costs(tables, early, *books, enabled.filter(F.col("asset_type").isin(*FIRST_TYPES)), FIRST_AS_OF, "run-1", CORRECTION, BACKFILL)
    J.refresh_costs(tables, usage, *books, enabled, AS_OF, "run-2", CORRECTION, BACKFILL)
    return tables


_SEEN = f"""
seen AS (SELECT * FROM lensed WHERE asset_type NOT IN {FIRST_TYPES} OR usage_date >= DATE '{AS_OF[:10]}' - {CORRECTION}
  OR (event_id % 5 <> 0 AND usage_date >= DATE '{FIRST_AS_OF[:10]}' - {BACKFILL}))"""
REFRESH = (*LENS, b.lensed_sql(AS_OF, dict.fromkeys(b.TYPES, 4000)).replace(f"- {4000}", f"- {BACKFILL + 20}"), _SEEN,
           b.COST_SQL.replace("FROM lensed", "FROM seen"), TAG_COST_SQL.replace("FROM lensed", "FROM seen"))


@query(
    "refresh_costs",
    with_sql(*REFRESH)
    + f""" SELECT 'asset' AS part, workspace_id, asset_type, asset_id, usage_date, usage_unit || ' ' || currency_code || ' ' || pricing_source AS detail,
        round(qty, 6) AS quantity, round(dollars, 6) AS dollars, round(tagged_dollars, 6) AS tagged_dollars FROM cost
      UNION ALL SELECT 'tag', workspace_id, asset_type, asset_id, usage_date, tag_key || '=' || tag_value || ' ' || pricing_source, 0, round(dollars, 6), 0
        FROM tag_cost
      UNION ALL SELECT 'state', w, t, '', CASE WHEN t IN {FIRST_TYPES} THEN DATE '{FIRST_AS_OF[:10]}' ELSE DATE '{AS_OF[:10]}' END - {BACKFILL}, '{AS_OF}', 0, 0, 0
        FROM (SELECT DISTINCT CAST(user_id % 3 AS VARCHAR) AS w FROM events) CROSS JOIN (VALUES {", ".join(f"('{t}')" for t in b.TYPES)}) t(t)""",
)
def q_refresh_costs(spark, sf):
    """Both rollups and the state after two refreshes, in wide decimals."""
    tables = refreshed_costs(spark, sf)
    keys = ["workspace_id", "asset_type", "asset_id", "usage_date"]
    none = F.lit(0.0)
    asset = tables.read("asset_cost_daily").select(
        F.lit("asset").alias("part"), *keys, F.concat_ws(" ", "usage_unit", "currency_code", "pricing_source").alias("detail"),
        r6("quantity", "actual_daily_usage_quantity"), r6("dollars", "actual_daily_dollars"), r6("tagged_dollars", "billing_tagged_daily_dollars"),
    )
    tag = tables.read("asset_tag_cost_daily").select(
        F.lit("tag").alias("part"), *keys, F.concat("tag_key", F.lit("="), "tag_value", F.lit(" "), "pricing_source").alias("detail"),
        none.alias("quantity"), r6("dollars", "actual_daily_dollars"), none.alias("tagged_dollars"),
    )
    state = tables.read("cost_refresh_state").select(
        F.lit("state").alias("part"), "workspace_id", "asset_type", F.lit("").alias("asset_id"), F.col("history_start_date").alias("usage_date"),
        text_time("last_success_ts").alias("detail"), none.alias("quantity"), none.alias("dollars"), none.alias("tagged_dollars"),
    )
    return asset.unionByName(tag).unionByName(state)


# --- inventory run ----------------------------------------------------------------------

RUN_CONFIG = [
    ("cluster", "COMPUTE", True, "clusters", "cluster", ["Owner ", "cost_center"], [" compute_policy"]),
    ("job", "WORKFLOWS", True, "jobs", "job", ["owner"], []),
    ("serving_endpoint", "MODEL_SERVING", True, "serving_endpoints", "serving_endpoint", [], []),
    ("warehouse", "SQL", True, "warehouses", "warehouse", ["owner"], []),
    ("volume", "STORAGE", False, "volumes", "volume", [], []),
]
EARLY_DAY = "2024-01-30 00:00:00"


def inventoried(spark, sf):
    """Three runs: one of the day before and one of the same day over clusters alone, then all eight inputs."""
    clusters = D.discover_clusters(b.clusters_scd(spark, sf), tie=("change_id",))
    discovered = [
        clusters,
        D.discover_jobs(A.jobs_scd(spark, sf), tie=("l_orderkey", "l_linenumber", "l_extendedprice")),
        D.discover_endpoints(A.endpoints_scd(spark, sf), tie=("o_orderkey",)),
        D.discover_warehouses(A.warehouses_scd(spark, sf), tie=("o_orderkey",)),
    ]
    enriched = [
        L.payload_clusters(A.cluster_payloads(spark, sf)), L.payload_jobs(A.job_payloads(spark, sf)),
        L.payload_endpoints(A.endpoint_payloads(spark, sf)), L.payload_warehouses(A.warehouse_payloads(spark, sf)),
    ]
    workspaces = b.table(spark, sf, "customer").select((F.col("c_custkey") % 3).cast("string").alias("workspace_id")).distinct()
    errors = local_frame(spark, [("serving_endpoint", "API enrichment failed: late")], "asset_type string, error_message string")
    policies, families, tables = A.policies(spark, sf), A.families(spark, sf), J.inventory_tables(spark, scratch(spark, "inventory"))
    config = asset_requirements(spark, RUN_CONFIG)
    only = asset_requirements(spark, RUN_CONFIG[:1])
    none = policies.limit(0)
    J.run_inventory(tables, [clusters], [], only, workspaces, none, families, "day-before", EARLY_DAY)
    J.run_inventory(tables, [clusters], [], only, workspaces, policies, families, "first-try", AS_OF)
    J.run_inventory(tables, discovered, enriched, config, workspaces, policies, families, "all-types", AS_OF, errors)
    return tables


def _both(kind: str, tags: str, api: str) -> str:
    """Discovered and API rows of one type as one; ``tags`` says how their tag texts join."""
    return f"""
both_{kind} AS (SELECT coalesce(d.workspace_id, e.workspace_id) AS workspace_id, coalesce(d.asset_type, e.asset_type) AS asset_type,
  coalesce(d.asset_id, e.asset_id) AS asset_id, coalesce(d.asset_name, e.asset_name) AS asset_name, coalesce(d.owner, e.owner) AS owner,
  coalesce(e.lifecycle_state, d.lifecycle_state) AS lifecycle_state, {tags} AS tags, coalesce(e.policies, '') AS policies,
  CASE WHEN d.asset_id IS NULL THEN 'API_ONLY' ELSE 'SYSTEM_TABLE' END AS discovery_source, e.asset_id IS NOT NULL AS api_enriched,
  e.asset_id IS NOT NULL OR d.tag_observation_complete AS tag_observation_complete,
  e.asset_id IS NOT NULL OR d.policy_observation_complete AS policy_observation_complete
  FROM ({ORACLES[f"discover_{kind}"]}) d FULL OUTER JOIN ({ORACLES[api]}) e
  ON e.workspace_id = d.workspace_id AND e.asset_id = d.asset_id)"""


_JOINED = "concat_ws(',', nullif({}.tags, ''), nullif({}.tags, ''))"
RUN_SQL = (
    *A.MERGE, A.TERMS_SQL,
    _both("jobs", _JOINED.format("d", "e"), "payload_jobs"), _both("endpoints", _JOINED.format("e", "d"), "payload_endpoints"),
    _both("warehouses", _JOINED.format("e", "d"), "payload_warehouses"),
    f"""
known AS (SELECT CAST(p_partkey % 3 AS VARCHAR) AS workspace_id, 'p' || p_partkey AS policy_id, p_name AS policy_name FROM part),
alone AS (SELECT *, cluster_id AS asset_id FROM disc),
found AS (
  SELECT 'day-before' AS run, workspace_id, 'cluster' AS asset_type, asset_id, cluster_name AS asset_name, owned_by AS owner, 'ACTIVE' AS lifecycle_state,
    'prio=' || prio || ',st=' || st AS tags, CASE WHEN policy_id IS NULL THEN '' ELSE 'COMPUTE_POLICY:' || policy_id || ':-' END AS policies,
    'SYSTEM_TABLE' AS discovery_source, FALSE AS api_enriched, TRUE AS tag_observation_complete, TRUE AS policy_observation_complete FROM alone
  UNION ALL SELECT 'all-types', workspace_id, asset_type, asset_id, asset_name, owner, lifecycle_state, tags, policies, discovery_source, api_enriched,
    tag_observation_complete, policy_observation_complete FROM merged
  UNION ALL SELECT 'all-types', * FROM both_jobs UNION ALL SELECT 'all-types', * FROM both_endpoints UNION ALL SELECT 'all-types', * FROM both_warehouses),
attached AS (SELECT f.run, f.workspace_id, f.asset_type, f.asset_id, split_part(p, ':', 1) AS policy_type, split_part(p, ':', 2) AS policy_id
  FROM (SELECT run, workspace_id, asset_type, asset_id, unnest(string_split(policies, ',')) AS p FROM found WHERE policies <> '') f),
lists AS (SELECT a.run, a.workspace_id, a.asset_type, a.asset_id, string_agg(a.policy_type || ':' || a.policy_id || ':'
    || CASE WHEN a.policy_type = 'COMPUTE_POLICY' AND a.run = 'all-types' THEN coalesce(k.policy_name, '-') ELSE '-' END, ','
    ORDER BY a.policy_type, a.policy_id) AS policies
  FROM attached a LEFT JOIN known k ON k.workspace_id = a.workspace_id AND k.policy_id = a.policy_id GROUP BY ALL),
inv AS (SELECT f.* EXCLUDE (policies), coalesce(l.policies, '') AS policies FROM found f LEFT JOIN lists l USING (run, workspace_id, asset_type, asset_id)),
days AS (SELECT * FROM (VALUES ('day-before', DATE '{EARLY_DAY[:10]}'), ('all-types', DATE '{AS_OF[:10]}')) t(run, day)),
config AS (SELECT * FROM (VALUES ('cluster', 'COMPUTE', TRUE, 'owner,cost_center', 'COMPUTE_POLICY'), ('job', 'WORKFLOWS', TRUE, 'owner', ''),
  ('serving_endpoint', 'MODEL_SERVING', TRUE, '', ''), ('warehouse', 'SQL', TRUE, 'owner', ''), ('volume', 'STORAGE', FALSE, '', ''))
  t(asset_type, product, enabled, tags, policies)),
wanted AS (SELECT run, day, w, c.* FROM days CROSS JOIN (SELECT DISTINCT CAST(c_custkey % 3 AS VARCHAR) AS w FROM customer) CROSS JOIN config c
  WHERE run = 'all-types' OR asset_type = 'cluster')""",
)


@query(
    "run_inventory",
    with_sql(*RUN_SQL)
    + """, counted AS (SELECT w.run, w.day, w.w, w.asset_type, count(i.asset_id) AS n FROM wanted w
        LEFT JOIN inv i ON i.run = w.run AND i.workspace_id = w.w AND i.asset_type = w.asset_type WHERE enabled GROUP BY ALL)
      SELECT 'run' AS part, w AS workspace_id, day, run, asset_type, '' AS id, 'SUCCESS ' || n || ' '
          || CASE WHEN run = 'all-types' AND asset_type = 'serving_endpoint' THEN 'API enrichment failed: late' ELSE '-' END AS detail FROM counted
      UNION ALL SELECT 'requirement', w, day, run, asset_type, product, enabled || ' ' || tags || ' ' || policies FROM wanted
      UNION ALL SELECT 'asset', workspace_id, day, inv.run, inv.asset_type, asset_id, concat_ws('|', product, asset_name, coalesce(owner, '-'), lifecycle_state,
          inv.tags, inv.policies, discovery_source, api_enriched, tag_observation_complete, policy_observation_complete)
        FROM inv JOIN days USING (run) JOIN config c ON c.asset_type = inv.asset_type
      UNION ALL SELECT 'tag', workspace_id, day, run, asset_type, asset_id, tag FROM (
        SELECT workspace_id, run, asset_type, asset_id, unnest(string_split(tags, ',')) AS tag FROM inv WHERE tags <> '') JOIN days USING (run)
      UNION ALL SELECT 'policy', o.workspace_id, day, run, 'COMPUTE_POLICY', o.policy_id, concat_ws('|', o.p_name, CASE WHEN o.k % 2 = 0 THEN o.p_type ELSE '-' END,
          coalesce(o.family, '-'), '{' || coalesce((SELECT string_agg('"' || path || '":' || rule, ',' ORDER BY path) FROM terms t
          WHERE t.policy_id = o.policy_id), '') || '}', CASE WHEN o.family IS NOT NULL THEN o.family ELSE '-' END)
        FROM own o CROSS JOIN days WHERE run = 'all-types'
      UNION ALL SELECT DISTINCT 'policy', a.workspace_id, day, run, a.policy_type, a.policy_id, '-|-|-|-|-' FROM attached a JOIN days USING (run)
        WHERE run = 'day-before' OR a.policy_type <> 'COMPUTE_POLICY'
          OR NOT EXISTS (SELECT 1 FROM known k WHERE k.workspace_id = a.workspace_id AND k.policy_id = a.policy_id)
      UNION ALL SELECT 'term', workspace_id, day, run, path, policy_id, concat_ws('|', rule_type,
          CASE WHEN path = 'workers' THEN '{"value":' || rule || '}' ELSE rule END, hidden, optional) FROM terms CROSS JOIN days WHERE run = 'all-types'""",
)
def q_run_inventory(spark, sf):
    """All six tables, stacked, after three runs of which the last replaced the second."""
    tables = inventoried(spark, sf)
    key = ["workspace_id", F.col("snapshot_date").alias("day"), F.col("collection_run_id").alias("run")]

    def part(table, name, kind, ident, *detail, by="|"):
        text = F.concat_ws(by, *[F.coalesce(c.cast("string"), F.lit("-")) for c in detail]).alias("detail")
        return tables.read(table).select(F.lit(name).alias("part"), *key, kind.alias("asset_type"), ident.alias("id"), text)

    kind, c = F.col("asset_type"), F.col
    flags = (c("discovery_source"), c("api_enriched"), c("tag_observation_complete"), c("policy_observation_complete"))
    rows = [
        part("collection_run", "run", kind, F.lit(""), c("status"), c("asset_count"), c("error_message"), by=" "),
        part("requirement_snapshot", "requirement", kind, c("product"), c("enabled"), F.array_join("required_tags", ","), F.array_join("required_policies", ","), by=" "),
        part("asset_inventory_snapshot", "asset", kind, c("asset_id"), c("product"), c("asset_name"), c("owner"), c("lifecycle_state"), tag_text("tags"), policy_text("policies"), *flags),
        part("asset_tag_snapshot", "tag", kind, c("asset_id"), c("tag_key"), c("tag_value"), by="="),
        part("policy_snapshot", "policy", c("policy_type"), c("policy_id"), c("policy_name"), c("description"), c("policy_family_id"), c("definition_json"),
             F.get_json_object("raw_payload", "$.resolved_policy_family.policy_family_id")),
        part("policy_term_snapshot", "term", c("definition_path"), c("policy_id"), c("rule_type"), c("rule_json"), c("hidden"), c("is_optional")),
    ]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


# --- running totals -------------------------------------------------------------------


def opened(spark, sf):
    """Cost as a dated table and its openings: first built while a tenth of the assets was missing, then corrected for the last 40 days."""
    cost = M.cost(spark, sf)
    folder = scratch(spark, "running")
    tables = V.VersionedTables(spark, f"{folder}/cost", {"asset_cost_daily": (_DAILY, ["usage_date"])})
    change = tables.change("all")
    change.add("asset_cost_daily", cost)
    change.commit()
    daily, openings = tables.read("asset_cost_daily"), R.openings_table(spark, f"{folder}/openings", double=True)
    early = openings.change("early")
    R.refresh_openings(early, daily.filter("usage_date < '2024-01-10' AND asset_id NOT LIKE '%7'"), "2024-01-10", None)
    early.commit()
    late = openings.change("late")
    R.refresh_openings(late, daily, MART_AS_OF, 40)
    late.commit()
    return daily, openings.read("asset_cost_opening")


_DAILY = (
    "workspace_id string, product string, asset_type string, asset_id string, usage_unit string, actual_daily_usage_quantity double, "
    "actual_daily_dollars double, billing_tagged_daily_dollars double, billing_untagged_daily_dollars double, currency_code string, pricing_source string, usage_date date"
)


@query("trailing_from_openings", ORACLES["trailing_cost"])
def q_trailing_from_openings(spark, sf):
    """Spend windows without a scan of old days."""
    daily, openings = opened(spark, sf)
    return R.trailing_from_openings(openings, daily, MART_AS_OF).select(
        "workspace_id", "product", "asset_type", "asset_id", *[r6(c) for c in M.SPEND_COLUMNS], "first_cost_date", "last_cost_date",
        F.array_join("currency_codes", ",").alias("currency_codes"),
    )


# --- migration ------------------------------------------------------------------------


@query(
    "migrate_tables",
    """SELECT CAST(event_id AS VARCHAR) AS record_id, user_id % 3 AS workspace_id, event_type AS kind, round(value, 6) AS amount,
      CAST(NULL AS VARCHAR) AS region, strftime(ts, '%Y-%m-%d') AS day FROM events""",
)
def q_migrate_tables(spark, sf):
    """Events stored under an old name and layout, moved by four steps, of which a second run repeats none."""
    tables = TableFolder(spark, scratch(spark, "layout"))
    e = b.table(spark, sf, "events")
    e.select("event_id", (F.col("user_id") % 3).cast("string").alias("ws"), "event_type", "value", "ts").write.parquet(f"{tables.folder}/old_events")
    steps = [
        Step("old_events", to="records"),
        Step("records", rename={"event_id": "record_id", "ws": "workspace_id", "event_type": "kind"}, add="region string"),
        Step("records", rename={"value": "amount", "ts": "day"}, cast="record_id string, workspace_id bigint, day date"),
        Step("records", cast="amount decimal(20,8)"),
    ]
    tables.migrate(steps[:2])
    tables.migrate(steps)
    tables.migrate(steps)
    return tables.read("records").select("record_id", "workspace_id", "kind", r6("amount"), "region", F.date_format("day", "yyyy-MM-dd").alias("day"))
