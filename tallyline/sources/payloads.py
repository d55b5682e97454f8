"""Asset rows from tables of JSON payloads (``workspace_id``, ``payload``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.exprs import filled, normalize_policies, normalize_tags, policy_struct, tags_from_pairs
from tallyline.sources.discovery import asset_rows, no_policies

_CLUSTER = (
    "cluster_id string, cluster_name string, creator_user_name string, cluster_source string, state string, "
    "policy_id string, custom_tags map<string,string>"
)
_ENDPOINT = (
    "name string, creator string, budget_policy_id string, usage_policy_id string, "
    "tags array<map<string,string>>, state struct<ready:string,config_update:string>"
)
_WAREHOUSE = (
    "id string, name string, creator_name string, state string, "
    "tags struct<custom_tags:array<map<string,string>>>"
)


#: Tasks stay variants: they nest to any depth, which no schema has to know.
_JOB = (
    "job_id string, creator_user_name string, run_as_user_name string, effective_budget_policy_id string, "
    "effective_usage_policy_id string, trigger_state struct<pause_status:string>, "
    "settings struct<name:string, tags:map<string,string>, budget_policy_id:string, usage_policy_id:string, "
    "job_clusters:array<struct<new_cluster:struct<policy_id:string>>>, tasks:array<variant>>"
)


def _decoded(raw: DataFrame, schema: str, wanted: Callable[[Column], Column] | None = None) -> DataFrame:
    """Payloads parsed once each; ``wanted`` judges the parsed value where it is made, as a filter would be pushed down with a parser of its own.

    Parsing takes far longer than reading, and a scan has no more tasks than
    its files have row groups, so the payloads are dealt out first.
    """
    raw = raw.hint("repartition")
    parsed = F.from_json("payload", schema)
    if wanted is None:
        return raw.select("workspace_id", "payload", parsed.alias("p"))
    return raw.select("workspace_id", "payload", F.explode(F.filter(F.array(parsed), wanted)).alias("p"))


def _from_api(rows: DataFrame, asset_type: str, **columns: Column) -> DataFrame:
    return asset_rows(
        rows,
        asset_type=asset_type,
        raw_payload=F.col("payload"),
        discovery_source="API",
        api_enriched=True,
        tags_observed=True,
        policies_observed=True,
        **columns,
    )


def payload_clusters(raw: DataFrame) -> DataFrame:
    rows = _decoded(raw, _CLUSTER, lambda p: F.upper(p["cluster_source"]).isin("UI", "API"))
    return _from_api(
        rows,
        "cluster",
        asset_id=F.col("p.cluster_id"),
        asset_name=F.col("p.cluster_name"),
        owner=F.col("p.creator_user_name"),
        lifecycle_state=F.coalesce(filled(F.col("p.state")), F.lit("UNKNOWN")),
        tags=normalize_tags(F.col("p.custom_tags")),
        policies=normalize_policies(F.array(policy_struct("COMPUTE_POLICY", F.col("p.policy_id")))),
    )


def nested_policy_ids(settings: Column, levels: Column) -> Column:
    """Policy ids of job clusters, of tasks, and of the tasks nested in for-each tasks, ``levels`` deep at most.

    The walk goes down a level at a time, from the tasks of one to those inside
    their for-each tasks, and ends where there are none.
    """
    none = F.array().cast("array<string>")

    def down(at: Column, _: Column) -> Column:
        here = F.transform(at["tasks"], lambda t: F.try_variant_get(t, "$.new_cluster.policy_id", "string"))
        inner = F.transform(at["tasks"], lambda t: F.try_variant_get(t, "$.for_each_task.task", "variant"))
        return F.struct(F.filter(inner, lambda t: t.isNotNull()).alias("tasks"), F.concat(at["ids"], here).alias("ids"))

    tasks = F.coalesce(F.filter(settings["tasks"], lambda t: t.isNotNull()), F.array().cast("array<variant>"))
    walked = F.aggregate(F.sequence(F.lit(0), levels), F.struct(tasks.alias("tasks"), none.alias("ids")), down, lambda at: at["ids"])
    clusters = F.coalesce(F.transform(settings["job_clusters"], lambda c: c["new_cluster"]["policy_id"]), none)
    return F.sort_array(F.array_distinct(F.filter(F.concat(clusters, walked), lambda i: filled(i).isNotNull())))


def payload_jobs(raw: DataFrame) -> DataFrame:
    """For-each tasks are read to whatever depth a payload has; a payload cannot nest deeper than it names them."""
    levels = F.regexp_count("payload", F.lit("for_each_task"))
    settings = F.col("p.settings")
    attached = F.array(
        policy_struct(
            "BUDGET_POLICY",
            F.coalesce(filled(F.col("p.effective_budget_policy_id")), settings["budget_policy_id"]),
        ),
        policy_struct(
            "USAGE_POLICY", F.coalesce(filled(F.col("p.effective_usage_policy_id")), settings["usage_policy_id"])
        ),
    )
    compute = F.transform(nested_policy_ids(settings, levels), lambda i: policy_struct("COMPUTE_POLICY", i))
    return _from_api(
        _decoded(raw, _JOB),
        "job",
        asset_id=F.col("p.job_id"),
        asset_name=settings["name"],
        owner=F.coalesce(filled(F.col("p.run_as_user_name")), F.col("p.creator_user_name")),
        lifecycle_state=F.coalesce(filled(F.col("p.trigger_state.pause_status")), F.lit("ACTIVE")),
        tags=normalize_tags(settings["tags"]),
        policies=normalize_policies(F.concat(attached, compute)),
    )


def payload_endpoints(raw: DataFrame) -> DataFrame:
    """The endpoint name is the key billing knows, so it is the asset id."""
    return _from_api(
        _decoded(raw, _ENDPOINT),
        "serving_endpoint",
        asset_id=F.col("p.name"),
        asset_name=F.col("p.name"),
        owner=F.col("p.creator"),
        lifecycle_state=F.coalesce(
            filled(F.col("p.state.ready")), filled(F.col("p.state.config_update")), F.lit("UNKNOWN")
        ),
        tags=tags_from_pairs(F.col("p.tags")),
        policies=normalize_policies(
            F.array(
                policy_struct("BUDGET_POLICY", F.col("p.budget_policy_id")),
                policy_struct("USAGE_POLICY", F.col("p.usage_policy_id")),
            )
        ),
    )


def payload_warehouses(raw: DataFrame) -> DataFrame:
    return _from_api(
        _decoded(raw, _WAREHOUSE),
        "warehouse",
        asset_id=F.col("p.id"),
        asset_name=F.col("p.name"),
        owner=F.col("p.creator_name"),
        lifecycle_state=F.coalesce(filled(F.col("p.state")), F.lit("UNKNOWN")),
        tags=tags_from_pairs(F.col("p.tags.custom_tags")),
        policies=no_policies(),
    )
