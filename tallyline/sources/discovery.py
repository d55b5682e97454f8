"""Current assets from change-row dimensions.

The newest row of a key is chosen first and its delete marker tested second, so
a deleted asset disappears instead of falling back to its last live version.
At equal change times a delete wins, then the named tie columns decide.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.exprs import EMPTY_TAGS, filled, normalize_policies, normalize_tags, policy_struct
from tallyline.functions.scale import latest_per_key
from tallyline.schemas import POLICIES


def asset_rows(
    rows: DataFrame,
    *,
    asset_type: str,
    asset_id: Column,
    asset_name: Column,
    owner: Column,
    lifecycle_state: Column,
    tags: Column,
    policies: Column,
    raw_payload: Column,
    discovery_source: str,
    api_enriched: bool,
    tags_observed: bool,
    policies_observed: bool,
) -> DataFrame:
    """The common inventory row.  A missing name falls back to the id."""
    ident = asset_id.cast("string")
    return rows.select(
        F.col("workspace_id").cast("string").alias("workspace_id"),
        F.lit(asset_type).alias("asset_type"),
        ident.alias("asset_id"),
        F.coalesce(filled(asset_name), ident).alias("asset_name"),
        owner.alias("owner"),
        lifecycle_state.alias("lifecycle_state"),
        tags.alias("tags"),
        policies.alias("policies"),
        F.lit(discovery_source).alias("discovery_source"),
        F.lit(api_enriched).alias("api_enriched"),
        F.lit(tags_observed).alias("tag_observation_complete"),
        F.lit(policies_observed).alias("policy_observation_complete"),
        raw_payload.alias("raw_payload"),
    )


def no_policies() -> Column:
    return F.array().cast(POLICIES)


def _live(scd: DataFrame, key: str, delete_col: str, order: Sequence[str], tie: Sequence[str]) -> DataFrame:
    ranked = [F.desc(c) for c in (*order, delete_col, *tie)]
    return latest_per_key(scd, ["workspace_id", key], ranked).filter(F.col(delete_col).isNull())


def _payload(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def discover_clusters(
    scd: DataFrame, sources: Sequence[str] = ("UI", "API"), tie: Sequence[str] = ("cluster_name", "owned_by")
) -> DataFrame:
    wanted = scd.filter(F.upper("cluster_source").isin(list(sources)))
    return asset_rows(
        _live(wanted, "cluster_id", "delete_time", ["change_time"], tie),
        asset_type="cluster",
        asset_id=F.col("cluster_id"),
        asset_name=F.col("cluster_name"),
        owner=F.col("owned_by"),
        lifecycle_state=F.lit("ACTIVE"),
        tags=normalize_tags(F.col("tags")),
        policies=normalize_policies(F.array(policy_struct("COMPUTE_POLICY", F.col("policy_id")))),
        raw_payload=_payload(
            ["cluster_id", "cluster_name", "owned_by", "tags", "cluster_source", "policy_id", "create_time",
             "delete_time", "change_time"]
        ),
        discovery_source="SYSTEM_TABLE",
        api_enriched=False,
        tags_observed=True,
        policies_observed=True,
    )


def discover_jobs(scd: DataFrame, tie: Sequence[str] = ("name", "creator_id")) -> DataFrame:
    live = _live(scd, "job_id", "delete_time", ["change_time"], tie).withColumn(
        "owner", F.coalesce("run_as_user_name", "creator_user_name", "run_as", "creator_id")
    )
    return asset_rows(
        live,
        asset_type="job",
        asset_id=F.col("job_id"),
        asset_name=F.col("name"),
        owner=F.col("owner"),
        lifecycle_state=F.when(F.col("paused"), "PAUSED").otherwise("ACTIVE"),
        tags=normalize_tags(F.col("tags")),
        policies=no_policies(),
        raw_payload=_payload(["job_id", "name", "owner", "tags", "paused", "create_time", "delete_time", "change_time"]),
        discovery_source="SYSTEM_TABLE",
        api_enriched=False,
        tags_observed=True,
        policies_observed=False,
    )


def discover_endpoints(scd: DataFrame, tie: Sequence[str] = ("endpoint_id", "created_by")) -> DataFrame:
    return asset_rows(
        _live(scd, "endpoint_name", "endpoint_delete_time", ["change_time", "endpoint_config_version"], tie),
        asset_type="serving_endpoint",
        asset_id=F.col("endpoint_name"),
        asset_name=F.col("endpoint_name"),
        owner=F.col("created_by"),
        lifecycle_state=F.lit("ACTIVE"),
        tags=F.expr(EMPTY_TAGS),
        policies=no_policies(),
        raw_payload=_payload(
            ["endpoint_name", "endpoint_id", "created_by", "endpoint_config_version", "endpoint_delete_time",
             "change_time"]
        ),
        discovery_source="SYSTEM_TABLE",
        api_enriched=False,
        tags_observed=False,
        policies_observed=False,
    )


def discover_warehouses(scd: DataFrame, tie: Sequence[str] = ("warehouse_name", "created_by")) -> DataFrame:
    # Warehouses have no policy attachments, so an empty list is a complete observation.
    return asset_rows(
        _live(scd, "warehouse_id", "delete_time", ["change_time"], tie),
        asset_type="warehouse",
        asset_id=F.col("warehouse_id"),
        asset_name=F.col("warehouse_name"),
        owner=F.col("created_by"),
        lifecycle_state=F.lit("ACTIVE"),
        tags=normalize_tags(F.col("tags")),
        policies=no_policies(),
        raw_payload=_payload(
            ["warehouse_id", "warehouse_name", "warehouse_type", "warehouse_size", "created_by", "tags", "change_time",
             "delete_time"]
        ),
        discovery_source="SYSTEM_TABLE",
        api_enriched=False,
        tags_observed=True,
        policies_observed=True,
    )
