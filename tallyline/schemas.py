"""Declared table schemas and conformance to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


POLICIES = "array<struct<policy_type:string,policy_id:string,policy_name:string>>"

SCORES = (
    "record_id string, workspace_id bigint, snapshot_ts timestamp, snapshot_date date, cluster_id string, "
    "cluster_name string, creator string, cluster_source string, node_type string, driver_node_type string, "
    "num_workers int, photon boolean, sku_name string, dbu_per_hour double, dollars_per_hour double, "
    "projected_daily_dollars double, baseline_mean double, baseline_stddev double, z_score double, "
    "signal string, reason string"
)
EVENT_LOG = (
    "event_ts timestamp, event_type string, detector_name string, workspace_id bigint, record_id string, "
    "asset_type string, asset_id string, asset_name string, severity string, recipient string, routing string, "
    "message_ts string, plain string, blocks string, details_json string"
)
INVENTORY = (
    "workspace_id string, collection_run_id string, snapshot_ts timestamp, snapshot_date date, product string, "
    "asset_type string, asset_id string, asset_name string, owner string, lifecycle_state string, "
    f"tags map<string,string>, policies {POLICIES}, discovery_source string, api_enriched boolean, "
    "tag_observation_complete boolean, policy_observation_complete boolean, raw_payload string"
)
COLLECTION_RUN = (
    "workspace_id string, collection_run_id string, snapshot_ts timestamp, snapshot_date date, asset_type string, "
    "status string, asset_count bigint, error_message string"
)
REQUIREMENTS = (
    "workspace_id string, collection_run_id string, snapshot_ts timestamp, snapshot_date date, product string, "
    "asset_type string, enabled boolean, collector string, cost_resolver string, required_tags array<string>, "
    "required_policies array<string>, config_hash string, raw_config string"
)
ASSET_TAGS = (
    "workspace_id string, collection_run_id string, snapshot_ts timestamp, snapshot_date date, asset_type string, "
    "asset_id string, tag_key string, tag_value string"
)
POLICY = (
    "workspace_id string, collection_run_id string, snapshot_ts timestamp, snapshot_date date, policy_type string, "
    "policy_id string, policy_name string, description string, definition_json string, policy_family_id string, "
    "raw_payload string"
)
POLICY_TERM = (
    "workspace_id string, collection_run_id string, snapshot_ts timestamp, snapshot_date date, policy_type string, "
    "policy_id string, definition_path string, rule_type string, rule_json string, hidden boolean, "
    "is_optional boolean"
)
ASSET_COST = (
    "workspace_id string, usage_date date, product string, asset_type string, asset_id string, usage_unit string, "
    "actual_daily_usage_quantity decimal(38,18), actual_daily_dollars decimal(38,12), "
    "billing_tagged_daily_dollars decimal(38,12), billing_untagged_daily_dollars decimal(38,12), "
    "currency_code string, pricing_source string"
)
ASSET_TAG_COST = (
    "workspace_id string, usage_date date, product string, asset_type string, asset_id string, tag_key string, "
    "tag_value string, actual_daily_dollars decimal(38,12), currency_code string, pricing_source string"
)
REFRESH_STATE = (
    "workspace_id string, asset_type string, history_start_date date, last_success_ts timestamp, resolver_hash string"
)


def conform_schema(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Add missing columns as typed NULLs, cast the others, drop extras, fix the order.

    ``snapshot_date`` is derived from ``snapshot_ts`` when only the latter is there.
    """
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    have = set(df.columns)

    def field(f: T.StructField):
        if f.name in have:
            value = F.col(f.name)
        elif f.name == "snapshot_date" and "snapshot_ts" in have:
            value = F.to_date("snapshot_ts")
        else:
            value = F.lit(None)
        return value.cast(f.dataType).alias(f.name)

    return df.select(*[field(f) for f in struct.fields])
