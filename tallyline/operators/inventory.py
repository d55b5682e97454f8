"""The asset inventory: discovered assets enriched by API payloads, one snapshot per run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyline.functions.exprs import filled, merge_tags, normalize_policies
from tallyline.functions.scale import latest_per_key, written
from tallyline.params import AsOf, as_of_ts
from tallyline.schemas import ASSET_TAGS, COLLECTION_RUN, INVENTORY, REQUIREMENTS, conform_schema

ASSET_KEY = ("workspace_id", "asset_type", "asset_id")


def merge_inventory(discovered: DataFrame, enriched: DataFrame) -> DataFrame:
    """Full outer merge per asset.

    Discovered only: unchanged.  API only: kept as ``API_ONLY``, fully observed.
    Both: name and owner prefer discovery, lifecycle prefers the API, API tags
    win, policies are united, and everything counts as observed.  Of several
    API rows of one asset the one whose payload sorts last counts.
    """
    enriched = latest_per_key(enriched, ASSET_KEY, [F.col("raw_payload").desc_nulls_last(), F.col("asset_name").desc_nulls_last()])
    fields = [c for c in discovered.columns if c not in ASSET_KEY]
    left = discovered.select(*ASSET_KEY, F.struct(*fields).alias("d"))
    right = enriched.select(*ASSET_KEY, F.struct(*fields).alias("e"))
    both = left.join(right, list(ASSET_KEY), "full_outer")
    in_d, in_e = F.col("d").isNotNull(), F.col("e").isNotNull()
    d, e = (lambda c: F.col(f"d.{c}")), (lambda c: F.col(f"e.{c}"))

    def pick(name: str, merged: Column, api_only: Column | None = None) -> Column:
        alone = e(name) if api_only is None else api_only
        return F.when(~in_e, d(name)).when(~in_d, alone).otherwise(merged).alias(name)

    true = F.lit(True)
    payloads = F.to_json(
        F.struct(e("raw_payload").alias("api"), d("raw_payload").alias("system_table")), {"ignoreNullFields": "false"}
    )
    return both.select(
        *ASSET_KEY,
        pick("asset_name", F.coalesce(filled(d("asset_name")), e("asset_name"))),
        pick("owner", F.coalesce(filled(d("owner")), e("owner"))),
        pick("lifecycle_state", F.coalesce(filled(e("lifecycle_state")), d("lifecycle_state"))),
        pick("tags", merge_tags(d("tags"), e("tags"))),
        pick("policies", normalize_policies(F.concat(d("policies"), e("policies")))),
        pick("discovery_source", d("discovery_source"), F.lit("API_ONLY")),
        pick("api_enriched", true, true),
        pick("tag_observation_complete", true, true),
        pick("policy_observation_complete", true, true),
        pick("raw_payload", payloads),
    )


def name_policies(inventory: DataFrame, listed: DataFrame) -> DataFrame:
    """Set the name of every attached compute policy from the policy list (NULL when not listed).

    Only attachments travel through the join; they regroup per asset, whose own
    list bounds the group.
    """
    names = listed.select("workspace_id", F.col("policy_id").alias("_id"), F.col("policy_name").alias("_name"))
    attached = (
        inventory.filter(F.exists("policies", lambda p: p["policy_type"] == "COMPUTE_POLICY"))
        .select(*ASSET_KEY, F.explode("policies").alias("p"))
        .withColumn("_id", F.col("p.policy_id"))
        .join(names, ["workspace_id", "_id"], "left")
    )
    compute = F.col("p.policy_type") == "COMPUTE_POLICY"
    renamed = F.struct(
        F.col("p.policy_type").alias("policy_type"),
        F.col("p.policy_id").alias("policy_id"),
        F.when(compute, F.col("_name")).otherwise(F.col("p.policy_name")).alias("policy_name"),
    )
    regrouped = attached.groupBy(*ASSET_KEY).agg(F.sort_array(F.collect_list(renamed)).alias("_policies"))
    return (
        inventory.join(regrouped, list(ASSET_KEY), "left")
        .withColumn("policies", F.coalesce("_policies", "policies"))
        .select(*inventory.columns)
    )


def inventory_snapshot(
    discovered: list[DataFrame],
    enriched: list[DataFrame],
    requirements: DataFrame,
    run_id: str,
    as_of: AsOf,
    listed_policies: DataFrame | None = None,
    store: Callable[[DataFrame], DataFrame] = written,
) -> DataFrame:
    """The merged inventory of the enabled asset types, stamped with its run.

    Where policies are named, the merged rows are read twice: ``store`` writes
    them, so that assets are discovered, parsed and merged once.
    """
    merged = merge_inventory(_stack(discovered), _stack(enriched))
    if listed_policies is not None:
        merged = name_policies(store(merged), listed_policies)
    enabled = requirements.filter("enabled").select("asset_type", "product").distinct()
    rows = merged.join(enabled, "asset_type").withColumns(
        {"collection_run_id": F.lit(run_id), "snapshot_ts": as_of_ts(as_of)}
    )
    return conform_schema(rows, INVENTORY)


def _stack(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def collection_runs(inventory: DataFrame, requirements: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """One SUCCESS row per enabled asset type of the run, also when it has no assets.

    ``errors`` (asset_type, error_message) records failed enrichment, which does
    not fail the run: discovery alone defines the inventory.
    """
    counts = inventory.groupBy("workspace_id", "collection_run_id", "asset_type").agg(F.count("*").alias("asset_count"))
    rows = requirements.filter("enabled").join(
        counts, ["workspace_id", "collection_run_id", "asset_type"], "left"
    )
    rows = rows.join(errors, "asset_type", "left") if errors is not None else rows
    rows = rows.withColumns({"status": F.lit("SUCCESS"), "asset_count": F.coalesce("asset_count", F.lit(0))})
    return conform_schema(rows, COLLECTION_RUN)


def asset_tags(inventory: DataFrame) -> DataFrame:
    """One row per asset and tag."""
    return conform_schema(inventory.select("*", F.explode("tags").alias("tag_key", "tag_value")), ASSET_TAGS)


def requirement_snapshot(config: DataFrame, workspaces: DataFrame, run_id: str, as_of: AsOf) -> DataFrame:
    """The rules active in a run, for every workspace, disabled types included.

    Tags are compared in lower case and policy types in upper case; the hash
    covers the configuration as written.
    """
    raw = F.to_json(F.struct(*sorted(c for c in config.columns)), {"ignoreNullFields": "false"})
    rules = config.withColumns(
        {
            "raw_config": raw,
            "config_hash": F.sha2(raw, 256),
            "required_tags": F.transform("required_tags", lambda v: F.lower(F.trim(v))),
            "required_policies": F.transform("required_policies", lambda v: F.upper(F.trim(v))),
            "collection_run_id": F.lit(run_id),
            "snapshot_ts": as_of_ts(as_of),
        }
    )
    # The configuration is a few rows: one scalar subquery puts it on every workspace.
    packed = rules.agg(F.collect_list(F.struct(*rules.columns)))
    spread = workspaces.select("workspace_id").distinct().withColumn("r", packed.scalar())
    return conform_schema(spread.select("workspace_id", F.inline("r")), REQUIREMENTS)


def config_history(requirements: DataFrame) -> DataFrame:
    """All requirement rows, marked where the rules differ from the previous run's."""
    runs = Window.partitionBy("workspace_id", "asset_type").orderBy("snapshot_ts", "collection_run_id")
    previous = F.lag("config_hash").over(runs)
    return requirements.withColumn("config_changed", F.coalesce(previous != F.col("config_hash"), F.lit(False)))
