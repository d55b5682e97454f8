"""Required tags and policies, judged by the rules of the run that saw the asset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.exprs import missing_policies, missing_tags


def requirement_status(required: Column, missing: Column, observed: Column) -> Column:
    """NOT_CONFIGURED, UNKNOWN, APPLIED, PARTIAL or NOT_APPLIED, in that precedence."""
    return (
        F.when(F.size(required) == 0, "NOT_CONFIGURED")
        .when(~observed, "UNKNOWN")
        .when(F.size(missing) == 0, "APPLIED")
        .when(F.size(missing) < F.size(required), "PARTIAL")
        .otherwise("NOT_APPLIED")
    )


def evaluate_requirements(inventory: DataFrame, requirements: DataFrame) -> DataFrame:
    """Join each asset to the rules of its own run, so a later rule change never rewrites history.

    What could not be observed has NULL missing lists, not empty ones.
    """
    key = ["workspace_id", "collection_run_id", "asset_type"]
    rules = requirements.select(*key, "required_tags", "required_policies", "config_hash")
    rows = inventory.join(rules, key).select(*inventory.columns, "required_tags", "required_policies", "config_hash")
    tags_seen = F.coalesce("tag_observation_complete", F.lit(False))
    policies_seen = F.coalesce("policy_observation_complete", F.lit(False))
    judged = rows.withColumns(
        {
            "_tags": missing_tags(F.col("tags"), F.col("required_tags")),
            "_policies": missing_policies(F.col("policies"), F.col("required_policies")),
        }
    )
    return judged.select(
        *rows.columns,
        F.when(tags_seen, F.col("_tags")).alias("missing_required_tags"),
        F.when(policies_seen, F.col("_policies")).alias("missing_required_policies"),
        requirement_status(F.col("required_tags"), F.col("_tags"), tags_seen).alias("tag_status"),
        requirement_status(F.col("required_policies"), F.col("_policies"), policies_seen).alias("policy_status"),
    )
