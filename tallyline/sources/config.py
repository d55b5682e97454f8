"""Configuration as data: fleet aliases and asset requirements."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyline.functions.scale import local_frame

# Fleet family -> concrete family whose rates it inherits.
FLEET_ALIASES = {
    "rd-fleet": "r5d",
    "r-fleet": "r5",
    "md-fleet": "m5d",
    "m-fleet": "m5",
    "c-fleet": "c5",
    "cd-fleet": "c5d",
    "i-fleet": "i3",
}

# Asset types with their default requirements.
ASSET_REQUIREMENTS = (
    ("cluster", "COMPUTE", True, "clusters", "cluster",
     ["cost_center", "business_unit", "product", "environment", "owner"], ["COMPUTE_POLICY"]),
    ("job", "WORKFLOWS", True, "jobs", "job", ["cost_center", "product", "owner"], ["BUDGET_POLICY"]),
    ("serving_endpoint", "MODEL_SERVING", True, "serving_endpoints", "serving_endpoint",
     ["cost_center", "product", "owner"], ["BUDGET_POLICY"]),
    ("warehouse", "SQL", True, "warehouses", "warehouse", ["cost_center", "product", "owner"], []),
)
_REQUIREMENT = (
    "asset_type string, product string, enabled boolean, collector string, cost_resolver string, "
    "required_tags array<string>, required_policies array<string>"
)


def fleet_aliases(spark: SparkSession, aliases: Mapping[str, str] = FLEET_ALIASES) -> DataFrame:
    return local_frame(spark, sorted(aliases.items()), "fleet_family string, base_family string")


def asset_requirements(spark: SparkSession, rows=ASSET_REQUIREMENTS) -> DataFrame:
    return local_frame(spark, list(rows), _REQUIREMENT)
