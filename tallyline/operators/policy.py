"""Policy definitions: family overrides, flattened terms and the catalogue of all policies seen."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.exprs import filled, json_object, overlay, parse_policy
from tallyline.functions.scale import written
from tallyline.params import AsOf, as_of_ts
from tallyline.schemas import POLICY, POLICY_TERM, conform_schema


def merge_policy(policies: DataFrame, families: DataFrame) -> DataFrame:
    """Add ``rules`` (path to rule JSON) and ``resolved_policy_family``: a policy of a family is the family definition with the
    policy's overrides replacing whole rules; others use their own definition."""
    inherited = families.select("policy_family_id", F.col("definition").alias("_family"), F.struct(*sorted(families.columns)).alias("_resolved"))
    has_family = filled(F.col("policy_family_id")).isNotNull()
    rules = F.when(
        has_family, overlay(parse_policy(F.col("_family")), parse_policy(F.col("policy_family_definition_overrides")))
    ).otherwise(parse_policy(F.col("definition")))
    resolved = F.when(has_family, F.col("_resolved")).alias("resolved_policy_family")
    joined = policies.hint("repartition").join(inherited, "policy_family_id", "left")  # a scan of few row groups would parse in few tasks
    return joined.select(*policies.columns, rules.alias("rules"), resolved)


def _flag(rule: Column, member: str) -> Column:
    """A rule member read as true or false: missing, null, false, zero and empty are false."""
    text = F.get_json_object(rule, f"$.{member}")
    return F.coalesce(~text.isin("false", "0", "0.0", "", "[]", "{}"), F.lit(False))


def flatten_policy_terms(policies: DataFrame) -> DataFrame:
    """One row per policy and path of ``rules``; a scalar rule becomes ``{"value": rule}``."""
    keep = [c for c in policies.columns if c not in ("rules", "resolved_policy_family")]
    terms = policies.select(*keep, F.explode("rules").alias("definition_path", "_rule"))
    scalar = ~F.col("_rule").startswith("{")
    rule = F.when(scalar, F.concat(F.lit('{"value":'), F.col("_rule"), F.lit("}"))).otherwise(F.col("_rule"))
    terms = terms.withColumn("rule_json", rule)
    return terms.select(
        *keep,
        "definition_path",
        F.coalesce(F.get_json_object("rule_json", "$.type"), F.lit("UNKNOWN")).alias("rule_type"),
        "rule_json",
        _flag(F.col("rule_json"), "hidden").alias("hidden"),
        _flag(F.col("rule_json"), "isOptional").alias("is_optional"),
    )


def policy_catalogue(listed: DataFrame, inventory: DataFrame) -> DataFrame:
    """Listed policies plus every attached policy that is not listed, one row per (type, id).

    ``listed`` has workspace_id, policy_id, policy_name, description,
    definition_json, policy_family_id and raw_payload.  The name of an unlisted
    policy is the one on the first asset in (type, id) order; an unlisted
    compute policy has none.
    """
    key = ["workspace_id", "policy_type", "policy_id"]
    known = listed.withColumn("policy_type", F.lit("COMPUTE_POLICY"))
    known = known.select(*key, *[c for c in known.columns if c not in key])
    seen = inventory.select(
        "workspace_id", "asset_type", "asset_id", F.explode("policies").alias("p")
    ).groupBy("workspace_id", F.col("p.policy_type").alias("policy_type"), F.col("p.policy_id").alias("policy_id"))
    attached = seen.agg(
        F.min(F.struct("asset_type", "asset_id", F.col("p.policy_name").alias("policy_name"))).alias("first")
    ).select(*key, F.when(F.col("policy_type") != "COMPUTE_POLICY", F.col("first.policy_name")).alias("policy_name"))
    extra = attached.join(known.select(*key), key, "left_anti")
    return known.unionByName(extra, allowMissingColumns=True)


def policy_snapshot(
    policies: DataFrame,
    families: DataFrame,
    inventory: DataFrame,
    run_id: str,
    as_of: AsOf,
    store: Callable[[DataFrame], DataFrame] = written,
) -> tuple[DataFrame, DataFrame]:
    """The run's policy rows and policy-term rows.

    The payload of a policy holds the family that it was resolved with.  Both
    tables read the resolved definitions that ``store`` wrote, so these are
    parsed and merged once.
    """
    stamp = {"collection_run_id": F.lit(run_id), "snapshot_ts": as_of_ts(as_of)}
    resolved = store(merge_policy(policies, families))
    listed = resolved.select(
        "workspace_id",
        "policy_id",
        F.col("name").alias("policy_name"),
        "description",
        json_object(F.col("rules")).alias("definition_json"),
        "policy_family_id",
        F.to_json(F.struct(*sorted([*policies.columns, "resolved_policy_family"]))).alias("raw_payload"),
    )
    rows = conform_schema(policy_catalogue(listed, inventory).withColumns(stamp), POLICY)
    typed = resolved.select("workspace_id", "policy_id", "rules").withColumns(
        {"policy_type": F.lit("COMPUTE_POLICY"), **stamp}
    )
    return rows, conform_schema(flatten_policy_terms(typed), POLICY_TERM)
