"""Cost by asset and tag, the current asset view, and how much of the bill is matched."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.exprs import EMPTY_TAGS
from tallyline.functions.scale import latest_per_key, written
from tallyline.operators.pricing import price_with_fallback
from tallyline.params import LENS_RULES, AsOf, LensRule, as_of_date, as_of_ts
from tallyline.schemas import POLICIES

ASSET = ("workspace_id", "asset_type", "asset_id")
NO_LIST = "cast(null as array<string>)"

# --- incremental plan -------------------------------------------------------


def resolver_hash(rule: LensRule) -> Column:
    """Changes whenever the meaning of a lens changes, which forces a rebuild of its history."""
    return F.sha2(F.lit(f"{rule.id_column}|{rule.billing_product or ''}"), 256)


def plan_refresh(enabled: DataFrame, state: DataFrame, correction_days: int, backfill_days: int) -> DataFrame:
    """How far back each enabled lens must be rebuilt.

    ``enabled`` has workspace_id, asset_type and resolver_hash.  A lens whose
    stored hash matches only absorbs late billing; so does one stored before
    hashes existed, except serving endpoints, whose meaning changed then.
    """
    if not backfill_days >= correction_days >= 1:
        raise ValueError("backfill_days must be >= correction_days >= 1")
    stored = state.select(
        "workspace_id", "asset_type", F.col("resolver_hash").alias("_stored"), F.lit(True).alias("_known")
    )
    same = F.col("_stored") == F.col("resolver_hash")
    legacy = F.col("_stored").isNull() & (F.col("asset_type") != "serving_endpoint")
    ready = F.coalesce(F.col("_known") & (same | legacy), F.lit(False))
    return enabled.join(stored, ["workspace_id", "asset_type"], "left").select(
        "workspace_id",
        "asset_type",
        "resolver_hash",
        F.when(ready, correction_days).otherwise(backfill_days).alias("lookback_days"),
    )


# --- rollups ----------------------------------------------------------------

_IDS = ("cluster_id", "job_id", "endpoint_name", "warehouse_id")


def lens_source(usage: DataFrame, as_of: AsOf, max_lookback_days: int) -> DataFrame:
    """The usage columns pricing and lenses need, over the longest window."""
    return usage.filter(F.col("usage_date") >= F.date_sub(as_of_date(as_of), max_lookback_days)).select(
        "account_id", "workspace_id", "cloud", "usage_date", "usage_start_time", "sku_name", "billing_origin_product",
        "usage_quantity", "usage_unit", "custom_tags", *[F.col(f"usage_metadata.{c}").alias(c) for c in _IDS],
    )


def daily_priced(priced: DataFrame) -> DataFrame:
    """Collapse priced usage to one row per day and combination of asset ids and tags.

    Both rollups start here, so the usage fact is scanned, priced and shuffled
    once, and tags are exploded only after this reduction.  Tags become a sorted
    entry array because maps cannot be grouping keys.
    """
    tags = F.sort_array(F.map_entries("custom_tags")).alias("tag_entries")
    return priced.groupBy(
        "workspace_id", "usage_date", "billing_origin_product", "usage_unit", *_IDS, tags, "currency_code",
        "pricing_source",
    ).agg(
        F.sum("usage_quantity").alias("usage_quantity"), F.sum("actual_dollars").alias("actual_dollars")
    )


def lens_usage(
    priced: DataFrame,
    lookbacks: DataFrame,
    as_of: AsOf,
    rules: Sequence[LensRule] = LENS_RULES,
) -> DataFrame:
    """Fan each row out to every asset type whose rule matches, within that type's lookback.

    Works on priced usage rows or on ``daily_priced``.  One row may appear under
    several asset types, so dollars must not be summed across types.
    """
    lenses = []
    for rule in rules:
        ident = F.col(rule.id_column).cast("string")
        if rule.billing_product is not None:
            ident = F.when(F.col("billing_origin_product") == rule.billing_product, ident)
        lenses.append(
            F.struct(F.lit(rule.asset_type).alias("asset_type"), F.lit(rule.product).alias("product"), ident.alias("asset_id"))
        )
    matching = F.filter(F.array(*lenses), lambda lens: lens["asset_id"].isNotNull())
    fanned = priced.select("*", F.inline(matching))
    window = lookbacks.select("workspace_id", "asset_type", "lookback_days")
    cutoff = F.date_sub(as_of_date(as_of), F.col("lookback_days"))
    return fanned.join(window, ["workspace_id", "asset_type"]).filter(F.col("usage_date") >= cutoff)


def _tag_count(df: DataFrame) -> Column:
    """Number of tags, 0 when the map is NULL."""
    return F.coalesce(F.size("tag_entries" if "tag_entries" in df.columns else "custom_tags"), F.lit(0))


def asset_cost_daily(lensed: DataFrame) -> DataFrame:
    """Quantity and dollars per asset and day, split by whether the usage carried any tag."""
    tagged = _tag_count(lensed) > 0
    dollars = F.col("actual_dollars")
    zero = F.lit(0).cast(lensed.schema["actual_dollars"].dataType)
    return lensed.groupBy(
        F.col("workspace_id").cast("string").alias("workspace_id"), "usage_date", "product", "asset_type", "asset_id",
        "usage_unit", "currency_code", "pricing_source",
    ).agg(
        F.sum("usage_quantity").alias("actual_daily_usage_quantity"),
        F.sum(dollars).alias("actual_daily_dollars"),
        F.sum(F.when(tagged, dollars).otherwise(zero)).alias("billing_tagged_daily_dollars"),
        F.sum(F.when(~tagged, dollars).otherwise(zero)).alias("billing_untagged_daily_dollars"),
    )


def asset_tag_cost_daily(lensed: DataFrame) -> DataFrame:
    """Dollars per asset, day and tag.  A row with two tags counts under both; untagged rows drop out."""
    entries = F.col("tag_entries") if "tag_entries" in lensed.columns else F.map_entries("custom_tags")
    per_tag = lensed.withColumn("_tag", F.explode(entries))
    return per_tag.groupBy(
        F.col("workspace_id").cast("string").alias("workspace_id"), "usage_date", "product", "asset_type", "asset_id",
        F.col("_tag.key").alias("tag_key"), F.col("_tag.value").alias("tag_value"), "currency_code", "pricing_source",
    ).agg(F.sum("actual_dollars").alias("actual_daily_dollars"))


def cost_rollup(
    usage: DataFrame,
    contract: DataFrame,
    list_: DataFrame,
    plan: DataFrame,
    as_of: AsOf,
    rules: Sequence[LensRule] = LENS_RULES,
    store: Callable[[DataFrame], DataFrame] = written,
) -> dict[str, DataFrame]:
    """Both rollups and the state rows of one refresh.

    ``plan`` comes from ``plan_refresh``; its largest lookback, one number, is
    what the scan of the usage goes back.  ``store`` materialises the reduced daily table, which
    both rollups read: left lazy, each would push its own filters into its own
    scan of the usage.  Apply ``replace_window`` and ``upsert_refresh_state`` to
    the results.
    """
    furthest = plan.agg(F.max("lookback_days")).first()[0] or 0
    daily = store(daily_priced(price_with_fallback(lens_source(usage, as_of, furthest), contract, list_)))
    lensed = lens_usage(daily, plan, as_of, rules)
    state = plan.select(
        F.col("workspace_id").cast("string").alias("workspace_id"),
        "asset_type",
        F.date_sub(as_of_date(as_of), F.col("lookback_days")).alias("history_start_date"),
        as_of_ts(as_of).alias("last_success_ts"),
        "resolver_hash",
    )
    return {
        "daily": daily,
        "asset_cost_daily": asset_cost_daily(lensed),
        "asset_tag_cost_daily": asset_tag_cost_daily(lensed),
        "state": state,
    }


# --- marts ------------------------------------------------------------------

WINDOWS = (
    "current_day_dollars", "previous_day_dollars", "trailing_7d_dollars", "trailing_30d_dollars",
    "trailing_90d_dollars", "month_to_date_dollars", "year_to_date_dollars", "total_observed_dollars",
)


def window_sums(cost: DataFrame, as_of: AsOf) -> dict[str, Column]:
    """Sums of the daily dollars over today, yesterday, the last 7/30/90 complete days, month and year to date, and all days."""
    today, day, dollars = as_of_date(as_of), F.col("usage_date"), F.col("actual_daily_dollars")
    yesterday = F.date_sub(today, 1)

    def total(when: Column) -> Column:
        return F.sum(F.when(when, dollars).otherwise(F.lit(0).cast(cost.schema["actual_daily_dollars"].dataType)))

    windows = {
        "current_day_dollars": day == today,
        "previous_day_dollars": day == yesterday,
        **{f"trailing_{n}d_dollars": day.between(F.date_sub(today, n), yesterday) for n in (7, 30, 90)},
        "month_to_date_dollars": day >= F.trunc(today, "month"),
        "year_to_date_dollars": day >= F.trunc(today, "year"),
    }
    return {**{name: total(when) for name, when in windows.items()}, "total_observed_dollars": F.sum(dollars)}


def trailing_cost(cost: DataFrame, as_of: AsOf) -> DataFrame:
    """Spend per asset and product over every window of ``window_sums``, in one pass over all days."""
    return cost.groupBy("workspace_id", "product", "asset_type", "asset_id").agg(
        *[s.alias(name) for name, s in window_sums(cost, as_of).items()],
        F.min("usage_date").alias("first_cost_date"),
        F.max("usage_date").alias("last_cost_date"),
        F.sort_array(F.collect_set("currency_code")).alias("currency_codes"),
    )


def latest_success(runs: DataFrame) -> DataFrame:
    """The newest successful run of every workspace and asset type."""
    good = runs.filter(F.col("status") == "SUCCESS")
    newest = latest_per_key(good, ["workspace_id", "asset_type"], [F.desc("snapshot_ts"), F.desc("collection_run_id")])
    return newest.select("workspace_id", "asset_type", "collection_run_id")


def latest_run_inventory(inventory: DataFrame, runs: DataFrame) -> DataFrame:
    """Rows of each asset type's newest successful run (also works for requirements)."""
    key = ["workspace_id", "asset_type", "collection_run_id"]
    return inventory.join(latest_success(runs), key, "left_semi")


_RULES = ("collection_run_id", "snapshot_ts", "snapshot_date", "required_tags", "required_policies", "config_hash")
_SPENT = (*WINDOWS, "first_cost_date", "last_cost_date", "currency_codes")


def _unmatched(spend: Callable[[str], Column], rule: Callable[[str], Column]) -> dict[str, Column]:
    """The columns of an asset that only the bill knows, by its spend row and the rules of its type."""
    text, yes = F.lit(None).cast("string"), F.lit(False)
    return {
        **{c: F.col(c) for c in ASSET},
        **{c: rule(c) for c in _RULES},
        "product": spend("product"),
        "asset_name": F.col("asset_id"),
        "owner": text,
        "lifecycle_state": F.lit("BILLING_ONLY"),
        "tags": F.expr(EMPTY_TAGS),
        "policies": F.array().cast(POLICIES),
        "discovery_source": F.lit("BILLING"),
        **dict.fromkeys(("api_enriched", "tag_observation_complete", "policy_observation_complete"), yes),
        "raw_payload": text,
        **dict.fromkeys(("missing_required_tags", "missing_required_policies"), F.expr(NO_LIST)),
        **dict.fromkeys(("tag_status", "policy_status"), F.lit("UNKNOWN")),
        "inventory_status": F.lit("BILLING_ONLY"),
        **{c: spend(c) for c in _SPENT},
        "actual_daily_dollars": spend("previous_day_dollars"),
    }


def billing_only_assets(
    spend: DataFrame, inventory: DataFrame, requirements: DataFrame, as_of: AsOf, days: int = 30
) -> DataFrame:
    """Assets on the bill in the last ``days`` days that the current inventory does not know.

    ``spend`` comes from ``trailing_cost``; ``inventory`` and ``requirements``
    are those of the latest run.
    """
    recent = spend.filter(F.col("last_cost_date") >= F.date_sub(as_of_date(as_of), days))
    unknown = recent.join(inventory.select(*ASSET), list(ASSET), "left_anti")
    ruled = unknown.join(requirements.select("workspace_id", "asset_type", *_RULES), ["workspace_id", "asset_type"])
    return ruled.select(*[v.alias(k) for k, v in _unmatched(F.col, F.col).items()])


def asset_current(
    history: DataFrame,
    runs: DataFrame,
    requirements: DataFrame,
    cost: DataFrame | None,
    as_of: AsOf,
    days: int = 30,
    spend: DataFrame | None = None,
) -> DataFrame:
    """Every known asset of the latest run with its spend, plus assets only the bill knows.

    ``history`` comes from ``evaluate_requirements``.  Spend of an observed
    asset covers all its products, so an asset is one row.  Inventory and spend
    (by asset, its products in a list) meet in one full outer join, of which
    each row becomes the row of its asset or one row per unmatched product.
    ``spend`` may come from ``running.trailing_from_openings`` in place of a
    scan of all ``cost``.
    """
    current = latest_run_inventory(history, runs)
    rules = latest_run_inventory(requirements, runs)
    per_product = trailing_cost(cost, as_of) if spend is None else spend
    kind = {f.name: f.dataType for f in per_product.schema.fields}
    per_asset = per_product.groupBy(*ASSET).agg(F.collect_list(F.struct("product", *_SPENT)).alias("_spend"))  # a handful of products
    known = current.select(*ASSET, F.struct(*current.columns).alias("_known"))
    rules = rules.select("workspace_id", "asset_type", F.struct(*_RULES).alias("_rule"))
    met = known.join(per_asset, list(ASSET), "full_outer").join(rules, ["workspace_id", "asset_type"], "left")
    observed = {
        **{c: F.col(f"_known.{c}") for c in current.columns},
        "inventory_status": F.lit("OBSERVED"),
        **{c: _total(c, kind[c]) for c in WINDOWS},
        "actual_daily_dollars": _total("previous_day_dollars", kind["previous_day_dollars"]),
        "first_cost_date": F.array_min(F.transform("_spend", lambda s: s["first_cost_date"])),
        "last_cost_date": F.array_max(F.transform("_spend", lambda s: s["last_cost_date"])),
        "currency_codes": F.sort_array(F.array_distinct(F.flatten(F.transform("_spend", lambda s: s["currency_codes"])))),
    }
    kinds = {**{f.name: f.dataType for f in current.schema.fields}, **kind, "inventory_status": T.StringType(), "actual_daily_dollars": kind["previous_day_dollars"]}

    def row(values: dict[str, Column]) -> Column:
        return F.struct(*[values[c].cast(kinds[c]).alias(c) for c in observed])

    since = F.date_sub(as_of_date(as_of), days)
    recent = F.filter("_spend", lambda s: F.col("_rule").isNotNull() & (s["last_cost_date"] >= since))
    alone = F.transform(recent, lambda s: row(_unmatched(lambda c: s[c], lambda c: F.col(f"_rule.{c}"))))
    return met.select(F.inline(F.when(F.col("_known").isNotNull(), F.array(row(observed))).otherwise(alone)))


def _total(column: str, kind: T.DataType) -> Column:
    """The sum of one amount over an asset's products; zero without any."""
    amounts = F.transform("_spend", lambda s: F.coalesce(s[column], F.lit(0).cast(kind)))
    return F.aggregate(F.coalesce(amounts, F.array().cast(T.ArrayType(kind))), F.lit(0).cast(kind), lambda total, x: (total + x).cast(kind))


def asset_daily(history: DataFrame, cost: DataFrame) -> DataFrame:
    """Assets and dollars per day and status.

    Cost is first summed to one row per asset and day, so an asset with several
    units or price sources still counts once.
    """
    spend = cost.groupBy(*ASSET, F.col("usage_date").alias("snapshot_date")).agg(
        F.sum("actual_daily_dollars").alias("actual_daily_dollars")
    )
    joined = history.select(*ASSET, "snapshot_date", "product", "tag_status", "policy_status").join(
        spend, [*ASSET, "snapshot_date"], "left"
    )
    return joined.groupBy(
        "workspace_id", "snapshot_date", "product", "asset_type", "tag_status", "policy_status"
    ).agg(
        F.count("*").alias("asset_count"),
        F.coalesce(F.sum("actual_daily_dollars"), F.lit(0)).alias("actual_daily_dollars"),
    )


def cost_coverage(inventory: DataFrame, runs: DataFrame, cost: DataFrame) -> DataFrame:
    """Per day and asset type: how many billed assets and dollars the latest inventory knows.

    Cost is one row per asset after the first aggregation, so assets are counted
    without a distinct.
    """
    known = latest_run_inventory(inventory, runs).select(*ASSET).distinct().withColumn("_known", F.lit(True))
    spend = cost.groupBy("workspace_id", "usage_date", "product", "asset_type", "asset_id").agg(
        F.sum("actual_daily_dollars").alias("dollars")
    )
    matched = spend.join(known, list(ASSET), "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    dollars, hit = F.col("dollars"), F.col("_known")
    zero = F.lit(0).cast(cost.schema["actual_daily_dollars"].dataType)
    totals = matched.groupBy("workspace_id", "usage_date", "product", "asset_type").agg(
        F.count("*").alias("billed_asset_count"),
        F.count_if(hit).alias("inventory_matched_asset_count"),
        F.count_if(~hit).alias("billing_only_asset_count"),
        F.sum(dollars).alias("total_billed_dollars"),
        F.sum(F.when(hit, dollars).otherwise(zero)).alias("inventory_matched_dollars"),
        F.sum(F.when(~hit, dollars).otherwise(zero)).alias("billing_only_dollars"),
    )
    pct = lambda part, whole: F.try_divide(F.lit(100.0) * F.col(part), F.col(whole))
    return totals.withColumns(
        {
            "asset_coverage_pct": pct("inventory_matched_asset_count", "billed_asset_count"),
            "dollar_coverage_pct": pct("inventory_matched_dollars", "total_billed_dollars"),
        }
    )


def observed_tags_policies(current: DataFrame) -> DataFrame:
    """Assets and 30-day dollars per tag value and per attached policy."""
    def values(kind: str, type_: Column, ident: Column, name: Column) -> Column:
        return F.struct(F.lit(kind).alias("governance_kind"), type_.alias("governance_type"), ident.alias("governance_id"), name.alias("governance_name"))

    tags = F.transform(F.map_entries("tags"), lambda t: values("TAG", t["key"], t["value"], F.lit(None).cast("string")))
    policies = F.transform("policies", lambda p: values("POLICY", p["policy_type"], p["policy_id"], p["policy_name"]))
    both = F.flatten(F.filter(F.array(tags, policies), lambda v: v.isNotNull()))
    each = current.select("workspace_id", "product", "asset_type", "asset_id", "trailing_30d_dollars", F.inline(both))
    keys = ["workspace_id", "product", "asset_type", "governance_kind", "governance_type", "governance_id", "governance_name"]
    # First to one row per asset and value, then count: no distinct set per value is ever held.
    per_asset = each.groupBy(*keys, "asset_id").agg(
        F.sum("trailing_30d_dollars").alias("trailing_30d_dollars")
    )
    return per_asset.groupBy(*keys).agg(
        F.count("*").alias("asset_count"), F.sum("trailing_30d_dollars").alias("trailing_30d_dollars")
    )
