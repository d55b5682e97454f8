"""Whole jobs: the steps of a run in their order, each done once, published at the end."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.storage import complete, delete
from tallyline.operators import costs as C
from tallyline.operators import inventory as I
from tallyline.operators.policy import policy_snapshot
from tallyline.operators.pricing import price_with_fallback
from tallyline.operators.state import upsert_refresh_state
from tallyline.operators.versions import VersionedTables, replace_snapshot_partitions, replace_window_partitions
from tallyline.params import LENS_RULES, AsOf, LensRule, as_of_date, as_of_ts
from tallyline.schemas import ASSET_COST, ASSET_TAG_COST, ASSET_TAGS, COLLECTION_RUN, INVENTORY, POLICY, POLICY_TERM, REFRESH_STATE, REQUIREMENTS


class Journal:
    """The steps that a run has finished, as written tables; a run started again goes on after the last of them."""

    def __init__(self, spark: SparkSession, folder: str, run: str):
        self.spark, self.folder = spark, f"{folder.rstrip('/')}/_journal/{run}"

    def done(self, step: str) -> bool:
        return complete(self.spark, f"{self.folder}/{step}")

    def step(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The table of a step: as an earlier attempt left it, else built and written now."""
        path = f"{self.folder}/{name}"
        if not self.done(name):
            delete(self.spark, path)  # half of a step
            build().write.parquet(path)
        return self.spark.read.parquet(path)

    def close(self) -> None:
        """Forget the steps of a run that is published."""
        delete(self.spark, self.folder)


# -- costs ------------------------------------------------------------------------

_LENS_DAY = ("workspace_id", "asset_type", "usage_date")


def cost_tables(spark: SparkSession, folder: str, double: bool = False) -> VersionedTables:
    """The tables of the cost refresh; ``double`` where prices and quantities are doubles."""
    kind = (lambda ddl: ddl.replace("decimal(38,18)", "double").replace("decimal(38,12)", "double")) if double else (lambda ddl: ddl)
    return VersionedTables(
        spark,
        folder,
        {
            "asset_cost_daily": (kind(ASSET_COST), _LENS_DAY),
            "asset_tag_cost_daily": (kind(ASSET_TAG_COST), _LENS_DAY),
            "cost_refresh_state": (REFRESH_STATE, ["workspace_id"]),
        },
    )


def refresh_costs(
    tables: VersionedTables,
    usage: DataFrame,
    contract: DataFrame,
    list_: DataFrame,
    enabled: DataFrame,
    as_of: AsOf,
    run_id: str,
    correction_days: int,
    backfill_days: int,
    rules: Sequence[LensRule] = LENS_RULES,
) -> int:
    """One cost refresh: plan, price and reduce the usage once, replace the windows, state last.  Gives the version.

    Each step is kept in a journal, so a run that broke off goes on where it
    stopped, with the plan that it started from; a run that is published does
    nothing when started again.  Both rollups and the state appear together.
    ``enabled`` comes with workspace_id, asset_type and resolver_hash; without
    a row nothing changes.
    """
    if run_id in tables.runs():
        return tables.versions()[-1]
    journal = Journal(tables.spark, tables.folder, run_id)
    key = F.col("workspace_id").cast("string").alias("workspace_id")

    def planned() -> DataFrame:
        wanted = enabled.select(key, "asset_type", "resolver_hash")
        return C.plan_refresh(wanted, tables.read("cost_refresh_state"), correction_days, backfill_days)

    plan = journal.step("plan", planned)
    furthest = plan.agg(F.max("lookback_days")).first()[0]
    if furthest is None:
        return (tables.versions() or [0])[-1]

    def reduced() -> DataFrame:
        source = C.lens_source(usage, as_of, furthest)
        mine = source.withColumn("workspace_id", F.col("workspace_id").cast("string")).join(plan.select("workspace_id").distinct(), "workspace_id", "left_semi")
        return C.daily_priced(price_with_fallback(mine, contract, list_))

    daily = journal.step("daily", reduced)
    lensed = C.lens_usage(daily, plan, as_of, rules)
    change = tables.change(run_id)
    replace_window_partitions(change, "asset_cost_daily", C.asset_cost_daily(lensed), plan, as_of)
    replace_window_partitions(change, "asset_tag_cost_daily", C.asset_tag_cost_daily(lensed), plan, as_of)
    ran = plan.select(
        "workspace_id", "asset_type", F.date_sub(as_of_date(as_of), F.col("lookback_days")).alias("history_start_date"),
        as_of_ts(as_of).alias("last_success_ts"), "resolver_hash",
    )
    workspaces = plan.select("workspace_id").distinct()
    before = tables.read("cost_refresh_state").join(workspaces, "workspace_id", "left_semi")
    change.retire("cost_refresh_state", workspaces)
    change.add("cost_refresh_state", upsert_refresh_state(before, ran))
    version = change.commit()
    journal.close()
    return version


# -- inventory --------------------------------------------------------------------

_SNAPSHOT = ("workspace_id", "snapshot_date")


def inventory_tables(spark: SparkSession, folder: str) -> VersionedTables:
    """The six tables of an inventory run."""
    schemas = {
        "collection_run": COLLECTION_RUN,
        "requirement_snapshot": REQUIREMENTS,
        "asset_inventory_snapshot": INVENTORY,
        "asset_tag_snapshot": ASSET_TAGS,
        "policy_snapshot": POLICY,
        "policy_term_snapshot": POLICY_TERM,
    }
    return VersionedTables(spark, folder, {name: (ddl, _SNAPSHOT) for name, ddl in schemas.items()})


def run_inventory(
    tables: VersionedTables,
    discovered: Sequence[DataFrame],
    enriched: Sequence[DataFrame],
    config: DataFrame,
    workspaces: DataFrame,
    policies: DataFrame,
    families: DataFrame,
    run_id: str,
    as_of: AsOf,
    errors: DataFrame | None = None,
) -> int:
    """One inventory run over all asset types: build everything, write everything, then publish six tables at once.

    ``discovered`` and ``enriched`` are the results of ``sources.discovery`` and
    ``sources.payloads``; ``errors`` (asset_type, error_message) are enrichments
    that failed, which leave the run a success.  The run takes the place of any
    earlier one of the same workspaces and UTC day in every table, also where
    it found nothing.  If anything fails before the end, readers see nothing of
    it; started again, the run goes on after the steps that it has finished.
    Gives the version.
    """
    if run_id in tables.runs():
        return tables.versions()[-1]
    journal = Journal(tables.spark, tables.folder, run_id)
    requirements = journal.step("requirements", lambda: I.requirement_snapshot(config, workspaces, run_id, as_of))
    listed = policies.select("workspace_id", "policy_id", F.col("name").alias("policy_name"))
    none = discovered[0].limit(0)

    def collected() -> DataFrame:
        merged = lambda df: journal.step("merged", lambda: df)
        return I.inventory_snapshot(list(discovered), list(enriched) or [none], requirements, run_id, as_of, listed, store=merged)

    inventory = journal.step("inventory", collected)
    rows, terms = policy_snapshot(policies, families, inventory, run_id, as_of, store=lambda df: journal.step("policies", lambda: df))
    change = tables.change(run_id)
    ran = requirements.select(*_SNAPSHOT).unionByName(inventory.select(*_SNAPSHOT)).unionByName(rows.select(*_SNAPSHOT)).distinct()
    ran = journal.step("replaced", lambda: ran)
    for name, frame in {
        "collection_run": I.collection_runs(inventory, requirements, errors),
        "requirement_snapshot": requirements,
        "asset_inventory_snapshot": inventory,
        "asset_tag_snapshot": I.asset_tags(inventory),
        "policy_snapshot": rows,
        "policy_term_snapshot": terms,
    }.items():
        replace_snapshot_partitions(change, name, frame, ran)
    version = change.commit()
    journal.close()
    return version
