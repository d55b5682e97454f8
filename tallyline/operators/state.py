"""Table maintenance as DataFrame algebra, plus the plain Parquet writes around it.

Parquet tables have no DELETE or MERGE.  Each function returns the whole new
content of a table, which the caller writes as a new version; nothing is
changed in place, so a failed job leaves the old version intact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.params import AsOf, as_of_date
from tallyline.schemas import conform_schema


def append_merge(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name; a column only one side has is NULL on the other."""
    return old.unionByName(new, allowMissingColumns=True)


def replace_window(old: DataFrame, new: DataFrame, scope: DataFrame, as_of: AsOf, date_col: str = "usage_date") -> DataFrame:
    """Replace the recent part of a rollup.

    ``scope`` (workspace_id, asset_type, lookback_days) says how far back each
    lens was rebuilt.  Old rows inside that range go even when the rebuild
    produced nothing for their day; older rows and other lenses stay.
    """
    window = scope.select("workspace_id", "asset_type", F.date_sub(as_of_date(as_of), F.col("lookback_days")).alias("_from"))
    window = window.withColumn("workspace_id", F.col("workspace_id").cast(old.schema["workspace_id"].dataType))
    outside = F.col("_from").isNull() | (F.col(date_col) < F.col("_from"))
    kept = old.join(window, ["workspace_id", "asset_type"], "left").filter(outside).select(*old.columns)
    return kept.unionByName(new.select(*old.columns))


def replace_snapshot(old: DataFrame, new: DataFrame, keys: Sequence[str] = ("workspace_id", "snapshot_date")) -> DataFrame:
    """A new run takes the place of an earlier run of the same workspace and day."""
    replaced = new.select(*keys).distinct()
    kept = old.join(replaced, list(keys), "left_anti").select(*old.columns)
    return kept.unionByName(new.select(*old.columns))


def upsert_refresh_state(state: DataFrame, run: DataFrame) -> DataFrame:
    """Insert or update per (workspace, asset type); the history start never moves forward."""
    key = ["workspace_id", "asset_type"]
    old = state.select(*key, F.struct("history_start_date", "last_success_ts", "resolver_hash").alias("o"))
    new = run.select(*key, F.struct("history_start_date", "last_success_ts", "resolver_hash").alias("n"))
    updated = F.col("n").isNotNull()
    return old.join(new, key, "full_outer").select(
        *key,
        F.least("o.history_start_date", "n.history_start_date").alias("history_start_date"),
        F.when(updated, F.col("n.last_success_ts")).otherwise(F.col("o.last_success_ts")).alias("last_success_ts"),
        F.when(updated, F.col("n.resolver_hash")).otherwise(F.col("o.resolver_hash")).alias("resolver_hash"),
    )


# --- physical writes --------------------------------------------------------


def _balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Few files per partition value: AQE joins small shuffle partitions and splits those of a hot value."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Replace content and schema; returns the table read back."""
    _balanced(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append; columns may be new, ``read_merged`` reconciles the files."""
    _balanced(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def read_merged(spark: SparkSession, path: str, schema=None) -> DataFrame:
    df = spark.read.option("mergeSchema", "true").parquet(path)
    return df if schema is None else conform_schema(df, schema)


def write_by_snapshot_date(df: DataFrame, path: str) -> None:
    """Append partitioned by the UTC date of ``snapshot_ts``."""
    append_table(df.withColumn("snapshot_date", F.to_date("snapshot_ts")), path, ["snapshot_date"])
