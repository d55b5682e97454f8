"""Running-cluster snapshots to the facts scoring needs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.exprs import filled

LIVE = (
    "cluster_id string, cluster_name string, creator_user_name string, cluster_source string, "
    "runtime_engine string, spark_version string, node_type_id string, driver_node_type_id string, "
    "num_workers int, executors array<struct<node_id:string>>, autoscale struct<min_workers:int,max_workers:int>"
)


def decode_live_clusters(raw: DataFrame) -> DataFrame:
    """Decode ``workspace_id, payload`` rows.

    Workers are the attached executors if any, else the fixed size, else the
    autoscale minimum, else none.
    """
    p = raw.select("workspace_id", F.from_json("payload", LIVE).alias("p")).select("workspace_id", "p.*")
    attached = F.when(F.size("executors") > 0, F.size("executors"))
    workers = F.coalesce(attached, "num_workers", "autoscale.min_workers", F.lit(0))
    photon = F.coalesce(F.col("runtime_engine") == "PHOTON", F.lit(False)) | F.coalesce(
        F.lower("spark_version").contains("photon"), F.lit(False)
    )
    return p.select(
        "workspace_id",
        "cluster_id",
        "cluster_name",
        F.col("creator_user_name").alias("creator"),
        "cluster_source",
        F.col("node_type_id").alias("node_type"),
        F.coalesce(filled(F.col("driver_node_type_id")), "node_type_id").alias("driver_node_type"),
        workers.cast("int").alias("num_workers"),
        photon.alias("photon"),
    )
