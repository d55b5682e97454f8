"""Public node-rate documents: arrays of {compute, plan, instance, dburate} records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Document schema and the marker that accelerated rows carry in their names.
DOCUMENT = "compute string, plan string, instance string, dburate string"
ACCELERATED_SUFFIX = r"\s*\(Photon\)\s*$"
ACCELERATED_WORKLOAD = "Photon"


def read_pricing_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DOCUMENT).json(path, multiLine=True)


def load_pricing_document(raw: DataFrame, workloads: Sequence[str], plan: str) -> DataFrame:
    """Keep the wanted workloads of one plan (rates do not depend on it) and clean instance names."""
    return raw.filter(F.col("compute").isin(list(workloads)) & (F.col("plan") == plan)).withColumn(
        "instance", F.regexp_replace("instance", ACCELERATED_SUFFIX, "")
    )
