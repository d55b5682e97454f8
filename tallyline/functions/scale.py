"""Helpers that keep plans sound on a large cluster.

Joins carry no broadcast hints.  Spark compares its own size estimate of a side with
``spark.sql.autoBroadcastJoinThreshold`` and broadcasts only what is below it;
anything larger is a shuffled join whose hot keys AQE splits.  Configuration
frames are therefore built by ``local_frame`` (an Arrow
backed relation with an exact size), not from a Python RDD whose size Spark
must assume to be unbounded.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators rely on (all may be changed on a live session)."""
    for key, value in {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }.items():
        spark.conf.set(key, value)
    return spark


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType) -> DataFrame:
    """A small configuration table whose exact size the planner knows."""
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(struct)
    columns = list(zip(*rows)) if rows else [()] * len(struct)
    table = pa.table([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], schema=arrow)
    return spark.createDataFrame(table, schema=struct)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Without one, a machine-local folder serves only a local master, whose
    executors are this process; on a cluster that is an error.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="tallyline-")
    spark.sparkContext.setCheckpointDir(named)
    return spark.sparkContext.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder, so that lost executors cost nothing upstream."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str = "side") -> DataFrame:
    """``df`` computed once into the shared folder; as files it has an exact size, by which Spark chooses the join."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """The first row of every key under ``order``.

    Spark turns ``row_number() = 1`` into a group limit on both sides of the
    shuffle, so each map task sends at most one row per key and a hot key never
    gathers in one task.  ``order`` must break ties.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
