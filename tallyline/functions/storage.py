"""Folders of the shared file system, by Hadoop's own client, so that any path Spark can read will do."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _at(spark, path)
    return files.exists(at)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a Spark job has written the folder to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def children(spark: SparkSession, path: str) -> list[str]:
    at, files = _at(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(at)) if files.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    at, files = _at(spark, path)
    files.delete(at, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    at, files = _at(spark, source)
    if not files.rename(at, _at(spark, target)[0]):
        raise OSError(f"cannot move {source} to {target}")
