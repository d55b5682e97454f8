"""Tables that change together, partition by partition, one version at a time.

Parquet has neither DELETE nor MERGE, and overwriting partitions leaves those
that a rebuild finds empty.  Here data files are only ever added, below
``<table>/batch=<id>/<partition>``, and a version is a small table that lists
which batches of which partitions are alive.  A change writes its rows, names
the partitions that it retires, and becomes visible in all tables at once when
the list of the next version is complete; whatever fails before leaves readers
where they were.  Partitions that a change does not touch keep their files.

One writer at a time: of two that start from one version, the second to commit
fails.  Files that no kept version lists are removed by ``vacuum``.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.scale import local_frame
from tallyline.functions.storage import children, complete, delete, exists
from tallyline.params import AsOf, as_of_date

MANIFEST = "table string, batch string, key array<string>, run string"


class VersionedTables:
    """``tables`` gives each table's schema (DDL) and partition columns, which hold no NULL."""

    def __init__(self, spark: SparkSession, folder: str, tables: Mapping[str, tuple[str, Sequence[str]]]):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.tables = {name: (T.StructType.fromDDL(ddl), list(keys)) for name, (ddl, keys) in tables.items()}

    # -- versions --

    def _path(self, version: int) -> str:
        return f"{self.folder}/_versions/{version:010d}"

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        names = children(self.spark, f"{self.folder}/_versions")
        return [int(n) for n in names if n.isdigit() and complete(self.spark, self._path(int(n)))]

    def manifest(self, version: int | None = None) -> DataFrame:
        """``(table, batch, key, run)`` of a version, the newest by default; none before the first."""
        known = self.versions()
        version = version if version is not None else known[-1] if known else None
        if version is None:
            return local_frame(self.spark, [], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(self._path(version))

    def runs(self) -> set[str]:
        """Runs whose change is part of the newest version: one short string for each."""
        return {r.run for r in self.manifest().filter("table IS NULL").select("run").distinct().collect()}

    # -- reading --

    def live(self, name: str, version: int | None = None) -> DataFrame:
        """The partitions of a table: its partition columns and ``batch``."""
        schema, keys = self.tables[name]
        listed = self.manifest(version).filter(F.col("table") == name)
        return listed.select(*[F.col("key")[i].cast(schema[k].dataType).alias(k) for i, k in enumerate(keys)], "batch")

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table's rows.  Filters on partition columns prune folders, the list of the version prunes batches."""
        schema, keys = self.tables[name]
        path = f"{self.folder}/{name}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        files = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.StringType())])).parquet(path)
        return files.join(self.live(name, version), [*keys, "batch"], "left_semi").select(*schema.fieldNames())

    def change(self, run: str) -> Change:
        return Change(self, run)

    def vacuum(self, keep: int = 1) -> int:
        """Remove versions but the newest ``keep``, and files that none of those lists; gives how many files went."""
        versions = self.versions()
        kept = [self.manifest(v).filter("table IS NOT NULL").select("table", "batch", "key") for v in versions[-keep:]]
        gone = 0
        for name, (schema, keys) in self.tables.items():
            path = f"{self.folder}/{name}"
            if not kept or not exists(self.spark, path):
                continue
            alive = kept[0]
            for more in kept[1:]:
                alive = alive.unionByName(more)
            alive = alive.filter(F.col("table") == name).select(*[F.col("key")[i].cast(schema[k].dataType).alias(k) for i, k in enumerate(keys)], "batch").distinct()
            fields = [schema[k] for k in keys] + [T.StructField("batch", T.StringType())]
            files = self.spark.read.schema(T.StructType(fields)).parquet(path).select(*keys, "batch", F.col("_metadata.file_path").alias("file")).distinct()
            for row in files.join(alive, [*keys, "batch"], "left_anti").select("file").toLocalIterator():
                delete(self.spark, row.file)
                gone += 1
        for version in versions[:-keep]:
            delete(self.spark, self._path(version))
        return gone


class Change:
    """What one run adds and retires; nothing is visible before ``commit``."""

    def __init__(self, tables: VersionedTables, run: str):
        self.tables, self.run, self.batch = tables, run, uuid.uuid4().hex
        known = tables.versions()
        self.base = known[-1] if known else None
        self._added: list[DataFrame] = []
        self._retired: list[DataFrame] = []

    def live(self, name: str) -> DataFrame:
        """Partitions of the version that the change starts from."""
        if self.base is None:
            return self.tables.live(name, None).filter("false")
        return self.tables.live(name, self.base)

    def _key(self, name: str, frame: DataFrame):
        return frame.select(F.lit(name).alias("table"), F.array(*[F.col(k).cast("string") for k in self.tables.tables[name][1]]).alias("key"))

    def add(self, name: str, rows: DataFrame) -> None:
        """Write rows as new files of their partitions."""
        schema, keys = self.tables.tables[name]
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        path = f"{self.tables.folder}/{name}/batch={self.batch}"
        rows.hint("rebalance", *keys).write.partitionBy(*keys).parquet(path)
        written = self.tables.spark.read.schema(schema).parquet(path) if any("=" in c for c in children(self.tables.spark, path)) else rows.limit(0)
        self._added.append(self._key(name, written.select(*keys).distinct()))

    def retire(self, name: str, partitions: DataFrame) -> None:
        """Let go of partitions, given by their partition columns, with or without new files."""
        self._retired.append(self._key(name, partitions.select(*self.tables.tables[name][1]).distinct()))

    def commit(self) -> int:
        """Publish; gives the new version."""
        before = self.tables.manifest(self.base) if self.base is not None else local_frame(self.tables.spark, [], MANIFEST)
        after = before
        for gone in self._retired:
            after = after.join(gone, ["table", "key"], "left_anti")
        new = local_frame(self.tables.spark, [(None, self.batch, None, self.run)], MANIFEST)  # marks the run, also when it adds nothing
        for keys in self._added:
            new = new.unionByName(keys.select("table", F.lit(self.batch).alias("batch"), "key", F.lit(self.run).alias("run")))
        version = (self.base or 0) + 1
        path = self.tables._path(version)
        if exists(self.tables.spark, path) and not complete(self.tables.spark, path):
            delete(self.tables.spark, path)  # left by a commit that failed
        after.select("table", "batch", "key", "run").unionByName(new).hint("rebalance").write.parquet(path)
        return version


# -- the two ways of replacing ------------------------------------------------------


def replace_window_partitions(change: Change, name: str, new: DataFrame, scope: DataFrame, as_of: AsOf, date_col: str = "usage_date") -> None:
    """``state.replace_window`` on partitions of workspace, asset type and day.

    Days inside the window that the rebuild left empty are retired without new
    files; older days and other lenses are not read, let alone written.
    """
    live = change.live(name)
    window = scope.select(F.col("workspace_id").cast(live.schema["workspace_id"].dataType), "asset_type", F.date_sub(as_of_date(as_of), F.col("lookback_days")).alias("_from"))
    inside = live.join(window, ["workspace_id", "asset_type"]).filter(F.col(date_col) >= F.col("_from"))
    change.retire(name, inside)
    change.add(name, new)


def replace_snapshot_partitions(change: Change, name: str, new: DataFrame, replaced: DataFrame) -> None:
    """Take the place of the partitions ``replaced`` (the workspaces and days of a run), also in tables where the run found nothing."""
    keys = change.tables.tables[name][1]
    change.retire(name, change.live(name).join(replaced.select(*keys).distinct(), keys, "left_semi"))
    change.add(name, new)
