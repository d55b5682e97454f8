"""Moving stored tables to newer layouts, one recorded step at a time.

The history of a table is an ordered list of steps: it gets another name,
columns get other names, columns are added, types change.  A folder of tables
records the number of the last step that its tables went through and where each
table's files are; ``migrate`` applies the steps after that and no other, so
running it twice is running it once.  Each step writes the tables that it
changes to new files and becomes visible with its record; old files stay, and a
step that fails leaves the layout before it.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions.scale import local_frame
from tallyline.functions.storage import children, complete, delete, exists

LAYOUT = "table string, path string"


@dataclass(frozen=True)
class Step:
    """What happens to one table: ``to`` is its new name, ``rename`` maps old to new column names, ``add`` and ``cast`` are DDL."""

    table: str
    to: str | None = None
    rename: Mapping[str, str] = field(default_factory=dict)
    add: str = ""
    cast: str = ""


def applied(df: DataFrame, step: Step) -> DataFrame:
    """The rows under the step's layout; added columns are NULL, and those that are there already stay."""
    clash = [new for old, new in step.rename.items() if new in df.columns and old in df.columns]
    if clash:
        raise ValueError(f"{step.table} already has {', '.join(clash)}")
    df = df.withColumnsRenamed(dict(step.rename))
    added = T.StructType.fromDDL(step.add) if step.add else []
    df = df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in added if f.name not in df.columns})
    kinds = T.StructType.fromDDL(step.cast) if step.cast else []
    return df.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in kinds})


class TableFolder:
    """Tables below one folder whose layout is recorded."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def level(self) -> int:
        """The number of steps that the tables went through."""
        names = children(self.spark, f"{self.folder}/_layout")
        return max((int(n) for n in names if n.isdigit() and complete(self.spark, f"{self.folder}/_layout/{n}")), default=0)

    def paths(self) -> dict[str, str]:
        """Where the files of every table are; before any step, in the folder of the table's name."""
        level = self.level()
        if level == 0:
            return {n: n for n in children(self.spark, self.folder) if not n.startswith(("_", "."))}
        return {r.table: r.path for r in self.spark.read.schema(LAYOUT).parquet(f"{self.folder}/_layout/{level:06d}").collect()}  # a row per table

    def read(self, table: str) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").parquet(f"{self.folder}/{self.paths()[table]}")

    def migrate(self, steps: Sequence[Step], partition_by: Mapping[str, Sequence[str]] | None = None) -> int:
        """Apply the steps that are not recorded yet; gives how many were applied.  A step of a table that is not there is only recorded."""
        start = self.level()
        for number, step in enumerate(steps[start:], start + 1):
            paths = self.paths()
            name = step.to or step.table
            if step.table in paths:
                if step.to and step.to in paths:
                    raise ValueError(f"{step.to} is there already")
                at = paths.pop(step.table)
                if step.rename or step.add or step.cast:
                    moved = f"{name}@{number}-{uuid.uuid4().hex[:8]}"
                    rows = applied(self.spark.read.option("mergeSchema", "true").parquet(f"{self.folder}/{at}"), step)
                    rows.write.partitionBy(*(partition_by or {}).get(name, ())).parquet(f"{self.folder}/{moved}")
                    at = moved
                paths[name] = at  # a new name alone moves no file
            record = f"{self.folder}/_layout/{number:06d}"
            if exists(self.spark, record):
                delete(self.spark, record)  # left by a step that broke off
            local_frame(self.spark, sorted(paths.items()), LAYOUT).coalesce(1).write.parquet(record)
        return len(steps) - min(start, len(steps))
