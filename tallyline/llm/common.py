"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions.scale import shared_dir

#: The lowest key: rows without an id take it where an order by id is needed.
LEAST = -(2**63)

#: White space as the word rules of the corpus tables have it.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders written inside each open ``scratch``.
_OPEN: list[list[str]] = []


def _folder(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end the tables that were stored inside; what is to last must be written to a ``Workspace`` from outside."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            _delete(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, and two readers do not compute it twice."""
    spark = df.sparkSession
    path = _folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of a sieve, at most (8 MB): of more than 2 million values it lets more through.
SIEVE = 1 << 26


def sieved(rows: DataFrame, column: str, among: DataFrame) -> DataFrame:
    """``rows`` with ``maybe``, which is false only where the value of ``column`` is none of those in the stored table ``among``.

    Bitmaps of hashed values travel to the rows, so that rows with long texts
    need no shuffle to find that they have no partner.
    """
    bits = min(SIEVE, 1 << max(15, (32 * among.count()).bit_length()))
    place = (F.pmod(F.xxhash64(column), F.lit(bits)) + 1).alias("_place")
    marks = among.select(place).groupBy(F.bitmap_bucket_number("_place").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"))
    at = F.bitmap_bit_position("_place")
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = rows.select("*", place).withColumn("_bucket", F.bitmap_bucket_number("_place")).join(F.broadcast(marks), "_bucket", "left")
    maybe = F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))
    return found.select(*(F.col(f"`{c}`") for c in rows.columns), maybe.alias("maybe"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole(text: Column | str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def spread(df: DataFrame, count: int | None = None) -> DataFrame:
    """Rows dealt out evenly where a scan has fewer tasks than the cluster has cores."""
    return df.repartition(count or partitions(df.sparkSession))


class Workspace:
    """A folder of written tables below the shared one, each of which can be given back when nothing reads it any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = _folder(spark, name)
        self._tables: dict[str, str] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def write_bucketed(self, df: DataFrame, name: str, column: str) -> DataFrame:
        """``df`` in as many buckets by ``column`` as shuffles have partitions: joins on the column leave it where it is.

        Buckets are known to the catalog only, so the table has a name there
        until ``forget`` or ``drop``; its files are those of the workspace like others.
        """
        at = f"{self.folder}/{name}"
        table = f"{name}_{uuid.uuid4().hex}".replace("-", "_")
        self._tables[name] = table
        df.write.option("compression", "zstd").option("path", at).bucketBy(partitions(self.spark), column).saveAsTable(table)
        return self.spark.table(table)

    def forget(self, name: str) -> DataFrame:
        """The bucketed table without its name in the catalog."""
        table = self._tables.pop(name)
        schema = self.spark.table(table).schema
        self.spark.sql(f"DROP TABLE {table}")
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}")

    def drop(self, name: str) -> None:
        if name in self._tables:
            self.spark.sql(f"DROP TABLE {self._tables.pop(name)}")
        _delete(self.spark, f"{self.folder}/{name}")
