"""Exact percentiles that never gather a group.

The built-in exact ``percentile`` keeps one hash map of distinct values per
group, which is unbounded.  Here a first pass counts values per logarithmic
bucket (a pure function of the value, so recomputed tasks agree), a running
count over the buckets says which bucket holds each wanted rank, and a second
pass puts only the distinct values of those buckets in order.  Neither pass
shuffles the values themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyline.functions.scale import written

# ln of the smallest and the largest double are about -745 and 710, so shifting
# by 750 keeps the buckets of positive values above zero.
_SHIFT = 750


def _bucket(value: Column, per_e_fold: int) -> Column:
    size = F.floor((F.ln(F.abs(value)) + _SHIFT) * per_e_fold)
    return F.when(value > 0, size).when(value < 0, -size).otherwise(F.lit(0).cast("bigint"))


def _holds(rank: Column) -> Column:
    """Whether a bucket contains a zero-based rank."""
    return (rank >= F.col("_before")) & (rank < F.col("_before") + F.col("_n"))


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, probs: Mapping[str, float], per_e_fold: int = 1024
) -> DataFrame:
    """Linear-interpolation percentiles of ``value`` per ``keys``: one column per ``probs`` entry.

    ``df`` is read twice, the first time at once: pass a stored table.
    """
    keys = list(keys)
    values = (
        df.select(*keys, F.col(value).cast("double").alias("_v"))
        .filter(F.col("_v").isNotNull())
        .withColumn("_b", F.when(F.col("_v") != 0, _bucket(F.col("_v"), per_e_fold)).otherwise(F.lit(0)))
    )
    counted = values.groupBy(*keys, "_b").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(*keys)
    running = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("_before", F.sum("_n").over(running) - F.col("_n")).withColumn(
        "_total", F.sum("_n").over(whole)
    )

    # Each probability asks for one or two neighbouring ranks with weights that sum to one.
    wanted, hit = [], F.lit(False)
    for name, prob in probs.items():
        pos = F.lit(float(prob)) * (F.col("_total") - 1)
        low = F.floor(pos)
        for rank, weight in ((low, 1.0 - (pos - low)), (low + 1, pos - low)):
            wanted.append(F.struct(F.lit(name).alias("p"), rank.alias("k"), weight.alias("w")))
            hit = hit | _holds(rank)
    inside = F.filter(F.array(*wanted), lambda t: (t["w"] > 0) & _holds(t["k"]))
    # The plain comparison sorts out nearly all buckets before the arrays are built for the rest.
    targets = placed.filter(hit).select(*keys, "_b", "_before", inside.alias("_t"))

    # Few rows pass this join, and equal values meet on the map side before anything is shuffled.
    distinct = (
        values.join(written(targets, "buckets"), [*keys, "_b"])
        .groupBy(*keys, "_b", "_before", "_t", "_v")
        .agg(F.count("*").alias("_n"))
    )
    within = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ordered = distinct.withColumn("_end", F.col("_before") + F.sum("_n").over(within))
    here = F.filter("_t", lambda t: (t["k"] < F.col("_end")) & (t["k"] >= F.col("_end") - F.col("_n")))
    found = ordered.select(*keys, F.explode(here).alias("_t"), "_v")
    return found.groupBy(*keys).agg(
        *[F.sum(F.when(F.col("_t.p") == name, F.col("_t.w") * F.col("_v"))).alias(name) for name in probs]
    )
