"""Mixing sources to target weights: a time-varying curriculum.

Each source has a schedule of weights over training time (0 to 1), linear
between its knots.  Its share is the integral of its schedule over the sum of
all integrals; a source that would have to be repeated more often than
``repeats`` allows keeps that many repeats, and the excess goes to the others
by weight.  A source's documents stand in a fixed random order.  All are taken
as many whole times as the target allows, and the first ones once more until
the target is reached, the last of them in part.  The words of a source, laid
end to end once for every time they are taken, are its cumulative demand: the
place of each use of a document in it is turned back into the training time at
which the schedule's integral has used up that demand, and sorting all uses by
that time gives the mixed order.

Null text has no words and null sources are a source of their own.  Documents
without words take part with nothing.  Rows with equal ids are told apart by
their size only.  A source without words has target 0; with no source above
weight 0 nothing is taken.

The order inside a source is split over hash ranges, so that a source with a
third of all rows is ranked by many tasks.  Only DataFrame functions are used.
Sources themselves (one row each) are ordered in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyline.llm.common import WORD, partitions, stored, table, whole

WEIGHTS = (5.0, 2.0, 1.0)
#: Weight factors over time by place: knots (time, factor).  These are of mean 1, so that the shares are those of WEIGHTS.
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))

Schedule = Sequence[tuple[float, float]]


def integral(schedule: Schedule) -> float:
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:]))


def _inverse(schedule: Schedule, share: Column) -> Column:
    """The time at which ``share`` of a schedule's integral is used up."""
    whole_area, used = integral(schedule), 0.0
    out = F.lit(float(schedule[-1][0]))
    pieces = []
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        area = (t1 - t0) * (w0 + w1) / 2
        if area <= 0:
            continue
        rest = share * whole_area - used
        slope = (w1 - w0) / (t1 - t0)
        if abs(slope) < 1e-12:
            time = t0 + rest / w0
        else:
            time = t0 + (F.sqrt(F.greatest(F.lit(0.0), w0 * w0 + 2 * slope * rest)) - w0) / slope
        pieces.append((used + area, time))
        used += area
    for end, time in reversed(pieces):
        out = F.when(share * whole_area <= end, time).otherwise(out)
    return out


def shares(weights: Sequence[float], schedules: Sequence[Schedule]) -> list[float]:
    """The weight over the whole training of every place: its weight times the integral of its schedule, until both repeat."""
    return [float(weights[i % len(weights)]) * integral(schedules[i % len(schedules)]) for i in range(math.lcm(len(weights), len(schedules)))]


def source_targets(sizes: DataFrame, weights: Sequence[float], repeats: float) -> DataFrame:
    """``(source, source_size, place, target)``; ``place`` is the source's number by code point, nulls last."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.withColumn("place", F.row_number().over(order) - 1)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    rows = rows.withColumn("weight", F.when(F.col("source_size") > 0, weight).otherwise(0.0))
    # a source is at its limit before those with more limit per weight; the first that is not sets the level for the rest
    rows = rows.withColumn("limit", F.col("source_size") * repeats).withColumn("ratio", F.when(F.col("weight") > 0, F.col("limit") / F.col("weight")))
    up = Window.orderBy(F.col("ratio").asc_nulls_last(), "place").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rows = rows.withColumn("total", F.sum("source_size").over(everything)).withColumn("weights", F.sum("weight").over(everything))
    full = F.coalesce(F.sum(F.when(F.col("weight") > 0, F.col("limit"))).over(up), F.lit(0.0))
    left = F.col("weights") - F.coalesce(F.sum("weight").over(up), F.lit(0.0))
    rows = rows.withColumn("level", F.when((F.col("weight") > 0) & (left > 0), (F.col("total") - full) / left))
    rows = rows.withColumn("chosen", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place", "level"))).over(everything))
    below = F.struct("ratio", "place") < F.struct("chosen.ratio", "chosen.place")
    target = F.when(F.col("weight") <= 0, 0.0).when(F.col("chosen").isNull() | below, F.col("limit")).otherwise(F.col("weight") * F.col("chosen.level"))
    return rows.select("source", "source_size", "place", target.cast("double").alias("target"))


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    schedules: Sequence[Schedule] = SCHEDULES,
    repeats: int = 3,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``(id, size, source_size, target, taken, position, positions, *carry)``: the time of the first use, null if none, and of every use."""
    spark = docs.sparkSession
    buckets = 4 * partitions(spark)
    kept = [F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry)]
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        F.regexp_count(whole(text_col), F.lit(WORD)).cast("bigint").alias("size"), *kept,
    )
    rows = rows.withColumn("draw", F.md5(F.coalesce(F.col("id").cast("string"), F.lit(""))))
    # the range of the hash, by its first 32 bits, so that ranges follow the order of the draw
    bits = F.conv(F.substring("draw", 1, 8), 16, 10).cast("bigint")
    rows = stored(rows.withColumn("range", F.floor(bits * buckets / 2.0**32).cast("int")), "sizes")
    parts = rows.groupBy("source", "range").agg(F.sum("size").alias("part"))
    before = F.sum("part").over(Window.partitionBy("source").orderBy("range")) - F.col("part")
    targets = source_targets(parts.groupBy("source").agg(F.sum("part").alias("source_size")), shares(weights, schedules), repeats)
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    parts = parts.withColumn("before", before)
    starts = parts.join(targets, same(parts, targets)).select(parts["source"].alias("of"), F.col("range").alias("in"), "before", "source_size", "place", "target")
    order = Window.partitionBy("source", "range").orderBy("draw", F.col("id").asc_nulls_last(), "size")
    placed = rows.withColumn("within", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    placed = placed.join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("in")))
    start = F.col("before") + F.col("within")
    goal = F.round("target").cast("bigint")
    cycles = F.when(F.col("source_size") > 0, F.floor(goal / F.greatest(F.col("source_size"), F.lit(1)))).otherwise(0).cast("bigint")
    once_more = F.least("size", F.greatest(F.lit(0).cast("bigint"), goal - cycles * F.col("source_size") - start))
    taken = (cycles * F.col("size") + once_more).cast("bigint")
    uses = cycles + (once_more > 0).cast("bigint")

    def time(use: Column) -> Column:
        """The time of a use, by the demand that it starts at."""
        share = F.when(goal > 0, (start + use * F.col("source_size")) / goal)
        out = F.lit(None).cast("double")
        for i, schedule in enumerate(schedules):
            out = F.when(F.col("place") % len(schedules) == i, _inverse(schedule, share)).otherwise(out)
        return out

    positions = F.when(taken > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), uses - 1), time)).otherwise(F.array().cast("array<double>"))
    out = placed.select(F.col("id").alias(id_col), "size", F.col("source_size").cast("bigint").alias("source_size"), "target", taken.alias("taken"),
                        F.when(taken > 0, time(F.lit(0))).alias("position"), positions.alias("positions"), *(F.col(f"carry_{i}").alias(c) for i, c in enumerate(carry)))
    return out


def mixed_order(plan: DataFrame, key: str = "mix_row") -> DataFrame:
    """Every use of the rows of ``mixed``, sorted by its time, ``key`` and number, then the rows without a use.

    ``positions`` gives way to ``use`` (from 0), ``at`` and ``words``, the part of the size that the use takes.
    """
    kept = [c for c in plan.columns if c not in ("position", "positions")]
    uses = plan.select(*kept, F.posexplode_outer("positions").alias("use", "at"))
    # no use takes more than the whole, the last what is left
    uses = uses.withColumn("words", F.when(F.col("use").isNotNull(), F.least("size", F.col("taken") - F.col("use") * F.col("size"))).otherwise(0))
    order = (F.col("at").asc_nulls_last(), key, "use")
    return uses.repartitionByRange(*order).sortWithinPartitions(*order)


def op7_curriculum_mix(spark, sf_dir: str) -> DataFrame:
    """All documents mixed by weights 5, 2, 1 of their sources: every use has its time and its place in the mixed order, which is written.

    A document has one row (as in ``OP7_SQL``): the words of all its uses, and the time of the first, by which the rows are sorted.
    """
    docs = table(spark, sf_dir, "documents").withColumn("mix_row", F.monotonically_increasing_id())
    plan = stored(mixed(docs, carry=["mix_row"]), "mix")
    uses = stored(mixed_order(plan), "order")
    names = ("doc_id", "size", "source_size", "target")
    rows = uses.groupBy("mix_row").agg(*(F.first(c).alias(c) for c in names), F.sum("words").alias("taken"), F.min(F.struct("use", "at")).alias("first"))
    rows = rows.withColumn("at", F.col("first.at")).orderBy(F.col("at").asc_nulls_last(), "mix_row")
    return rows.select(*names, "taken", F.round("at", 6).alias("position"))


OP7_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS draw
  FROM documents
),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
placed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sums),
weighed AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0.0 ELSE [5.0, 2.0, 1.0][place % 3 + 1] END AS weight,
         CAST(sum(source_size) OVER () AS DOUBLE) AS total
  FROM placed
),
levels AS (
  -- the level at which capped and uncapped targets together use up everything, tried at every source's limit
  SELECT max(level) AS level FROM (
    SELECT (any_value(a.total) - sum(CASE WHEN 3.0 * b.source_size / b.weight < 3.0 * a.source_size / a.weight THEN 3.0 * b.source_size ELSE 0 END))
           / sum(CASE WHEN 3.0 * b.source_size / b.weight >= 3.0 * a.source_size / a.weight THEN b.weight ELSE 0 END) AS level
    FROM weighed a JOIN weighed b ON a.weight > 0 AND b.weight > 0 GROUP BY a.source, a.source_size, a.weight
    )
),
targets AS (
  SELECT source, place, source_size, CASE WHEN weight = 0 THEN 0.0 ELSE least(3.0 * source_size, weight * level) END AS target
  FROM weighed, levels
),
laid AS (
  SELECT doc_id, size, source_size, place, target, CAST(round(target) AS BIGINT) AS goal,
         sum(size) OVER (PARTITION BY s.source ORDER BY draw, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) - size AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
),
counted AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE CAST((goal // source_size) * size + least(size, greatest(0, goal % source_size - start)) AS BIGINT) END AS taken,
         CASE WHEN goal > 0 THEN start / goal END AS share
  FROM laid
)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target, CAST(taken AS BIGINT) AS taken,
       CASE WHEN taken > 0 THEN round(CASE place % 3 WHEN 0 THEN 1.5 - sqrt(greatest(0, 2.25 - 2 * share)) WHEN 1 THEN share ELSE sqrt(0.25 + 2 * share) - 0.5 END, 6) END AS position
FROM counted
"""
