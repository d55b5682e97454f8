"""Connected components of links between 64-bit keys, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``(node, label)``: the smallest node reachable from every node that has a link ``(a, b)``.

    Every round takes the smallest label among the neighbours and then the
    label of that label, so that paths shorten by more than half.  Each round
    is written to the shared folder.
    """
    edges = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct(), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    while True:
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("of")).agg(F.min("label").alias("least"))
        better = labels.join(near, F.col("node") == F.col("of")).select("node", F.least("label", "least").alias("next"), F.col("label").alias("last"))
        up = labels.select(F.col("node").alias("at"), F.col("label").alias("above"))
        jumped = better.join(up, F.col("next") == F.col("at"), "left")
        new = stored(jumped.select("node", F.least("next", F.coalesce("above", "next")).alias("label"), "last"), "labels")
        if new.filter("label <> last").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")
