"""Exact top-k search by distributed histogram selection.

Queries and candidates are dealt into blocks; a task scores one block of
queries against one block of candidates with integer products.  No score is
shipped: each pass counts, per query, how many scores fall into each of ``bins``
equal intervals of the range where its k-th highest score is known to lie, and
the summed counts narrow that range, until it is a single value.  A last pass
returns the scores above the k-th value and, of those equal to it, the ones
with the smallest ids.  A block reports a query's bins only down to its own
k-th score: the global k-th value is never lower, so nothing is lost.

Components become ``floor(scale * x)``.  Null vectors and vectors that hold
null or non-finite components take no part, nor do rows without an id.  Rows
that share an id count once (the smallest vector).  Vectors meet only vectors
of their own dimension.  Fewer than k candidates give all of them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyline.llm.common import stored, table

BINS = 4096
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 8192
EXACT = 2**53


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """``(id, v, dim)`` with integer components, one row per id."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = vectors.filter(F.col(id_col).isNotNull() & F.coalesce(finite, F.lit(False)) & (F.size(x) > 0))
    whole = F.transform(x, lambda e: F.floor(e * F.lit(float(scale))).cast("bigint"))
    rows = rows.select(F.col(id_col).cast("bigint").alias("id"), whole.alias("v"))
    return rows.groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _scores(queries: pa.Table, candidates: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Integer scores, some rows of queries at a time; products whose sums stay below 2^53 are exact in floating point."""
    dim = queries.column("dim")[0].as_py()
    a, b = _matrix(queries.column("v"), dim), _matrix(candidates.column("w"), dim)
    ids = candidates.column("other").to_numpy()
    bound = int(np.abs(a).max()) * int(np.abs(b).max()) * dim
    if bound < EXACT:
        a, b = a.astype(np.float64), b.astype(np.float64)
    for i in range(0, len(a), 256):
        scores = (a[i : i + 256] @ b.T).astype(np.int64)
        own = queries.column("id").to_numpy()[i : i + 256, None] == ids[None, :]
        yield i, np.where(own, np.iinfo(np.int64).min, scores)


class TopK:
    """One search; ``pairs`` deals both sides out to block pairs."""

    def __init__(self, queries: DataFrame, candidates: DataFrame, k: int):
        self.k = k
        sizes = candidates.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0).cast("bigint"), lambda m, e: F.greatest(m, F.abs(e)))).alias("m"), F.max("dim").alias("d")).first()
        self.empty = not sizes["n"]
        most = (sizes["m"] or 0) ** 2 * (sizes["d"] or 0)
        if most >= 2**62:
            raise ValueError("scores do not fit into 64 bits")
        self.low, self.high = -most, most + 1
        number = queries.count()
        self.query_blocks = max(1, math.ceil(number / QUERY_BLOCK))
        self.candidate_blocks = max(1, math.ceil(sizes["n"] / CANDIDATE_BLOCK))

        def block(count: int, seed: int) -> Column:
            return F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(count)).cast("int")

        self.queries = queries.withColumn("q", block(self.query_blocks, 1))
        self.candidates = candidates.withColumn("c", block(self.candidate_blocks, 2))

    def _pairs(self, state: DataFrame):
        spread_q = F.explode(F.sequence(F.lit(0), F.lit(self.candidate_blocks - 1)))
        spread_c = F.explode(F.sequence(F.lit(0), F.lit(self.query_blocks - 1)))
        left = self.queries.join(state, "id").select("*", spread_q.alias("c"))
        right = self.candidates.select("*", spread_c.alias("q")).toDF("other", "w", "dim_w", "c_w", "q_w")
        return left.groupBy("q", "c", "dim").cogroup(right.groupBy("q_w", "c_w", "dim_w"))

    def _count(self, state: DataFrame, width: int) -> DataFrame:
        """Scores per query and bin of ``width`` values from the query's ``low`` on; those above the range count as the top bin's number."""
        k, bins = self.k, BINS

        def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
            found: list[list[np.ndarray]] = [[], [], []]
            if queries.num_rows and candidates.num_rows:
                ids, lows = queries.column("id").to_numpy(), queries.column("low").to_numpy()
                for i, scores in _scores(queries, candidates):
                    low = lows[i : i + 256, None]
                    real = scores != np.iinfo(np.int64).min
                    slot = np.where(scores >= low, np.minimum((np.maximum(scores, low) - low) // width, bins), -1)
                    slot = np.where(real, slot, -1) + 1
                    rows = np.arange(len(slot))[:, None]
                    counts = np.bincount((rows * (bins + 2) + slot).ravel(), minlength=len(slot) * (bins + 2)).reshape(len(slot), -1)[:, 1:]
                    above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1] - counts
                    r, s = np.nonzero((counts > 0) & (above < k))
                    for out, part in zip(found, (ids[i + r], s, counts[r, s])):
                        out.append(part)
            columns = [np.concatenate(x) if x else np.empty(0, np.int64) for x in found]
            return pa.table([pa.array(c, pa.int64()) for c in columns], names=["id", "slot", "n"])

        found = self._pairs(state).applyInArrow(run, "id bigint, slot bigint, n bigint")
        return found.groupBy("id", "slot").agg(F.sum("n").alias("n"))

    def search(self) -> DataFrame:
        state = self.queries.select("id", F.lit(self.low).cast("bigint").alias("low"))
        size = self.high - self.low
        while size > 1:
            size = -(-size // BINS)
            down = Window.partitionBy("id").orderBy(F.desc("slot"))
            reached = self._count(state, size).withColumn("above", F.sum("n").over(down))
            # the bin where k is reached; a query with fewer scores takes all of them
            chosen = reached.filter(F.col("above") >= self.k).groupBy("id").agg(F.max("slot").alias("slot"))
            state = stored(
                state.join(chosen, "id", "left").select("id", F.when(F.col("slot").isNull(), F.lit(self.low)).otherwise(F.col("low") + F.col("slot") * size).cast("bigint").alias("low")),
                "topk",
            )
        return self._best(state)

    def _best(self, state: DataFrame) -> DataFrame:
        """Scores from the k-th value on; of the ties at that value a block sends its k smallest ids."""
        k = self.k

        def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
            found: list[list[np.ndarray]] = [[], [], []]
            if queries.num_rows and candidates.num_rows:
                ids, lows, others = queries.column("id").to_numpy(), queries.column("low").to_numpy(), candidates.column("other").to_numpy()
                for i, scores in _scores(queries, candidates):
                    for j, low in enumerate(lows[i : i + 256]):
                        hit = np.flatnonzero((scores[j] >= low) & (scores[j] != np.iinfo(np.int64).min))
                        best = hit[np.lexsort((others[hit], -scores[j][hit]))][:k]
                        for out, part in zip(found, (np.full(len(best), ids[i + j]), others[best], scores[j][best])):
                            out.append(part)
            columns = [np.concatenate(x) if x else np.empty(0, np.int64) for x in found]
            return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "id", "score"])

        found = self._pairs(state).applyInArrow(run, "query_id bigint, id bigint, score bigint")
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0) -> DataFrame:
    """``(query_id, rank, id, score)``: for the rows where ``queries`` (a condition on ``id``) holds, the k best other rows."""
    rows = stored(quantised(vectors, id_col, vector_col, scale), "vectors")
    return TopK(rows.filter(queries), rows, k).search().select("query_id", "rank", F.col("id").alias(id_col), "score")


def op5_histogram_top_k(spark, sf_dir: str) -> DataFrame:
    """The 20 best others of every vector whose id is divisible by 20."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, 20)


OP5_SQL = """
WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM good q JOIN good c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 20
"""
