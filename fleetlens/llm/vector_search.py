"""Operator 6, exact top-k search over vector-approximation files.

Components become integers, floor(256 x). Vectors and queries are dealt into
blocks of bounded size and each pair of blocks is one task's work. There the
approximation file keeps, for each component, the number of its cell (between
block quantiles) only. Cells bound each inner product from above and below;
a vector whose upper bound is under the query's kth lower bound cannot be a
result. The others' exact vectors are read in the order of their bounds
until the kth result beats the next bound. The best ``k`` of each block are
merged by query.

Cases: vectors that are null, empty or hold a null or non-finite component,
and rows with a null vec_id, take no part; vectors are compared with those
of their own length; a row is not compared with rows of its own vec_id, and
repeated rows of another vec_id are results each; ties go to the smaller
vec_id; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

K, QUERY_EVERY, SCALE = 5, 50, 256
CELLS = 32                 # cells of a component
QUERY_ROWS = 1024          # queries in a block
BLOCK_VALUES = 1 << 21     # components in a block of vectors, at most
BLOCKS = 32                # blocks of vectors, at least, while they have LEAST_ROWS rows
LEAST_ROWS = 512
STEP = 32                  # exact vectors read at once


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding, dim) of the rows that take part."""
    e = F.col("embedding")
    bad = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.where(F.col("vec_id").isNotNull() & e.isNotNull() & (F.size(e) > 0))
            .where(~F.coalesce(bad, F.lit(True)))
            .select("vec_id", e.cast("array<double>").alias("embedding"), F.size(e).alias("dim")))


def integers(column: pd.Series) -> np.ndarray:
    x = np.floor(np.stack(column.to_numpy()) * SCALE)
    return x if np.abs(x).max(initial=0) ** 2 * x.shape[1] < 2 ** 53 else \
        np.array([[int(v) for v in row] for row in x], dtype=object)


class ApproximationFile:
    """Cell numbers of a block's vectors, and the cells' edges."""

    def __init__(self, vectors: np.ndarray):
        v = vectors.astype(float)
        self.edges = np.quantile(v, np.linspace(0, 1, CELLS + 1), axis=0, method="nearest")
        self.codes = np.empty(v.shape, dtype=np.uint8)
        for d in range(v.shape[1]):
            at = np.searchsorted(self.edges[:, d], v[:, d], side="right") - 1
            self.codes[:, d] = np.clip(at, 0, max(len(self.edges) - 2, 0))

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the inner products, queries x vectors."""
        cols = np.arange(self.codes.shape[1])
        low = self.edges[self.codes, cols]
        high = self.edges[np.minimum(self.codes + 1, len(self.edges) - 1), cols]
        q = queries.astype(float)
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def search_block(query_ids, queries, ids, vectors, k: int) -> list[tuple]:
    """(query_id, vec_id, score): exact best ``k`` of the block for each query."""
    exact = queries.dtype != object and vectors.dtype != object
    lower, upper = ApproximationFile(vectors).bounds(queries) if exact else (None, None)
    out = []
    for i, qid in enumerate(query_ids):
        other = np.flatnonzero(ids != qid)
        if not len(other):
            continue
        if exact:
            floor = np.partition(lower[i, other], -k)[-k] if len(other) > k else -np.inf
            left = other[upper[i, other] >= floor]
            left = left[np.argsort(-upper[i, left], kind="stable")]
        else:
            left = other
        best: list[tuple] = []
        for at in range(0, len(left), STEP):
            if exact and len(best) == k and -best[-1][0] > upper[i, left[at]]:
                break
            part = left[at:at + STEP]
            scores = vectors[part] @ queries[i]
            best = sorted([*best, *((-int(s), int(ids[p])) for s, p in zip(scores, part, strict=True))])[:k]
        out += [(int(qid), v, max(-2 ** 63, min(2 ** 63 - 1, -s))) for s, v in best]
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products of
    every row of ``queries`` with the rows of ``vectors``."""
    cand, ask = usable(vectors), usable(queries)
    n, dim = cand.agg(F.count("*"), F.max("dim")).first()
    rows = max(1, min(BLOCK_VALUES // max(dim or 1, 1), max(LEAST_ROWS, n // BLOCKS)))
    vector_blocks, query_blocks = -(-n // rows) or 1, -(-ask.count() // QUERY_ROWS) or 1
    cand = (cand.withColumn("vb", F.pmod(F.xxhash64("vec_id"), F.lit(vector_blocks)).cast("int"))
            .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))
    ask = (ask.withColumn("qb", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(query_blocks)).cast("int"))
           .withColumn("vb", F.explode(F.sequence(F.lit(0), F.lit(vector_blocks - 1)))))

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = search_block(right.vec_id.to_numpy(), integers(right.embedding), left.vec_id.to_numpy(),
                             integers(left.embedding), k) if len(left) and len(right) else []
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    keys = ["dim", "vb", "qb"]
    best = cand.groupBy(*keys).cogroup(ask.groupBy(*keys)).applyInPandas(
        cell, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def every(vectors: DataFrame, n: int = QUERY_EVERY) -> DataFrame:
    return vectors.where(F.col("vec_id") % n == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_dot_product(q.e, v.e) AS BIGINT) AS score
  FROM v q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id AND len(q.e) = len(v.e)
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
