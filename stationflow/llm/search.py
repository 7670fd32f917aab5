"""Exact top-k by inner product: an impact-ordered index read score at a time, with proofs and exact rescoring."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationflow.llm.common import quoted
from stationflow.storage import stage


@dataclass(frozen=True)
class Blocks:
    """Vectors and queries meet in blocks of about this many; a query is rescored once at most ``rescored`` vectors
    of the block are possible members of its result."""

    vectors: int = 8_192
    queries: int = 512
    rescored: int = 64


class ImpactIndex:
    """Posting segments of one block of integer vectors, in order of impact.

    The impact of a vector in a dimension is its distance from the least value there. It is quantised in binary
    steps: the segment (dimension, 2^b) holds the vectors whose impact has step b. A query that is negative in a
    dimension reads the distance from the top instead, whose segments are the complements. So whatever is still
    unread adds between nothing and (2^b - 1) times the sum of the query's magnitudes.
    """

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.low = vectors.min(axis=0)
        impact = vectors - self.low
        self.steps = int(impact.max(initial=0)).bit_length()
        # The segments of one step in all dimensions form a matrix: reading them for many queries is a product.
        self.segments = [((impact >> b) & 1).astype(np.float32) for b in range(self.steps)]

    def top(self, queries: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int, rescored: int) -> list[list[tuple[int, int]]]:
        """For each query the k best (score, id), ties to the smaller id, without vectors of the id ``own``.

        Segments are read from the greatest step down. A query stops when the proof leaves few possible members:
        those whose upper bound reaches the k-th greatest lower bound. They are scored exactly.
        """
        weight = np.abs(queries).sum(axis=1).astype(float)
        exact = np.float32 if len(queries) == 0 or weight.max() < 2**24 else np.float64
        negative = np.where(queries < 0, queries, 0).sum(axis=1).astype(float)
        sure = (queries @ self.low + negative * (2.0**self.steps - 1))[:, None] + np.zeros((1, len(ids)))
        sure[own[:, None] == ids[None, :]] = -np.inf
        wanted = min(k, len(ids))
        out: list[list[tuple[int, int]]] = [[] for _ in queries]
        open_ = np.arange(len(queries))
        for b in reversed(range(-1, self.steps)):
            if b >= 0:
                read = queries[open_].astype(exact) @ self.segments[b].astype(exact, copy=False).T
                sure += (read - negative[open_, None]) * 2.0**b
                rest = (2.0**b - 1) * weight[open_]
            else:
                rest = np.zeros(len(open_))
            least = np.partition(sure, len(ids) - wanted, axis=1)[:, len(ids) - wanted]
            possible = sure >= (least - rest)[:, None]
            possible &= np.isfinite(sure)
            ready = possible.sum(axis=1) <= max(rescored, wanted) if b > 0 else np.ones(len(open_), bool)
            for row in np.flatnonzero(ready):
                at = np.flatnonzero(possible[row])
                scores = self.vectors[at] @ queries[open_[row]]
                best = np.lexsort((ids[at], -scores))[:k]
                out[open_[row]] = [(int(scores[i]), int(ids[at[i]])) for i in best]
            open_, sure = open_[~ready], sure[~ready]
            if not len(open_):
                break
        return out


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as bigint; null if the vector or a component is null or not finite."""
    bad = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf"))
    )
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    return F.when(vector.isNotNull() & ~bad & (F.size(vector) > 0), whole)


def top_k(
    df: DataFrame,
    queries: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    blocks: Blocks | None = None,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row with a true ``queries``, the k best others.

    Scores are integer inner products of quantised vectors; ties go to the smaller id. A query meets the vectors
    block by block: one task holds one block of each, and gives k rows a query, which are ranked in a last window
    (k rows for each block of vectors). Null ids, null or empty vectors and vectors with null or non-finite
    components take no part; vectors of another length than the query's are no candidates of it. A repeated query
    id counts once for each distinct vector, and rows with the query's own id are never its candidates. An empty
    frame gives an empty frame.
    """
    blocks = blocks or Blocks()
    rows = df.select(
        quoted(vec_id).cast("bigint").alias("id"), quantised(quoted(vector)).alias("v"), queries.alias("is_query")
    ).where("id is not null and v is not null")
    rows = stage(rows.withColumn("dims", F.size("v")), "vectors")
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("q")).first()
    n_vectors, n_queries = (max(1, math.ceil(sizes[c] / m)) for c, m in (("n", blocks.vectors), ("q", blocks.queries)))
    one = F.pmod(F.xxhash64("id", "v"), F.lit(n_vectors)).cast("int")
    two = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_queries)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("id", "v", "dims", one.alias("vb"), every(n_queries).alias("qb"))
    right = rows.where("is_query").select("id", "v", "dims", two.alias("qb"), every(n_vectors).alias("vb"))

    def meet(vectors: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(vectors) and len(asked):
            index = ImpactIndex(np.stack(vectors["v"].to_numpy()).astype(np.int64))
            own, queries = asked["id"].to_numpy(), np.stack(asked["v"].to_numpy()).astype(np.int64)
            found = index.top(queries, vectors["id"].to_numpy(), own, k, blocks.rescored)
            out = [(q, v, s) for q, best in zip(own, found) for s, v in best]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")

    keys = ("vb", "qb", "dims")
    met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
