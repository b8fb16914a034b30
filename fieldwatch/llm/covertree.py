"""Exact top-k by inner product: dual-tree search over cover trees.

Vectors are dealt into data blocks, queries into query blocks, both of bounded size; a pair of blocks is one task. It builds a cover tree
over the data and one over the queries and descends both together. For a pair of nodes with centres q and c and covering radii r and s, no
inner product exceeds q.c + |q| s + |c| r + r s; the pair is pruned when that bound is below the worst k-th score of any query under the
query node. Each task gives k rows a query at most, and a ranking over these gives the result. The bound holds for any vectors; on
vectors without structure it prunes little, and the work is then that of comparing every query with every vector.

Components become floor(scale * x); scores are integer sums, exact in double precision below 2**53 (larger ones raise an error).

Defined results: vectors that are null, or hold a null or non-finite component, and rows with a null vec_id take no part. Vectors meet only
vectors of their own length; an empty vector scores 0 with empty vectors. Rows that repeat a vec_id are candidates each; a query's own vec_id never is
one. A query id that several rows share is answered from the row whose vector sorts first.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldwatch.llm.common import checkpointed

LEAF = 64


@dataclass
class Node:
    """A ball: centre, covering radius, and either children or the places of its points."""

    centre: np.ndarray
    radius: float
    places: np.ndarray
    children: list[Node] = field(default_factory=list)
    norm: float = 0.0


def cover_tree(points: np.ndarray, places: np.ndarray | None = None, radius: float | None = None) -> Node:
    """A cover tree: at each level, centres taken greedily cover all points within half the radius above and lie farther apart than that.

    Where halving the radius separates nearly all points, it is halved no further and they become one leaf.
    """
    places = np.arange(len(points)) if places is None else places
    own = points[places]
    apart = np.sqrt(((own - own[0]) ** 2).sum(axis=1))
    node = Node(own[0], float(apart.max()), places, norm=float(np.linalg.norm(own[0])))
    if len(places) <= LEAF or node.radius == 0:
        return node
    reach = node.radius / 2 if radius is None else min(radius / 2, node.radius / 2)
    nearest, owner, most = apart, np.zeros(len(places), np.int64), max(len(places) // 8, min(len(places) // 2, 512))
    centres = 1
    while True:
        far = int(np.argmax(nearest))
        if nearest[far] <= reach:
            break
        if centres == most:
            return node  # no structure at this scale
        away = np.sqrt(((own - own[far]) ** 2).sum(axis=1))
        owner = np.where(away < nearest, centres, owner)
        nearest = np.minimum(nearest, away)
        centres += 1
    node.children = [cover_tree(points, places[owner == c], 2 * reach) for c in range(centres) if (owner == c).any()]
    return node


class Search:
    """Best k scores per query of one block pair, kept as arrays that only improve."""

    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int) -> None:
        self.queries, self.query_ids, self.data, self.ids, self.k = queries, query_ids, data, ids, k
        self.score = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.pruned = self.compared = 0

    def compare(self, q: np.ndarray, d: np.ndarray) -> None:
        scores = self.queries[q] @ self.data[d].T
        scores[self.query_ids[q][:, None] == self.ids[d][None, :]] = -np.inf
        self.compared += scores.size
        all_scores = np.concatenate([self.score[q], scores], axis=1)
        all_ids = np.concatenate([self.found[q], np.broadcast_to(self.ids[d], scores.shape)], axis=1)
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, : self.k]
        self.score[q] = np.take_along_axis(all_scores, order, axis=1)
        self.found[q] = np.take_along_axis(all_ids, order, axis=1)

    def bound(self, q: Node, d: Node) -> float:
        return float(q.centre @ d.centre) + q.norm * d.radius + d.norm * q.radius + q.radius * d.radius

    def visit(self, q: Node, d: Node) -> None:
        if self.bound(q, d) * (1 + 1e-12) + 1e-6 < self.score[q.places, -1].min():
            self.pruned += len(q.places) * len(d.places)
        elif not q.children and not d.children:
            for k in range(0, len(d.places), 1024):
                self.compare(q.places, d.places[k : k + 1024])
        elif q.children:  # queries first, so that each group meets the data in its own best order
            for child in q.children:
                self.visit(child, d)
        else:
            for child in sorted(d.children, key=lambda c: -self.bound(q, c)):
                self.visit(q, child)


def top_k(vectors: DataFrame, every: int = 100, k: int = 10, scale: int = 1024, data_block: int = 8192, query_block: int = 2048) -> DataFrame:
    """query_id, rank, vec_id and score: for each row whose vec_id is divisible by ``every``, the k rows with the largest inner product.

    Ties go to the smaller vec_id. Two counts reach the driver.
    """
    x = F.col("embedding")
    fine = F.col("vec_id").isNotNull() & x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    whole: Column = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    rows = checkpointed(vectors.filter(fine).select(F.col("vec_id").cast("long"), whole.alias("v")).withColumn("dim", F.size("v")))
    queries = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    n, n_queries = rows.count(), queries.count()
    data_blocks, query_blocks = max(1, -(-n // data_block)), max(1, -(-n_queries // query_block))
    numbers = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    own = lambda count: F.pmod(F.xxhash64("vec_id", "v"), F.lit(count)).cast("int")
    data = rows.select("*", own(data_blocks).alias("d"), numbers(query_blocks).alias("q"), F.lit(False).alias("asks"))
    asked = queries.select("vec_id", "v", "dim", numbers(data_blocks).alias("d"), own(query_blocks).alias("q"), F.lit(True).alias("asks"))

    def search(pair: pd.DataFrame) -> pd.DataFrame:
        asks = pair["asks"].to_numpy(bool)
        names = ["query_id", "vec_id", "score"]
        if not asks.any() or asks.all():
            return pd.DataFrame({c: np.empty(0, np.int64) for c in names})
        matrix = np.stack(pair["v"].to_list()).astype(np.float64)
        ids = pair["vec_id"].to_numpy(np.int64)
        q, d = matrix[asks], matrix[~asks]
        if matrix.size and np.abs(q).max() * np.abs(d).max() * matrix.shape[1] >= 2**53:
            raise OverflowError("scores exceed exact double precision; use a smaller scale")
        found = Search(q, ids[asks], d, ids[~asks], k)
        found.visit(cover_tree(q), cover_tree(d))
        real = np.isfinite(found.score)
        return pd.DataFrame({"query_id": np.repeat(ids[asks], k)[real.ravel()], "vec_id": found.found[real], "score": found.score[real].astype(np.int64)})

    best = data.unionByName(asked).groupBy("dim", "d", "q").applyInPandas(search, "query_id long, vec_id long, score long")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


#: DuckDB, for vectors of one length.
TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v::DOUBLE[], d.v::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 100 = 0),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
