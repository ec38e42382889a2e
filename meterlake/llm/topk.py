"""Exact top-k search by inner product with a KD-tree per shard.

Vectors are dealt over shards, and each shard builds a KD-tree: median splits
along the widest side, with the tight box of every node. A query visits nodes
in the order of the highest score their box allows, and stops where that is
below its kth best score so far. The first round searches every query in one
shard; its kth score goes along to all others, which then skip most of their
nodes where the data let them.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.keyed import top_per_key

SHARD_ROWS = 16_384
QUERY_BLOCK = 1024
LEAF = 64
EXACT = float(2**53)


def whole_numbers(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of every component, as longs; null for a vector that can't take part.

    That is one that is null, empty or has a component that is null or not finite.
    """
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(x.isNotNull() & (F.size(x) > 0) & ~F.coalesce(bad, F.lit(True)), F.transform(x, lambda v: F.floor(v * scale)))


class Tree:
    """KD-tree over the rows of one shard."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(points))
        low, high, first, last, child = [], [], [], [], []
        todo = [(0, len(points), None)]
        while todo:
            a, b, parent = todo.pop()
            node = len(low)
            if parent is not None:
                child[parent].append(node)
            part = points[order[a:b]]
            low.append(part.min(axis=0))
            high.append(part.max(axis=0))
            first.append(a)
            last.append(b)
            child.append([])
            if b - a > leaf:
                side = int((high[-1] - low[-1]).argmax())
                middle = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(part[:, side], middle)]
                todo += [(a, a + middle, node), (a + middle, b, node)]
        self.points, self.ids = points[order], ids[order]
        self.low, self.high = np.stack(low), np.stack(high)
        self.first, self.last, self.child = first, last, child

    def search(self, query: np.ndarray, k: int, own: int | None, floor: float | None) -> list[tuple[int, int]]:
        """The k best (score, id), ties to the smaller id; rows under `floor` can be left out."""
        bounds = np.maximum(query * self.low, query * self.high).sum(axis=1)
        best: list[tuple[int, int]] = []  # a heap of (score, -id)
        nodes = [(-bounds[0], 0)]
        while nodes:
            bound, node = heapq.heappop(nodes)
            kth = best[0][0] if len(best) == k else None
            if floor is not None and (kth is None or floor > kth):
                kth = floor
            if kth is not None and -bound < kth:
                break
            if self.child[node]:
                for c in self.child[node]:
                    if kth is None or bounds[c] >= kth:
                        heapq.heappush(nodes, (-bounds[c], c))
                continue
            a, b = self.first[node], self.last[node]
            scores = self.points[a:b] @ query
            likely = range(b - a) if kth is None else np.flatnonzero(scores >= kth).tolist()
            for i in likely:
                found = (int(scores[i]), -int(self.ids[a + i]))
                if -found[1] == own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        return [(score, -minus) for score, minus in sorted(best, reverse=True)]


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.int64)


def _safe(points: np.ndarray, queries: np.ndarray) -> bool:
    """Whether all sums are whole numbers that a double holds, so that they are exact in either form."""
    return float(np.abs(points).max(initial=0)) * float(np.abs(queries).max(initial=0)) * points.shape[1] < EXACT


def _search_pair(k: int):
    def run(key, queries: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if not len(queries) or not len(points):
            return pd.DataFrame(columns=columns).astype("int64")
        p, q = _matrix(points["point"]), _matrix(queries["vector"])
        if _safe(p, q):
            p, q = p.astype(np.float64), q.astype(np.float64)
        tree = Tree(p, points["id"].to_numpy())
        floors = queries["floor"].to_numpy(dtype=np.float64, na_value=np.nan)
        rows = []
        for vector, id_, floor in zip(q, queries["id"].to_numpy(), floors, strict=True):
            rows += [(id_, v, s) for s, v in tree.search(vector, k, id_, None if np.isnan(floor) else floor)]
        return pd.DataFrame(rows, columns=columns).astype("int64")

    return run


def top_k(queries: DataFrame, vectors: DataFrame, k: int, shards: int, blocks: int, id_col: str = "vec_id") -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k best vectors.

    queries and vectors have the columns id_col and `vector` (longs, see
    whole_numbers), ids without repeats; a row of either with a null id or
    vector takes no part, and a query's own id is no candidate. Vectors are compared with
    those of their length only. A query with fewer candidates gets all of
    them, one without any no row; ties go to the smaller id. shards and blocks
    say how many parts the vectors and the queries are dealt into; a task
    holds one part of each.
    """
    size = F.size("vector")
    usable = [F.col(id_col).cast("long").alias("id"), "vector", size.alias("dim")]
    ok = F.col(id_col).isNotNull() & F.col("vector").isNotNull()
    q = queries.where(ok).select(*usable).withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int"))
    # New names: both sides may come from one table.
    v = vectors.where(ok).select(usable[0], F.col("vector").alias("point"), size.alias("dim")).withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    home = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(shards)).cast("int")
    cell = ["dim", "shard", "block"]
    everywhere = v.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    everywhere = everywhere.groupBy(*cell)
    schema = "query_id long, vec_id long, score long"

    def round_of(asked: DataFrame) -> DataFrame:
        return asked.groupBy(*cell).cogroup(everywhere).applyInPandas(_search_pair(k), schema)

    first = round_of(q.withColumns({"shard": home, "floor": F.lit(None).cast("double")}))
    kth = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("floor"))
    kth = kth.where(F.col("n") == k).select(F.col("query_id").alias("id"), "floor")
    other = q.join(kth, "id", "left").withColumn("home", home)
    other = other.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home").drop("home")
    found = first.unionByName(round_of(other))
    best = top_per_key(found, ["query_id"], [F.desc("score"), F.asc("vec_id")], k)
    return best.select("query_id", "rank", "vec_id", "score")


def parts(rows: int, each: int) -> int:
    return max(-(-rows // each), 1)
