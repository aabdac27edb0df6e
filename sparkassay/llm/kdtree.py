"""Exact top-k by inner product: KD-trees per shard, searched best first under a bound that travels with the query."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkassay.llm.common import whole_numbers
from sparkassay.session import cut_lineage

LEAF = 64
EXACT = 2**53
SMALLEST, LARGEST = -(2**63), 2**63 - 1


def usable(vector: Column) -> Column:
    """True for a vector without null and non-finite components."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, fine)


def products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products of integers: in doubles where they cannot round, else in Python's integers."""
    top = float(np.abs(rows.astype(float)).max(initial=0)) * float(np.abs(query.astype(float)).max(initial=0))
    if top * max(1, len(query)) < EXACT:
        return (rows.astype(float) @ query.astype(float)).astype(np.int64)
    whole = rows.astype(object) @ query.astype(object)
    return np.array([min(max(int(x), SMALLEST), LARGEST) for x in whole], np.int64)


class Tree:
    """Median splits along the widest side down to leaves; each node keeps its tight box and its smallest id."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order, nodes = np.arange(len(ids)), []

        def grow(begin: int, end: int) -> int:
            own = order[begin:end]
            low, high = rows[own].min(axis=0), rows[own].max(axis=0)
            at = len(nodes)
            nodes.append([begin, end, -1, -1, low, high, ids[own].min()])
            if end - begin > LEAF and len(low) and (side := int((high.astype(float) - low).argmax())) >= 0 and high[side] > low[side]:
                half = (end - begin) // 2
                order[begin:end] = own[np.argpartition(rows[own, side], half)]
                nodes[at][2], nodes[at][3] = grow(begin, begin + half), grow(begin + half, end)
            return at

        grow(0, len(ids))
        self.begin, self.end, self.left, self.right = (np.array([node[i] for node in nodes]) for i in range(4))
        self.low, self.high = (np.array([node[i] for node in nodes], float) for i in (4, 5))
        self.first = np.array([node[6] for node in nodes])
        self.ids, self.rows = ids[order], rows[order]
        self.top = float(np.abs(self.rows.astype(float)).max(initial=0))
        self.plain = self.rows.astype(float)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """No row of a node's box has a larger product with a query; queries x nodes."""
        positive, negative = np.maximum(queries, 0.0), np.minimum(queries, 0.0)
        found = positive @ self.high.T + negative @ self.low.T
        size = self.top * np.abs(queries).max(initial=0) * max(1, queries.shape[1])
        return found if size < EXACT else found + size * 1e-12  # the doubles may have rounded

    def search(self, own: int, query: np.ndarray, bound: np.ndarray, k: int, kth: tuple[int, int]):
        """The k best of this shard as (score, -id), best last, without those worse than ``kth``, found elsewhere."""
        best: list[tuple[int, int]] = []  # a heap; its first is the worst of the best
        exact = self.top * float(np.abs(query.astype(float)).max(initial=0)) * max(1, len(query)) < EXACT
        plain = query.astype(float)
        queue = [(-bound[0], 0)]
        while queue:
            promise, node = heapq.heappop(queue)
            worst = best[0] if len(best) == k else None
            limit = max(worst, kth) if worst else kth
            if -promise < limit[0]:
                break  # every other box promises less
            if -promise == limit[0] and -int(self.first[node]) < limit[1]:
                continue  # only ties with larger ids
            if self.left[node] >= 0:
                for child in (self.left[node], self.right[node]):
                    heapq.heappush(queue, (-bound[child], int(child)))
                continue
            begin, end = self.begin[node], self.end[node]
            scores = self.plain[begin:end] @ plain if exact else products(self.rows[begin:end], query)
            ids = self.ids[begin:end]
            rank = np.lexsort((ids, -scores))
            for at in rank[: k + 1 + int((ids == own).sum())]:
                item = (int(scores[at]), -int(ids[at]))
                if ids[at] == own:
                    continue
                if len(best) == k and item <= best[0] or item < kth:
                    break
                if len(best) < k:
                    heapq.heappush(best, item)
                else:
                    heapq.heapreplace(best, item)
        return sorted(best)


def search_shard(rows: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The best rows of a shard for a block of queries; vectors of another length than the query's take no part."""
    out = []
    queries = queries.assign(size=queries["vector"].map(len))
    lengths = rows["vector"].map(len)
    for size, block in queries.groupby("size"):
        own = rows[lengths == size]
        if own.empty:
            continue
        tree = Tree(own["id"].to_numpy(np.int64), np.stack(own["vector"].to_numpy()).astype(np.int64).reshape(len(own), size))
        vectors = np.stack(block["vector"].to_numpy()).astype(np.int64).reshape(len(block), size)
        bounds = tree.bounds(vectors.astype(float))
        for at, (key, own_id, score, other) in enumerate(
            zip(block["query"], block["query_id"], block["kth_score"], block["kth_id"])
        ):
            for found, other_id in tree.search(int(own_id), vectors[at], bounds[at], k, (int(score), -int(other))):
                out.append((key, own_id, -other_id, found))
    return pd.DataFrame(out, columns=["query", "query_id", "vec_id", "score"])


def top_k(
    vectors: DataFrame, queries: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
    scale: float = 1024.0, shard_rows: int = 4096, block_queries: int = 2048,
) -> DataFrame:
    """The k rows with the largest inner product for every query: ``query_id, rank, vec_id, score``.

    Components become floor(scale x component). Rows are dealt by a hash of their id to shards of about ``shard_rows``;
    queries to blocks. Every query first searches one shard (the one its own hash names). The kth best score found
    there goes with it to all other shards, whose trees are then searched best box first until no box can hold a
    better row, so most of them give few rows or none. A task holds one shard and one block of queries.

    Ties go to the smaller id; a row with the query's own id is no candidate. Rows with a null id, a null vector or
    null or non-finite components take no part. Repeated rows are candidates each; repeated equal queries are one.
    Vectors of different length do not meet. Empty tables give no rows. Other columns are not read.
    """
    spark = vectors.sparkSession

    def prepared(df: DataFrame) -> DataFrame:
        vector = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale))
        fine = df.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
        return fine.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"))

    rows = prepared(vectors)
    asked = prepared(queries).distinct()
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-asked.count() // block_queries))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("id", "vector"), F.lit(shards)))
    rows = rows.withColumn("block", F.explode(whole_numbers(blocks)))
    asked = asked.select(
        F.xxhash64("id", "vector").alias("query"), F.col("id").alias("query_id"), "vector",
        F.pmod(F.xxhash64("id", "vector"), F.lit(shards)).alias("home"),
        F.pmod(F.xxhash64("vector", "id"), F.lit(blocks)).alias("block"),
    )
    found = "query long, query_id long, vec_id long, score long"

    def searched(some: DataFrame) -> DataFrame:
        left = rows.groupBy("shard", "block")
        return left.cogroup(some.groupBy("shard", "block")).applyInPandas(
            lambda one, other: search_shard(one, other, k), found
        )

    anything = {"kth_score": F.lit(SMALLEST), "kth_id": F.lit(LARGEST)}
    first = searched(asked.withColumn("shard", F.col("home")).withColumns(anything))
    first = cut_lineage(first, "first")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    kth = first.withColumn("place", F.row_number().over(order)).where(F.col("place") == k)
    kth = kth.select("query", F.col("score").alias("kth_score"), F.col("vec_id").alias("kth_id"))
    bounded = asked.join(kth, "query", "left").withColumns({c: F.coalesce(c, v) for c, v in anything.items()})
    others = bounded.withColumn(
        "shard", F.explode(whole_numbers(shards))
    )
    rest = searched(others.where(F.col("shard") != F.col("home")))
    ranked = first.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
