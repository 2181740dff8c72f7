"""Exact top-k by inner product: a KD-tree per shard, searched best first.

Vectors are dealt to shards of bounded size by a hash of their id, queries to blocks of bounded size; a task has one
shard and one block. Median splits over the widest component give the tree, every node keeps the tight box of its
vectors, and a box bounds the score of all of them. A first pass searches one shard per query and so gives a kth score
that no answer can be below; the second pass takes it to the other shards, which return only what reaches it.
"""

from __future__ import annotations

from collections.abc import Callable
from heapq import heappop, heappush, heapreplace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from winnow.llm.storage import written

SHARD_ROWS = 8192
QUERY_ROWS = 2048
LEAF_ROWS = 48
NO_SCORE = -(2**63)


class Tree:
    """KD-tree over integer vectors. Nodes are numbered from the root, 0; ``children`` is None for leaves."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.children: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray | None] = []
        low, high, least = [], [], []
        waiting = [(np.arange(len(ids)), -1, 0)]
        while waiting:
            rows, parent, side = waiting.pop()
            node, own = len(self.children), points[rows]
            low.append(own.min(axis=0))
            high.append(own.max(axis=0))
            least.append(int(ids[rows].min()))
            self.children.append(None)
            self.rows.append(rows)
            if parent >= 0:
                a, b = self.children[parent] or (0, 0)
                self.children[parent] = (node, b) if side == 0 else (a, node)
            widest = int(np.argmax(high[-1] - low[-1]))
            if len(rows) > leaf_rows and high[-1][widest] > low[-1][widest]:
                order = np.argpartition(own[:, widest], len(rows) // 2)
                self.rows[node] = None
                waiting += [(rows[order[: len(rows) // 2]], node, 0), (rows[order[len(rows) // 2 :]], node, 1)]
        self.ids, self.points = ids, points
        self.low, self.high, self.least = np.array(low), np.array(high), least

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The highest score any vector in a node's box can have, per query and node."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def best(self, own_id: int, query: np.ndarray, bounds: list[int], k: int, floor: int) -> list[tuple[int, int]]:
        """(score, -id) of the k best rows other than ``own_id`` with a score of at least ``floor``; more go first, then smaller ids."""
        found: list[tuple[int, int]] = []
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heappop(queue)
            bound = -bound
            if bound < floor or len(found) == k and (bound < found[0][0] or bound == found[0][0] and self.least[node] > -found[0][1]):
                if bound < floor or bound < found[0][0]:
                    break
                continue
            rows = self.rows[node]
            if rows is None:
                for child in self.children[node]:
                    heappush(queue, (-bounds[child], child))
                continue
            scores = self.points[rows] @ query
            kth = max(floor, found[0][0]) if len(found) == k else floor
            for at in np.flatnonzero(scores >= kth).tolist():
                entry = (int(scores[at]), -int(self.ids[rows[at]]))
                if -entry[1] == own_id:
                    continue
                if len(found) < k:
                    heappush(found, entry)
                elif entry > found[0]:
                    heapreplace(found, entry)
        return found


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(flat), -1)


def _search(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(points: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        sizes, asked = points["size"].to_numpy(), queries["size"].to_numpy()
        for size in np.unique(asked).tolist():
            own, of = points.filter(pa.array(sizes == size)), queries.filter(pa.array(asked == size))
            if not len(own):
                continue
            tree = Tree(own["id"].to_numpy(), _matrix(own["vector"]))
            wanted = _matrix(of["vector"])
            bounds = tree.bounds(wanted).tolist()
            for i, (own_id, floor) in enumerate(zip(of["id"].to_pylist(), of["floor"].to_pylist(), strict=True)):
                out += [(own_id, -other, score) for score, other in tree.best(own_id, wanted[i], bounds[i], k, floor)]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], schema=schema)

    return run


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """id, vector (floor(scale * x) as longs), size; rows that take no part are gone."""
    x = F.col(vec_col)
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) != float("inf")))
    rows = vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.coalesce(whole, F.lit(False)))
    vector = F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double")).cast("long"))
    return rows.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"), F.size(x).alias("size"))


def top_k(
    vectors: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 256.0,
    shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest inner products of each query over all other rows.

    Equal scores go by smaller id; a query with fewer candidates gets all. Vectors that are null, empty or hold a null
    or non-finite component take no part, nor do rows without an id; vectors of another length than the query's are no
    candidates. Rows with the query's id are not candidates for it; a repeated id is a candidate as often as it occurs,
    and asks once, with its least vector. Scores must fit in a long. Other columns are not looked at. An empty table
    gives an empty result.
    """
    points = quantised(vectors, id_col, vec_col, scale)
    queries = quantised(vectors.where(is_query), id_col, vec_col, scale).groupBy("id").agg(F.min("vector").alias("vector"))
    queries = queries.withColumn("size", F.size("vector"))
    n_shards = max(1, -(-points.count() // shard_rows))
    n_blocks = max(1, -(-queries.count() // query_rows))

    def number(n: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")

    shard, block = number(n_shards, 0), number(n_blocks, 1)
    points = points.withColumn("shard", shard)
    queries = queries.withColumn("block", block).withColumn("home", number(n_shards, 2))
    each_block = points.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    schema = "query_id long, vec_id long, score long"

    def search(asked: DataFrame) -> DataFrame:
        asked = asked.select("shard", "block", "id", "vector", "size", "floor")
        return each_block.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(_search(k), schema)

    first = written(search(queries.withColumn("shard", F.col("home")).withColumn("floor", F.lit(NO_SCORE))), "first-scores")
    kth = first.groupBy(F.col("query_id").alias("id")).agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
    others = queries.join(kth, "id", "left").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    others = others.where(F.col("shard") != F.col("home")).withColumn("floor", F.coalesce("kth", F.lit(NO_SCORE)))
    found = first.unionByName(search(others))
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
