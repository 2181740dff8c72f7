"""Connected components of a table of links.

Tasks of bounded size first contract the links they hold to stars. If more than one task is needed, a large-star and a
small-star step carry the labels between them, and both are repeated until nothing changes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from winnow.llm.storage import written

TASK_LINKS = 1_000_000


def contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars (node, least node connected with it) of a list of links."""
    nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
    up = list(range(len(nodes)))
    for a, b in zip(index[: len(u)].tolist(), index[len(u) :].tolist(), strict=True):
        while up[a] != a:
            up[a] = up[up[a]]
            a = up[a]
        while up[b] != b:
            up[b] = up[up[b]]
            b = up[b]
        if a < b:
            up[b] = a
        elif b < a:
            up[a] = b
    for i, above in enumerate(up):
        up[i] = up[above]  # a node above comes first, so it has its root already
    root = np.array(up, dtype=np.int64)
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def _contract(most: int):
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += batch.num_rows
            if size > 2 * most:
                u, v = contracted(*map(np.concatenate, zip(*held, strict=True)))
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=schema)
                held, size = [], 0
        if size:
            u, v = contracted(*map(np.concatenate, zip(*held, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=schema)

    return run


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over edges u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    # a node with very many links is a skewed key of this join only, with one row on the other side
    large = edges.join(least.select(F.col("u").alias("v"), "m"), "v").select("u", F.col("m").alias("v"))
    large = written(large.unionByName(edges).distinct(), "large-star")
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    ends = F.explode(F.array(F.col("v"), F.col("u")))
    return large.join(least, "u").select(ends.alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b", task_links: int = TASK_LINKS) -> DataFrame:
    """node, label (the least node it is connected with), for every node that has a link to another node.

    Links with a null end or to oneself are ignored. The number of rounds grows with the logarithm of the longest path
    between tasks; a table that fits one task needs none.
    """
    u, v = F.col(a).cast("long"), F.col(b).cast("long")
    edges = written(links.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")), "edges")
    state = None
    while True:
        tasks = max(1, -(-edges.count() // task_links))
        edges = written(edges.coalesce(tasks).mapInArrow(_contract(task_links), "u long, v long"), "contracted")
        if tasks == 1:
            break
        edges = written(_stars(edges), "stars")
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())
        if now == state:
            break
        state = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
