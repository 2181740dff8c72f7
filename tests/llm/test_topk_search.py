import math

import pytest
from pyspark.sql import functions as F

from winnow.llm.topk_search import top_k

SCHEMA = "vec_id long, embedding array<float>, size int, score string"


def brute(rows, k, wanted):
    points = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in points if wanted(i)}):
        own = min(v for i, v in points if i == q)
        found = sorted((-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in points if i != q and len(v) == len(own))
        out += [(q, rank, i, -score) for rank, (score, i) in enumerate(found[:k], 1)]
    return out


@pytest.mark.parametrize(("shard", "block"), [(8192, 2048), (40, 3)])
def test_against_brute_force(spark, shard, block):
    import random

    random.seed(4)
    rows = [(i, [random.choice([-0.5, 0.25, 0.125, 0.75]) for _ in range(4)]) for i in range(200)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(200, 280)]  # one very common vector
    rows += [(300, None), (310, [0.1, None, 0.2, 0.3]), (320, [float("nan")] * 4), (330, [float("inf")] * 4), (340, []), (None, [0.1] * 4), (350, [0.3, 0.4]), (50, [0.9] * 4), (50, [0.9] * 4)]
    docs = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    got = sorted(tuple(r) for r in top_k(docs, F.col("vec_id") % 10 == 0, 5, shard_rows=shard, query_rows=block).collect())
    assert got == brute(rows, 5, lambda i: i % 10 == 0)


def test_few_and_none(spark):
    docs = spark.createDataFrame([(0, [0.5], 1, "x"), (1, [0.25], 1, "x")], SCHEMA)
    assert [tuple(r) for r in top_k(docs, F.col("vec_id") == 0, 5).collect()] == [(0, 1, 1, 128 * 64)]
    assert top_k(docs.limit(0), F.lit(True), 5).count() == 0
