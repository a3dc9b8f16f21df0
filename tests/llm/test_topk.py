import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from remitscope.llm import topk


def expected(rows, asked, k):
    """By plain loops over Python integers."""
    usable = [
        (i, [math.floor(256 * float(x)) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for query in sorted({i for i, _ in usable if asked(i)}):
        own = min(v for i, v in usable if i == query)
        scored = [
            (-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(own, v)))), i)
            for i, v in usable
            if i != query and len(v) == len(own)
        ]
        for rank, (score, i) in enumerate(sorted(scored)[:k], 1):
            out.append((query, rank, i, -score))
    return out


def found(spark, rows, k=5):
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = vectors.withColumns({"rank": F.lit(1), "score": F.lit("x"), "dim": F.lit(0), "shard": F.lit(0)})
    return sorted(map(tuple, topk.top_k(vectors.repartition(3), F.col("vec_id") % 5 == 0, k).collect()))


def vectors(n, dim, seed=0, spread=2):
    draw = np.random.default_rng(seed)
    return [(i, [float(x) for x in draw.integers(-spread, spread + 1, dim)]) for i in range(n)]


@pytest.mark.parametrize(("tile", "queries", "shard"), [(4096, 256, 8192), (7, 3, 20)])
def test_ties_and_awkward_vectors(spark, monkeypatch, tile, queries, shard):
    monkeypatch.setattr(topk, "TILE_ROWS", tile)
    monkeypatch.setattr(topk, "QUERY_ROWS", queries)
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    rows = vectors(100, 4) + [
        (200, None),
        (205, [1.0, None, 2.0, 3.0]),
        (210, [1.0, float("nan"), 2.0, 3.0]),
        (215, [1.0, float("inf"), 2.0, 3.0]),
        (220, []),
        (225, []),
        (230, [1.0, 2.0]),
        (None, [1.0, 1.0, 1.0, 1.0]),
        (7, [2.0, 2.0, 2.0, 2.0]),
        (5, [-1.0, 0.0, 1.0, 0.5]),
        (240, [1e30, 1e30, 0.0, 0.0]),
        (245, [-1e30, 3.4e38, 1.0, 0.0]),
    ]
    assert found(spark, rows) == expected(rows, lambda i: i % 5 == 0, 5)


def test_fewer_candidates_than_asked_and_none(spark):
    rows = vectors(3, 2)
    assert found(spark, rows) == expected(rows, lambda i: i % 5 == 0, 5)
    assert found(spark, rows[:1]) == []
    assert found(spark, []) == []
