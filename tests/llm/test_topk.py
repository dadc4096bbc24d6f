import math

import numpy as np
import pytest
from pyspark.sql import types as T

from nutrilake.llm import topk

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType())])


def brute(rows, k, is_query):
    v = [(i, [math.floor(1024 * float(np.float32(x))) for x in e]) for i, e in rows
         if i is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for q, x in v:
        if is_query(q):
            found = sorted({(-min(max(sum(a * b for a, b in zip(x, y)), -2 ** 63), 2 ** 63 - 1), j)
                            for j, y in v if j != q and len(y) == len(x)})[:k]
            out += [(q, r + 1, j, -s) for r, (s, j) in enumerate(found)]
    return sorted(set(out))


def run(spark, rows, k=10, **kw):
    table = spark.createDataFrame([(i, e, 0) for i, e in rows], SCHEMA).repartition(3)
    v = topk.quantised(table, "vec_id", "embedding")
    return sorted(tuple(r) for r in topk.top_k(v, v.where("id % 100 = 0"), k, **kw).collect())


@pytest.mark.parametrize("clustered", [False, True])
def test_against_brute_force(spark, clustered):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(5, 8)) * 5
    rows = [(i, (rng.normal(size=8) + (centres[i % 5] if clustered else 0)).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)]            # a large group of equal vectors
    rows += [(2000, None), (2001, [1.0, None] * 4), (2002, [float("nan")] * 8), (2003, [float("inf")] * 8),
             (None, rows[0][1]), (2100, []), (300, rows[300][1])]
    want = brute(rows, 10, lambda i: i % 100 == 0)
    assert run(spark, rows, block_rows=64, max_pivots=4) == want
    assert run(spark, rows) == want


def test_large_magnitudes_are_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=6) * 10.0 ** (i % 12)).astype(np.float32).tolist()) for i in range(400)]
    assert run(spark, rows, block_rows=50) == brute(rows, 10, lambda i: i % 100 == 0)


def test_products_beyond_double_precision():
    q = np.array([[1024 * 100_000_003, 3], [2 ** 62, 2 ** 62], [-2 ** 62, 1], [1, 1]])
    got = topk.inner_products(q, q)
    want = [[min(max(sum(a * b for a, b in zip(x, y)), -2 ** 63), 2 ** 63 - 1) for y in q.tolist()] for x in q.tolist()]
    assert got.tolist() == want


def test_tight_clusters(spark):
    """Tight clusters far apart, where most pairs of cells are ruled out."""
    rng = np.random.default_rng(8)
    centres = np.eye(8) * 100
    rows = [(i, (centres[i % 8] + rng.normal(size=8) * 0.01).tolist()) for i in range(1600)]
    assert run(spark, rows, block_rows=100, max_pivots=32) == brute(rows, 10, lambda i: i % 100 == 0)


def test_few_and_no_rows(spark):
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [-1.0, 0.25])]
    assert run(spark, rows) == brute(rows, 10, lambda i: i % 100 == 0)
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, []) == []
