import math

import numpy as np
import pytest
from pyspark.sql import types as T

from nutrilake.llm import whitening

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("x", T.StringType())])


def run(spark, rows, **kw):
    table = spark.createDataFrame([(i, e, 0, "x") for i, e in rows], SCHEMA).repartition(3)
    return [r.asDict() for r in whitening.whiten(table, **kw).collect()]


def reference(rows, k=4):
    """By numpy's symmetric eigensolver over the formed covariance."""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in e]) for i, e in rows
            if e and all(c is not None and math.isfinite(c) for c in e)]
    x = np.array(sorted({tuple(v) for _, v in kept}), float)
    n, mean = len(x), x.mean(axis=0)
    value, vector = np.linalg.eigh((x - mean).T @ (x - mean) / n)
    value, vector = value[::-1][:k], vector[:, ::-1][:, :k]
    sums = [int(s) for s in x.sum(axis=0)]
    return [(i, n, sum((n * c - s) ** 2 for c, s in zip(v, sums)), (np.array(v) - mean) @ vector / np.sqrt(value),
             value / ((x - mean) ** 2).sum() * n) for i, v in kept]


def test_against_numpy(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 12)) @ rng.normal(size=(12, 12)) * 0.3
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[5][1]) for i in range(300)]                         # copies do not weigh
    rows += [(2000, None), (2001, [None] + [1.0] * 11), (2002, [float("nan")] * 12), (2003, [float("inf")] * 12),
             (2004, []), (None, rows[0][1]), (7, rows[7][1])]
    got = run(spark, rows)
    want = reference(rows)
    assert len(got) == 4 * len(want)
    sign = {}
    by_key = {}
    for r in got:
        by_key.setdefault((r["vec_id"], r["component"]), []).append(r)
    for i, n, deviation, white, explained in want:
        for c in range(4):
            r = by_key[i, c + 1][0]
            assert (r["n"], r["deviation"]) == (n, deviation) and abs(r["explained"] / explained[c] - 1) < 1e-9
            s = sign.setdefault(c, 1 if r["whitened"] * white[c] > 0 else -1)
            assert abs(r["whitened"] - s * white[c]) < 1e-8
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-10


def test_few_rows_constant_dimensions_and_empty_tables(spark):
    assert run(spark, []) == [] and run(spark, [(1, None)]) == [] and run(spark, [(1, [1.0, 2.0])]) == []
    two = run(spark, [(1, [1.0, 5.0, 0.0]), (2, [2.0, 5.0, 0.0]), (3, [2.0, 5.0, 0.0])])
    assert sorted((r["vec_id"], r["component"], round(abs(r["whitened"]), 12), round(r["explained"], 12)) for r in two) == [
        (1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0), (3, 1, 1.0, 1.0)]
    mixed = run(spark, [(i, [float(i), float(i * i % 7)]) for i in range(9)] + [(50 + i, [float(i)]) for i in range(3)])
    assert {(r["n"], r["component"]) for r in mixed} == {(9, 1), (9, 2), (3, 1)}


def test_deviation_beyond_64_bits_is_null(spark):
    rows = run(spark, [(1, [1e9, 0.0]), (2, [-1e9, 1.0]), (3, [0.0, 0.0])])
    assert {r["vec_id"]: r["deviation"] for r in rows}[1] is None
    assert all(r["identity_error"] < 1e-8 for r in rows)
    with pytest.raises(Exception, match="exceeds"):
        run(spark, [(1, [1e30]), (2, [0.0])])


def test_factors_fold_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FOLD", 2)
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 3)
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(200, 5)))]
    white = {(r["vec_id"], r["component"]): r["whitened"] for r in run(spark, rows)}
    want = {i: w for i, _, _, w, _ in reference(rows)}
    for c in range(4):
        a, b = np.array([white[i, c + 1] for i in want]), np.array([w[c] for w in want.values()])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9


@pytest.mark.parametrize("kind", ["plain", "graded", "whole", "repeated", "equal", "two_levels", "zero"])
def test_bidiagonal_solver(kind):
    rng = np.random.default_rng(len(kind))
    for n, d in ((1, 1), (3, 2), (2, 9), (40, 17), (90, 64)):
        x = rng.normal(size=(n, d))
        if kind == "graded":
            x = x * np.geomspace(1, 1e-9, d)
        elif kind == "whole":
            x = np.round(x * 2)
        elif kind == "repeated":
            x = np.repeat(x[:, :max(1, d // 3)], 4, axis=1)[:, :d]
        elif kind == "equal":
            x = np.linalg.qr(rng.normal(size=(max(n, d), d)))[0]
        elif kind == "two_levels":
            x = np.linalg.qr(rng.normal(size=(max(n, d), d)))[0] * np.where(np.arange(d) <= d // 2, 1, 1e-3)
        elif kind == "zero":
            x = np.zeros((n, d))
        diagonal, above, w = whitening.bidiagonalise(whitening.triangle(x))
        values = whitening.dqds(diagonal, above)
        want = np.linalg.svd(x, compute_uv=False)
        want = np.append(want, np.zeros(max(0, d - len(want))))[:d]
        assert np.abs(values - want).max() <= 1e-13 * max(want[0], 1e-300)
        if want[0] == 0:
            continue
        top = values[:4][values[:4] > 1e-12 * values[0]]
        v = w @ whitening.singular_vectors(diagonal, above, top)
        assert np.abs(v.T @ v - np.eye(len(top))).max() < 1e-12
        assert np.abs(x.T @ (x @ v) - v * top ** 2).max() < 1e-12 * values[0] ** 2


def test_dqds_keeps_small_values_accurate():
    """A bidiagonal matrix determines even its tiny singular values to high relative accuracy."""
    q, e = np.array([1.0, 1e-5, 1e-10, 1e-14]), np.array([0.5, 1e-6, 1e-11])
    values = whitening.dqds(q, e)
    assert abs(np.prod(values) / np.prod(q) - 1) < 1e-12
    assert 0 < values[-1] < 1e-13
