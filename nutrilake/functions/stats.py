"""Statistical column expressions shared by profiling, drift and metrics."""
from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column
from pyspark.sql import functions as F

# Functions that run in Python workers are shipped by value: executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])

# ---- fixed values -------------------------------------------------------------
PSI_EPSILON = 1e-6          # floor of each bin proportion
KS_SERIES_TERMS = 100       # terms of the Kolmogorov series
KS_SMALL_LAMBDA = 0.2       # below it the series is 1 to double precision
KS_EXACT_ROWS = 10_000      # samples up to this size get the exact p-value
# ------------------------------------------------------------------------------


def bias_corrected_skewness(value: Column) -> Column:
    """Aggregate: sample skewness G1 = g1 * sqrt(n(n-1)) / (n-2) (the
    pandas ``skew``), NULL when n < 3, 0 for a constant column.

    ``F.skewness`` is the population g1; Spark's central-moment aggregates
    merge partial states, so this is one distributive pass.
    """
    n = F.count(value).cast("double")
    g1 = F.skewness(value)
    return (F.when(n < 3, F.lit(None).cast("double"))
            .when(F.stddev_pop(value) == 0, F.lit(0.0))
            .otherwise(g1 * F.sqrt(n * (n - 1)) / (n - 2)))


def ks_pvalue(d: Column, n1: Column, n2: Column) -> Column:
    """Asymptotic two-sided p-value of the two-sample KS statistic ``d``:
    Q(l) = 2 sum_{j>=1} (-1)^(j-1) exp(-2 j^2 l^2), l = d sqrt(n1 n2 / (n1+n2)),
    clamped to [0, 1].  A column expression (no UDF)."""
    lam = F.when((n1 > 0) & (n2 > 0), d * F.sqrt(n1.cast("double") * n2 / (n1 + n2))) \
        .otherwise(F.lit(0.0))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(KS_SERIES_TERMS)), F.lit(0.0),
        lambda acc, j: acc + 2.0 * F.pow(F.lit(-1.0), j - 1) * F.exp(-2.0 * j * j * lam * lam))
    return F.when(lam < KS_SMALL_LAMBDA, F.lit(1.0)) \
        .otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def ks_exact_pvalue(d: float, n1: int, n2: int) -> float:
    """Exact two-sided p-value of the two-sample KS statistic ``d``: the share of
    lattice paths from (0, 0) to (n1, n2) that somewhere are ``d`` or more off
    the diagonal.

    Row by row, the paths that stay inside the band are running sums of the row
    before, cut to the band; rows are rescaled, so counts do not overflow.
    """
    if n1 == 0 or n2 == 0:
        return 1.0
    g = math.gcd(n1, n2)
    a, b = n2 // g, n1 // g
    h = round(d * (n1 // g) * n2)        # in units of 1 / lcm(n1, n2)
    if h <= 0:
        return 1.0

    def band(i: int) -> tuple[int, int]:
        return max(0, (i * a - h) // b + 1), min(n2, -((-i * a - h) // b) - 1)

    low, high = band(0)
    row, log_scale = np.ones(high - low + 1), 0.0
    for i in range(1, n1 + 1):
        new_low, new_high = band(i)
        if new_low > new_high:
            return 1.0
        wide = np.zeros(new_high - new_low + 1)
        kept = row[new_low - low:]
        wide[:len(kept)] = kept
        row, low = np.cumsum(wide), new_low
        top = row[-1]
        if top == 0:
            return 1.0
        if top > 1e200:
            row, log_scale = row / top, log_scale + math.log(top)
    paths = math.lgamma(n1 + n2 + 1) - math.lgamma(n1 + 1) - math.lgamma(n2 + 1)
    return min(1.0, max(0.0, -math.expm1(math.log(row[-1]) + log_scale - paths)))


def ks_pvalue_exact(d: Column, n1: Column, n2: Column) -> Column:
    """``ks_exact_pvalue`` of a column: one row per feature, O(n1 n2) steps each."""
    exact = ks_exact_pvalue

    def run(x: pd.Series, m: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([exact(float(u), int(v), int(w)) for u, v, w in zip(x, m, n)], dtype="float64")

    return F.pandas_udf(run, "double")(d, n1, n2)


def psi_term(ref_prop: Column, cur_prop: Column, eps: float = PSI_EPSILON) -> Column:
    """One bin's PSI contribution with both proportions floored at eps."""
    r = F.greatest(ref_prop, F.lit(eps))
    c = F.greatest(cur_prop, F.lit(eps))
    return (c - r) * F.log(c / r)


def severity(psi: Column, moderate: float = 0.1, major: float = 0.25) -> Column:
    return F.when(psi >= major, "major").when(psi >= moderate, "moderate").otherwise("none")
