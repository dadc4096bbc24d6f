"""Property-based checks (hypothesis) of the exact order statistics and the
split sizes against numpy / brute force."""
import math

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from nutrilake.functions.ordered import long_quantiles
from nutrilake.operators import split

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

values = st.lists(st.one_of(st.integers(-50, 50).map(float),
                            st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False)),
                  min_size=1, max_size=120)


@SETTINGS
@given(values, st.lists(st.floats(0, 1), min_size=1, max_size=5), st.sampled_from([1, 3, 64]))
def test_quantiles_bit_identical_to_numpy(spark, vals, probs, buckets):
    df = spark.createDataFrame([("g", v) for v in vals], "g string, v double")
    got = long_quantiles(df, "g", "v", probs, n_buckets=buckets).first()["q"]
    assert list(got) == list(np.quantile(np.array(vals), probs))


@SETTINGS
@given(st.dictionaries(st.sampled_from("ABCDE"), st.integers(2, 60), min_size=2, max_size=5),
       st.sampled_from([0.1, 0.2, 0.25, 0.5]))
def test_split_sizes(spark, sizes, test_size):
    n = sum(sizes.values())
    n_test = math.ceil(test_size * n)
    if n_test < len(sizes) or n - n_test < len(sizes):
        return
    rows = [(f"{c}{i}", c) for c, k in sizes.items() for i in range(k)]
    df = spark.createDataFrame(rows, "Person_ID string, Health_Status string")
    out = split.stratified_split(df, test_size=test_size, seed=1)
    got = {(r[0], r[1]): r[2] for r in out.groupBy("Health_Status", "split").count().collect()}
    quotas = split.test_quotas(sizes, test_size)
    assert sum(quotas.values()) == n_test
    for c, q in quotas.items():
        assert got.get((c, "test"), 0) == q
        assert got.get((c, "train"), 0) == sizes[c] - q
