"""Brute-force checks of the bucketed order statistics."""
import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from nutrilake.functions.ordered import (column_quantiles, hash_rank, long_quantiles,
                                         running_totals, seeded_order_key)


def test_hash_rank_equals_row_number(spark):
    rng = np.random.RandomState(0)
    rows = [(f"k{i}", str(rng.choice(["a", "b", "c"], p=[0.7, 0.2, 0.1]))) for i in range(3000)]
    df = spark.createDataFrame(rows, "key string, g string").withColumn("o", seeded_order_key(42, "key"))
    for plen in (1, 2, 3):
        got = hash_rank(df, "o", ["g"], ["key"], prefix_len=plen)
        ref = df.withColumn("_ref", F.row_number().over(Window.partitionBy("g").orderBy("o", "key")))
        bad = got.join(ref, ["key", "g", "o"]).where(F.col("_rank") != F.col("_ref")).count()
        assert bad == 0
    # no group: one global order
    got = hash_rank(df, "o", [], ["key"], prefix_len=2)
    ref = df.withColumn("_ref", F.row_number().over(Window.orderBy("o", "key")))
    assert got.join(ref, ["key"]).where(F.col("_rank") != F.col("_ref")).count() == 0


@pytest.mark.parametrize("buckets", [1, 4, 256])
def test_quantiles_equal_numpy(spark, buckets):
    rng = np.random.RandomState(1)
    a = np.round(rng.normal(0, 1, 997), 1)               # many ties
    b = rng.exponential(5, 501)
    rows = [("a", float(v)) for v in a] + [("b", float(v)) for v in b] + [("c", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.73, 0.9, 1.0]
    got = {r["g"]: r["q"] for r in long_quantiles(df, "g", "v", probs, n_buckets=buckets).collect()}
    assert list(got["a"]) == list(np.quantile(a, probs))  # bit-identical
    assert list(got["b"]) == list(np.quantile(b, probs))
    assert "c" not in got


def test_column_quantiles_and_approx(spark):
    df = spark.createDataFrame([(float(i), float(i % 7)) for i in range(1000)], "x double, y double")
    q = column_quantiles(df, ["x", "y"], [0.5])
    assert q == {"x": [499.5], "y": [float(np.quantile([i % 7 for i in range(1000)], 0.5))]}
    qa = column_quantiles(df, ["x"], [0.5], method="approx")
    assert abs(qa["x"][0] - 499.5) <= 1


def test_running_totals_brute_force(spark):
    rng = np.random.RandomState(2)
    vals = rng.randint(0, 300, 2000)
    rows = [("f", float(v), int(i % 2)) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "feature string, value double, side int")
    counts = df.groupBy("feature", "value").agg(F.count_if(F.col("side") == 0).alias("rn"),
                                                 F.count_if(F.col("side") == 1).alias("cn"))
    got = {r["value"]: (r["cum_rn"], r["cum_cn"]) for r in
           running_totals(counts, ["feature"], "value", ["rn", "cn"], n_buckets=16).collect()}
    for v in (0.0, 57.0, 150.0, 299.0):
        if v in got:
            exp_r = sum(1 for i, x in enumerate(vals) if x <= v and i % 2 == 0)
            exp_c = sum(1 for i, x in enumerate(vals) if x <= v and i % 2 == 1)
            assert got[v] == (exp_r, exp_c)


def test_count_below_binary_search(spark):
    import bisect
    from nutrilake.functions.ordered import count_below
    rng = np.random.RandomState(5)
    for size in (0, 1, 2, 7, 100):
        arr = sorted(set(np.round(rng.normal(0, 10, size), 1).tolist()))
        probes = [-100.0, 100.0] + (arr[:5] if arr else []) + list(rng.normal(0, 10, 20))
        df = spark.createDataFrame([(float(p),) for p in probes], "v double")
        lit_arr = F.array(*[F.lit(float(a)) for a in arr]) if arr else F.array().cast("array<double>")
        got = [r[0] for r in df.select(count_below(lit_arr, F.col("v"), max(len(arr), 1))).collect()]
        assert got == [bisect.bisect_left(arr, p) for p in probes]


def test_hash_thresholds_refinement(spark):
    """A tiny max_cut_rows forces re-cutting with longer prefixes; the cut
    must still be the exact q-th row."""
    from nutrilake.functions.ordered import hash_thresholds, within_threshold
    df = spark.createDataFrame([(f"k{i}", "a" if i % 3 else "b") for i in range(5000)], "key string, g string") \
        .withColumn("o", seeded_order_key(1, "key"))
    quotas = {"a": 1234, "b": 77}
    cuts, totals, _ = hash_thresholds(df, "o", "g", ["key"], quotas, prefix_len=1, max_cut_rows=20)
    assert totals == {"a": 3333, "b": 1667}
    sel = within_threshold(df, "o", ["key"], "g", cuts, "_in").where("_in")
    ref = df.withColumn("_r", F.row_number().over(Window.partitionBy("g").orderBy("o", "key")))
    q = F.create_map(F.lit("a"), F.lit(1234), F.lit("b"), F.lit(77))
    exp = ref.where(F.col("_r") <= q[F.col("g")])
    assert sorted(r[0] for r in sel.select("key").collect()) == sorted(r[0] for r in exp.select("key").collect())


def test_checked_broadcast_falls_back_to_shuffle(spark):
    from nutrilake.functions.ordered import checked_broadcast
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # only hints may broadcast
    try:
        big = spark.range(1000)

        def plan(df):
            return df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan(big.join(checked_broadcast(spark.range(10), 100), "id"))
        fallback = big.join(checked_broadcast(spark.range(10), 5), "id")
        assert "BroadcastHashJoin" not in plan(fallback)
        assert fallback.count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_collect_bounded(spark):
    from nutrilake.functions.ordered import collect_bounded
    assert len(collect_bounded(spark.range(5), 5)) == 5
    with pytest.raises(ValueError, match="more than 4"):
        collect_bounded(spark.range(5), 4)


@pytest.mark.parametrize("accuracy", [8, 50, 10_000])
def test_bracketed_quantiles_equal_numpy(spark, accuracy):
    from nutrilake.functions.ordered import bracketed_quantiles
    rng = np.random.RandomState(11)
    data = {"x": rng.normal(0, 5, 4000), "ties": rng.randint(0, 4, 4000).astype(float), "one": np.full(4000, 2.5)}
    rows = [(float(a), float(b), float(c), None, i) for i, (a, b, c) in enumerate(zip(*data.values()))]
    rows += [(None, None, None, None, None)] * 30
    df = spark.createDataFrame(rows, "x double, ties double, one double, none double, i int").repartition(7)
    probs = [0.0, 0.25, 0.5, 0.731, 0.999, 1.0]
    got = bracketed_quantiles(df, ["x", "ties", "one", "none", "i"], probs, accuracy)
    for c in ("x", "ties", "one"):
        assert got[c] == np.quantile(data[c], probs).tolist()
    assert got["none"] is None and got["i"] == np.quantile(np.arange(4000), probs).tolist()
    assert bracketed_quantiles(df.limit(0), ["x"], probs) == {"x": None}
