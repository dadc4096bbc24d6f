import math
import warnings

import pytest
from pyspark.sql import functions as F

from nutrilake.operators import split


def _frame(spark, sizes):
    rows = []
    for cls, n in sizes.items():
        rows += [(f"{cls}-{i}", cls) for i in range(n)]
    return spark.createDataFrame(rows, "Person_ID string, Health_Status string")


def test_split_sizes_exact_and_disjoint(spark):
    df = _frame(spark, {"A": 53, "B": 31, "C": 9, "D": 7})
    s = split.stratified_split(df, test_size=0.2, seed=42).cache()
    n = 100
    n_test = math.ceil(0.2 * n)
    assert s.where("split = 'test'").count() == n_test
    assert s.count() == n and s.select("Person_ID").distinct().count() == n
    per = {(r[0], r[1]): r[2] for r in s.groupBy("Health_Status", "split").count().collect()}
    quotas = split.test_quotas({"A": 53, "B": 31, "C": 9, "D": 7}, 0.2)
    for cls, q in quotas.items():
        assert per[(cls, "test")] == q
    assert sum(quotas.values()) == n_test


def test_largest_remainder_allocation():
    assert split.train_allocation({"a": 1, "b": 1, "c": 1}, 2) == {"a": 1, "b": 1, "c": 0}
    alloc = split.train_allocation({"x": 10, "y": 5, "z": 2}, 13)
    assert sum(alloc.values()) == 13 and alloc["x"] >= 7


def test_split_is_seeded(spark):
    df = _frame(spark, {"A": 40, "B": 20})
    a = sorted(r[0] for r in split.stratified_split(df, seed=3).where("split='test'").select("Person_ID").collect())
    b = sorted(r[0] for r in split.stratified_split(df, seed=3).where("split='test'").select("Person_ID").collect())
    c = sorted(r[0] for r in split.stratified_split(df, seed=4).where("split='test'").select("Person_ID").collect())
    assert a == b and a != c


def test_single_member_class_is_an_error(spark):
    with pytest.raises(ValueError, match="least populated class"):
        split.stratified_split(_frame(spark, {"A": 10, "B": 1}))


def test_kfold_each_row_once(spark):
    df = _frame(spark, {"A": 23, "B": 12, "C": 5})
    f = split.stratified_folds(df, 5).cache()
    assert f.count() == 40
    per = f.groupBy("Health_Status", "fold").count().collect()
    by_cls = {}
    for r in per:
        by_cls.setdefault(r[0], []).append(r[2])
    for counts in by_cls.values():
        assert max(counts) - min(counts) <= 1
    with pytest.raises(ValueError):
        split.stratified_folds(df, 30)
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        split.stratified_folds(df, 6)
        assert any("least populated" in str(x.message) for x in w)


def test_recombine_and_features_label(spark):
    df = _frame(spark, {"A": 10, "B": 10}).withColumn("f", F.lit(1.0))
    train, test = split.train_test(df)
    both = split.recombine(train, test)
    assert both.count() == 20
    assert split.features_and_label(both, ["f"]).columns == ["Person_ID", "f", "Health_Status"]


def test_split_equals_row_number_cut(spark):
    from pyspark.sql import Window
    from nutrilake.functions.ordered import seeded_order_key
    df = _frame(spark, {"A": 300, "B": 120, "C": 33})
    quotas = split.test_quotas({"A": 300, "B": 120, "C": 33}, 0.3)
    got = split.stratified_split(df, test_size=0.3, seed=9)
    ranked = df.withColumn("_o", seeded_order_key(9, "Person_ID")) \
        .withColumn("_r", F.row_number().over(Window.partitionBy("Health_Status").orderBy("_o", "Person_ID")))
    q = F.create_map(*[x for c, v in quotas.items() for x in (F.lit(c), F.lit(v))])
    exp = ranked.withColumn("exp", F.when(F.col("_r") <= q[F.col("Health_Status")], "test").otherwise("train"))
    assert got.join(exp, ["Person_ID", "Health_Status"]).where(F.col("split") != F.col("exp")).count() == 0


def test_folds_and_split_with_null_keys(spark):
    rows = [(None if i % 3 == 0 else f"k{i % 7}", f"c{i % 2}", i) for i in range(60)]
    df = spark.createDataFrame(rows, "Person_ID string, Health_Status string, v int").repartition(3)
    folds = split.stratified_folds(df, 5).groupBy("Health_Status", "fold").count().collect()
    assert sorted((r[0], r[1], r[2]) for r in folds) == [(c, f, 6) for c in ("c0", "c1") for f in range(5)]
    bad = df.withColumn("Health_Status", F.when(F.col("v") > 3, F.col("Health_Status")))
    for run in (lambda: split.stratified_folds(bad, 3), lambda: split.stratified_split(bad)):
        with pytest.raises(ValueError, match="NULL"):
            run()


def test_very_many_classes(spark):
    n = 20_000
    df = spark.range(5 * n).select(F.concat(F.lit("k"), F.col("id")).alias("Person_ID"),
                                   (F.col("id") % n).cast("string").alias("Health_Status"))
    out = split.stratified_split(df, test_size=0.4)
    counts = out.where("split = 'test'").groupBy("Health_Status").count()
    assert [tuple(r) for r in counts.groupBy("count").count().collect()] == [(2, n)]


def _blocks(rows, k):
    """Folds as the definition says: (md5 of the seeded key, md5 of the row) order, blocks per class."""
    import hashlib

    def md5(text):
        return hashlib.md5(text.encode()).hexdigest()

    null = "␀"
    counts = {}
    for r in rows:
        counts[r[1]] = counts.get(r[1], 0) + 1
    sizes, out = split.fold_sizes(counts, k), []
    for c in counts:
        own = sorted((r for r in rows if r[1] == c), key=lambda r: (
            md5("42:" + (null if r[0] is None else r[0])),
            md5("|".join(null if x is None else str(x) for x in r))))
        at = 0
        for f, n in enumerate(sizes[c]):
            out += [(*r, f) for r in own[at:at + n]]
            at += n
    return sorted(map(repr, out))


@pytest.mark.parametrize("k,max_cut_rows", [(2, 10 ** 6), (5, 10 ** 6), (5, 1), (7, 4)])
def test_fold_blocks_equal_the_order(spark, k, max_cut_rows):
    # unique keys, a key that a third of the rows lack, whole rows that repeat, a class smaller than k
    rows = [(None if i % 3 == 0 else f"k{i % 40}", f"c{i % 2}", i % 4) for i in range(300)]
    rows += [(f"u{i}", "c2", i) for i in range(50)] + [("same", "c3", 1)] * 33 + [("x", "c4", 0), ("y", "c4", 1)]
    df = spark.createDataFrame(rows, "Person_ID string, Health_Status string, v int").repartition(5)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        got = split.stratified_fold_blocks(df, k, max_cut_rows=max_cut_rows)
    assert got.columns == df.columns + ["fold"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == _blocks(rows, k)


def test_fold_blocks_edges(spark):
    schema = "Person_ID string, Health_Status string, `a.b` int"
    assert split.stratified_fold_blocks(spark.createDataFrame([], schema)).columns[-1] == "fold"
    df = spark.createDataFrame([(f"p{i}", "A", i) for i in range(4)], schema)
    for wrong, said in ((1, "at least 2"), (5, "greater than the number")):
        with pytest.raises(ValueError, match=said):
            split.stratified_fold_blocks(df, wrong)
    with pytest.raises(ValueError, match="NULL"):
        split.stratified_fold_blocks(spark.createDataFrame([("p", None, 1)], schema))
    plan = split.stratified_fold_blocks(df, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan


def test_fold_sizes_differ_by_one_at_most():
    for counts, k in (({"a": 7, "b": 5, "c": 11}, 4), ({"a": 1, "b": 9}, 5)):
        sizes = split.fold_sizes(counts, k)
        assert all(sum(sizes[c]) == n and max(sizes[c]) - min(sizes[c]) <= 1 for c, n in counts.items())
        whole = [sum(s[f] for s in sizes.values()) for f in range(k)]
        assert max(whole) - min(whole) <= 1
