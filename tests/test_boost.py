"""The learner contract, run for every registered type."""
import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import types as T
from pyspark.sql import functions as F

from nutrilake.operators import histogram
from nutrilake.operators.boost import MODEL_REGISTRY, load_model, make_model

FAST = {"n_estimators": 3, "max_depth": 2}


@pytest.fixture(scope="module")
def toy(spark):
    rng = np.random.RandomState(42)
    rows = [(i, Vectors.dense(float(rng.rand()), float(rng.rand())), i % 4) for i in range(40)]
    val = [(100 + i, Vectors.dense(float(rng.rand()), float(rng.rand())), i % 4) for i in range(12)]
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("features", VectorUDT()),
                           T.StructField("label", T.IntegerType())])
    return spark.createDataFrame(rows, schema), spark.createDataFrame(val, schema)


@pytest.mark.parametrize("model_type", list(MODEL_REGISTRY))
def test_contract(spark, toy, model_type, tmp_path):
    train, val = toy
    model = make_model(model_type, 42, **FAST)
    with pytest.raises(RuntimeError, match="must be fitted"):
        model.predict(train)
    with pytest.raises(RuntimeError, match="must be fitted"):
        model.get_evals_result()
    assert model.fit(train, validation=val) is model
    pred = model.predict(train).select("id", "prediction").orderBy("id").collect()
    assert len(pred) == 40 and all(0 <= r[1] < 4 for r in pred)
    proba = model.predict_proba(train).select("probability").collect()
    assert all(len(r[0]) == 4 and abs(sum(r[0]) - 1) < 1e-9 for r in proba)
    curves = model.get_evals_result().collect()
    tr = [r for r in curves if r["split"] == "train"]
    va = [r for r in curves if r["split"] == "validation"]
    assert len(tr) == len(va) > 0
    path = str(tmp_path / model_type)
    model.save(path)
    back = load_model(path)
    again = back.predict(train).select("id", "prediction").orderBy("id").collect()
    assert again == pred


@pytest.mark.parametrize("model_type", list(MODEL_REGISTRY))
def test_no_validation_and_params(spark, toy, model_type):
    train, _ = toy
    model = make_model(model_type, 7, **FAST).fit(train)
    assert model.random_state == 7
    with pytest.raises(RuntimeError, match="without a validation set"):
        model.get_evals_result()
    bare = make_model(model_type)
    assert "n_estimators" not in bare.hyperparameters and "iterations" not in bare.hyperparameters
    with pytest.raises(ValueError, match="unknown hyper-parameter"):
        make_model(model_type, bogus=1)


@pytest.mark.parametrize("model_type", list(MODEL_REGISTRY))
def test_learns_a_separable_rule(spark, model_type):
    rng = np.random.RandomState(0)
    xs = rng.uniform(0, 4, 400)
    schema = T.StructType([T.StructField("features", VectorUDT()), T.StructField("label", T.IntegerType())])
    df = spark.createDataFrame([(Vectors.dense(float(x), float(rng.rand())), int(x)) for x in xs], schema)
    model = make_model(model_type, 1, n_estimators=4, max_depth=2, learning_rate=0.8).fit(df)
    acc = model.predict(df).select(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert acc >= 0.95


@pytest.mark.parametrize("model_type", list(MODEL_REGISTRY))
def test_hyper_parameters_are_honoured(spark, toy, model_type):
    assert make_model(model_type, seed=7).random_state == make_model(model_type, random_state=7).random_state == 7
    assert make_model(model_type, 1, seed=7, random_state=7).random_state == 7
    with pytest.raises(ValueError, match="two different seeds"):
        make_model(model_type, seed=7, random_state=8)
    train, _ = toy
    p = [[round(x, 9) for x in r[0]] for kw in ({}, {"subsample": 0.5})
         for r in make_model(model_type, 3, **FAST, **kw).fit(train).predict_proba(train.orderBy("id")).select("probability").collect()]
    assert p[:40] != p[40:]


@pytest.mark.parametrize("model_type", list(MODEL_REGISTRY))
def test_a_class_missing_from_train_keeps_its_place(spark, toy, model_type):
    train, _ = toy
    part = train.where("label < 3")
    model = make_model(model_type, 1, **FAST).fit(part, n_classes=4)
    assert all(len(r[0]) == 4 for r in model.predict_proba(train).select("probability").collect())


def test_plan_does_not_grow_with_rounds(spark, toy):
    from nutrilake.operators.boost import SoftmaxBoost
    train, _ = toy
    model = SoftmaxBoost(1, iterations=2, depth=2).fit(train)
    one = len(model.predict_proba(train)._jdf.queryExecution().toString())
    two = [r for r in model.nodes if r[0] < 2]
    model.nodes = [(2 * i + r[0], *r[1:]) for i in range(250) for r in two]      # 500 rounds of 4 classes
    scored = model.predict_proba(train)
    assert len(scored._jdf.queryExecution().toString()) < one + 200
    assert all(abs(sum(r[0]) - 1) < 1e-9 for r in scored.select("probability").collect())


def _brute_tree(x, y, k, classes, objective, depth, l2=1.0):
    """Best splits of the first tree of class k by trying every cut: {heap place: (feature, cut, gain, value)}."""
    n = len(y)
    share = np.array([(y == c).sum() / n for c in range(classes)])
    p = share[k] if objective == "softmax" else 1 / (1 + (n - (y == k).sum()) / (y == k).sum())
    unit = histogram.FIXED
    g, h = np.rint((p - (y == k)) * unit) / unit, np.full(n, np.rint(p * (1 - p) * unit) / unit)
    factor = (classes - 1) / classes if objective == "softmax" else 1.0
    out = {}

    def grow(at, rows, level):
        total = g[rows].sum(), h[rows].sum()
        best = None
        if level < depth:
            for f in range(x.shape[1]):
                values = np.unique(x[:, f])
                for lo, hi in zip(values[:-1], values[1:]):
                    left = rows[x[rows, f] <= lo]
                    if 0 < len(left) < len(rows):
                        a = g[left].sum(), h[left].sum()
                        gain = sum(u * u / (v + l2) for u, v in (a, (total[0] - a[0], total[1] - a[1]))) - total[0] ** 2 / (total[1] + l2)
                        if best is None or gain > best[2] + 1e-12:
                            best = (f, lo + (hi - lo) / 2, gain)
        if best is None or best[2] <= histogram.MIN_GAIN:
            out[at] = (-1, 0.0, 0.0, -factor * total[0] / (total[1] + l2))
            return
        out[at] = (*best, None)
        small = x[rows, best[0]] <= best[1]
        grow(2 * at + 1, rows[small], level + 1)
        grow(2 * at + 2, rows[~small], level + 1)

    grow(0, np.arange(n), 0)
    return out


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.RandomState(11)
    x = np.stack([rng.randint(0, 7, 600), rng.randint(0, 20, 600) / 4, rng.randint(0, 2, 600)], axis=1).astype(float)
    y = ((x[:, 0] > 3).astype(int) + (x[:, 1] + rng.rand(600) > 3)) % 3
    schema = T.StructType([T.StructField("features", VectorUDT()), T.StructField("label", T.IntegerType()),
                           T.StructField("fold", T.IntegerType())])
    df = spark.createDataFrame([(Vectors.dense(*map(float, r)), int(c), i % 4) for i, (r, c) in enumerate(zip(x, y))], schema)
    return df.repartition(5), x, y


@pytest.mark.parametrize("model_type", list(MODEL_REGISTRY))
def test_first_trees_against_brute_force(table, model_type):
    df, x, y = table
    model = make_model(model_type, 1, iterations=1, depth=2).fit(df)
    trees = model.forest.rounds[0]
    for k in range(3):
        for at, (feature, cut, gain, value) in _brute_tree(x, y, k, 3, model.objective, 2).items():
            assert trees.feature[0, k, at] == feature
            if feature >= 0:
                assert model.forest.thresholds[feature][trees.bin[0, k, at]] == cut
                assert abs(trees.gain[0, k, at] - gain) < 1e-9
            else:
                assert abs(trees.value[0, k, at] - value) < 1e-12


@pytest.mark.parametrize("model_type", list(MODEL_REGISTRY))
def test_joint_folds_equal_separate_fits(table, model_type):
    df, _, _ = table
    model = make_model(model_type, 1, iterations=3, depth=3, learning_rate=0.5)
    pairs, forest = model.fit_folds(df, 4, n_classes=3)
    assert forest.passes == 3 * 3                  # one pass a level, for all folds and classes
    want = {}
    for fold in range(4):
        alone = make_model(model_type, 1, iterations=3, depth=3, learning_rate=0.5)
        alone.fit(df.where(F.col("fold") != fold), n_classes=3, thresholds=forest.thresholds)
        assert histogram.node_rows(forest, fold) == alone.nodes
        assert forest.init[fold].tolist() == alone.init_scores
        for r in alone.predict(df.where(F.col("fold") == fold)).groupBy("label", "prediction").count().collect():
            want[fold, r["label"], r["prediction"]] = r["count"]
    assert {(r.fold, r.label, r.prediction): r.n for r in pairs.collect()} == want


@pytest.mark.parametrize("model_type", list(MODEL_REGISTRY))
def test_partitions_and_kept_scores_change_nothing(table, model_type, monkeypatch):
    df, _, _ = table
    a = make_model(model_type, 1, iterations=4, depth=2, subsample=1.0).fit(df, validation=df)
    monkeypatch.setattr(histogram, "KEEP_EVERY", 1)
    b = make_model(model_type, 1, iterations=4, depth=2).fit(df.coalesce(1), validation=df)
    assert a.nodes == b.nodes and a._curves == b._curves and len(a._curves) == 8
    train = [v for i, side, _, v in a._curves if side == "train"]
    assert train == [v for i, side, _, v in a._curves if side == "validation"]
    assert train == sorted(train, reverse=True)
    p = a.predict_proba(df).select("label", "probability").collect()
    if model_type == "softmax_boost":
        assert abs(train[-1] + np.mean([np.log(r.probability[r.label]) for r in p])) < 1e-6


def test_flat_trees_score_like_bins(table):
    from pyspark.ml.functions import vector_to_array

    from nutrilake.operators.boost import forest_scorer
    df, x, _ = table
    model = make_model("softmax_boost", 1, iterations=3, depth=4).fit(df)
    forest = model.forest
    score = np.tile(forest.init, (len(x), 1, 1))
    histogram._add_rounds(score, histogram.bin_rows(x, forest.thresholds), forest.rounds, 4, 0.1)
    want = {tuple(r): tuple(np.round(s[0], 9)) for r, s in zip(x.tolist(), score)}
    got = df.select("features", forest_scorer(model.nodes, model.init_scores, 0.1)(vector_to_array("features")).alias("s")).collect()
    assert all(tuple(np.round(r.s, 9)) == want[tuple(r.features.toArray().tolist())] for r in got)


def test_thresholds_of_many_values_nan_and_constants(spark):
    rng = np.random.RandomState(4)
    rows = [(Vectors.dense(float(v), 5.0, float("nan") if i % 9 == 0 else float(i % 3)),) for i, v in enumerate(rng.rand(2000))]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("features", VectorUDT())])).repartition(3)
    many, constant, few = histogram.fit_thresholds(df, "features", 16)
    assert len(many) == 15 and len(constant) == 0 and few.tolist() == [0.5, 1.5]
    share = np.searchsorted(np.sort([r[0][0] for r in rows]), many) / 2000
    assert np.abs(share - np.arange(1, 16) / 16).max() < 0.005
    bins = histogram.bin_rows(np.array([[0.0, 5.0, np.nan], [1.0, 9.0, 0.0]]), [many, constant, few])
    assert bins.tolist() == [[0, 0, 2], [15, 0, 0]]


def test_scratch_of_a_fit_is_removed(spark, toy):
    import os

    from nutrilake.session import ensure_checkpoint_dir, remove_scratch
    train, _ = toy
    folder = os.path.join(ensure_checkpoint_dir(spark), "scratch")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    make_model("ovr_gbt", 1, **FAST).fit(train)
    assert set(os.listdir(folder)) == before
    for path in ("/tmp", folder, folder + "/", folder + "/../x"):
        with pytest.raises(ValueError, match="no scratch folder"):
            remove_scratch(spark, path)


def test_rows_are_kept_in_blocks_and_features_counted_jointly(table, monkeypatch):
    df, _, _ = table
    blocks = histogram.binned_table(df.coalesce(1), "features", "label", None, histogram.fit_thresholds(df, "features", 32))
    assert blocks.count() == 1                              # 600 rows, one block
    want = make_model("softmax_boost", 1, iterations=2, depth=3).fit(df, validation=df)
    groups = histogram._grouped([7, 20, 2, 5000], 4096)
    assert sorted(f for g in groups for f in g) == [0, 1, 2, 3] and [3] in groups and len(groups) == 2
    monkeypatch.setattr(histogram, "BLOCK", 64)             # many blocks, every feature on its own
    monkeypatch.setattr(histogram, "GROUP_CELLS", 1)
    alone = make_model("softmax_boost", 1, iterations=2, depth=3).fit(df, validation=df)
    assert alone.nodes == want.nodes and alone._curves == want._curves


def test_shared_bins_equal_own_bins(table):
    from pyspark.ml.feature import VectorSlicer
    df, _, _ = table
    binned = histogram.bin_once(df, "features", "label", histogram.fit_thresholds(df, "features", 32))
    part = VectorSlicer(inputCol="features", outputCol="part", indices=[2, 0]).transform(df).drop("features") \
        .withColumnRenamed("part", "features")
    shared = make_model("ovr_gbt", 1, iterations=2, depth=2).fit(df, binned=binned.only([2, 0]))
    assert shared.nodes == make_model("ovr_gbt", 1, iterations=2, depth=2).fit(part).nodes
    binned.remove()


def test_probabilities_are_generated_code(spark, toy):
    train, _ = toy
    model = make_model("ovr_gbt", 1, **FAST).fit(train)
    assert "lambdafunction" not in model.predict_proba(train)._jdf.queryExecution().toString()
