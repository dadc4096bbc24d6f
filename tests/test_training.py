"""Training jobs: learners and subsets of one query share rows, folds and bins."""
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from nutrilake.operators import histogram
from nutrilake.plans import catalog, training
from nutrilake.plans.preprocess import prepare

SHORT = {"n_estimators": 2, "max_depth": 2}


@pytest.fixture(scope="module")
def orders(spark, tmp_path_factory):
    """600 orders of many values, in a data folder of their own."""
    folder = str(tmp_path_factory.mktemp("orders"))
    spark.range(1, 601).select(
        F.col("id").alias("o_orderkey"), (F.col("id") * 37 % 191).alias("o_custkey"),
        F.concat((F.col("id") % 5 + 1).cast("string"), F.lit("-X")).alias("o_orderpriority")) \
        .write.parquet(folder + "/orders.parquet")
    return folder


@pytest.fixture(scope="module")
def prepared(spark, mock_df):
    base = mock_df.unionByName(mock_df.withColumn("Person_ID", F.concat("Person_ID", F.lit("b"))))
    return prepare(base, test_size=0.25, how="cache")


@pytest.fixture
def calls(monkeypatch):
    """How often rows are assembled, split candidates found and rows binned."""
    seen = {"model_frame": 0, "fit_thresholds": 0, "bin_once": 0}

    def counted(module, name):
        real = getattr(module, name)

        def call(*args, **kw):
            seen[name] += 1
            return real(*args, **kw)
        return call

    monkeypatch.setattr(training, "model_frame", counted(training, "model_frame"))
    for name in ("fit_thresholds", "bin_once"):
        shared = counted(histogram, name)
        for module in (training, histogram):
            monkeypatch.setattr(module, name, shared)
    return seen


@pytest.mark.parametrize("name, rows", [("train_curves", 18), ("cross_validate", 50), ("leakage_ablation", 30)])
def test_learners_share_rows_and_bins(spark, orders, calls, name, rows):
    found = catalog.queries()[name](spark, orders).collect()
    assert len(found) == rows and all(r[-1] for r in found)
    assert calls == {"model_frame": 1, "fit_thresholds": 1, "bin_once": 1}


def test_reloaded_scores_are_compared_without_a_shuffle_by_id(spark, orders, capsys):
    found = catalog.queries()["score_reload"](spark, orders)
    assert all(r["same_label"] and r["same_probabilities"] for r in found.collect())
    found.explain()
    plan = capsys.readouterr().out
    assert "Union" not in plan and "request_id" not in "".join(x for x in plan.split("\n") if "Exchange" in x)


def test_shared_folds_equal_own_folds(spark, prepared):
    folded, folder = training.folded_rows(prepared, 3, 42)
    binned = training.shared_bins(folded, None, {"ovr_gbt": SHORT, "softmax_boost": SHORT}, 42, "fold")
    assert binned["ovr_gbt"] is binned["softmax_boost"]
    for t in binned:
        shared, _ = training.cross_validate(t, prepared, 3, 42, SHORT, binned[t])
        alone, _ = training.cross_validate(t, prepared, 3, 42, SHORT)
        order = ["fold", "metric"]
        assert shared.orderBy(*order).collect() == alone.orderBy(*order).collect()
    training.remove_bins(binned)
    histogram.remove_scratch(spark, folder)


def test_some_features_of_a_frame(prepared):
    names = prepared.feature_names
    x = vector_to_array("features").alias("x")
    part = training.only_features(training.model_frame(prepared), [3, 0]).select("Person_ID", x)
    want = training.model_frame(prepared, [names[3], names[0]]).select("Person_ID", x)
    assert part.orderBy("Person_ID").collect() == want.orderBy("Person_ID").collect()
