"""Boosting classifiers (M1-M6) on the histogram engine.

Two registered learners with one contract:

* ``ovr_gbt``       -- one boosted logistic model per class, one against the
  rest; class probabilities are the K logistic values normalised to sum to 1.
* ``softmax_boost`` -- multinomial boosting: p = softmax(scores), Newton leaf
  values with Friedman's factor (K-1)/K.

Both grow the trees of all classes together from one binned table
(``operators.histogram``): a level of a round is one pass, whatever the number
of classes, and of folds in ``fit_folds``.  The fitted trees become one node
table: it is saved as one Parquet table and scored in one Arrow pass, so
neither the plan nor the number of model files grows with the rounds.

Input: a DataFrame with a vector column (``features``) and an integer label
0..K-1.  Nothing but model parameters reaches the driver.
"""
from __future__ import annotations

import json
import os

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nutrilake.functions.ordered import collect_bounded
from nutrilake.operators import histogram
from nutrilake.session import current_session

# caller names -> parameters of the engine (M6); reporting-only keys are accepted
PARAM_ALIASES = {
    "n_estimators": "maxIter", "iterations": "maxIter", "max_iter": "maxIter", "maxIter": "maxIter",
    "max_depth": "maxDepth", "depth": "maxDepth", "maxDepth": "maxDepth",
    "learning_rate": "stepSize", "eta": "stepSize", "stepSize": "stepSize",
    "subsample": "subsamplingRate", "subsamplingRate": "subsamplingRate",
    "max_bins": "maxBins", "maxBins": "maxBins",
    "min_child_weight": "minInstancesPerNode", "minInstancesPerNode": "minInstancesPerNode",
    "reg_lambda": "l2", "l2_leaf_reg": "l2", "l2": "l2",
}
REPORTING_KEYS = {"eval_metric", "verbose"}      # what to report, not what to fit
SEED_KEYS = ("random_state", "seed")
DEFAULT_PARALLELISM = 4     # concurrent per-class fits (jobs), not threads of work


def resolve_params(hyperparameters: dict) -> dict:
    """Map caller hyper-parameters to the engine's names; unknown keys are errors.
    Unset parameters keep ``HistogramBoost.DEFAULTS``."""
    out = {}
    for key, value in hyperparameters.items():
        if key in REPORTING_KEYS:
            continue
        if key not in PARAM_ALIASES:
            raise ValueError(f"unknown hyper-parameter {key!r}")
        out[PARAM_ALIASES[key]] = value
    return out


def _not_fitted(name: str) -> RuntimeError:
    return RuntimeError(f"{name} must be fitted before use")


class BoostingClassifier:
    """Common contract of the registered learners."""

    model_type = "base"

    def __init__(self, random_state: int = 42, /, **hyperparameters):
        seeds = {int(hyperparameters.pop(key)) for key in SEED_KEYS if key in hyperparameters}
        if len(seeds) > 1:
            raise ValueError(f"two different seeds: {sorted(seeds)}")
        self.random_state = seeds.pop() if seeds else random_state
        self.parallelism = int(hyperparameters.pop("parallelism", DEFAULT_PARALLELISM))
        self.hyperparameters = dict(hyperparameters)
        self.params = resolve_params(self.hyperparameters)
        self.n_classes: int | None = None
        self.features_col = "features"
        # names of the features in vector order, when the caller knows them
        self.feature_names: list[str] | None = None
        self._curves: list[tuple] | None = None
        self._fitted = False

    # -- contract -----------------------------------------------------------
    def fit(self, train: DataFrame, label_col: str = "label", features_col: str = "features",
            validation: DataFrame | None = None, n_classes: int | None = None) -> "BoostingClassifier":
        """``n_classes`` fixes the width of the probabilities; when None it is
        the largest label of ``train`` plus one."""
        raise NotImplementedError

    def predict_proba(self, df: DataFrame, prob_col: str = "probability") -> DataFrame:
        """Adds ``probability`` ARRAY<DOUBLE> of length K (sums to 1)."""
        raise NotImplementedError

    def predict(self, df: DataFrame, prediction_col: str = "prediction") -> DataFrame:
        """Adds the arg-max class index (lowest index wins ties)."""
        self._require_fitted()
        scored = self.predict_proba(df, "_proba")
        return scored.withColumn(prediction_col, argmax(F.col("_proba"))).drop("_proba")

    def get_evals_result(self) -> DataFrame:
        """(iteration, split, metric, value): train and validation curves."""
        self._require_fitted()
        if self._curves is None:
            raise RuntimeError("get_evals_result() is unavailable for a model fitted "
                               "without a validation set")
        spark = current_session()
        return spark.createDataFrame(self._curves, "iteration int, split string, metric string, value double")

    def _require_fitted(self) -> None:
        if not self._fitted:
            raise _not_fitted(type(self).__name__)

    def _meta(self) -> dict:
        return {"model_type": self.model_type, "random_state": self.random_state,
                "hyperparameters": self.hyperparameters, "n_classes": self.n_classes,
                "features_col": self.features_col, "feature_names": self.feature_names, "curves": self._curves}

    def _restore(self, meta: dict) -> None:
        self.n_classes = meta["n_classes"]
        self.features_col = meta["features_col"]
        self.feature_names = meta.get("feature_names")
        self._curves = [tuple(c) for c in meta["curves"]] if meta.get("curves") else None
        self._fitted = True


def run_parallel(fns: list, parallelism: int) -> list:
    """Run independent fits as concurrent Spark jobs (as MLlib's OneVsRest /
    CrossValidator ``parallelism`` does); results keep the input order."""
    if parallelism <= 1 or len(fns) <= 1:
        return [fn() for fn in fns]
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=min(parallelism, len(fns))) as pool:
        return list(pool.map(lambda fn: fn(), fns))


def argmax(arr: Column) -> Column:
    """0-based index of the largest element; first index on ties."""
    best = F.array_max(arr)
    return (F.array_position(arr, best) - 1).cast("int")


class HistogramBoost(BoostingClassifier):
    """The common part of both learners; they differ in the objective."""

    objective = ""
    metric = ""
    DEFAULTS = {"maxIter": 20, "maxDepth": 5, "stepSize": 0.1, "maxBins": 32, "minInstancesPerNode": 1,
                "subsamplingRate": 1.0, "l2": 1.0}

    def __init__(self, random_state: int = 42, /, **hyperparameters):
        super().__init__(random_state, **hyperparameters)
        # one row per node of every tree: see NODE_COLUMNS
        self.nodes: list[tuple] = []
        self.init_scores: list[float] = []
        self.step = 0.0
        self.forest: histogram.Forest | None = None       # as fitted, with gains; not saved

    def _p(self, name: str):
        return self.params.get(name, self.DEFAULTS[name])

    @property
    def max_bins(self) -> int:
        return int(self._p("maxBins"))

    def settings(self) -> histogram.Settings:
        return histogram.Settings(self.objective, int(self._p("maxIter")), int(self._p("maxDepth")),
                                  float(self._p("stepSize")), int(self._p("minInstancesPerNode")), float(self._p("l2")),
                                  float(self._p("subsamplingRate")), self.random_state)

    def _classes(self, train: DataFrame, label_col: str, n_classes: int | None) -> int:
        return n_classes or int(train.agg(F.max(label_col)).first()[0]) + 1

    def fit(self, train, label_col="label", features_col="features", validation=None, n_classes=None, thresholds=None,
            binned=None):
        """``thresholds`` (split candidates per feature) are found from ``train``
        when None.  ``binned``: the same rows as ``histogram.bin_once`` made them,
        for fits that share them."""
        self.features_col = features_col
        self.n_classes = self._classes(train, label_col, n_classes)
        settings = self.settings()
        self.forest = histogram.fit_forest(train, features_col, label_col, self.n_classes, settings,
                                           self.max_bins, validation=validation, thresholds=thresholds, binned=binned)
        self.init_scores = self.forest.init[0].tolist()
        self.nodes = histogram.node_rows(self.forest)
        self.step = settings.step
        self._curves = ([(i, side, self.metric, value) for i, side, value in self.forest.losses]
                        if validation is not None else None)
        self._fitted = True
        return self

    def fit_folds(self, rows: DataFrame, k: int, fold_col: str = "fold", label_col: str = "label",
                  features_col: str = "features", n_classes: int | None = None,
                  thresholds=None, binned=None) -> tuple[DataFrame, histogram.Forest]:
        """M8: the k models that each leave one fold out, trained in the same
        passes; returns the counts (fold, label, prediction, n) of every row
        judged by the model that has not seen it, and the forests.

        Split candidates come from all rows, as they use no label.  ``binned``:
        the same rows with their folds, for learners that share them.
        """
        settings, spark = self.settings(), rows.sparkSession
        classes = self._classes(rows, label_col, n_classes)

        def judge(table, binned, forest, done):
            pairs = histogram.left_out_predictions(table, binned.layout, forest, done, settings)
            counted = collect_bounded(pairs.groupBy("fold", "label", "prediction").agg(F.sum("n").alias("n")),
                                      what="pairs of classes")
            return spark.createDataFrame([tuple(r) for r in counted], "fold int, label int, prediction int, n long"), forest

        return histogram.fit_forest(rows, features_col, label_col, classes, settings, self.max_bins,
                                    fold_col, k, thresholds=thresholds, keep=judge, binned=binned)

    def _to_probability(self, scores: Column) -> Column:
        raise NotImplementedError

    def predict_proba(self, df, prob_col="probability"):
        self._require_fitted()
        score = forest_scorer(self.nodes, self.init_scores, self.step)
        return (df.withColumn("_s", score(vector_to_array(F.col(self.features_col))))
                .withColumn(prob_col, self._to_probability(F.col("_s"))).drop("_s"))

    def _meta(self) -> dict:
        meta = super()._meta()
        meta.update({"init_scores": self.init_scores, "step": self.step})
        return meta

    def save(self, path: str) -> None:
        self._require_fitted()
        current_session().createDataFrame(self.nodes, NODE_COLUMNS).coalesce(1) \
            .write.mode("overwrite").parquet(os.path.join(path, "nodes"))
        _write_meta(path, self._meta())

    @classmethod
    def load(cls, path: str) -> "HistogramBoost":
        meta = _read_meta(path)
        obj = cls(meta["random_state"], **meta["hyperparameters"])
        obj._restore(meta)
        obj.init_scores = meta["init_scores"]
        obj.step = meta["step"]
        nodes = current_session().read.parquet(os.path.join(path, "nodes")).collect()   # the model itself
        obj.nodes = sorted(tuple(r) for r in nodes)
        return obj


UNROLLED = 32       # classes written out one by one, as generated code; more are mapped


def _probabilities(scores: Column, classes: int, part) -> Column:
    """``part`` of every class score, divided by their sum."""
    if classes > UNROLLED:
        return _divided_by_sum(F.transform(scores, part))
    parts = [part(F.get(scores, F.lit(k))) for k in range(classes)]
    total = F.lit(0.0)
    for p in parts:
        total = total + p
    return F.array(*[F.when(total > 0, p / total).otherwise(F.lit(1.0) / F.lit(classes)) for p in parts])


def _divided_by_sum(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return F.transform(values, lambda v: F.when(total > 0, v / total).otherwise(F.lit(1.0) / F.size(values)))


class OneVsRestGBT(HistogramBoost):
    """Learner A: K logistic models, one against the rest."""

    model_type, objective, metric = "ovr_gbt", "logistic", "ovr_logloss"

    def _to_probability(self, scores):
        return _probabilities(scores, len(self.init_scores), lambda s: F.lit(1.0) / (F.lit(1.0) + F.exp(-s)))


class SoftmaxBoost(HistogramBoost):
    """Learner B: multinomial boosting."""

    model_type, objective, metric = "softmax_boost", "softmax", "mlogloss"

    def _to_probability(self, scores):
        return _probabilities(scores, len(self.init_scores), lambda s: F.exp(s - F.array_max(scores)))


NODE_COLUMNS = ("round int, class int, node int, feature int, threshold double, left int, right int, "
                "value double")


SMALL_TREE = 128    # nodes of a tree that is evaluated over whole columns


def forest_scorer(nodes: list[tuple], init_scores: list[float], step: float):
    """A vectorised function features ARRAY<DOUBLE> -> class scores, over all
    trees at once.  The node table is the closure: trees x 2^depth rows."""
    import numpy as np
    import pyarrow as pa
    from pyspark.sql.functions import arrow_udf

    table = np.array([n[:4] + (n[5], n[6]) for n in nodes], dtype=np.int64).reshape(-1, 6)
    threshold = np.array([n[4] for n in nodes], float)
    value = step * np.array([n[7] for n in nodes], float)
    roots = np.flatnonzero(table[:, 2] == 0)
    feature = table[:, 3]
    size = np.diff(np.append(roots, len(table)))
    base = np.repeat(roots, size) if len(table) else roots
    left, right = table[:, 4] + base, table[:, 5] + base
    of_class = table[roots, 1]

    def run(features: pa.Array) -> pa.Array:
        if features.null_count:
            raise ValueError("a row to score has no features")
        n = len(features)
        x = features.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.zeros((0, 1))
        by_feature = np.ascontiguousarray(x.T)
        out = np.tile(np.array(init_scores, float), (n, 1))
        row = np.arange(n)

        def reached(node: int):
            if feature[node] < 0 or not n:
                return value[node]
            return np.where(by_feature[feature[node]] <= threshold[node], reached(left[node]), reached(right[node]))

        for root, nodes_here, k in zip(roots, size, of_class):
            if nodes_here <= SMALL_TREE:
                out[:, k] += reached(root)
                continue
            at = np.full(n, root)
            inner = feature[at] >= 0
            while inner.any():
                here = at[inner]
                small = x[row[inner], feature[here]] <= threshold[here]
                at[inner] = np.where(small, left[here], right[here])
                inner = feature[at] >= 0
            out[:, k] += value[at]
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * out.shape[1], pa.int32()), pa.array(out.ravel()))

    run.__annotations__ = {"features": pa.Array, "return": pa.Array}
    return arrow_udf(run, "array<double>")


# ---------------------------------------------------------------------------
MODEL_REGISTRY: dict[str, type[BoostingClassifier]] = {
    OneVsRestGBT.model_type: OneVsRestGBT,
    SoftmaxBoost.model_type: SoftmaxBoost,
}


def make_model(model_type: str, random_state: int = 42, /, **hyperparameters) -> BoostingClassifier:
    if model_type not in MODEL_REGISTRY:
        raise ValueError(f"unknown model type {model_type!r}; registered: {list(MODEL_REGISTRY)}")
    return MODEL_REGISTRY[model_type](random_state, **hyperparameters)


def load_model(path: str) -> BoostingClassifier:
    meta = _read_meta(path)
    return MODEL_REGISTRY[meta["model_type"]].load(path)


def _write_meta(path: str, meta: dict) -> None:
    spark = current_session()
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
        .write.mode("overwrite").text(os.path.join(path, "meta"))


def _read_meta(path: str) -> dict:
    spark = current_session()
    return json.loads(spark.read.text(os.path.join(path, "meta")).first()[0])
