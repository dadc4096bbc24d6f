"""Training jobs (M7-M12, A4): train one, cross-validate, compare, pick and
publish the best, read its metadata; leakage ablation."""
from __future__ import annotations

import json
import os
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nutrilake import schema as S
from nutrilake.operators.boost import MODEL_REGISTRY, BoostingClassifier, make_model, run_parallel
from nutrilake.operators.clean import require_path
from nutrilake.operators.encode import LabelCodes, assemble
from nutrilake.operators.evaluate import classification_metrics, metrics_from_pairs, pair_counts
from nutrilake.operators.histogram import Binned, bin_once, fit_thresholds
from nutrilake.operators.split import stratified_folds
from nutrilake.plans.preprocess import Prepared, in_scratch, materialize
from nutrilake.session import remove_scratch
from nutrilake.sources.versions import VersionedStore, published_folder


@dataclass
class TrainingResult:
    model_type: str
    model: BoostingClassifier
    metrics: DataFrame          # one row: accuracy ... mcc, confusion_matrix, class_labels
    evals: DataFrame            # (iteration, split, metric, value)
    model_path: str | None
    labels_path: str | None


def model_frame(prepared: Prepared, feature_names: list[str] | None = None) -> DataFrame:
    """key, split, label code, features vector (label codes from train)."""
    feats = feature_names or prepared.feature_names
    df = prepared.frame.withColumn("label", prepared.labels.encode(prepared.target))
    return assemble(df, feats).select(prepared.key, "split", prepared.target, "label", "features")


def only_features(frame: DataFrame, places: list[int]) -> DataFrame:
    """``frame`` with the vector of some of its features, in the given order."""
    x = vector_to_array("features")
    return frame.withColumn("features", array_to_vector(F.array(*[F.get(x, F.lit(i)) for i in places])))


def shared_bins(train: DataFrame, test: DataFrame | None, params: dict[str, dict], random_state: int = 42,
                fold: str | None = None) -> dict[str, Binned]:
    """The rows as bins for every model type of ``params``: types of one bin
    count share their split candidates and one table.  ``remove_bins`` after the last fit."""
    counts = {t: make_model(t, random_state, **p).max_bins for t, p in params.items()}
    binned = {n: bin_once(train, "features", "label", fit_thresholds(train, "features", n), fold, test)
              for n in sorted(set(counts.values()))}
    return {t: binned[n] for t, n in counts.items()}


def remove_bins(binned: dict[str, Binned]) -> None:
    for b in {b.folder: b for b in binned.values()}.values():
        b.remove()


def sides(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    return frame.where(F.col("split") == "train"), frame.where(F.col("split") == "test")


def _metrics(pred: DataFrame, labels: LabelCodes) -> DataFrame:
    named = pred.select(labels.decode("label").alias("y"), labels.decode("prediction").alias("yhat"))
    return classification_metrics(named, "y", "yhat", labels.classes)


def train_model(model_type: str, prepared: Prepared, out_dir: str | None = None,
                random_state: int = 42, hyperparameters: dict | None = None,
                frame: DataFrame | None = None, feature_names: list[str] | None = None,
                binned: Binned | None = None) -> TrainingResult:
    """M7: fit on train with test as validation set, score test, metrics,
    curves, persist model + label codes under ``<out>/<type>/``.
    ``binned``: the rows as bins, when several fits share them."""
    frame = frame if frame is not None else materialize(model_frame(prepared), "cache")
    train, test = sides(frame)
    model = make_model(model_type, random_state, **(hyperparameters or {}))
    model.feature_names = list(feature_names or prepared.feature_names)
    model.fit(train, "label", "features", validation=test, n_classes=len(prepared.labels.classes),
              binned=binned)
    pred = model.predict(test)
    metrics = materialize(_metrics(pred, prepared.labels), "cache")      # a row, from one scoring of the test side
    model_path = labels_path = None
    if out_dir:
        model_path = os.path.join(out_dir, model_type)
        labels_path = os.path.join(model_path, "label_codes")
        model.save(model_path)
        prepared.labels.save(frame.sparkSession, labels_path)
    return TrainingResult(model_type, model, metrics, model.get_evals_result(), model_path, labels_path)


def folded_rows(prepared: Prepared, k: int = 5, random_state: int = 42) -> tuple[DataFrame, str]:
    """The rows of ``model_frame`` with their ``fold``, in a scratch folder, and
    the folder."""
    return in_scratch(stratified_folds(model_frame(prepared), k, prepared.target, random_state, prepared.key))


def cross_validate(model_type: str, prepared: Prepared, k: int = 5, random_state: int = 42,
                   hyperparameters: dict | None = None, binned: Binned | None = None) -> tuple[DataFrame, DataFrame]:
    """M8: stratified k-fold over train+test recombined; a fresh model per
    fold, all trained in the same passes (``fit_folds``); returns (fold metrics
    (fold, metric, value), summary (metric, mean, std) with the population
    std).  Nothing is persisted.  ``binned``: the rows of ``folded_rows`` (of
    the same k and seed) as bins, when several learners share them."""
    model = make_model(model_type, random_state, **(hyperparameters or {}))
    folded, folder = (prepared.frame, None) if binned is not None else folded_rows(prepared, k, random_state)
    pairs, _ = model.fit_folds(folded, k, n_classes=len(prepared.labels.classes), binned=binned)
    if folder:
        remove_scratch(folded.sparkSession, folder)
    named = pairs.select("fold", prepared.labels.decode("label").alias("t"),
                         prepared.labels.decode("prediction").alias("p"), "n")
    m = metrics_from_pairs(named, ["fold"])
    per_fold = materialize(m.unpivot(["fold"], S.METRIC_KEYS, "metric", "value"), "cache")
    return per_fold, cv_summary(per_fold)


def cv_summary(per_fold: DataFrame) -> DataFrame:
    """mean and population std per metric."""
    return per_fold.groupBy("metric").agg(F.avg("value").alias("mean"),
                                          F.stddev_pop("value").alias("std"))


def compare_models(prepared: Prepared, out_dir: str | None = None, random_state: int = 42,
                   hyperparameters_by_model: dict | None = None,
                   parallelism: int = 1) -> dict[str, TrainingResult]:
    """M9: every registered type on the same split, each with its own params."""
    frame = materialize(model_frame(prepared))
    types = list(MODEL_REGISTRY)
    params = {t: (hyperparameters_by_model or {}).get(t, {}) for t in types}
    binned = shared_bins(*sides(frame), params, random_state)
    # the learners are independent: they may be trained as concurrent jobs
    results = run_parallel([lambda t=t: train_model(t, prepared, out_dir, random_state, params[t], frame,
                                                    binned=binned[t]) for t in types], parallelism)
    remove_bins(binned)
    return dict(zip(types, results))


def metrics_table(results: dict[str, TrainingResult]) -> DataFrame:
    """(model_type, metric, value, registry_position) from a comparison."""
    parts = []
    for pos, (t, res) in enumerate(results.items()):
        m = res.metrics.select(*S.METRIC_KEYS)
        parts.append(m.unpivot([], S.METRIC_KEYS, "metric", "value")
                     .select(F.lit(t).alias("model_type"), "metric", "value",
                             F.lit(pos).alias("registry_position")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def best_model(metrics: DataFrame, metric: str = "mcc") -> DataFrame:
    """One row (model_type, metric, value): highest value, the first
    registered type wins ties."""
    return (metrics.where(F.col("metric") == metric)
            .agg(F.max_by(F.struct("model_type", "value"),
                          F.struct("value", (-F.col("registry_position")).alias("p"))).alias("b"))
            .select(F.col("b.model_type").alias("model_type"), F.lit(metric).alias("metric"),
                    F.col("b.value").alias("value")))


def publish_best(results: dict[str, TrainingResult], out_dir: str, metric: str = "mcc") -> str:
    """Save the winner with metadata as the newest version of ``<out>/best/``."""
    winner = best_model(metrics_table(results), metric).first()
    res = results[winner["model_type"]]
    spark = res.metrics.sparkSession
    meta = {"model_type": winner["model_type"], "selection_metric": metric,
            "selection_metric_value": float(winner["value"])}

    def write(folder: str) -> None:
        res.model.save(folder)
        LabelCodes(list(res.metrics.first()["class_labels"])).save(spark, os.path.join(folder, "label_codes"))
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1) \
            .write.mode("overwrite").text(os.path.join(folder, "metadata"))

    VersionedStore(spark, os.path.join(out_dir, "best")).publish(write, winner["model_type"])
    return winner["model_type"]


def best_model_info(spark: SparkSession, out_dir: str) -> dict:
    """Metadata of the published winner; clear error when absent."""
    path = os.path.join(published_folder(spark, os.path.join(out_dir, "best")), "metadata")
    require_path(path, "no published model; compare models and publish the best first")
    return json.loads(spark.read.text(path).first()[0])


def subset_features(subsets: dict[str, list[str]]) -> list[str]:
    """The features of all subsets, each once."""
    return list(dict.fromkeys(f for feats in subsets.values() for f in feats))


def leakage_ablation(prepared: Prepared, model_type: str = "ovr_gbt", random_state: int = 42,
                     hyperparameters: dict | None = None,
                     subsets: dict[str, list[str]] | None = None,
                     whole: DataFrame | None = None, binned: Binned | None = None) -> DataFrame:
    """A4: test metrics per feature subset (e.g. all features vs without
    the BMI-derived ones).  ``whole`` (``model_frame`` of ``subset_features``, written
    once) and ``binned`` are the rows, when several learners share them."""
    subsets = subsets or {"model_features": prepared.feature_names}
    # Split candidates of a feature do not depend on the others: all subsets share one table of bins.
    names, spark, folder, own = subset_features(subsets), prepared.frame.sparkSession, None, {}
    if whole is None:
        whole, folder = in_scratch(model_frame(prepared, names))
    if binned is None:
        own = shared_bins(*sides(whole), {model_type: hyperparameters or {}}, random_state)
        binned = own[model_type]
    rows = []
    for name, feats in subsets.items():
        places = [names.index(f) for f in feats]
        res = train_model(model_type, prepared, None, random_state, hyperparameters, only_features(whole, places), feats,
                          binned.only(places))
        m = res.metrics.first()
        res.metrics.unpersist()
        rows += [(name, key, float(m[key])) for key in S.METRIC_KEYS]
    remove_bins(own)
    if folder:
        remove_scratch(spark, folder)
    return spark.createDataFrame(rows, "subset string, metric string, value double")
