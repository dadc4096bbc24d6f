"""Job-level entry points with the same surface as the reference's facade
(SURVEY §2.14), for users who switch over: every method is a Spark job (or
a lazy DataFrame) built from the operators; nothing loads whole tables into
the driver.
"""
from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nutrilake import schema as S
from nutrilake.operators import drift, score, stats
from nutrilake.operators.clean import drop_duplicates_first
from nutrilake.plans import training
from nutrilake.plans.preprocess import Prepared, prepare
from nutrilake.sources import loader


@dataclass
class JobSettings:
    """Job arguments (replaces the YAML / env settings object)."""

    raw_data_path: str
    output_dir: str
    target_column: str = S.TARGET_COLUMN
    sample_size: int | None = None
    test_size: float = 0.2
    random_state: int = 42
    selection_metric: str = "mcc"
    hyperparameters: dict[str, dict] = field(default_factory=dict)

    @property
    def processed_dir(self) -> str:
        return os.path.join(self.output_dir, "processed")

    @property
    def models_dir(self) -> str:
        return os.path.join(self.output_dir, "models")


class DietJobs:
    """load_data, get_health_statistics, preprocess_data, train_model,
    cross_validate_model, compare_models, select_best_model,
    analyze_data_drift, predict_health_status, get_best_model_info,
    summary -- as Spark jobs."""

    def __init__(self, spark: SparkSession, settings: JobSettings):
        self.spark = spark
        self.settings = settings

    # S1-S4, S7
    def raw_data(self, keep_position: bool = False) -> DataFrame:
        """The table as read: numbers coerced, records not yet judged."""
        return loader.load_table(self.spark, self.settings.raw_data_path, self.settings.sample_size,
                                 self.settings.random_state, keep_position=keep_position)

    def load_data(self, strict: bool = True) -> DataFrame:
        """The raw columns of valid records.  An unknown activity level, diet
        or status fails the job; with ``strict=False`` such rows are left out."""
        raw = self.raw_data()
        return loader.validated(raw) if strict else raw.where(F.size(loader.record_errors()) == 0)

    # A1
    def get_health_statistics(self, df: DataFrame | None = None) -> DataFrame:
        df = df if df is not None else self.load_data()
        return stats.health_summary(df)

    # T7
    def preprocess_data(self, how: str = "checkpoint") -> Prepared:
        """Dedup keeps the first row per person in file order."""
        return prepare(self.raw_data(keep_position=True), target=self.settings.target_column,
                       test_size=self.settings.test_size, seed=self.settings.random_state,
                       order_by=[loader.SOURCE_POSITION],
                       out_dir=self.settings.processed_dir, how=how)

    # M7
    def train_model(self, model_type: str, prepared: Prepared,
                    hyperparameters: dict | None = None) -> training.TrainingResult:
        params = hyperparameters if hyperparameters is not None else \
            self.settings.hyperparameters.get(model_type, {})
        return training.train_model(model_type, prepared, self.settings.models_dir,
                                    self.settings.random_state, params)

    # M8
    def cross_validate_model(self, model_type: str, prepared: Prepared, n_splits: int = 5):
        return training.cross_validate(model_type, prepared, n_splits, self.settings.random_state,
                                       self.settings.hyperparameters.get(model_type, {}))

    # M9
    def compare_models(self, prepared: Prepared) -> dict[str, training.TrainingResult]:
        return training.compare_models(prepared, self.settings.models_dir, self.settings.random_state,
                                       self.settings.hyperparameters)

    # M10 + M11
    def select_best_model(self, comparison: dict, metric: str | None = None) -> str:
        return training.publish_best(comparison, self.settings.models_dir,
                                     metric or self.settings.selection_metric)

    # F
    def analyze_data_drift(self, prepared: Prepared, current: DataFrame | None = None,
                           **kw) -> drift.DriftResult:
        """Train vs test of the feature matrix, or train vs ``current``."""
        feats = prepared.feature_names
        ref = prepared.train().select(*feats)
        cur = prepared.test().select(*feats) if current is None else current
        return drift.analyze_drift(ref, cur, **kw)

    # R1-R4
    def predict_health_status(self, records: DataFrame, key: str | None = None) -> DataFrame:
        """Score raw records (the source's column names, as the reference's
        facade takes them) or scoring requests (request field names: they
        are validated first; invalid ones come back with their ``errors`` and
        without a prediction)."""
        art = score.ScoringArtifacts.load(self.spark, self.settings.processed_dir,
                                          os.path.join(self.settings.models_dir, "best"))
        keep = [key] if key else []
        none = F.lit(None).cast("array<string>").alias("errors")
        if "Age" in records.columns:
            return score.score(records, art, keep=keep).withColumn("errors", none)
        valid, rejected = score.validate_requests(records)
        scored = score.score(score.to_raw_records(valid, keep=keep), art, keep=keep).withColumn("errors", none)
        return scored.unionByName(rejected.select(*keep, "errors"), allowMissingColumns=True)

    # M12
    def get_best_model_info(self) -> dict:
        return training.best_model_info(self.spark, self.settings.models_dir)

    # S6
    def summary(self) -> DataFrame:
        return loader.dataset_overview(self.raw_data())

    # P1-P8 (``get_dataset_summary``): examples in order of appearance
    def dataset_summary(self, max_examples: int = 5, outlier_iqr_factor: float = 1.5) -> DataFrame:
        from nutrilake.operators.profile import dataset_profile
        return dataset_profile(self.raw_data(keep_position=True), max_examples, outlier_iqr_factor,
                               order_col=loader.SOURCE_POSITION)

    def deduplicated(self) -> DataFrame:
        """First row per person in file order."""
        raw = self.raw_data(keep_position=True)
        return drop_duplicates_first(raw, S.ID_COLUMN, [loader.SOURCE_POSITION]) \
            .drop(loader.SOURCE_POSITION)
