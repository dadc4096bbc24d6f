"""nutrilake: person-level diet and health analytics on Apache Spark.

Public entry points (all DataFrame -> DataFrame or fit -> small state):

* sources:   ``load_table``, ``sample_n``, ``dataset_overview``, ``typed_records``
* rules:     ``engineer_features`` and the per-rule Column functions
* operators: ``dataset_profile``, ``Cleaner``, ``stratified_split``,
  ``stratified_folds``, ``Encoder``, ``LabelCodes``, ``health_summary``,
  ``drift_report``, ``classification_metrics``, ``make_model``, ``score``
* jobs:      ``prepare`` (the preparation job) and ``DietJobs``
"""
from nutrilake.functions.rules import engineer_features
from nutrilake.operators.clean import Cleaner, CleanerModel, drop_duplicates_first
from nutrilake.operators.drift import analyze_drift, drift_report, drift_summary
from nutrilake.operators.encode import Encoder, EncoderModel, LabelCodes
from nutrilake.operators.evaluate import classification_metrics
from nutrilake.operators.profile import dataset_profile
from nutrilake.operators.split import stratified_folds, stratified_split
from nutrilake.operators.stats import health_summary, label_determinism
from nutrilake.sources.loader import dataset_overview, load_table, sample_n, typed_records

__version__ = "0.1.0"

__all__ = [
    "Cleaner", "CleanerModel", "Encoder", "EncoderModel", "LabelCodes", "analyze_drift",
    "classification_metrics", "dataset_overview", "dataset_profile", "drift_report",
    "drift_summary", "drop_duplicates_first", "engineer_features", "health_summary",
    "label_determinism", "load_table", "sample_n", "stratified_folds", "stratified_split",
    "typed_records",
]
