"""Scoring raw records.

Requests are validated as rows (an ``errors`` array per row, valid and
rejected outputs), mapped to the raw column names with BMI derived, then
run through the training-fitted cleaner, the engineered features, the
training-fitted encoder and the model -- all column expressions plus MLlib
``transform``, for a batch or a stream alike.
"""
from __future__ import annotations

import functools
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nutrilake import schema as S
from nutrilake.functions import rules
from nutrilake.operators.boost import BoostingClassifier, argmax, load_model
from nutrilake.operators.clean import CleanerModel, require_path
from nutrilake.operators.encode import EncoderModel, LabelCodes, assemble
from nutrilake.sources.versions import published_folder

# ---- fixed values: request field -> raw column, and request limits ----------
REQUEST_FIELDS = {
    "age": "Age", "gender": "Gender", "height_cm": "Height_cm", "weight_kg": "Weight_kg",
    "activity_level": "Activity_Level", "diet_type": "Diet_Type",
    "daily_calorie_requirement": "Daily_Calorie_Requirement",
    "daily_calorie_consumed": "Daily_Calorie_Consumed", "protein_intake_g": "Protein_Intake_g",
    "carbohydrate_intake_g": "Carbohydrate_Intake_g", "fat_intake_g": "Fat_Intake_g",
    "water_intake_liters": "Water_Intake_Liters",
}
AGE_MIN_EXCLUSIVE, AGE_MAX = 0, 120
POSITIVE_FIELDS = ["height_cm", "weight_kg", "daily_calorie_requirement", "daily_calorie_consumed"]
NON_NEGATIVE_FIELDS = ["protein_intake_g", "carbohydrate_intake_g", "fat_intake_g",
                       "water_intake_liters"]
# ------------------------------------------------------------------------------


def _checks(df: DataFrame) -> list[tuple[F.Column, str]]:
    """(violated, message) of every rule."""
    age = F.col("age")
    checks = [
        (age.isNull() | (age <= AGE_MIN_EXCLUSIVE) | (age > AGE_MAX) | (age != F.floor(age)),
         "age must be an integer in 1..120"),
        (F.col("gender").isNull() | ~F.col("gender").isin(*S.GENDERS), "gender must be one of Male, Female, Other"),
        (F.col("activity_level").isNull() | ~F.col("activity_level").isin(*S.ACTIVITY_LEVELS),
         "activity_level is not a known level"),
        (F.col("diet_type").isNull() | ~F.col("diet_type").isin(*S.DIET_TYPES), "diet_type is not a known diet"),
    ]
    checks += [(F.col(c).isNull() | (F.col(c) <= 0), f"{c} must be > 0") for c in POSITIVE_FIELDS]
    checks += [(F.col(c).isNull() | (F.col(c) < 0), f"{c} must be >= 0") for c in NON_NEGATIVE_FIELDS]
    missing = [f for f in REQUEST_FIELDS if f not in df.columns]
    if missing:
        raise ValueError(f"request fields missing: {missing}")
    return checks


def request_errors(df: DataFrame) -> F.Column:
    """ARRAY<STRING> of violated rules (empty = valid)."""
    return F.filter(F.array(*[F.when(c, F.lit(msg)) for c, msg in _checks(df)]), lambda e: e.isNotNull())


def is_valid(df: DataFrame) -> F.Column:
    """No rule is violated; one condition, without the messages."""
    return ~functools.reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c, _ in _checks(df)])


def validate_requests(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); rejected rows carry ``errors``."""
    return (df.where(is_valid(df)).drop("errors"),
            df.withColumn("errors", request_errors(df)).where(F.size("errors") > 0))


def to_raw_records(requests: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """R2: request fields -> raw column names, BMI derived (2 decimals)."""
    keep = [c for c in (keep or []) if c in requests.columns]
    cols = [F.col(f).alias(raw) for f, raw in REQUEST_FIELDS.items()]
    out = requests.select(*keep, *cols)
    out = out.withColumn("Age", F.col("Age").cast("int"))
    for c in S.RAW_NUMERIC_COLUMNS:
        if c not in ("Age", "BMI"):
            out = out.withColumn(c, F.col(c).cast("double"))
    return out.withColumn("BMI", rules.bmi_from_measurements("Weight_kg", "Height_cm"))


@dataclass
class ScoringArtifacts:
    cleaner: CleanerModel
    encoder: EncoderModel
    model: BoostingClassifier
    labels: LabelCodes

    @classmethod
    def load(cls, spark: SparkSession, processed_dir: str, model_dir: str) -> "ScoringArtifacts":
        """Every artifact checked before any job runs; of a versioned model
        folder, the newest version."""
        model_dir = published_folder(spark, model_dir)
        require_path(os.path.join(model_dir, "meta"),
                     "no published model; compare models and publish the best first")
        require_path(os.path.join(processed_dir, "encoder_state"),
                     "no encoder state; run the preparation job first")
        require_path(os.path.join(processed_dir, "cleaner_state"),
                     "no cleaner state; run the preparation job first")
        return cls(CleanerModel.load(spark, os.path.join(processed_dir, "cleaner_state")),
                   EncoderModel.load(spark, os.path.join(processed_dir, "encoder_state")),
                   load_model(model_dir),
                   LabelCodes.load(spark, os.path.join(model_dir, "label_codes")))


def score(raw: DataFrame, art: ScoringArtifacts, keep: list[str] | None = None) -> DataFrame:
    """Training-fit clean -> engineer -> training-fit encode -> model.

    Adds ``predicted_health_status`` and ``probabilities`` (MAP class ->
    probability); id/target columns are not needed.  A model that was fitted
    on other features, or on the same in another order, is refused.
    """
    names = art.encoder.feature_names()
    if art.model.feature_names is not None and art.model.feature_names != names:
        raise ValueError(f"the model was fitted on {art.model.feature_names}, the encoder gives {names}")
    keep = [c for c in (keep or []) if c in raw.columns]
    cleaned = art.cleaner.transform(raw)
    engineered = rules.engineer_features(cleaned)
    feats = art.encoder.transform(engineered, keep=keep)
    vec = assemble(feats, names)
    proba = art.model.predict_proba(vec.select(*keep, "features"), "_proba")
    classes = art.labels.classes
    return proba.select(
        *keep,
        art.labels.decode(argmax(F.col("_proba"))).alias("predicted_health_status"),
        F.map_from_arrays(F.array(*[F.lit(c) for c in classes]), F.col("_proba")).alias("probabilities"))


# ---- R6: what-if scenarios ---------------------------------------------------
# fixed scenario set: name, weight factor, calorie surplus (kcal)
SCENARIOS = [("baseline", 1.0, 0.0), ("weight_minus_10pct", 0.9, 0.0),
             ("weight_plus_10pct", 1.1, 0.0), ("calorie_surplus_500", 1.0, 500.0)]


def expand_scenarios(raw: DataFrame, scenarios=SCENARIOS) -> DataFrame:
    """Each record once per scenario (a generator over a literal array of
    scenario structs -- no join): weight scaled (BMI re-derived) and/or
    calorie surplus added to consumption."""
    arr = F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(w).alias("wf"), F.lit(s).alias("surplus"))
                    for n, w, s in scenarios])
    x = raw.withColumn("_sc", F.explode(arr))
    return (x.withColumn("scenario", F.col("_sc.scenario"))
            .withColumn("Weight_kg", F.col("Weight_kg") * F.col("_sc.wf"))
            .withColumn("BMI", rules.bmi_from_measurements("Weight_kg", "Height_cm"))
            .withColumn("Daily_Calorie_Consumed", F.col("Daily_Calorie_Consumed") + F.col("_sc.surplus"))
            .drop("_sc"))


def sensitivity(raw: DataFrame, art: "ScoringArtifacts", scenarios=SCENARIOS) -> DataFrame:
    """Per scenario, records whose predicted status differs from the
    record's own baseline prediction.

    Each row is scored once as is, carries that prediction through the
    scenario expansion and is compared with itself -- no join back on a key
    (a duplicated key would otherwise pair every copy with every copy).
    The final group-by has one group per scenario and is combined map-side.
    """
    cols = raw.columns
    base = score(raw, art, keep=cols).withColumnRenamed("predicted_health_status", "_base") \
        .drop("probabilities")
    what_if = score(expand_scenarios(base, scenarios), art, keep=["scenario", "_base"])
    return (what_if.groupBy("scenario")
            .agg(F.count(F.lit(1)).alias("records"),
                 F.count_if(F.col("predicted_health_status") != F.col("_base")).alias("changed")))
