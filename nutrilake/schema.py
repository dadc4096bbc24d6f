"""Column names, closed vocabularies and feature sets of the person-level
diet table.  Every operator is generic in its column names; these constants
are the default configuration."""
from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values (must equal the source data model) -----------------------
ID_COLUMN = "Person_ID"
TARGET_COLUMN = "Health_Status"

RAW_COLUMNS = [
    "Person_ID", "Age", "Gender", "Height_cm", "Weight_kg", "BMI",
    "Activity_Level", "Daily_Calorie_Requirement", "Daily_Calorie_Consumed",
    "Protein_Intake_g", "Carbohydrate_Intake_g", "Fat_Intake_g",
    "Water_Intake_Liters", "Diet_Type", "Health_Status",
]
RAW_NUMERIC_COLUMNS = [
    "Age", "Height_cm", "Weight_kg", "BMI", "Daily_Calorie_Requirement",
    "Daily_Calorie_Consumed", "Protein_Intake_g", "Carbohydrate_Intake_g",
    "Fat_Intake_g", "Water_Intake_Liters",
]
RAW_CATEGORICAL_COLUMNS = ["Gender", "Activity_Level", "Diet_Type"]
ENGINEERED_NUMERIC_COLUMNS = [
    "Calorie_Balance", "Calorie_Deviation_Pct", "Total_Macros_g",
    "Protein_Ratio", "Carb_Ratio", "Fat_Ratio", "Adequate_Water_Intake", "BMR",
    "Activity_Calorie_Multiplier", "Protein_per_kg_Bodyweight",
    "Water_Intake_ml_per_kg", "Ideal_Weight_kg", "Weight_Deviation_kg",
]
ENGINEERED_CATEGORICAL_COLUMNS = ["Age_Group"]
# Columns that reconstruct BMI (and so the label) and are kept out of the model.
LEAKING_NUMERIC_COLUMNS = [
    "Height_cm", "Weight_kg", "BMI", "BMR", "Activity_Calorie_Multiplier",
    "Protein_per_kg_Bodyweight", "Water_Intake_ml_per_kg", "Ideal_Weight_kg",
    "Weight_Deviation_kg",
]

HEALTH_STATUSES = ["Underweight", "Healthy", "Overweight", "Obese"]
DIET_TYPES = ["Balanced", "Keto", "Vegetarian", "Vegan", "High Protein", "Mediterranean"]
ACTIVITY_LEVELS = ["Sedentary", "Lightly Active", "Moderately Active", "Very Active", "Athlete"]
GENDERS = ["Male", "Female", "Other"]
INTERVENTION_STATUSES = ["Obese", "Overweight"]
# WHO BMI bands (upper bounds, exclusive) -> status
BMI_BANDS = [(18.5, "Underweight"), (25.0, "Healthy"), (30.0, "Overweight")]
BMI_TOP_BAND = "Obese"
# Age groups, right-closed upper bounds
AGE_GROUPS = [(17, "Child"), (29, "Young Adult"), (59, "Adult")]
AGE_TOP_GROUP = "Senior"
# --------------------------------------------------------------------------

NUMERIC_FEATURES = [c for c in RAW_NUMERIC_COLUMNS + ENGINEERED_NUMERIC_COLUMNS
                    if c not in LEAKING_NUMERIC_COLUMNS]
CATEGORICAL_FEATURES = RAW_CATEGORICAL_COLUMNS + ENGINEERED_CATEGORICAL_COLUMNS

METRIC_KEYS = ["accuracy", "precision_macro", "recall_macro", "f1_macro", "mcc"]


def raw_schema() -> T.StructType:
    """Typed schema of the raw table after coercion."""
    fields = []
    for name in RAW_COLUMNS:
        if name == "Age":
            dtype = T.IntegerType()
        elif name in RAW_NUMERIC_COLUMNS:
            dtype = T.DoubleType()
        else:
            dtype = T.StringType()
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)
