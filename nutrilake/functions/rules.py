"""Row rules as Spark Column expressions (domain rules D1-D4, engineered
features E1-E14).

Everything here is a pure ``Column -> Column`` function, so it stays inside
whole-stage codegen and runs wherever the caller's plan runs.  NULL
semantics follow the vectorised (batch) form of each rule: a missing input
gives a missing output, except where noted (water adequacy -> 0, unknown
gender -> the "other" branch).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nutrilake import schema as S

# ---- fixed values: energy per gram (Atwater) and formula constants ----------
KCAL_PER_G_PROTEIN = 4.0
KCAL_PER_G_CARB = 4.0
KCAL_PER_G_FAT = 9.0
WATER_ADEQUATE_LITRES = 2.0
BMR_OFFSET = {"Male": 5.0, "Female": -161.0}          # Mifflin-St Jeor
BMR_OFFSET_OTHER = -78.0                               # mean of the two
IDEAL_BASE = {"Male": 50.0, "Female": 45.5}            # Devine
IDEAL_BASE_OTHER = 47.75                               # mean of the two
HEALTHY_BMI_LOW, HEALTHY_BMI_HIGH = 18.5, 25.0
# ------------------------------------------------------------------------------


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ratio_or_zero(num: Column, den: Column) -> Column:
    """``num/den``, 0.0 when ``den == 0``, NULL when either side is NULL.

    Written as ``den == 0 -> 0`` (not ``den != 0 -> num/den``) so a NULL
    denominator propagates instead of silently becoming 0.
    """
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den)


# ---- domain rules (D) ---------------------------------------------------------
def is_healthy(bmi: str | Column = "BMI") -> Column:
    b = _c(bmi)
    return (b >= HEALTHY_BMI_LOW) & (b < HEALTHY_BMI_HIGH)


def needs_intervention(status: str | Column = S.TARGET_COLUMN) -> Column:
    return _c(status).isin(*S.INTERVENTION_STATUSES)


def macros_calories(protein="Protein_Intake_g", carb="Carbohydrate_Intake_g",
                    fat="Fat_Intake_g") -> Column:
    return F.struct(
        (_c(protein) * KCAL_PER_G_PROTEIN).alias("protein_kcal"),
        (_c(carb) * KCAL_PER_G_CARB).alias("carb_kcal"),
        (_c(fat) * KCAL_PER_G_FAT).alias("fat_kcal"),
    )


def bmi_from_measurements(weight="Weight_kg", height="Height_cm") -> Column:
    h = _c(height) / 100.0
    return F.round(_c(weight) / (h * h), 2)


def bmi_band(bmi: str | Column = "BMI") -> Column:
    """WHO banding of BMI into the four health statuses."""
    b = _c(bmi)
    expr = None
    for upper, label in S.BMI_BANDS:
        expr = F.when(b < upper, label) if expr is None else expr.when(b < upper, label)
    return F.when(b.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(S.BMI_TOP_BAND))


# ---- engineered features (E) ----------------------------------------------------
def age_group(age: str | Column = "Age") -> Column:
    """Right-closed bins (-inf,17] (17,29] (29,59] (59,inf); NULL age -> NULL."""
    a = _c(age)
    expr = None
    for upper, label in S.AGE_GROUPS:
        expr = F.when(a <= upper, label) if expr is None else expr.when(a <= upper, label)
    return F.when(a.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(S.AGE_TOP_GROUP))


def _gender_offset(gender: Column, table: dict, other: float) -> Column:
    expr = None
    for value, offset in table.items():
        expr = F.when(gender == value, F.lit(offset)) if expr is None \
            else expr.when(gender == value, F.lit(offset))
    return expr.otherwise(F.lit(other))


def bmr(weight="Weight_kg", height="Height_cm", age="Age", gender="Gender") -> Column:
    base = 10 * _c(weight) + 6.25 * _c(height) - 5 * _c(age)
    return base + _gender_offset(_c(gender), BMR_OFFSET, BMR_OFFSET_OTHER)


def ideal_weight_kg(height="Height_cm", gender="Gender") -> Column:
    inches_over_5ft = _c(height) / 2.54 - 60
    return _gender_offset(_c(gender), IDEAL_BASE, IDEAL_BASE_OTHER) + 2.3 * inches_over_5ft


def engineered_columns(age="Age", gender="Gender", height="Height_cm", weight="Weight_kg",
                       requirement="Daily_Calorie_Requirement",
                       consumed="Daily_Calorie_Consumed", protein="Protein_Intake_g",
                       carb="Carbohydrate_Intake_g", fat="Fat_Intake_g",
                       water="Water_Intake_Liters") -> dict[str, Column]:
    """The 14 engineered columns, in output order, as expressions."""
    req, cons = _c(requirement).cast("double"), _c(consumed).cast("double")
    p, cb, ft = _c(protein), _c(carb), _c(fat)
    w = _c(weight)
    balance = cons - req
    p_kcal, c_kcal, f_kcal = p * KCAL_PER_G_PROTEIN, cb * KCAL_PER_G_CARB, ft * KCAL_PER_G_FAT
    total_kcal = p_kcal + c_kcal + f_kcal
    the_bmr = bmr(weight, height, age, gender)
    ideal = ideal_weight_kg(height, gender)
    return {
        "Age_Group": age_group(age),
        "Calorie_Balance": balance,
        "Calorie_Deviation_Pct": ratio_or_zero(balance, req) * 100.0,
        "Total_Macros_g": p + cb + ft,
        "Protein_Ratio": ratio_or_zero(p_kcal, total_kcal),
        "Carb_Ratio": ratio_or_zero(c_kcal, total_kcal),
        "Fat_Ratio": ratio_or_zero(f_kcal, total_kcal),
        "Adequate_Water_Intake": F.coalesce(_c(water) >= WATER_ADEQUATE_LITRES,
                                            F.lit(False)).cast("int"),
        "BMR": the_bmr,
        "Activity_Calorie_Multiplier": ratio_or_zero(req, the_bmr),
        "Protein_per_kg_Bodyweight": ratio_or_zero(p, w),
        "Water_Intake_ml_per_kg": ratio_or_zero(_c(water) * 1000.0, w),
        "Ideal_Weight_kg": ideal,
        "Weight_Deviation_kg": w - ideal,
    }


def engineer_features(df: DataFrame, **column_names) -> DataFrame:
    """Append the 14 engineered columns; input columns are kept unchanged."""
    return df.withColumns(engineered_columns(**column_names))


def domain_flags(df: DataFrame, bmi="BMI", status=S.TARGET_COLUMN) -> DataFrame:
    """Append the per-record domain rules (D1-D3) as columns."""
    return df.withColumns({
        "is_healthy": is_healthy(bmi),
        "needs_intervention": needs_intervention(status),
        "macro_kcal": macros_calories(),
    })
