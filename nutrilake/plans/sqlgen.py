"""DuckDB SQL text for the oracle side of the registered queries.

Column lists come from the schema; every number, band and vocabulary of the
rules is written out here once more, independent of the Spark side, so that a
wrong constant on either side shows as a difference.
"""
from __future__ import annotations

from nutrilake import schema as S
from nutrilake.plans.common import DIET_DD_CTES

# ---- fixed values, as the reference has them ----------------------------------
GENDERS = ["Male", "Female", "Other"]
ACTIVITY_LEVELS = ["Sedentary", "Lightly Active", "Moderately Active", "Very Active", "Athlete"]
DIET_TYPES = ["Balanced", "Keto", "Vegetarian", "Vegan", "High Protein", "Mediterranean"]
HEALTH_STATUSES = ["Underweight", "Healthy", "Overweight", "Obese"]
NA_STRINGS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
              "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
POSITIVE_FIELDS = ["height_cm", "weight_kg", "daily_calorie_requirement", "daily_calorie_consumed"]
NON_NEGATIVE_FIELDS = ["protein_intake_g", "carbohydrate_intake_g", "fat_intake_g", "water_intake_liters"]
# ---------------------------------------------------------------------------------

NUMERIC = S.RAW_NUMERIC_COLUMNS
STRINGS = [c for c in S.RAW_COLUMNS if c not in S.RAW_NUMERIC_COLUMNS]


def q(name: str) -> str:
    return '"' + name + '"'


def lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(float(v))


def age_group_sql(age: str = "Age") -> str:
    return (f"CASE WHEN {age} IS NULL THEN NULL WHEN {age} <= 17 THEN 'Child' WHEN {age} <= 29 THEN 'Young Adult' "
            f"WHEN {age} <= 59 THEN 'Adult' ELSE 'Senior' END")


def bmi_band_sql(bmi: str = "BMI") -> str:
    return (f"CASE WHEN {bmi} IS NULL THEN NULL WHEN {bmi} < 18.5 THEN 'Underweight' WHEN {bmi} < 25.0 THEN 'Healthy' "
            f"WHEN {bmi} < 30.0 THEN 'Overweight' ELSE 'Obese' END")


def _offset_sql(table: dict, other: float, gender: str = "Gender") -> str:
    parts = " ".join(f"WHEN {gender} = {lit(k)} THEN CAST({v!r} AS DOUBLE)" for k, v in table.items())
    return f"(CASE {parts} ELSE CAST({other!r} AS DOUBLE) END)"


def _ratio(num: str, den: str) -> str:
    return f"(CASE WHEN {den} = 0 THEN CAST(0 AS DOUBLE) ELSE CAST({num} AS DOUBLE) / {den} END)"


def engineered_sql() -> dict[str, str]:
    """The 14 engineered columns as SQL expressions over the raw names."""
    req = "CAST(Daily_Calorie_Requirement AS DOUBLE)"
    cons = "CAST(Daily_Calorie_Consumed AS DOUBLE)"
    p, c, f = "Protein_Intake_g", "Carbohydrate_Intake_g", "Fat_Intake_g"
    pk, ck, fk = f"({p} * 4.0)", f"({c} * 4.0)", f"({f} * 9.0)"
    total = f"({pk} + {ck} + {fk})"
    bmr = (f"(10 * Weight_kg + 6.25 * Height_cm - 5 * Age + "
           f"{_offset_sql({'Male': 5.0, 'Female': -161.0}, -78.0)})")
    ideal = f"({_offset_sql({'Male': 50.0, 'Female': 45.5}, 47.75)} + 2.3 * (Height_cm / 2.54 - 60))"
    bal = f"({cons} - {req})"
    return {
        "Age_Group": age_group_sql(),
        "Calorie_Balance": bal,
        "Calorie_Deviation_Pct": f"({_ratio(bal, req)} * 100.0)",
        "Total_Macros_g": f"({p} + {c} + {f})",
        "Protein_Ratio": _ratio(pk, total),
        "Carb_Ratio": _ratio(ck, total),
        "Fat_Ratio": _ratio(fk, total),
        "Adequate_Water_Intake": f"CAST(coalesce(Water_Intake_Liters >= 2.0, false) AS INTEGER)",
        "BMR": bmr,
        "Activity_Calorie_Multiplier": _ratio(req, bmr),
        "Protein_per_kg_Bodyweight": _ratio(p, "Weight_kg"),
        "Water_Intake_ml_per_kg": _ratio("Water_Intake_Liters * 1000.0", "Weight_kg"),
        "Ideal_Weight_kg": ideal,
        "Weight_Deviation_kg": f"(Weight_kg - {ideal})",
    }


# --------------------------------------------------------------------------
# split / folds
# --------------------------------------------------------------------------
def split_ctes(src: str = "dd", target: str = S.TARGET_COLUMN, key: str = S.ID_COLUMN,
               test_size: float = 0.2, seed: int = 42) -> str:
    """CTEs ``cnt, tot, al, need, quota, rk, sp`` (sp = src + rnk + split)."""
    return f"""
cnt AS (SELECT {target} AS cls, count(*) AS n_c FROM {src} GROUP BY {target}),
tot AS (SELECT sum(n_c) AS n, CAST(ceil(CAST({test_size!r} AS DOUBLE) * sum(n_c)) AS BIGINT) AS n_test FROM cnt),
al0 AS (SELECT cls, n_c, CAST(n_c AS DOUBLE) / (SELECT n FROM tot)
                            * ((SELECT n FROM tot) - (SELECT n_test FROM tot)) AS cont FROM cnt),
al AS (SELECT cls, n_c, floor(cont) AS fl, cont - floor(cont) AS rem FROM al0),
need AS (SELECT (SELECT n - n_test FROM tot) - sum(fl) AS k FROM al),
quota AS (SELECT cls, n_c - (fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, cls) <= (SELECT k FROM need)
                                  THEN 1 ELSE 0 END) AS test_q FROM al),
rk AS (SELECT s.*, row_number() OVER (PARTITION BY {target}
                                      ORDER BY md5('{seed}:' || CAST({key} AS VARCHAR)), {key}) AS rnk
       FROM {src} s),
sp AS (SELECT rk.*, CASE WHEN rnk <= quota.test_q THEN 'test' ELSE 'train' END AS split
       FROM rk JOIN quota ON rk.{target} = quota.cls)"""


# --------------------------------------------------------------------------
# cleaner
# --------------------------------------------------------------------------
def cleaner_state_ctes(src: str, factor: float = 3.0) -> str:
    """CTE ``cst``: (column, kind, num_value, str_value, lower, upper) fitted on ``src``."""
    parts = []
    for c in NUMERIC:
        parts.append(
            f"SELECT '{c}' AS col_name, 'numeric' AS kind, quantile_cont({c}, 0.5) AS num_value, "
            f"CAST(NULL AS VARCHAR) AS str_value, "
            f"quantile_cont({c}, 0.25) - {factor!r} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lower, "
            f"quantile_cont({c}, 0.75) + {factor!r} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS upper "
            f"FROM {src}")
    for c in STRINGS:
        parts.append(
            f"SELECT '{c}', 'string', CAST(NULL AS DOUBLE), "
            f"(SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1), "
            f"CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)")
    return "cst AS (\n" + "\nUNION ALL ".join(parts) + "\n)"


def cleaned_select(src: str, extra: list[str] | None = None) -> str:
    """SELECT list applying the fitted state ``cst`` to ``src`` rows."""
    cols = []
    for c in S.RAW_COLUMNS:
        if c in NUMERIC:
            v = f"(SELECT num_value FROM cst WHERE col_name = '{c}')"
            lo = f"(SELECT lower FROM cst WHERE col_name = '{c}')"
            hi = f"(SELECT upper FROM cst WHERE col_name = '{c}')"
            filled = f"coalesce(CAST({c} AS DOUBLE), {v})"
            cols.append(f"CASE WHEN {filled} IS NULL THEN NULL ELSE greatest({lo}, least({hi}, {filled})) END AS {c}")
        else:
            v = f"(SELECT str_value FROM cst WHERE col_name = '{c}')"
            cols.append(f"coalesce({c}, {v}) AS {c}")
    return "SELECT " + ", ".join((extra or []) + cols) + f" FROM {src}"


def prepared_ctes(test_size: float = 0.2, seed: int = 42) -> str:
    """dd -> split (sp) -> cleaner fit on train (cst) -> cleaned (cl) ->
    engineered (en)."""
    eng = engineered_sql()
    eng_cols = ", ".join(f"{e} AS {n}" for n, e in eng.items())
    return (DIET_DD_CTES + "," + split_ctes("dd", test_size=test_size, seed=seed) + ",\n"
            + "tr AS (SELECT * FROM sp WHERE split = 'train'),\n"
            + cleaner_state_ctes("tr") + ",\n"
            + "cl AS (" + cleaned_select("sp", ["split"]) + "),\n"
            + f"en AS (SELECT *, {eng_cols} FROM cl)")


def encoder_ctes() -> str:
    """``enc``: numeric means / population stds on train rows of ``en``."""
    parts = [f"SELECT '{c}' AS feature, avg({c}) AS mean, stddev_pop({c}) AS std FROM en WHERE split = 'train'"
             for c in S.NUMERIC_FEATURES]
    return "enc AS (\n" + "\nUNION ALL ".join(parts) + "\n)"


def scaled_expr(c: str) -> str:
    mean = f"(SELECT mean FROM enc WHERE feature = '{c}')"
    std = f"(SELECT CASE WHEN std = 0 OR std IS NULL THEN 1.0 ELSE std END FROM enc WHERE feature = '{c}')"
    return f"(CAST({c} AS DOUBLE) - {mean}) / {std}"


def quantile_sql(arr: str, p: float) -> str:
    """numpy-exact linear quantile of a sorted DuckDB list ``arr``."""
    pos = f"({p!r} * (len({arr}) - 1))"
    a = f"{arr}[CAST(floor({pos}) AS BIGINT) + 1]"
    b = f"{arr}[CAST(ceil({pos}) AS BIGINT) + 1]"
    t = f"({pos} - floor({pos}))"
    return f"(CASE WHEN {t} >= 0.5 THEN {b} - ({b} - {a}) * (1 - {t}) ELSE {a} + ({b} - {a}) * {t} END)"
