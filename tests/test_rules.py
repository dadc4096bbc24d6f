import math

from pyspark.sql import Row
from pyspark.sql import functions as F

from nutrilake import schema as S
from nutrilake.functions import rules


def _one(spark, **kw):
    base = dict(Age=30, Gender="Male", Height_cm=180.0, Weight_kg=80.0,
                Daily_Calorie_Requirement=2500.0, Daily_Calorie_Consumed=2300.0,
                Protein_Intake_g=150.0, Carbohydrate_Intake_g=250.0, Fat_Intake_g=70.0,
                Water_Intake_Liters=2.5)
    base.update(kw)
    schema = ("Age int, Gender string, Height_cm double, Weight_kg double, "
              "Daily_Calorie_Requirement double, Daily_Calorie_Consumed double, "
              "Protein_Intake_g double, Carbohydrate_Intake_g double, Fat_Intake_g double, "
              "Water_Intake_Liters double")
    return spark.createDataFrame([tuple(base[c.split()[0]] for c in schema.split(", "))], schema)


def test_engineered_names_and_inputs_kept(spark):
    df = _one(spark)
    out = rules.engineer_features(df)
    assert out.columns[:len(df.columns)] == df.columns
    assert out.columns[len(df.columns):] == S.ENGINEERED_CATEGORICAL_COLUMNS + S.ENGINEERED_NUMERIC_COLUMNS


def test_anchor_values(spark):
    r = rules.engineer_features(_one(spark)).first()
    assert r["BMR"] == 10 * 80 + 6.25 * 180 - 5 * 30 + 5 == 1780
    assert r["Calorie_Balance"] == -200
    assert math.isclose(r["Calorie_Deviation_Pct"], -8.0)
    assert math.isclose(r["Protein_Ratio"] + r["Carb_Ratio"] + r["Fat_Ratio"], 1.0)
    assert r["Total_Macros_g"] == 470
    assert r["Adequate_Water_Intake"] == 1
    assert math.isclose(r["Ideal_Weight_kg"], 50 + 2.3 * (180 / 2.54 - 60))
    assert math.isclose(r["Weight_Deviation_kg"], 80 - r["Ideal_Weight_kg"])
    assert math.isclose(r["Protein_per_kg_Bodyweight"], 150 / 80)
    assert math.isclose(r["Water_Intake_ml_per_kg"], 2500 / 80)
    assert math.isclose(r["Activity_Calorie_Multiplier"], 2500 / 1780)


def test_gender_offsets(spark):
    female = rules.engineer_features(_one(spark, Gender="Female")).first()
    other = rules.engineer_features(_one(spark, Gender="Other")).first()
    assert female["BMR"] == 1780 - 5 - 161
    assert other["BMR"] == 1780 - 5 - 78
    assert math.isclose(other["Ideal_Weight_kg"] - female["Ideal_Weight_kg"], 47.75 - 45.5)


def test_age_group_edges(spark):
    df = spark.createDataFrame([(a,) for a in [17, 18, 29, 30, 59, 60, None]], "Age int") \
        .withColumn("Age", F.col("Age").cast("double"))
    got = [r[0] for r in df.select(rules.age_group("Age")).collect()]
    assert got == ["Child", "Young Adult", "Young Adult", "Adult", "Adult", "Senior", None]
    # right-closed bins: 17.5 is a young adult
    assert spark.range(1).select(rules.age_group(F.lit(17.5))).first()[0] == "Young Adult"


def test_null_and_zero_division(spark):
    r = rules.engineer_features(_one(spark, Weight_kg=None, Daily_Calorie_Requirement=0.0,
                                     Water_Intake_Liters=None)).first()
    assert r["Calorie_Deviation_Pct"] == 0.0          # requirement 0 -> 0
    assert r["Protein_per_kg_Bodyweight"] is None      # missing weight -> missing, not 0
    assert r["BMR"] is None
    assert r["Adequate_Water_Intake"] == 0             # missing water -> 0
    z = rules.engineer_features(_one(spark, Weight_kg=0.0)).first()
    assert z["Protein_per_kg_Bodyweight"] == 0.0


def test_water_edge(spark):
    assert rules.engineer_features(_one(spark, Water_Intake_Liters=2.0)).first()["Adequate_Water_Intake"] == 1
    assert rules.engineer_features(_one(spark, Water_Intake_Liters=1.99)).first()["Adequate_Water_Intake"] == 0


def test_domain_rules(spark):
    df = spark.createDataFrame([(18.5, "Healthy"), (24.99, "Obese"), (25.0, "Overweight"), (18.4, "Underweight")],
                               "BMI double, Health_Status string")
    got = df.select(rules.is_healthy("BMI"), rules.needs_intervention(), rules.bmi_band("BMI")).collect()
    assert [tuple(r) for r in got] == [(True, False, "Healthy"), (True, True, "Healthy"),
                                      (False, True, "Overweight"), (False, False, "Underweight")]
    bmi = spark.createDataFrame([Row(Weight_kg=70.0, Height_cm=175.0)]).select(rules.bmi_from_measurements()).first()[0]
    assert bmi == round(70 / 1.75 ** 2, 2)
