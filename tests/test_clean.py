import numpy as np
import pytest
from pyspark.sql import functions as F

from nutrilake import schema as S
from nutrilake.operators.clean import Cleaner, CleanerModel, column_modes, drop_duplicates_first


def test_dedup_keeps_first(mock_dedup):
    assert mock_dedup.count() == 16
    assert mock_dedup.select("Person_ID").distinct().count() == 16


def test_dedup_first_by_order_and_whole_rows(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 5, "only"), (None, 1, "n1"),
                                (None, 0, "n0")], "id string, pos int, v string")
    got = {r["id"]: r["v"] for r in drop_duplicates_first(df, "id", ["pos"]).collect()}
    assert got == {"a": "early", "b": "only", None: "n0"}
    whole = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "a int, b string")
    assert drop_duplicates_first(whole, None).count() == 2


def test_median_mode_and_ties(spark):
    df = spark.createDataFrame([("P1", 10.0, "x"), ("P2", 20.0, "x"), ("P3", None, "y"), ("P4", None, None)],
                               "Person_ID string, value double, category string")
    m = Cleaner().fit(df)
    assert m.numeric_impute["value"] == 15.0
    assert m.string_impute["category"] == "x"
    ties = spark.createDataFrame([("b",), ("a",), ("b",), ("a",)], "c string")
    assert column_modes(ties, ["c"]) == {"c": "a"}


def test_train_value_fills_test(spark):
    train = spark.createDataFrame([("P1", 10.0), ("P2", 20.0), ("P3", 30.0)], "Person_ID string, value double")
    test = spark.createDataFrame([("P9", None)], "Person_ID string, value double")
    m = Cleaner().fit(train)
    assert m.transform(test).first()["value"] == 20.0
    # columns absent from the input are skipped (id/target-free records)
    only = spark.createDataFrame([(None,)], "value double")
    assert m.transform(only).first()["value"] == 20.0


def test_clip_bounds_and_report(spark):
    vals = [9, 10, 10, 10, 11, 11, 10, 9, 10, 11, 1000]
    df = spark.createDataFrame([(f"P{i}", v) for i, v in enumerate(vals)], "Person_ID string, value int")
    m = Cleaner(["value"], iqr_factor=3.0).fit(df)
    lo, hi = m.bounds["value"]
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    assert (lo, hi) == (q1 - 3 * (q3 - q1), q3 + 3 * (q3 - q1))
    out = [r["value"] for r in m.transform(df).collect()]
    assert max(out) == pytest.approx(hi) and min(out) >= lo
    rep = {r["column"]: (r["imputed"], r["clipped"]) for r in m.report(df).collect()}
    assert rep["value"] == (0, 1)


def test_all_null_numeric_stays_missing(spark):
    df = spark.createDataFrame([(None,), (None,)], "value double")
    m = Cleaner().fit(df)
    assert m.numeric_impute["value"] is None
    assert m.transform(df).where(F.col("value").isNull()).count() == 2


def test_state_round_trip(spark, tmp_path, mock_dedup):
    m = Cleaner(S.RAW_NUMERIC_COLUMNS).fit(mock_dedup)
    p = str(tmp_path / "cleaner")
    m.save(spark, p)
    back = CleanerModel.load(spark, p)
    assert back.numeric_impute == m.numeric_impute and back.string_impute == m.string_impute
    assert back.bounds == m.bounds
    a = [tuple(r) for r in m.transform(mock_dedup).orderBy("Person_ID").collect()]
    b = [tuple(r) for r in back.transform(mock_dedup).orderBy("Person_ID").collect()]
    assert a == b


def test_unique_column_mode_is_min(spark, mock_dedup):
    a = Cleaner(S.RAW_NUMERIC_COLUMNS).fit(mock_dedup)
    b = Cleaner(S.RAW_NUMERIC_COLUMNS, unique_columns=["Person_ID"]).fit(mock_dedup)
    assert a.string_impute == b.string_impute and a.numeric_impute == b.numeric_impute
    assert b.string_impute["Person_ID"] == "D-01"


def test_first_in_file_order(spark, tmp_path):
    from nutrilake.sources.loader import SOURCE_POSITION, load_table
    p = tmp_path / "dups.csv"
    rows = ["Person_ID,Age,Gender,Height_cm,Weight_kg,BMI,Activity_Level,Daily_Calorie_Requirement,"
            "Daily_Calorie_Consumed,Protein_Intake_g,Carbohydrate_Intake_g,Fat_Intake_g,"
            "Water_Intake_Liters,Diet_Type,Health_Status"]
    for i, age in enumerate([50, 20, 70, 30]):     # same person, later copies have other ages
        rows.append(f"P1,{age},Male,180,80,24.7,Sedentary,2000,2000,100,200,50,2,Keto,Healthy")
    rows.append("P2,40,Female,160,60,23.4,Athlete,2000,2000,100,200,50,2,Vegan,Healthy")
    p.write_text("\n".join(rows) + "\n")
    df = load_table(spark, str(p), keep_position=True)
    first = drop_duplicates_first(df, "Person_ID", [SOURCE_POSITION]).drop(SOURCE_POSITION)
    got = {r["Person_ID"]: r["Age"] for r in first.collect()}
    assert got == {"P1": 50, "P2": 40}
