import numpy as np
import pandas as pd
import pytest

from nutrilake.operators.profile import dataset_profile


def test_profile_of_mock(mock_df):
    rows = {r["Column"]: r for r in dataset_profile(mock_df.drop()).collect()}
    assert rows["Weight_kg"]["Missing"] == 1 and rows["Activity_Level"]["Missing"] == 1
    assert rows["Fat_Intake_g"]["Missing"] == 1
    assert rows["Person_ID"]["Cardinality"] == 16
    assert rows["Gender"]["Skewness"] is None and rows["Gender"]["Pct_Outliers"] is None
    assert rows["Weight_kg"]["Pct_Missing"] == round(1 / 17 * 100, 2)
    assert rows["Gender"]["Examples"] == ["Female", "Male", "Other"]
    # sorted by % missing, descending
    order = [r["Column"] for r in dataset_profile(mock_df).collect()]
    assert set(order[:3]) == {"Weight_kg", "Activity_Level", "Fat_Intake_g"}


def test_profile_matches_pandas_measures(spark):
    rng = np.random.RandomState(3)
    vals = list(rng.gamma(2.0, 3.0, 200)) + [None] * 5 + [500.0]
    pdf = pd.DataFrame({"value": vals})
    df = spark.createDataFrame([(None if v is None else float(v),) for v in vals], "value double")
    r = dataset_profile(df).first()
    s = pdf["value"]
    assert r["Skewness"] == round(s.skew(), 2)
    q1, q3 = s.quantile([0.25, 0.75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    assert r["Pct_Outliers"] == round(((s < lo) | (s > hi)).sum() / len(s) * 100, 2)
    assert r["Cardinality"] == s.nunique()


def test_constant_and_empty(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 6, "b"), (1, 7, None)], "c int, v int, s string")
    rows = {r["Column"]: r for r in dataset_profile(df).collect()}
    assert rows["c"]["Constant"] is True and rows["v"]["Constant"] is False
    assert rows["c"]["Skewness"] == 0.0
    assert dataset_profile(df.limit(0)).count() == 0


@pytest.mark.parametrize("method", ["exact", "approx"])
def test_outlier_pct_clip_fixture(spark, method):
    vals = [9, 10, 10, 10, 11, 11, 10, 9, 10, 11, 1000]
    df = spark.createDataFrame([(v,) for v in vals], "value int")
    r = dataset_profile(df, quantile_method=method).first()
    assert r["Pct_Outliers"] == round(1 / 11 * 100, 2)


def test_examples_in_order_of_appearance(spark, mock_csv):
    from nutrilake.sources.loader import SOURCE_POSITION, load_table
    df = load_table(spark, mock_csv, keep_position=True)
    rows = {r["Column"]: r for r in dataset_profile(df, order_col=SOURCE_POSITION).collect()}
    assert SOURCE_POSITION not in rows
    assert rows["Gender"]["Examples"] == ["Female", "Male", "Other"]
    assert rows["Person_ID"]["Examples"] == ["D-01", "D-02", "D-03", "D-04", "D-05"]
    # first five distinct ages in file order are 52, 17, 30, 59, 18 -> shown sorted
    assert rows["Age"]["Examples"] == ["17.0", "18.0", "30.0", "52.0", "59.0"]
    assert rows["Activity_Level"]["Examples"] == ["Sedentary", "Athlete", "Lightly Active",
                                                  "Very Active", "Moderately Active"]


def test_quartiles_need_no_search_per_value(spark):
    df = spark.createDataFrame([(float(i % 7), float("nan") if i == 3 else None) for i in range(50)], "v double, w double")
    plan = dataset_profile(df)._jdf.queryExecution().toString()
    assert "lambda acc" not in plan and "aggregate(sequence" not in plan
    rows = {r["Column"]: r for r in dataset_profile(df).collect()}
    assert rows["v"]["Pct_Outliers"] == 0.0 and rows["w"]["Missing"] == 49 and rows["w"]["Cardinality"] == 1
