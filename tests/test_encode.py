import numpy as np
import pytest

from nutrilake.operators.encode import Encoder, EncoderModel, LabelCodes


@pytest.fixture
def enc_df(spark):
    return spark.createDataFrame([(1.0, 5.0, "a"), (2.0, 5.0, "b"), (3.0, 5.0, "a"), (4.0, 5.0, "c")],
                                 "num_a double, num_b double, cat_a string")


def test_scale_and_one_hot(spark, enc_df):
    m = Encoder(["num_a", "num_b"], ["cat_a"]).fit(enc_df)
    assert m.feature_names() == ["numeric__num_a", "numeric__num_b", "categorical__cat_a_a",
                                 "categorical__cat_a_b", "categorical__cat_a_c"]
    out = m.transform(enc_df).collect()
    a = np.array([1.0, 2.0, 3.0, 4.0])
    assert [r[0] for r in out] == pytest.approx(list((a - a.mean()) / a.std()))
    assert all(r[1] == 0.0 for r in out)            # zero variance -> divided by 1
    assert [tuple(r)[2:] for r in out] == [(1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (1.0, 0.0, 0.0), (0.0, 0.0, 1.0)]
    unseen = spark.createDataFrame([(1.0, 5.0, "z")], enc_df.schema)
    assert tuple(m.transform(unseen).first())[2:] == (0.0, 0.0, 0.0)


def test_unfitted_and_round_trip(spark, enc_df, tmp_path):
    with pytest.raises(RuntimeError, match="must be fitted"):
        Encoder(["num_a"], ["cat_a"]).transform(enc_df)
    m = Encoder(["num_a", "num_b"], ["cat_a"]).fit(enc_df)
    m.save(spark, str(tmp_path / "enc"))
    back = EncoderModel.load(spark, str(tmp_path / "enc"))
    assert back.feature_names() == m.feature_names()
    assert [tuple(r) for r in back.transform(enc_df).collect()] == [tuple(r) for r in m.transform(enc_df).collect()]


def test_reload_keeps_the_fitted_order(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0, "x", "p", None), (3.0, 5.0, "w", "q", None)],
                               "z double, a double, zz string, aa string, empty string")
    m = Encoder(["z", "a"], ["zz", "aa", "empty"]).fit(df)
    m.save(spark, str(tmp_path / "enc"))
    back = EncoderModel.load(spark, str(tmp_path / "enc"))
    assert back == m and back.feature_names() == m.feature_names() == [
        "numeric__z", "numeric__a", "categorical__zz_w", "categorical__zz_x", "categorical__aa_p", "categorical__aa_q"]


def test_label_codes(spark, tmp_path):
    df = spark.createDataFrame([("Obese",), ("Healthy",), ("Underweight",), ("Healthy",)], "Health_Status string")
    codes = LabelCodes.fit(df)
    assert codes.classes == ["Healthy", "Obese", "Underweight"]
    got = [r[0] for r in df.select(codes.encode("Health_Status")).collect()]
    assert got == [1, 0, 2, 0]
    back = df.select(codes.decode(codes.encode("Health_Status"))).collect()
    assert [r[0] for r in back] == ["Obese", "Healthy", "Underweight", "Healthy"]
    bad = spark.createDataFrame([("Overweight",)], "Health_Status string")
    with pytest.raises(Exception, match="unseen labels"):
        bad.select(codes.encode("Health_Status")).collect()
    codes.save(spark, str(tmp_path / "codes"))
    assert LabelCodes.load(spark, str(tmp_path / "codes")).classes == codes.classes
