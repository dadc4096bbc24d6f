import pytest
from pyspark.sql import functions as F

from nutrilake import schema as S
from nutrilake.operators import stats
from nutrilake.sources import loader


def test_csv_load_types_and_rows(mock_df):
    assert mock_df.count() == 17
    types = dict(mock_df.dtypes)
    assert types["Age"] == "int" and types["Weight_kg"] == "double" and types["Gender"] == "string"
    assert mock_df.where(F.col("Weight_kg").isNull()).count() == 1
    assert mock_df.where(F.col("Activity_Level").isNull()).count() == 1


def test_missing_column_is_an_error(spark, tmp_path):
    from tests.conftest import DIET_CSV
    lines = DIET_CSV.strip().split("\n")
    header = lines[0].split(",")
    idx = header.index("BMI")
    body = "\n".join(",".join(v for i, v in enumerate(line.split(",")) if i != idx) for line in lines)
    p = tmp_path / "no_bmi.csv"
    p.write_text(body + "\n")
    with pytest.raises(loader.DataLoadError, match="lacks"):
        loader.load_table(spark, str(p))


def test_missing_file_is_a_load_error(spark, tmp_path):
    with pytest.raises(loader.DataLoadError, match="cannot read"):
        loader.read_raw_csv(spark, str(tmp_path / "absent.csv"))


def test_na_strings_and_coercion(spark):
    df = spark.createDataFrame([("1", "2.5"), ("NA", "x"), ("None", "nan"), ("30.0", "")], "a string, b string")
    df = df.select(*[loader._na_to_null(F.col(c)).alias(c) for c in df.columns])
    out = loader.coerce_numeric(df, ["a", "b"], {"a": "int"}).collect()
    assert [tuple(r) for r in out] == [(1, 2.5), (None, None), (None, None), (30, None)]
    lost = {r["column"]: r["lost"] for r in loader.coercion_losses(df, ["a", "b"], {"a": "int"}).collect()}
    assert lost == {"a": 0, "b": 1}


def test_sample_exact_size(mock_dedup):
    assert loader.sample_n(mock_dedup, 5).count() == 5
    assert loader.sample_n(mock_dedup, 100).count() == 16
    a = sorted(r[0] for r in loader.sample_n(mock_dedup, 7, seed=1).select("Person_ID").collect())
    b = sorted(r[0] for r in loader.sample_n(mock_dedup, 7, seed=1).select("Person_ID").collect())
    assert a == b and len(set(a)) == 7


def test_overview(mock_df):
    r = loader.dataset_overview(mock_df).first()
    assert r["total_records"] == 17 and r["total_columns"] == 15
    assert r["health_status_distribution"] == {"Healthy": 6, "Overweight": 6, "Obese": 3, "Underweight": 2}
    assert r["age_range"] == "17 - 73"
    assert r["bmi_range"] == "17.1 - 35.9"


def test_typed_records_strict_and_permissive(mock_df):
    valid, rejected = loader.load_records(mock_df, strict=False)
    assert valid.count() == 16 and rejected.count() == 1
    assert rejected.first()["errors"] == ["invalid Activity_Level"]
    with pytest.raises(Exception, match="invalid record"):
        loader.load_records(mock_df, strict=True).count()
    rec = valid.first()
    assert set(rec["person"].asDict()) >= {"person_id", "age", "bmi", "activity_level"}


def test_health_statistics_after_dedup(mock_dedup):
    r = stats.health_summary(mock_dedup).first()
    assert r["total_assessments"] == 16
    assert r["health_status_distribution"] == {"Healthy": 6, "Overweight": 5, "Obese": 3, "Underweight": 2}
    assert r["people_needing_intervention"] == 8
    assert r["intervention_percentage"] == pytest.approx(50.0)


def test_health_statistics_small(spark):
    df = spark.createDataFrame([("Obese", "Keto", 32.0, 2600.0, 2000.0),
                                ("Healthy", "Vegan", 22.0, 2000.0, 2000.0),
                                ("Overweight", "Keto", 27.0, 2400.0, 1800.0)],
                               "Health_Status string, Diet_Type string, BMI double, "
                               "Daily_Calorie_Consumed double, Daily_Calorie_Requirement double")
    r = stats.health_summary(df).first()
    assert r["people_needing_intervention"] == 2
    assert r["intervention_percentage"] == pytest.approx(200 / 3)
    assert r["average_bmi"] == pytest.approx(27.0)
    assert r["average_calorie_balance"] == pytest.approx(400.0)
    assert stats.health_summary(df.limit(0)).count() == 0


def test_label_determinism(mock_dedup):
    rows = stats.label_determinism(mock_dedup).collect()
    assert sum(r["violations"] for r in rows) == 0


def test_source_inventory(spark, mock_csv):
    inv = loader.source_inventory(loader.read_raw_csv(spark, mock_csv)).collect()
    assert len(inv) == 1 and inv[0]["rows"] == 17 and inv[0]["size_bytes"] > 0


def test_distributions_skip_missing(spark):
    df = spark.createDataFrame([("Healthy", "Keto", 22.0, 2000.0, 2100.0), (None, "Keto", 31.0, 2000.0, 2000.0)],
                               "Health_Status string, Diet_Type string, BMI double, "
                               "Daily_Calorie_Consumed double, Daily_Calorie_Requirement double")
    r = stats.health_summary(df).first()
    assert r["health_status_distribution"] == {"Healthy": 1} and r["total_assessments"] == 2


def test_source_info(spark, mock_csv, tmp_path):
    import os
    info = loader.source_info(spark, mock_csv)
    assert info == {"path": mock_csv, "exists": True, "size_bytes": os.path.getsize(mock_csv)}
    missing = loader.source_info(spark, str(tmp_path / "nope.csv"))
    assert missing["exists"] is False and missing["size_bytes"] is None


def test_csv_dialect(spark, tmp_path):
    p = tmp_path / "odd.csv"
    p.write_text('a,b,c\n"x ""q"", y",1,"two\nlines"\nshort,2\nlong,3,z,extra\nNA,,"n/a"\n')
    rows = sorted(map(repr, map(tuple, loader.read_raw_csv(spark, str(p)).collect())))
    assert rows == sorted(map(repr, [('x "q", y', "1", "two\nlines"), ("short", "2", None), ("long", "3", "z"),
                                     (None, None, None)]))


def test_parquet_goes_the_same_way(spark, tmp_path, mock_csv):
    raw = spark.read.option("header", True).csv(mock_csv).fillna("NA", ["Gender", "Activity_Level"])
    path = str(tmp_path / "no_suffix")
    raw.write.parquet(path)
    back = loader.load_table(spark, path)
    assert back.count() == 17 and back.where("Activity_Level IS NULL").count() == 1
    assert sorted(map(repr, back.collect())) == sorted(map(repr, loader.load_table(spark, mock_csv).collect()))
    assert loader.load_table(spark, path, fmt="parquet").count() == 17


@pytest.mark.parametrize("nulls", [False, True])
def test_sample_is_exact_with_any_keys(spark, nulls):
    rows = [(None if nulls and i % 4 == 0 else f"k{i % 9}", i % 5) for i in range(40)] + [("same", 1)] * 6
    df = spark.createDataFrame(rows, "Person_ID string, v int").repartition(3)
    left = sorted(map(repr, map(tuple, df.collect())))
    before = []
    for n in range(0, 47):
        got = sorted(map(repr, map(tuple, loader.sample_n(df, n).collect())))
        assert len(got) == n
        rest = list(left)
        for x in got:
            rest.remove(x)
        grown = list(got)
        for x in before:
            grown.remove(x)          # samples of one seed are nested
        before = got
