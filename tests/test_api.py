"""End-to-end through the job API on the 17-row table of the tests (doubled so
every class can be split and folded)."""
import os

import pytest
from pyspark.sql import functions as F

from nutrilake.plans.api import DietJobs, JobSettings
from nutrilake.sources import sinks
from tests.conftest import DIET_CSV
from tests.test_score import REQ, _reqs

FAST = {"ovr_gbt": {"n_estimators": 2, "max_depth": 2}, "softmax_boost": {"iterations": 2, "depth": 2}}


@pytest.fixture(scope="module")
def jobs(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("api")
    lines = DIET_CSV.strip().split("\n")
    extra = [l.replace("D-", "E-", 1) for l in lines[1:]]
    (d / "raw.csv").write_text("\n".join(lines + extra) + "\n")
    s = JobSettings(str(d / "raw.csv"), str(d / "out"), test_size=0.25, hyperparameters=FAST)
    return DietJobs(spark, s)


def test_statistics_and_summary(jobs):
    r = jobs.get_health_statistics(jobs.deduplicated()).first()
    assert r["total_assessments"] == 32
    assert jobs.summary().first()["total_records"] == 34
    prof = {r["Column"]: r for r in jobs.dataset_summary().collect()}
    assert prof["Gender"]["Examples"] == ["Female", "Male", "Other"] and prof["Weight_kg"]["Missing"] == 2


def test_records_are_judged_by_default(jobs):
    with pytest.raises(Exception, match="invalid record: invalid Activity_Level"):
        jobs.load_data().count()
    with pytest.raises(Exception, match="invalid record"):
        jobs.get_health_statistics().collect()
    assert jobs.load_data(strict=False).count() == 32


def test_full_flow(spark, jobs):
    prep = jobs.preprocess_data(how="cache")
    assert prep.train().count() + prep.test().count() == 32
    assert prep.test().count() == 8
    paths = sinks.artifact_paths(jobs.settings.processed_dir)
    assert all(os.path.exists(paths[k]) for k in ("X_train", "X_test", "y_train", "y_test", "cleaner", "encoder"))
    x = sinks.read_split(spark, jobs.settings.processed_dir, "X_test")
    y = sinks.read_split(spark, jobs.settings.processed_dir, "y_test")
    assert x.join(y, "Person_ID").count() == 8
    res = jobs.train_model("ovr_gbt", prep)
    assert set(res.metrics.columns) >= {"accuracy", "mcc", "confusion_matrix", "class_labels"}
    per_fold, summ = jobs.cross_validate_model("softmax_boost", prep, n_splits=2)
    assert per_fold.count() == 10 and summ.count() == 5
    cmp = jobs.compare_models(prep)
    winner = jobs.select_best_model(cmp)
    assert jobs.get_best_model_info()["model_type"] == winner
    dr = jobs.analyze_data_drift(prep)
    assert dr.summary.first()["n_features_checked"] == len(prep.feature_names)
    out = jobs.predict_health_status(_reqs(spark, [REQ, dict(REQ, request_id="x", age=-5)]), key="request_id")
    rows = out.collect()
    assert {r["request_id"]: r["errors"] for r in rows} == {"r1": None, "x": ["age must be an integer in 1..120"]}
    assert [r["predicted_health_status"] is None for r in sorted(rows, key=lambda r: r["request_id"])] == [False, True]
    raw = jobs.raw_data().drop("Person_ID", "Health_Status").limit(3)   # raw column names
    scored = jobs.predict_health_status(raw).collect()
    assert len(scored) == 3 and all(abs(sum(r["probabilities"].values()) - 1) < 1e-9 for r in scored)


def test_csv_sink_round_trip_with_schema(spark, tmp_path, mock_dedup):
    from pyspark.sql import types as T
    frame = mock_dedup.select("Person_ID", "Health_Status", F.col("Age").cast("double").alias("numeric__Age")) \
        .withColumn("split", F.when(F.col("Person_ID") < "D-08", "train").otherwise("test"))
    sinks.write_splits(frame, str(tmp_path), "Person_ID", "Health_Status", fmt="csv")
    schema = T.StructType([T.StructField("Person_ID", T.StringType()), T.StructField("numeric__Age", T.DoubleType())])
    back = sinks.read_split(spark, str(tmp_path), "X_train", fmt="csv", schema=schema)
    exp = frame.where("split = 'train'").select("Person_ID", "numeric__Age")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, exp.collect()))
