import os

import pytest
from pyspark.sql import functions as F

from nutrilake.operators import score
from nutrilake.plans import training
from nutrilake.streaming.scoring import REQUEST_SCHEMA, read_rejected, read_scored, start_scoring_stream

REQ = dict(request_id="r1", age=30, gender="Male", height_cm=175.0, weight_kg=70.0,
           activity_level="Moderately Active", diet_type="Balanced", daily_calorie_requirement=2200.0,
           daily_calorie_consumed=2100.0, protein_intake_g=90.0, carbohydrate_intake_g=250.0,
           fat_intake_g=70.0, water_intake_liters=2.5)


def _reqs(spark, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in REQUEST_SCHEMA.fields) for r in rows], REQUEST_SCHEMA)


def test_request_validation(spark):
    bad = [dict(REQ, request_id="a", age=-5), dict(REQ, request_id="g", gender="Robot"),
           dict(REQ, request_id="s", activity_level="Superhuman"), dict(REQ, request_id="w", weight_kg=0.0)]
    valid, rejected = score.validate_requests(_reqs(spark, [REQ] + bad))
    assert [r["request_id"] for r in valid.collect()] == ["r1"]
    errs = {r["request_id"]: r["errors"] for r in rejected.collect()}
    assert set(errs) == {"a", "g", "s", "w"} and all(len(e) == 1 for e in errs.values())


def test_raw_record_mapping(spark):
    raw = score.to_raw_records(_reqs(spark, [REQ])).first()
    assert raw["BMI"] == round(70 / 1.75 ** 2, 2) and raw["Age"] == 30 and raw["Diet_Type"] == "Balanced"


def test_publish_and_score_batch_and_stream(spark, published):
    out, winner = published
    info = training.best_model_info(spark, os.path.join(out, "models"))
    assert info["model_type"] == winner and info["selection_metric"] == "mcc"
    art = score.ScoringArtifacts.load(spark, os.path.join(out, "processed"), os.path.join(out, "models", "best"))
    reqs = _reqs(spark, [REQ, dict(REQ, request_id="r2", weight_kg=110.0), dict(REQ, request_id="bad", age=-5)])
    valid, _ = score.validate_requests(reqs)
    batch = score.score(score.to_raw_records(valid, keep=["request_id"]), art, keep=["request_id"])
    rows = {r["request_id"]: r for r in batch.collect()}
    assert set(rows) == {"r1", "r2"}
    for r in rows.values():
        assert abs(sum(r["probabilities"].values()) - 1) < 1e-9
        assert r["predicted_health_status"] == max(r["probabilities"], key=r["probabilities"].get)
    inbox = os.path.join(out, "inbox")
    reqs.write.mode("overwrite").parquet(inbox)
    q = start_scoring_stream(spark, inbox, art, os.path.join(out, "stream"), os.path.join(out, "ckpt"))
    q.awaitTermination()
    streamed = {r["request_id"]: r["predicted_health_status"] for r in read_scored(spark, os.path.join(out, "stream")).collect()}
    assert streamed == {k: v["predicted_health_status"] for k, v in rows.items()}
    assert [r["request_id"] for r in read_rejected(spark, os.path.join(out, "stream")).collect()] == ["bad"]


def test_reloaded_encoder_matches_the_model(spark, published):
    out, _ = published
    art = score.ScoringArtifacts.load(spark, os.path.join(out, "processed"), os.path.join(out, "models", "best"))
    assert art.model.feature_names == art.encoder.feature_names()
    valid, _ = score.validate_requests(_reqs(spark, [REQ]))
    raw = score.to_raw_records(valid, keep=["request_id"])
    art.encoder.categorical = art.encoder.categorical[::-1]
    with pytest.raises(ValueError, match="the model was fitted on"):
        score.score(raw, art, keep=["request_id"])


def test_missing_artifact(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no published model"):
        score.ScoringArtifacts.load(spark, str(tmp_path), str(tmp_path / "best"))
    with pytest.raises(FileNotFoundError, match="no published model"):
        training.best_model_info(spark, str(tmp_path))


def test_best_model_ties_first_registered(spark):
    m = spark.createDataFrame([("a", "mcc", 0.5, 0), ("b", "mcc", 0.5, 1), ("b", "accuracy", 0.9, 1)],
                              "model_type string, metric string, value double, registry_position int")
    assert training.best_model(m).first()["model_type"] == "a"
    assert training.best_model(m, "accuracy").first()["model_type"] == "b"
