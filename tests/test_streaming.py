"""Stream scoring survives a restart: offsets come from the checkpoint, each
micro-batch overwrites its own batch-id folder, so nothing is scored twice
or lost."""
import os


from nutrilake.operators import score
from nutrilake.session import ensure_checkpoint_dir
from nutrilake.streaming.scoring import read_scored, start_scoring_stream
from tests.test_score import REQ, _reqs


def test_restart_scores_each_request_once(spark, published, tmp_path):
    out, _winner = published
    art = score.ScoringArtifacts.load(spark, os.path.join(out, "processed"), os.path.join(out, "models", "best"))
    inbox, sink, ckpt = str(tmp_path / "inbox"), str(tmp_path / "sink"), str(tmp_path / "ckpt")
    first = [dict(REQ, request_id=f"a{i}", weight_kg=60.0 + i) for i in range(5)]
    second = [dict(REQ, request_id=f"b{i}", weight_kg=90.0 + i) for i in range(4)]
    _reqs(spark, first).write.mode("append").parquet(inbox)
    start_scoring_stream(spark, inbox, art, sink, ckpt).awaitTermination()
    assert read_scored(spark, sink).count() == 5
    _reqs(spark, second).write.mode("append").parquet(inbox)
    start_scoring_stream(spark, inbox, art, sink, ckpt).awaitTermination()   # restart, same checkpoint
    ids = [r[0] for r in read_scored(spark, sink).select("request_id").collect()]
    assert sorted(ids) == sorted([f"a{i}" for i in range(5)] + [f"b{i}" for i in range(4)])


def test_checkpoint_dir_respected(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert ensure_checkpoint_dir(spark) == configured
    assert spark.sparkContext.getCheckpointDir() is not None


def test_json_request_stream(spark, published, tmp_path):
    import json
    out, _winner = published
    art = score.ScoringArtifacts.load(spark, os.path.join(out, "processed"), os.path.join(out, "models", "best"))
    inbox = tmp_path / "json_inbox"
    inbox.mkdir()
    reqs = [dict(REQ, request_id="j1"), dict(REQ, request_id="j2", gender="Robot")]
    (inbox / "part-0.json").write_text("\n".join(json.dumps(r) for r in reqs) + "\n")
    q = start_scoring_stream(spark, str(inbox), art, str(tmp_path / "sink"), str(tmp_path / "ckpt"), fmt="json")
    q.awaitTermination()
    assert [r[0] for r in read_scored(spark, str(tmp_path / "sink")).select("request_id").collect()] == ["j1"]


def test_a_batch_of_one_file_uses_all_cores(spark, tmp_path, monkeypatch):
    from nutrilake.streaming import scoring
    seen = []

    def score(raw, art, keep):
        seen.append(raw.rdd.getNumPartitions())
        return raw.select(*keep)

    monkeypatch.setattr(scoring, "score", score)
    batch = spark.createDataFrame([], scoring.REQUEST_SCHEMA).coalesce(1)
    scoring.score_micro_batch(batch, 0, None, str(tmp_path / "out"))
    assert seen == [spark.sparkContext.defaultParallelism]
