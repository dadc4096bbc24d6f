import os

from nutrilake.llm import cleanup, common, line_dedup


def test_runs_and_folders_go(spark, tmp_path, monkeypatch):
    for module in (cleanup, common):
        monkeypatch.setattr(module, "ensure_checkpoint_dir", lambda spark: str(tmp_path))
    docs = spark.createDataFrame([(i, "a line of more than twenty letters") for i in range(4)], "doc_id long, text string")
    assert line_dedup.dedup_lines(docs).where("n_dropped = 1").count() == 3
    assert os.listdir(tmp_path / "nutrilake-llm")
    assert cleanup.clear_temporary(spark) >= 1 and cleanup.clear_temporary(spark) == 0
    assert not os.path.exists(tmp_path / "nutrilake-llm")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("nutrilake_run_")]
