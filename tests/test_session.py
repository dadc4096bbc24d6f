import os

from nutrilake import session
from nutrilake.operators import bands


def test_clear_scratch_removes_own_folders_only(spark, monkeypatch):
    monkeypatch.setattr(session, "_MADE", {})       # folders of other tests stay
    foreign = session.ensure_checkpoint_dir(spark).rstrip("/") + "/scratch/of-another-application"
    spark.range(1).write.mode("overwrite").parquet(foreign)
    df = spark.createDataFrame([(1.0, "a"), (2.0, "b")], "x double, Health_Status string")
    assert bands.label_bands(df, "x").count() == 2
    (folder,) = session._MADE[spark.sparkContext.applicationId]
    assert os.path.isdir(folder)
    assert session.clear_scratch(spark) == 1 and session.clear_scratch(spark) == 0
    assert not os.path.isdir(folder) and os.path.isdir(foreign)
