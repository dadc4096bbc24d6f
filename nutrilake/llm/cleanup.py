"""Removing the temporary tables of this package."""
from __future__ import annotations

from pyspark.sql import SparkSession

from nutrilake.session import ensure_checkpoint_dir

RUN_TABLES = "nutrilake_run_*"


def clear_temporary(spark: SparkSession) -> int:
    """Drop the line runs from the session's current database and remove the folder
    ``nutrilake-llm`` below ``spark.checkpoint.dir``; returns the number of runs.

    Results are read lazily from that folder, by every application that shares the
    setting: call it when all of them have written what they keep.
    """
    runs = [t.name for t in spark.catalog.listTables(pattern=RUN_TABLES)]
    for name in runs:
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    folder = spark._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark).rstrip("/") + "/nutrilake-llm")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len(runs)
