"""SparkSession helpers.

The library never creates a session behind the caller's back: every public
function takes the caller's DataFrame (and so its session).  ``local_session``
is only for tests, the bench and the driver entry point.
"""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins and coalesces shuffle
# partitions at run time; skew-join splitting handles hot keys in the few
# shuffle joins we keep.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "nutrilake") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("NUTRILAKE_DRIVER_MEMORY", "8g")))
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3/...) folder
    and is used as is.  Only when it is unset and the master is local, as in
    tests, a fresh scratch folder is created and registered; on any other
    master executors could not see it, so its absence is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"spark.checkpoint.dir is not set: on {master} it must name a shared folder")
    path = tempfile.mkdtemp(prefix="nutrilake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def current_session() -> SparkSession:
    """The caller's session, also from worker threads (the active session is
    thread-local; ``getOrCreate`` returns the process's existing one)."""
    return SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()


_MADE: dict[str, list[str]] = {}        # application -> its scratch folders (paths only)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex[:16]}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Remove every scratch folder that this application made and return their
    number.  Results that were not written elsewhere read them: call it after
    they have been.  Folders of other applications stay."""
    made = _MADE.pop(spark.sparkContext.applicationId, [])
    for path in made:
        remove_scratch(spark, path)
    return len(made)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``scratch_folder`` named; any other is refused."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch/"
    if not path.startswith(base) or len(path) <= len(base) or ".." in path:
        raise ValueError(f"{path} is no scratch folder of this session")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
