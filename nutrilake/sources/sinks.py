"""Sinks (K1-K4): processed features and targets, artifact locations.

Train and test, features and targets are written in ONE pass: one table
(key, features, label) partitioned by ``split``, plus a one-row manifest
naming the key, the label and the feature columns.  X_train / X_test /
y_train / y_test are the partition folders and are read back as
projections of that table (partition pruning keeps the read to one side).
"""
from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def artifact_paths(out_dir: str) -> dict[str, str]:
    """K3: fixed locations under the output folder."""
    prepared = os.path.join(out_dir, "prepared")
    return {
        "prepared": prepared,
        "manifest": os.path.join(out_dir, "prepared_manifest"),
        "X_train": os.path.join(prepared, "split=train"),
        "X_test": os.path.join(prepared, "split=test"),
        "y_train": os.path.join(prepared, "split=train"),
        "y_test": os.path.join(prepared, "split=test"),
        "cleaner": os.path.join(out_dir, "cleaner_state"),
        "encoder": os.path.join(out_dir, "encoder_state"),
        "labels": os.path.join(out_dir, "label_codes"),
    }


def write_splits(frame: DataFrame, out_dir: str, key: str, target: str,
                 fmt: str = "parquet") -> dict[str, str]:
    """K1/K2: features and targets of both splits, overwrite, one pass.
    The key stays with the features and the label, so X and y join back
    without relying on row positions."""
    paths = artifact_paths(out_dir)
    features = [c for c in frame.columns if c not in (target, "split")]
    w = frame.select(*features, target, "split").write.mode("overwrite").partitionBy("split")
    if fmt == "csv":
        w.option("header", True).csv(paths["prepared"])
    else:
        w.parquet(paths["prepared"])
    manifest = {"key": key if key in frame.columns else None, "target": target,
                "features": features, "format": fmt}
    frame.sparkSession.createDataFrame([(json.dumps(manifest),)], "value string") \
        .coalesce(1).write.mode("overwrite").text(paths["manifest"])
    return paths


def read_manifest(spark: SparkSession, out_dir: str) -> dict:
    return json.loads(spark.read.text(artifact_paths(out_dir)["manifest"]).first()[0])


def read_split(spark: SparkSession, out_dir: str, name: str, fmt: str | None = None,
               schema=None) -> DataFrame:
    """K4: read back X_train / X_test / y_train / y_test.  CSV columns are
    bound by name (header) and cast to ``schema`` when one is given."""
    paths = artifact_paths(out_dir)
    man = read_manifest(spark, out_dir)
    fmt = fmt or man["format"]
    kind, side = name.split("_", 1)
    key = [man["key"]] if man["key"] else []
    cols = man["features"] if kind == "X" else key + [man["target"]]
    if fmt == "csv":
        df = spark.read.option("header", True).csv(paths["prepared"])
    else:
        df = spark.read.parquet(paths["prepared"])
    df = df.where(F.col("split") == side)
    if schema is not None:
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return df.select(*cols)
