"""Scoring as a Structured Streaming job.

The HTTP endpoint of the source is re-aimed as a stream: request records
land as files, each micro-batch is validated, valid rows are scored with
the training-fitted artifacts (loaded once, shipped as literals / MLlib
models -- never re-fitted per batch) and rejected rows go to a side sink.
Output paths are keyed by batch id and overwritten, so a replayed batch
after a failure rewrites the same files (idempotent sink on top of the
checkpointed source offsets).
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nutrilake.operators.score import ScoringArtifacts, request_errors, score, to_raw_records

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("height_cm", T.DoubleType()),
    T.StructField("weight_kg", T.DoubleType()),
    T.StructField("activity_level", T.StringType()),
    T.StructField("diet_type", T.StringType()),
    T.StructField("daily_calorie_requirement", T.DoubleType()),
    T.StructField("daily_calorie_consumed", T.DoubleType()),
    T.StructField("protein_intake_g", T.DoubleType()),
    T.StructField("carbohydrate_intake_g", T.DoubleType()),
    T.StructField("fat_intake_g", T.DoubleType()),
    T.StructField("water_intake_liters", T.DoubleType()),
])


def score_micro_batch(batch: DataFrame, batch_id: int, art: ScoringArtifacts, out_dir: str,
                      key: str = "request_id") -> None:
    # A file is read by as many tasks as it has row groups, often one, whatever the
    # number of partitions: the rows are dealt out, so that scoring uses all cores.
    batch = batch.repartition(batch.sparkSession.sparkContext.defaultParallelism)
    # both outputs read the same validated rows once (micro-batch scoped)
    checked = batch.withColumn("errors", request_errors(batch)).persist()
    try:
        valid = checked.where(F.size("errors") == 0).drop("errors")
        rejected = checked.where(F.size("errors") > 0)
        scored = score(to_raw_records(valid, keep=[key]), art, keep=[key])
        scored.write.mode("overwrite").parquet(os.path.join(out_dir, "scored", f"batch_id={batch_id}"))
        rejected.write.mode("overwrite").parquet(os.path.join(out_dir, "rejected", f"batch_id={batch_id}"))
    finally:
        checked.unpersist()


def start_scoring_stream(spark: SparkSession, input_dir: str, art: ScoringArtifacts,
                         out_dir: str, checkpoint_dir: str, available_now: bool = True,
                         max_files_per_trigger: int | None = None, fmt: str = "parquet"):
    """Start the stream over request files (``fmt``: parquet, or json for
    one request object per line); returns the StreamingQuery."""
    reader = spark.readStream.schema(REQUEST_SCHEMA).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(input_dir)
    writer = (stream.writeStream
              .foreachBatch(lambda df, bid: score_micro_batch(df, bid, art, out_dir))
              .option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def read_scored(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(out_dir, "scored"))


def read_rejected(spark: SparkSession, out_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(out_dir, "rejected"))
