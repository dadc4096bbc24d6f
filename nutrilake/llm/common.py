"""Small helpers shared by the operators of this package."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nutrilake.session import ensure_checkpoint_dir

# ASCII white space (space, tab, LF, VT, FF, CR) as regular expressions and as a string.
WHITE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/nutrilake-llm/{uuid.uuid4().hex}-{name}"


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in shared storage and read it back.

    The table survives the loss of any executor; unlike ``checkpoint()`` its
    columns are compressed and later reads can prune them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Hand whole texts to Python in batches of at most BATCH_ROWS rows.

    Spark's default of 10,000 rows is meant for numbers; with texts of many
    kilobytes it costs each worker hundreds of MB.  The setting is read when a
    plan runs, so it is left in the session.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z and nothing else.  ``lower`` does just that to ASCII
    strings and is much faster than ``translate``."""
    return (F.when(F.octet_length(col) == F.length(col), F.lower(col))
            .otherwise(F.translate(col, UPPER, LOWER)))


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``name``: the 0-based place of each row in the order of the key
    columns, with no window over the whole table.

    Rows are dealt to range partitions, ranked inside each, and shifted by the
    rows of the partitions before.  One count per partition (a number the
    session sets) reaches the driver.
    """
    spark = df.sparkSession
    n = shuffle_partitions(spark)
    parts = written(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()),
                    "ranked")
    counts = {r["_part"]: r["n"] for r in parts.groupBy("_part").agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for k in range(n):
        before.append(total)
        total += counts.get(k, 0)
    offsets = F.array(*[F.lit(x).cast("long") for x in before])
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return (parts.withColumn(name, inside + F.element_at(offsets, F.col("_part") + 1))
            .drop("_part"))


def worker_cache() -> dict:
    """A dict that lives as long as the Python process: what is costly to load
    (a tokenizer) is loaded once per worker, not once per task."""
    import sys
    import types
    return sys.modules.setdefault("_nutrilake_worker", types.ModuleType("_nutrilake_worker")).__dict__
