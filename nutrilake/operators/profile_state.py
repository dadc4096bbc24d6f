"""Column profile as mergeable state (P1-P6 without a second look at the data).

A table that grows by batches need not be profiled anew: each batch leaves one
small row per column, and rows of several batches merge into the profile of
their union.

* rows, missing cells, smallest and largest value: exact;
* mean and skewness: central moments, merged by their shift formulas, exact up
  to rounding;
* cardinality: HyperLogLog sketch of ``2 ** lg_k`` registers, relative standard
  error ``1.04 / sqrt(2 ** lg_k)``;
* quartiles and outliers: KLL sketch, rank error ``rank_error(k)`` at 99 %.

One pass a batch: every column is an aggregate of the same scan, nothing is
unpivoted or shuffled but the sketches.  Partial states are merged by
``MERGE_TASKS`` tasks first, so no task receives those of the whole cluster.

Defined cases: NaN counts as missing; an empty batch adds nothing; a column
without values has no mean, skewness, quartiles or extremes and is constant; a
batch written again under its id replaces itself; columns the batch has beyond
the state's are ignored, absent ones are an error.
"""
from __future__ import annotations

import json
import math
import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nutrilake.operators.clean import require_path

LG_K, KLL_K = 14, 800
MERGE_TASKS = 64
STATE_SCHEMA = ("column string, n long, missing long, mean double, m2 double, m3 double, lo double, hi double, "
                "lo_text string, hi_text string, values binary, ranks binary")
PROFILE_COLUMNS = ["Column", "Type", "Rows", "Missing", "Pct_Missing", "Cardinality", "Constant", "Mean", "Skewness",
                   "Quartiles", "Pct_Outliers", "Min", "Max", "Min_Text", "Max_Text"]


def rank_error(k: int = KLL_K) -> float:
    """Normalised rank error of a KLL sketch, one query point, 99 % confidence."""
    return 2.296 / k ** 0.9723


def cardinality_error(lg_k: int = LG_K) -> float:
    """Relative standard error of the cardinality."""
    return 1.04 / 2 ** (lg_k / 2)


def _column_state(name: str, dtype: T.DataType, lg_k: int, k: int) -> Column:
    """The state of one column as an aggregate (a struct)."""
    cell, number, text = F.col(f"`{name}`"), F.lit(None).cast("double"), F.lit(None).cast("string")
    numeric = isinstance(dtype, (T.NumericType, T.BooleanType))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        cell = F.when(~F.isnan(cell), cell + F.lit(0).cast(dtype))       # -0.0 is 0.0
    if numeric:
        number = cell.cast("double")
    else:
        text = cell.cast("string")
    present = F.count(cell)
    m2 = F.coalesce(F.var_pop(number) * present, F.lit(0.0))
    # skewness is sqrt(n) m3 / m2 ** 1.5, and null without spread
    m3 = F.coalesce(F.skewness(number) * F.pow(m2, 1.5) / F.sqrt(present.cast("double")), F.lit(0.0))
    return F.struct(
        F.lit(name).alias("column"), F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) - present).alias("missing"),
        F.avg(number).alias("mean"), m2.alias("m2"), m3.alias("m3"), F.min(number).alias("lo"),
        F.max(number).alias("hi"), F.min(text).alias("lo_text"), F.max(text).alias("hi_text"),
        F.hll_sketch_agg(cell.cast("string"), lg_k).alias("values"),
        (F.kll_sketch_agg_double(number, F.lit(k)) if numeric else F.lit(None).cast("binary")).alias("ranks"))


def merge_states(states: DataFrame, k: int = KLL_K) -> DataFrame:
    """One state per column from any number of them."""
    w = Window.partitionBy("column")
    size = (F.col("n") - F.col("missing")).cast("double")
    # states without values have no mean and weigh nothing
    mean = F.sum(size * F.col("mean")).over(w) / F.nullif(F.sum(size).over(w), F.lit(0.0))
    moved = states.withColumn("_mean", mean).withColumn("_d", F.coalesce(F.col("mean") - F.col("_mean"), F.lit(0.0)))
    d = F.col("_d")
    return moved.groupBy("column").agg(
        F.sum("n").alias("n"), F.sum("missing").alias("missing"), F.first("_mean").alias("mean"),
        F.sum(F.col("m2") + size * d * d).alias("m2"),
        F.sum(F.col("m3") + 3 * d * F.col("m2") + size * d * d * d).alias("m3"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.min("lo_text").alias("lo_text"), F.max("hi_text").alias("hi_text"),
        F.hll_union_agg("values").alias("values"), F.kll_merge_agg_double("ranks", F.lit(k)).alias("ranks"))


class ProfileState:
    """Mergeable profile below ``path``: ``columns`` (names, types, sketch
    sizes) and ``states/batch_id=<id>``, one row per column and batch."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, lg_k: int = LG_K, k: int = KLL_K):
        self.spark, self.path, self.schema, self.lg_k, self.k = spark, path, schema, lg_k, k

    @classmethod
    def create(cls, like: DataFrame, path: str, lg_k: int = LG_K, k: int = KLL_K) -> "ProfileState":
        """An empty state for tables with the columns of ``like``."""
        state = cls(like.sparkSession, path, like.schema, lg_k, k)
        meta = json.dumps({"schema": like.schema.jsonValue(), "lg_k": lg_k, "k": k})
        state.spark.createDataFrame([(meta,)], "value string").coalesce(1) \
            .write.mode("overwrite").text(os.path.join(path, "columns"))
        return state

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ProfileState":
        require_path(os.path.join(path, "columns"), "no profile state; create one first")
        meta = json.loads(spark.read.text(os.path.join(path, "columns")).first()[0])
        return cls(spark, path, T.StructType.fromJson(meta["schema"]), meta["lg_k"], meta["k"])

    def measure(self, batch: DataFrame) -> DataFrame:
        """The state of one batch: one row per column."""
        absent = [f.name for f in self.schema.fields if f.name not in batch.columns]
        if absent:
            raise ValueError(f"the batch lacks {absent}")
        typed = batch.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields],
                             F.pmod(F.spark_partition_id(), F.lit(MERGE_TASKS)).alias("_merge_task"))
        cells = [_column_state(f.name, f.dataType, self.lg_k, self.k) for f in self.schema.fields]
        partial = typed.groupBy("_merge_task").agg(F.array(*cells).alias("_s")).select(F.explode("_s").alias("_s"))
        return merge_states(partial.select("_s.*"), self.k)

    def add(self, batch: DataFrame, batch_id: int) -> "ProfileState":
        """Add the rows of one batch; the same id again replaces them."""
        self.measure(batch).coalesce(1).write.mode("overwrite") \
            .parquet(os.path.join(self.path, "states", f"batch_id={int(batch_id)}"))
        return self

    def states(self) -> DataFrame:
        require_path(os.path.join(self.path, "states"), "the profile state holds no batch")
        return self.spark.read.schema(STATE_SCHEMA + ", batch_id long").parquet(os.path.join(self.path, "states"))

    def profile(self, iqr_factor: float = 1.5, batches: list[int] | None = None) -> DataFrame:
        """The profile of all batches, or of those named, in the order of the columns."""
        states = self.states()
        if batches is not None:
            states = states.where(F.col("batch_id").isin(*batches))
        return finish_profile(merge_states(states.drop("batch_id"), self.k), self.schema, iqr_factor)


def finish_profile(merged: DataFrame, schema: T.StructType, iqr_factor: float = 1.5) -> DataFrame:
    """Merged states -> profile rows (``PROFILE_COLUMNS``)."""
    numeric = [f.name for f in schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    types = F.create_map(*[F.lit(x) for f in schema.fields for x in (f.name, f.dataType.simpleString())])
    order = F.array(*[F.lit(f.name) for f in schema.fields])
    size = (F.col("n") - F.col("missing")).cast("double")
    number = F.col("column").isin(*numeric) & (size > 0)
    quartiles = F.kll_sketch_get_quantile_double("ranks", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    # a sketch is asked with literals only: one row per numeric column reaches the driver
    share = F.lit(None).cast("double")
    for name, (q1, _, q3) in merged.where(number).select("column", quartiles).collect():
        low, high = q1 - iqr_factor * (q3 - q1), q3 + iqr_factor * (q3 - q1)
        # ranks include the value itself: below the fence means up to the double before it
        below = F.kll_sketch_get_rank_double("ranks", F.lit(math.nextafter(low, -math.inf)))
        share = F.when(F.col("column") == name, below + 1.0 - F.kll_sketch_get_rank_double("ranks", F.lit(high))) \
            .otherwise(share)
    skew = (F.when(size < 3, F.lit(None).cast("double")).when(F.col("m2") == 0, F.lit(0.0))
            .otherwise(size * F.sqrt(size - 1) / (size - 2) * F.col("m3") / F.pow("m2", 1.5)))
    return (merged.where(F.col("n") > 0).withColumn("Quartiles", F.when(number, quartiles)).select(
        F.col("column").alias("Column"), types[F.col("column")].alias("Type"), F.col("n").alias("Rows"),
        F.col("missing").alias("Missing"), F.round(F.col("missing") / F.col("n") * 100, 2).alias("Pct_Missing"),
        F.hll_sketch_estimate("values").alias("Cardinality"),
        ((size == 0) | F.coalesce(F.col("lo") == F.col("hi"), F.col("lo_text") == F.col("hi_text"), F.lit(False)))
        .alias("Constant"),
        F.col("mean").alias("Mean"), F.when(number, skew).alias("Skewness"), "Quartiles",
        F.when(number, F.round(share * size / F.col("n") * 100, 2)).alias("Pct_Outliers"),
        F.col("lo").alias("Min"), F.col("hi").alias("Max"), F.col("lo_text").alias("Min_Text"),
        F.col("hi_text").alias("Max_Text"))
        .orderBy(F.desc("Pct_Missing"), F.array_position(order, F.col("Column"))))
