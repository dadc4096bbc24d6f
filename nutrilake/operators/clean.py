"""Cleaning (C1-C9): duplicates, imputation, outlier clipping.

``fit`` is a handful of aggregations over the *training* rows that return a
small state (one entry per column); ``transform`` is pure column
expressions with that state as literals, so it runs unchanged on a batch,
a stream or one record.
"""
from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nutrilake import schema as S
from nutrilake.session import current_session
from nutrilake.functions.ordered import bracketed_quantiles, counted, value_counts_long


# --------------------------------------------------------------------------
# duplicates
# --------------------------------------------------------------------------
def drop_duplicates_first(df: DataFrame, key: str | list[str] | None = S.ID_COLUMN,
                          order_by: list[str] | None = None) -> DataFrame:
    """Keep the first row per key, "first" = smallest ``order_by`` (then the
    remaining columns, so the pick is deterministic).  Without a key column
    whole-row duplicates are dropped.

    Runs as ``min(struct(order..., rest...))`` per key: a (sort-based,
    spill-safe) aggregate with a partial step before the shuffle, so a key
    that holds a third of all rows is collapsed map-side instead of landing
    in one window partition.
    NULL keys form one group (as pandas does).
    """
    keys = [key] if isinstance(key, str) else list(key or [])
    keys = [k for k in keys if k in df.columns]
    if not keys:
        return df.dropDuplicates()
    order_by = [c for c in (order_by or []) if c in df.columns and c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    fields = order_by + rest
    if not fields:
        return df.dropDuplicates(keys)
    packed = F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(fields)])
    first = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return first.select(*[F.col(c) if c in keys else
                          F.col(f"_first.f{fields.index(c)}").alias(c) for c in df.columns])


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Whole-row duplicates (partial aggregation on all columns)."""
    return df.dropDuplicates()


# --------------------------------------------------------------------------
# Imputation and clipping
# --------------------------------------------------------------------------
def is_numeric_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def column_modes(df: DataFrame, columns: list[str]) -> dict[str, str | None]:
    """Most frequent non-NULL value per column, ties -> smallest value.

    Long form (column, value) -> count per value (distributed, map-side
    combined) -> one winner per column.  No per-group value map is held in
    memory, so an id-like column with billions of values is fine.
    """
    if not columns:
        return {}
    long_df = df.select(*[F.col(c).cast("string").alias(c) for c in columns]) \
        .unpivot([], columns, "column", "value").where(F.col("value").isNotNull())
    counts = long_df.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("neg_n"), F.col("value"))).alias("mode"))
    found = {r["column"]: r["mode"] for r in best.collect()}
    return {c: found.get(c) for c in columns}


@dataclass
class CleanerModel:
    """Fitted cleaning state: impute value per column, clip bounds per
    outlier column."""

    numeric_impute: dict[str, float | None] = field(default_factory=dict)
    string_impute: dict[str, str] = field(default_factory=dict)
    bounds: dict[str, tuple[float, float]] = field(default_factory=dict)

    # C5 + C6
    def transform(self, df: DataFrame) -> DataFrame:
        out = {}
        for c, v in self.numeric_impute.items():
            if c in df.columns:
                col = F.col(c).cast("double")
                out[c] = F.coalesce(col, F.lit(v).cast("double")) if v is not None else col
        for c, v in self.string_impute.items():
            if c in df.columns:
                out[c] = F.coalesce(F.col(c), F.lit(v))
        for c, (lo, hi) in self.bounds.items():
            if c in df.columns:
                base = out.get(c, F.col(c).cast("double"))
                out[c] = F.when(base.isNull(), F.lit(None).cast("double")) \
                    .otherwise(F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), base)))
        return df.withColumns(out) if out else df

    # C7
    def report(self, df: DataFrame) -> DataFrame:
        """(column, imputed, clipped): cells filled and cells clipped by
        ``transform`` on ``df`` (clipping counted after imputation)."""
        names = [c for c in list(self.numeric_impute) + list(self.string_impute)
                 if c in df.columns]
        aggs = []
        for c in names:
            aggs.append(F.count_if(F.col(c).isNull()).alias(f"i_{c}"))
            if c in self.bounds:
                lo, hi = self.bounds[c]
                v = self.numeric_impute.get(c)
                filled = F.coalesce(F.col(c).cast("double"), F.lit(v).cast("double"))
                aggs.append(F.count_if((filled < lo) | (filled > hi)).alias(f"c_{c}"))
            else:
                aggs.append(F.lit(0).cast("long").alias(f"c_{c}"))
        if not aggs:
            return df.sparkSession.createDataFrame([], "column string, imputed long, clipped long")
        wide = df.agg(*aggs)
        stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                               F.col(f"i_{c}").alias("imputed"),
                                               F.col(f"c_{c}").alias("clipped"))
                                      for c in names]))
        return wide.select(stacked.alias("r")).select("r.*")

    # C9
    def state_rows(self) -> list[tuple]:
        rows = []
        for c, v in self.numeric_impute.items():
            lo, hi = self.bounds.get(c, (None, None))
            rows.append((c, "numeric", v, None, lo, hi))
        for c, v in self.string_impute.items():
            rows.append((c, "string", None, v, None, None))
        return rows

    STATE_SCHEMA = ("column string, kind string, num_value double, str_value string, "
                    "lower double, upper double")

    def state_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.state_rows(), self.STATE_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        self.state_df(spark).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "CleanerModel":
        model = cls()
        for r in spark.read.parquet(path).collect():
            if r["kind"] == "numeric":
                model.numeric_impute[r["column"]] = r["num_value"]
                if r["lower"] is not None:
                    model.bounds[r["column"]] = (r["lower"], r["upper"])
            else:
                model.string_impute[r["column"]] = r["str_value"]
        return model

    def to_json(self) -> str:
        return json.dumps({"numeric": self.numeric_impute, "string": self.string_impute,
                           "bounds": self.bounds})


class Cleaner:
    """Learn medians (every numeric column), modes (every other
    column) and IQR clip bounds (listed columns) from the training rows."""

    def __init__(self, outlier_columns: list[str] | None = None, iqr_factor: float = 3.0,
                 quantile_method: str = "exact", unique_columns: list[str] | None = None):
        """``unique_columns``: non-numeric columns known to hold distinct
        values (e.g. the key after deduplication).  Every value then occurs
        once, so the mode with ties broken to the smallest value is exactly
        ``min(column)`` -- computed without shuffling the column's values."""
        self.outlier_columns = list(outlier_columns or [])
        self.iqr_factor = iqr_factor
        self.quantile_method = quantile_method
        self.unique_columns = list(unique_columns or [])

    def fit(self, df: DataFrame) -> CleanerModel:
        """Exact quartiles and medians of the numeric columns come from two
        scans and a shuffle of the values next to the wanted ranks
        (``bracketed_quantiles``); the modes of the others from a value-count
        table.  One small result per column reaches the driver."""
        numeric = [f.name for f in df.schema.fields if is_numeric_type(f.dataType)]
        unique = [f.name for f in df.schema.fields
                  if not is_numeric_type(f.dataType) and f.name in self.unique_columns]
        other = [f.name for f in df.schema.fields
                 if not is_numeric_type(f.dataType) and f.name not in unique]
        model = CleanerModel()
        if not numeric and not other and not unique:
            return model
        parts = []
        if unique:
            mins = df.agg(*[F.min(F.col(c).cast("string")).alias(c) for c in unique])
            parts.append(mins.unpivot([], unique, "column", "mode")
                         .select("column", F.lit(None).cast("array<double>").alias("q"), "mode"))
        if not numeric and not other:
            found = {r["column"]: r for r in parts[0].collect()}
            for c in unique:
                if found[c]["mode"] is not None:
                    model.string_impute[c] = found[c]["mode"]
            return model
        if numeric:
            probs = [0.25, 0.5, 0.75]
            if self.quantile_method == "approx":
                row = df.agg(*[F.percentile_approx(F.col(c).cast("double"), probs, 10_000).alias(c) for c in numeric]).first()
                quartiles = {c: list(row[c]) if row[c] is not None else None for c in numeric}
            else:
                quartiles = bracketed_quantiles(df, numeric, probs)
        if other:
            vc = value_counts_long(df, [], other, keep_nulls=False)
            txt = vc.where(counted(vc, F.col("sval").isNotNull()))
            modes = txt.groupBy("column").agg(F.min_by("sval", F.struct(
                (-F.col("n")).alias("neg_n"), F.col("sval"))).alias("mode"))
            parts.append(modes.select("column", F.lit(None).cast("array<double>").alias("q"), "mode"))
        found = {}
        if parts:
            res = parts[0]
            for part in parts[1:]:
                res = res.unionByName(part)
            found = {r["column"]: r for r in res.collect()}      # one row per column
        for c in numeric:
            q = quartiles[c]
            model.numeric_impute[c] = q[1] if q is not None else None
            if c in self.outlier_columns and q is not None:
                iqr = q[2] - q[0]
                model.bounds[c] = (q[0] - self.iqr_factor * iqr, q[2] + self.iqr_factor * iqr)
        for c in [f.name for f in df.schema.fields if f.name in other or f.name in unique]:
            if c in found and found[c]["mode"] is not None:
                model.string_impute[c] = found[c]["mode"]
        return model

    def fit_transform(self, df: DataFrame) -> tuple[CleanerModel, DataFrame]:
        model = self.fit(df)
        return model, model.transform(df)


def path_exists(path: str) -> bool:
    """Existence on the cluster's file system (HDFS, object stores, local),
    through Hadoop's FileSystem API of the active session."""
    spark = current_session()
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath))


def require_path(path: str, message: str) -> None:
    """Fail early with a clear message when an artifact is missing."""
    if not path_exists(path):
        raise FileNotFoundError(f"{message}: {path} is missing")
