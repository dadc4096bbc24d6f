"""Drift between a reference and a current table.

Per shared column: PSI (categorical when the reference has at most
``categorical_max_unique`` distinct values, else binned on the reference's
deciles with right-closed bins) and the two-sample KS statistic with its
p-value (exact for small samples, asymptotic beyond).

Plan: both sides are unpivoted to (feature, value) and counted per distinct
value in ONE shuffle (map-side combined, so a hot value is one row).  That count
table is range-partitioned by (feature, value) and written once; everything else
is a local pass over its ordered parts (``functions.segments``):

1. totals per ordered segment, whose prefix sums are the offsets of each;
2. the KS statistic and the exact reference quantiles, from running totals
   that start at the offset;
3. PSI cells: bins by those quantiles, or values.

What reaches the driver is a row per (segment, feature), then per (feature, bin).

A ``DriftBaseline`` keeps the reference as counts per value, added up batch by
batch, with its totals and edges: later tables are compared with it without
reading the reference again.
"""
from __future__ import annotations

import json
import os
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nutrilake.functions import segments
from nutrilake.functions.ordered import side_value_counts, value_counts_long
from nutrilake.functions.stats import KS_EXACT_ROWS, ks_pvalue, ks_pvalue_exact, severity
from nutrilake.operators.clean import require_path
from nutrilake.session import remove_scratch, scratch_folder

REPORT_COLUMNS = ["feature", "psi", "ks_statistic", "ks_pvalue", "drift_severity"]


def shared_columns(reference: DataFrame, current: DataFrame) -> list[str]:
    """columns of the reference that the current table also has."""
    cur = set(current.columns)
    return [c for c in reference.columns if c in cur]


def _is_numeric(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType))


def drift_report(reference: DataFrame, current: DataFrame, columns: list[str] | None = None,
                 buckets: int = 10, moderate: float = 0.1, major: float = 0.25,
                 categorical_max_unique: int = 10, pvalue: str = "asymptotic") -> DataFrame:
    """One row per shared column, sorted by PSI descending.

    ``pvalue``: "exact" (lattice paths, O(n1 n2) a column), "asymptotic", or "auto":
    exact where neither sample has more than KS_EXACT_ROWS rows.

    Numeric columns are compared as numbers, the others as strings
    (categorical PSI; KS over lexicographic order).  A column that is NULL on
    both sides has PSI 0, KS 0 and p-value 1.
    """
    cols = shared_columns(reference, current) if columns is None else list(columns)
    num = [c for c in cols if _is_numeric(reference, c)]
    txt = [c for c in cols if c not in num]
    # the one shuffle over the data
    counts = side_value_counts(reference, current, num, txt) if cols else None
    return _report(reference.sparkSession, counts, cols, set(txt), buckets, moderate, major, categorical_max_unique,
                   pvalue)


def _report(spark: SparkSession, counts: DataFrame | None, cols: list[str], texts: set[str], buckets: int,
            moderate: float, major: float, categorical_max_unique: int, pvalue: str,
            known_edges: dict[str, list[float]] | None = None) -> DataFrame:
    """The report of a count table (column, dval, sval, rn, cn), one row per
    value.  ``known_edges``: the reference's quantiles of numeric columns with
    more than ``categorical_max_unique`` values, when they are known."""
    if pvalue not in ("auto", "exact", "asymptotic"):
        raise ValueError(f"unknown kind of p-value {pvalue!r}")
    rows = []
    if cols:
        folder = scratch_folder(spark, "drift")
        feature = F.array_position(F.array(*[F.lit(c) for c in cols]), F.col("column")) - 1
        ordered = segments.write_ordered(counts.select(feature.cast("int").alias("feature"), "dval", "sval", "rn", "cn"),
                                         folder)
        found = segments.totals(ordered)
        n_r, n_c, unique = (np.zeros(len(cols), np.int64) for _ in range(3))
        for s in found:
            n_r[s.feature] += s.r
            n_c[s.feature] += s.c
            unique[s.feature] += s.distinct
        binned = [i for i, c in enumerate(cols) if c not in texts and unique[i] > categorical_max_unique]
        probs = [i / buckets for i in range(buckets + 1)]
        edges = {i: known_edges[cols[i]] for i in binned} if known_edges is not None else None
        wanted = {} if edges is not None else {i: segments.ranks(probs, int(n_r[i])) for i in binned}
        ks, picked = segments.levels(ordered, found, n_r, n_c, wanted)
        if edges is None:
            edges = {i: segments.quantiles(probs, int(n_r[i]), picked[i]) for i in binned}
        inner = {i: np.unique(np.array(e, float))[1:-1] for i, e in edges.items()}
        psi = segments.psi(ordered, n_r, n_c, inner)
        remove_scratch(spark, folder)
        rows = [(c, float(psi[i]), float(ks[i]), int(n_r[i]), int(n_c[i])) for i, c in enumerate(cols)]
    # one row per shared column: a column without any value on either side did not move
    def exact(r: tuple) -> bool:
        return pvalue == "exact" or (pvalue == "auto" and max(r[3:]) <= KS_EXACT_ROWS)

    frame = spark.createDataFrame([(*r, exact(r)) for r in rows],
                                  "feature string, psi double, ks_statistic double, n_r long, n_c long, exact boolean")
    of = F.col("ks_statistic"), F.col("n_r"), F.col("n_c")
    series = F.when(F.col("n_r") + F.col("n_c") > 0, ks_pvalue(*of)).otherwise(F.lit(1.0))
    if any(exact(r) for r in rows):
        # rows without a sample of the right size take the asymptotic value, and cost no lattice
        small = [F.when(F.col("exact"), x).otherwise(F.lit(0).cast("long")) for x in of[1:]]
        series = F.when(F.col("exact"), ks_pvalue_exact(of[0], *small)).otherwise(series)
    return (frame.select("feature", "psi", "ks_statistic", series.alias("ks_pvalue"),
                         severity(F.col("psi"), moderate, major).alias("drift_severity"))
            .orderBy(F.desc("psi"), "feature"))


# ---- F10: the reference as saved state -----------------------------------------
class DriftBaseline:
    """The reference of a comparison as mergeable state below ``path``.

    ``counts/batch_id=<id>`` holds the counts per (column, value) of one batch; a
    batch that is written again replaces itself, so a replayed stream batch or a
    repeated job adds nothing.  ``columns`` lists the columns.  ``edges`` holds
    totals and quantiles, found by ``freeze`` and out of date after ``add``.
    """

    def __init__(self, spark: SparkSession, path: str, numeric: list[str], texts: list[str], order: list[str]):
        self.spark, self.path = spark, path
        self.numeric, self.texts, self.order = numeric, texts, order

    @classmethod
    def create(cls, like: DataFrame, path: str, columns: list[str] | None = None) -> "DriftBaseline":
        """An empty baseline for tables with the columns of ``like``."""
        order = list(columns or like.columns)
        num = [c for c in order if _is_numeric(like, c)]
        meta = {"numeric": num, "texts": [c for c in order if c not in num], "order": order}
        like.sparkSession.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1) \
            .write.mode("overwrite").text(os.path.join(path, "columns"))
        return cls(like.sparkSession, path, **meta)

    @classmethod
    def fit(cls, reference: DataFrame, path: str, columns: list[str] | None = None) -> "DriftBaseline":
        """The whole reference as one batch, frozen."""
        return cls.create(reference, path, columns).add(reference, 0).freeze()

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "DriftBaseline":
        require_path(os.path.join(path, "columns"), "no drift baseline; fit one first")
        return cls(spark, path, **json.loads(spark.read.text(os.path.join(path, "columns")).first()[0]))

    def add(self, batch: DataFrame, batch_id: int) -> "DriftBaseline":
        """Add the rows of one batch: one aggregation with map-side combine."""
        value_counts_long(batch, self.numeric, self.texts, keep_nulls=False) \
            .write.mode("overwrite").parquet(os.path.join(self.path, "counts", f"batch_id={int(batch_id)}"))
        return self

    def counts(self) -> DataFrame:
        """(column, dval, sval, n) over all batches."""
        return (self.spark.read.schema("column string, dval double, sval string, n long, batch_id long")
                .parquet(os.path.join(self.path, "counts"))
                .groupBy("column", "dval", "sval").agg(F.sum("n").alias("n")))

    def freeze(self, buckets: int = 10) -> "DriftBaseline":
        """Find totals and edges, so that comparisons need not."""
        folder = scratch_folder(self.spark, "baseline")
        feature = F.array_position(F.array(*[F.lit(c) for c in self.order]), F.col("column")) - 1
        ordered = segments.write_ordered(self.counts().select(
            feature.cast("int").alias("feature"), "dval", "sval", F.col("n").alias("rn"), F.lit(0).cast("long").alias("cn")), folder)
        found = segments.totals(ordered)
        n, unique = np.zeros(len(self.order), np.int64), np.zeros(len(self.order), np.int64)
        for s in found:
            n[s.feature] += s.r
            unique[s.feature] += s.distinct
        probs = [i / buckets for i in range(buckets + 1)]
        numeric = [i for i, c in enumerate(self.order) if c in set(self.numeric) and n[i]]
        _, picked = segments.levels(ordered, found, n, np.zeros_like(n), {i: segments.ranks(probs, int(n[i])) for i in numeric})
        remove_scratch(self.spark, folder)
        rows = [(c, int(n[i]), int(unique[i]), buckets,
                 segments.quantiles(probs, int(n[i]), picked[i]) if i in picked else None) for i, c in enumerate(self.order)]
        self.spark.createDataFrame(rows, "feature string, n long, distinct long, buckets int, edges array<double>") \
            .coalesce(1).write.mode("overwrite").parquet(os.path.join(self.path, "edges"))
        return self

    def compare(self, current: DataFrame, moderate: float = 0.1, major: float = 0.25,
                categorical_max_unique: int = 10, pvalue: str = "asymptotic") -> DataFrame:
        """The report of ``drift_report(reference, current)`` over the columns
        that ``current`` has; the baseline must be frozen."""
        require_path(os.path.join(self.path, "edges"), "the drift baseline is not frozen")
        frozen = {r["feature"]: r for r in self.spark.read.parquet(os.path.join(self.path, "edges")).collect()}
        cols = [c for c in self.order if c in set(current.columns)]
        num = [c for c in cols if c in set(self.numeric)]
        texts = [c for c in cols if c not in num]
        now = value_counts_long(current, num, texts, keep_nulls=False)
        both = (self.counts().where(F.col("column").isin(cols))
                .select("column", "dval", "sval", F.col("n").alias("rn"), F.lit(0).cast("long").alias("cn"))
                .unionByName(now.select("column", "dval", "sval", F.lit(0).cast("long").alias("rn"), F.col("n").alias("cn")))
                .groupBy("column", "dval", "sval").agg(F.sum("rn").alias("rn"), F.sum("cn").alias("cn")))
        edges = {c: list(r["edges"]) for c, r in frozen.items() if r["edges"] is not None}
        return _report(self.spark, both, cols, set(texts), 10, moderate, major, categorical_max_unique, pvalue, edges)


def drift_summary(report: DataFrame) -> DataFrame:
    """features checked, drifted features (PSI order), any major drift."""
    return report.agg(
        F.count(F.lit(1)).alias("n_features_checked"),
        F.transform(F.array_sort(F.collect_list(F.when(
            F.col("drift_severity") != "none",
            F.struct((-F.col("psi")).alias("k"), F.col("feature").alias("feature"))))),
            lambda s: s["feature"]).alias("drifted_features"),
        F.coalesce(F.max(F.col("drift_severity") == "major"), F.lit(False)).alias("has_major_drift"))


@dataclass
class DriftResult:
    report: DataFrame
    summary: DataFrame


def analyze_drift(reference: DataFrame, current: DataFrame, pvalue: str = "auto", **kw) -> DriftResult:
    """Report and summary, with exact p-values for small samples as the job API gives them."""
    report = drift_report(reference, current, pvalue=pvalue, **kw)
    return DriftResult(report, drift_summary(report))
