"""Classification metrics (V1-V5).

One distributed aggregation -- counts per (truth, prediction) pair, K^2 rows
at most -- and every metric is derived from that small table:
accuracy, macro precision / recall / F1 (zero division -> 0, averaged over
the classes present in truth or prediction), multiclass MCC, and the
confusion matrix pinned to all known classes.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nutrilake.functions.ordered import collect_bounded


def pair_counts(df: DataFrame, label: str, prediction: str,
                group: list[str] | None = None) -> DataFrame:
    """(group..., t, p, n): rows per (truth, prediction) pair (partial
    aggregation; K^2 rows per group)."""
    g = list(group or [])
    return (df.select(*g, F.col(label).cast("string").alias("t"),
                      F.col(prediction).cast("string").alias("p"))
            .groupBy(*g, "t", "p").agg(F.count(F.lit(1)).alias("n")))


def per_class(pairs: DataFrame, group: list[str] | None = None) -> DataFrame:
    """(group..., k, tp, pred_k, true_k) for every class seen in truth or
    prediction (of the group)."""
    g = list(group or [])
    by_t = pairs.groupBy(*g, F.col("t").alias("k")).agg(
        F.sum("n").alias("true_k"), F.sum(F.when(F.col("t") == F.col("p"), F.col("n"))).alias("tp"))
    by_p = pairs.groupBy(*g, F.col("p").alias("k")).agg(F.sum("n").alias("pred_k"))
    return (by_t.join(by_p, g + ["k"], "full")
            .select(*g, "k", F.coalesce("tp", F.lit(0)).alias("tp"),
                    F.coalesce("pred_k", F.lit(0)).alias("pred_k"),
                    F.coalesce("true_k", F.lit(0)).alias("true_k")))


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def metrics_from_pairs(pairs: DataFrame, group: list[str] | None = None) -> DataFrame:
    """One row (per group): accuracy, precision_macro, recall_macro,
    f1_macro, mcc.  ``group`` (e.g. a fold column) evaluates many
    partitions of the predictions in the same plan."""
    g = list(group or [])
    pc = per_class(pairs, g)
    macro = pc.groupBy(*g).agg(
        F.avg(_safe_div(F.col("tp"), F.col("pred_k"))).alias("precision_macro"),
        F.avg(_safe_div(F.col("tp"), F.col("true_k"))).alias("recall_macro"),
        F.avg(_safe_div(2 * F.col("tp"), 2 * F.col("tp") + (F.col("pred_k") - F.col("tp"))
                        + (F.col("true_k") - F.col("tp")))).alias("f1_macro"),
        F.sum("tp").cast("double").alias("_c"),
        F.sum("true_k").cast("double").alias("_s"),
        F.sum(F.col("pred_k").cast("double") * F.col("true_k")).alias("_pt"),
        F.sum(F.col("pred_k").cast("double") * F.col("pred_k")).alias("_pp"),
        F.sum(F.col("true_k").cast("double") * F.col("true_k")).alias("_tt"))
    den = F.sqrt((F.col("_s") * F.col("_s") - F.col("_pp")) * (F.col("_s") * F.col("_s") - F.col("_tt")))
    return macro.select(
        *g,
        _safe_div(F.col("_c"), F.col("_s")).alias("accuracy"),
        "precision_macro", "recall_macro", "f1_macro",
        F.when(den == 0, F.lit(0.0)).otherwise(
            (F.col("_c") * F.col("_s") - F.col("_pt")) / den).alias("mcc"))


def confusion_long(pairs: DataFrame, classes: list[str]) -> DataFrame:
    """(true_label, pred_label, n) for all K x K known classes, zeros kept.
    The K^2 grid is generated from the literal class list (no join of data
    against data)."""
    arr = F.array(*[F.lit(c) for c in classes])
    grid = pairs.sparkSession.range(1).select(F.explode(arr).alias("true_label")) \
        .select("true_label", F.explode(arr).alias("pred_label"))
    got = pairs.select(F.col("t").alias("true_label"), F.col("p").alias("pred_label"), "n")
    return grid.join(got, ["true_label", "pred_label"], "left") \
        .select("true_label", "pred_label", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def confusion_matrix(pairs: DataFrame, classes: list[str]) -> DataFrame:
    """One row: ``confusion_matrix`` ARRAY<ARRAY<BIGINT>> (rows = truth, in
    class order) and ``class_labels``."""
    pos = F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(i))])
    cl = confusion_long(pairs, classes) \
        .withColumn("ti", pos[F.col("true_label")]).withColumn("pi", pos[F.col("pred_label")])
    rows = cl.groupBy("ti").agg(F.transform(F.array_sort(F.collect_list(F.struct("pi", "n"))),
                                            lambda s: s["n"]).alias("row"))
    return rows.agg(F.transform(F.array_sort(F.collect_list(F.struct("ti", "row"))),
                                lambda s: s["row"]).alias("confusion_matrix")) \
        .withColumn("class_labels", F.array(*[F.lit(c) for c in classes]))


def classification_metrics(df: DataFrame, label: str, prediction: str,
                           classes: list[str] | None = None) -> DataFrame:
    """V1-V5 in one row.  ``classes`` pins the confusion matrix (defaults to
    the sorted classes seen)."""
    pairs = pair_counts(df, label, prediction).cache()
    if classes is None:
        classes = sorted({r[0] for r in collect_bounded(per_class(pairs).select("k"), what="classes")})
    return one_row(metrics_from_pairs(pairs), confusion_matrix(pairs, classes))


def one_row(*frames: DataFrame) -> DataFrame:
    """Put several one-row frames side by side without a join: union by
    name (missing columns NULL) and keep the non-NULL value per column."""
    cols = [c for f in frames for c in f.columns]
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])
