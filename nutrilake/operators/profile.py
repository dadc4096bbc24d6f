"""Column profile (P1-P8): one row per input column.

Columns: Column, Type, Missing, Pct_Missing, Cardinality, Constant,
Skewness, Pct_Outliers, Examples.

Plan: ONE scan of the input feeds ONE value-count table
``vc = (column, dval, sval, n)`` -- every column unpivoted, counted per
distinct value (NULL included) with map-side combine.  Every measure is a
small aggregation over ``vc``:

* rows / missing / cardinality: sums and counts per column;
* skewness: mean per column, then central moments weighted by ``n``;
* quartiles (outlier fences): exact, by local passes over the ordered numbers
  of ``vc`` (``functions.segments``);
* outliers: sum of ``n`` outside the fences;
* examples: the smallest distinct values, map-side top-k.

``vc`` is written once, in a scratch folder (``clear_scratch`` removes it):
the source is read once however many columns it has, and no consumer repeats
the aggregation.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nutrilake.functions import segments
from nutrilake.functions.ordered import bounded_broadcast, counted, value_counts_long
from nutrilake.session import remove_scratch, scratch_folder

PROFILE_COLUMNS = ["Column", "Type", "Missing", "Pct_Missing", "Cardinality", "Constant",
                   "Skewness", "Pct_Outliers", "Examples"]
PROFILE_SCHEMA = ("Column string, Type string, Missing long, Pct_Missing double, "
                  "Cardinality long, Constant boolean, Skewness double, "
                  "Pct_Outliers double, Examples array<string>")


def _smallest_k(vc: DataFrame, k: int, by_appearance: bool = False) -> DataFrame:
    """k example values per column: the k smallest distinct values, or --
    ``by_appearance`` -- the first k distinct values in source order, then
    sorted for numeric columns (what the source profile shows).

    ``row_number() <= k`` over a window per column: Spark plans it with a
    partial ``WindowGroupLimit`` before the shuffle, so each task forwards
    at most k rows per column (a map-side top-k) -- the window after the
    shuffle sees k x tasks rows, never all distinct values of a column.
    """
    present = vc.where(counted(vc, F.col("dval").isNotNull() | F.col("sval").isNotNull()))
    order = [F.col("first_pos")] if by_appearance else [F.col("dval"), F.col("sval")]
    w = Window.partitionBy("column").orderBy(*order)
    top = present.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
    text = F.coalesce(F.col("dval").cast("string"), F.col("sval")).alias("value")
    # numbers are listed in value order, strings in the window's order
    rank = F.when(F.col("dval").isNotNull(), F.col("dval")).otherwise(F.col("_r").cast("double"))
    return top.groupBy("column").agg(
        F.transform(F.array_sort(F.collect_list(F.struct(rank.alias("_k"), text))),
                    lambda s: s["value"]).alias("Examples"))


def _moments(vc: DataFrame) -> DataFrame:
    """(column, Skewness): pandas' bias-corrected sample skewness from the
    weighted central moments of the distinct values."""
    num = vc.where(counted(vc, F.col("dval").isNotNull()))
    means = num.groupBy("column").agg(
        F.sum("n").alias("_cnt"), (F.sum(F.col("dval") * F.col("n")) / F.sum("n")).alias("_mean"))
    # means: one row per numeric column.
    dev = num.join(bounded_broadcast(means), "column") \
        .withColumn("_d", F.col("dval") - F.col("_mean"))
    m = dev.groupBy("column", "_cnt").agg(
        F.sum(F.col("n") * F.col("_d") * F.col("_d")).alias("_m2"),
        F.sum(F.col("n") * F.col("_d") * F.col("_d") * F.col("_d")).alias("_m3"))
    cnt = F.col("_cnt").cast("double")
    skew = (F.when(cnt < 3, F.lit(None).cast("double"))
            .when(F.col("_m2") == 0, F.lit(0.0))
            .otherwise(cnt * F.sqrt(cnt - 1) / (cnt - 2) * (F.col("_m3") / F.pow(F.col("_m2"), 1.5))))
    return m.select("column", skew.alias("Skewness"))


def _quartiles(num: DataFrame, columns: list[str]) -> dict[str, list[float]]:
    """Exact quartiles of the columns with values: their numbers are dealt to
    range partitions, and the values at the wanted ranks are found by one local
    pass from the offsets of the parts."""
    folder = scratch_folder(num.sparkSession, "ordered")
    feature = F.create_map(*[x for i, c in enumerate(columns) for x in (F.lit(c), F.lit(i))])[F.col("column")]
    ordered = segments.write_ordered(num.select(
        feature.alias("feature"), "dval", "sval", F.col("n").alias("rn"), F.lit(0).cast("long").alias("cn")), folder)
    found = segments.totals(ordered)
    n = [0] * len(columns)
    for s in found:
        n[s.feature] += s.r
    probs = [0.25, 0.75]
    wanted = {i: segments.ranks(probs, n[i]) for i in range(len(columns)) if n[i]}
    _, picked = segments.levels(ordered, found, n, [0] * len(columns), wanted)
    remove_scratch(num.sparkSession, folder)
    return {columns[i]: segments.quantiles(probs, n[i], picked[i]) for i in wanted}


def dataset_profile(df: DataFrame, max_examples: int = 5, iqr_factor: float = 1.5,
                    quantile_method: str = "exact", approx_accuracy: int = 10_000,
                    order_col: str | None = None) -> DataFrame:
    """P1-P8.  Empty input -> empty frame with the profile columns.

    ``order_col`` (an orderable source position, e.g. ``_source_pos`` from
    ``load_table(keep_position=True)``) makes ``Examples`` the first values
    in order of appearance; without it they are the smallest values.
    """
    spark = df.sparkSession
    data_cols = [c for c in df.columns if c != order_col]
    if not data_cols:
        return spark.createDataFrame([], PROFILE_SCHEMA)
    fields = [f for f in df.schema.fields if f.name != order_col]
    numeric = [f.name for f in fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))]
    strings = [f.name for f in fields if f.name not in numeric]
    position = {f.name: i for i, f in enumerate(fields)}
    types = {f.name: f.dataType.simpleString() for f in fields}

    counts, folder = value_counts_long(df, numeric, strings, order_col=order_col), scratch_folder(spark, "counts")
    counts.write.parquet(folder)
    vc = spark.read.schema(counts.schema).parquet(folder)

    base = vc.groupBy("column").agg(
        F.sum("n").alias("_n"),
        F.sum(F.when(F.col("dval").isNull() & F.col("sval").isNull(), F.col("n")).otherwise(0))
        .alias("Missing"),
        F.count_if((F.col("dval").isNotNull() | F.col("sval").isNotNull()) & (F.col("n") > 0))
        .alias("Cardinality"))
    examples = _smallest_k(vc, max_examples, by_appearance=order_col is not None)
    out = base.join(bounded_broadcast(examples), "column", "left")   # one row per column

    if numeric:
        num = vc.where(counted(vc, F.col("dval").isNotNull()))
        if quantile_method == "approx":
            q = num.groupBy("column").agg(F.percentile_approx(
                "dval", [0.25, 0.75], approx_accuracy).alias("q"))
        else:
            q = spark.createDataFrame(list(_quartiles(num, numeric).items()), "column string, q array<double>")
        fences = q.select("column",
                          (F.col("q")[0] - iqr_factor * (F.col("q")[1] - F.col("q")[0])).alias("_lo"),
                          (F.col("q")[1] + iqr_factor * (F.col("q")[1] - F.col("q")[0])).alias("_hi"))
        # fences: one row per numeric column.
        outliers = num.join(bounded_broadcast(fences), "column").groupBy("column").agg(
            F.sum(F.when((F.col("dval") < F.col("_lo")) | (F.col("dval") > F.col("_hi")),
                         F.col("n")).otherwise(0)).alias("_out"))
        out = out.join(bounded_broadcast(_moments(vc)), "column", "left") \
            .join(bounded_broadcast(outliers), "column", "left")
    else:
        out = out.withColumn("Skewness", F.lit(None).cast("double")) \
            .withColumn("_out", F.lit(None).cast("long"))

    pos_map = F.create_map(*[x for c in data_cols for x in (F.lit(c), F.lit(position[c]))])
    type_map = F.create_map(*[x for c in data_cols for x in (F.lit(c), F.lit(types[c]))])
    is_num = F.col("column").isin(*numeric) if numeric else F.lit(False)
    card = F.coalesce(F.col("Cardinality"), F.lit(0)).cast("long")
    pct = lambda x: F.round(x / F.col("_n") * 100, 2)
    return (out.where(F.col("_n") > 0).select(
        F.col("column").alias("Column"), type_map[F.col("column")].alias("Type"),
        F.col("Missing").cast("long").alias("Missing"),
        pct(F.col("Missing")).alias("Pct_Missing"),
        card.alias("Cardinality"), (card <= 1).alias("Constant"),
        F.when(is_num, F.round("Skewness", 2)).alias("Skewness"),
        F.when(is_num, pct(F.coalesce(F.col("_out"), F.lit(0)))).alias("Pct_Outliers"),
        F.coalesce(F.col("Examples"), F.array().cast("array<string>")).alias("Examples"),
        pos_map[F.col("column")].alias("_pos"))
        .orderBy(F.desc("Pct_Missing"), "_pos").drop("_pos"))
