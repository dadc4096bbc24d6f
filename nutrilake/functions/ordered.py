"""Order statistics that stay distributed at any scale.

Three operators need "position in sorted order" inside a group:

* exact quantiles (profiling fences, imputation medians, clipping bounds,
  drift bin edges),
* running totals over sorted distinct values (two-sample KS),
* row ranks in a seeded hash order (stratified split, k-fold, exact-n sample).

The textbook ``Window.partitionBy(group).orderBy(value)`` puts a whole group
in one task; with a handful of groups (4 classes, 20 features) that is a
handful of tasks for the whole table, and a hot group holding a third of the
rows would sink it.  Instead every operator here uses the same two-level
scheme:

1. pre-aggregate to one row per (group, value) where possible (map-side
   combine, so a hot value is a single row after the partial aggregation);
2. cut each group's ordered domain into many buckets (approximate
   percentiles for numbers, hex prefixes for uniform hashes, sampled
   values for strings); bucket order agrees with value order;
3. totals per (group, bucket) form a small table (groups x buckets rows,
   bounded by parameters) whose prefix sums are the offsets of each bucket;
4. the exact position inside a bucket comes from a window partitioned by
   (group, bucket), i.e. thousands of small window partitions.

Results are exact, equal to ``row_number``/``percentile``/``quantile_cont``
computed on one machine.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nutrilake.functions import segments
from nutrilake.session import remove_scratch, scratch_folder

# Largest small table we broadcast after counting it; beyond it the join
# shuffles instead.
BROADCAST_MAX_ROWS = 2_000_000


# Class / group tables that reach the driver: one (value, count) pair each.
# Beyond it the argument ``max_rows`` must be raised on purpose.
MAX_CLASSES = 1_000_000
# Up to this many classes a lookup is written into the plan; beyond it the
# classes form a table that is joined, so plans do not grow with classes.
MAX_LITERAL_CLASSES = 64


def collect_bounded(df: DataFrame, max_rows: int = MAX_CLASSES, what: str = "rows") -> list:
    """Collect a table that must be small (classes, groups): at most
    ``max_rows + 1`` rows are fetched; more is an error, never a silent cut."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"more than {max_rows} {what}: not a small table")
    return rows


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` only after counting it.

    The table is cached first so the count and the later join read the same
    materialised rows (a small derived table; losing the cache only costs a
    recomputation).  Above ``max_rows`` the unhinted table is returned and
    the optimizer plans a shuffle join.
    """
    df = df.cache()
    if df.count() <= max_rows:
        return F.broadcast(df)
    return df


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a table whose size is bounded by construction (columns x
    parameters, classes x buckets ...).  Callers state the bound."""
    return F.broadcast(df)


# --------------------------------------------------------------------------
# bucketing of an ordered domain
# --------------------------------------------------------------------------
DEFAULT_BUCKETS = 4096
STRING_BUCKETS = 1024


def _numeric_bucket_bounds(df: DataFrame, groups: list[str], value: str,
                           n_buckets: int) -> DataFrame:
    """Per group: sorted distinct approximate percentiles (equal-count cut
    points).  Exactness never depends on them -- only the balance of the
    buckets -- so a modest sketch accuracy (4 x buckets) is enough."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    return (df.groupBy(*groups)
            .agg(F.array_distinct(F.percentile_approx(F.col(value).cast("double"), probs,
                                                      max(1000, 4 * n_buckets)))
                 .alias("_bounds")))


def _string_bucket_bounds(df: DataFrame, groups: list[str], value: str, n_buckets: int) -> DataFrame:
    """Per group: the ``n_buckets`` values with the smallest hash, sorted -- a
    uniform sample of the distinct values, so buckets are even whatever the
    strings have in common.  The top-n is cut before the shuffle."""
    w = Window.partitionBy(*groups).orderBy("_hash", value)
    picked = (df.select(*groups, value, F.xxhash64(value).alias("_hash"))
              .withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n_buckets))
    return picked.groupBy(*groups).agg(F.array_sort(F.collect_set(value)).alias("_bounds"))


def count_below(sorted_arr: Column, v: Column, max_len: int) -> Column:
    """Number of elements of an ascending array strictly below ``v``
    (lower bound) by binary search: ceil(log2(max_len+1)) steps of a fold,
    instead of a linear scan over every cut point."""
    steps = max(1, math.ceil(math.log2(max_len + 1)) + 1)
    init = F.struct(F.lit(0).alias("lo"), F.size(sorted_arr).alias("hi"))

    def step(acc, _):
        lo, hi = acc["lo"], acc["hi"]
        mid = F.floor((lo + hi) / 2).cast("int")
        below = F.element_at(sorted_arr, mid + 1) < v
        return F.when(lo >= hi, acc).otherwise(
            F.when(below, F.struct((mid + 1).alias("lo"), hi.alias("hi")))
            .otherwise(F.struct(lo.alias("lo"), mid.alias("hi"))))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), init, step, lambda acc: acc["lo"])


def with_value_bucket(df: DataFrame, groups: list[str], value: str,
                      n_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Add ``_bucket``: a per-group ordinal whose order agrees with ``value``.

    Numbers: equal-count buckets from approximate percentiles of the
    (usually pre-aggregated) input.  Strings: cut points from a uniform
    sample of the distinct values.
    """
    dtype = df.schema[value].dataType
    if not groups:
        raise ValueError("with_value_bucket needs at least one group column")
    if isinstance(dtype, T.StringType):
        n_buckets = min(n_buckets, STRING_BUCKETS)
        # one row per group, each with at most STRING_BUCKETS values
        joined = df.join(bounded_broadcast(_string_bucket_bounds(df, groups, value, n_buckets)), groups, "left")
        arr = F.coalesce(F.col("_bounds"), F.array().cast("array<string>"))
        return joined.withColumn("_bucket", count_below(arr, F.col(value), n_buckets)).drop("_bounds")
    if isinstance(dtype, (T.BooleanType,)):
        return df.withColumn("_bucket", F.col(value).cast("int"))
    if n_buckets <= 1:
        return df.withColumn("_bucket", F.lit(0))
    bounds = _numeric_bucket_bounds(df, groups, value, n_buckets)
    # bound: one row per group (groups are column names / classes), each
    # with at most n_buckets-1 numbers.
    joined = df.join(bounded_broadcast(bounds), groups, "left")
    arr = F.coalesce(F.col("_bounds"), F.array().cast("array<double>"))
    bucket = count_below(arr, F.col(value).cast("double"), n_buckets)
    return joined.withColumn("_bucket", bucket).drop("_bounds")


def _bucket_offsets(bucketed: DataFrame, groups: list[str], weights: list[str]) -> DataFrame:
    totals = bucketed.groupBy(*groups, "_bucket").agg(*[F.sum(w).alias(w) for w in weights])
    w_prev = (Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))) \
        .orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(*groups, "_bucket",
                         *[F.coalesce(F.sum(w).over(w_prev), F.lit(0)).alias(f"_off_{w}")
                           for w in weights])


def running_totals(df: DataFrame, groups: list[str], value: str, weights: list[str],
                   n_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """For a table with one row per (groups, value), add ``cum_<w>``: the sum
    of ``w`` over all rows of the group with a value <= this one.

    ``df`` must already be aggregated to distinct (groups, value) rows.
    """
    b = with_value_bucket(df, groups, value, n_buckets)
    offsets = _bucket_offsets(b, groups, weights)
    w_in = Window.partitionBy(*groups, "_bucket").orderBy(value) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = b.select(*df.columns, "_bucket",
                     *[F.sum(w).over(w_in).alias(f"_loc_{w}") for w in weights])
    out = local.join(bounded_broadcast(offsets), groups + ["_bucket"], "left")  # groups x n_buckets rows
    return out.select(*df.columns,
                      *[(F.col(f"_loc_{w}") + F.col(f"_off_{w}")).alias(f"cum_{w}")
                        for w in weights])


# --------------------------------------------------------------------------
# exact quantiles
# --------------------------------------------------------------------------
def lerp(a: Column, b: Column, t: Column) -> Column:
    """Linear interpolation as numpy's quantile does it: ``a + (b-a)*t``
    below t = 0.5 and ``b - (b-a)*(1-t)`` from 0.5 on (bit-identical
    results to pandas/numpy ``quantile``)."""
    d = b - a
    return F.when(t >= 0.5, b - d * (1 - t)).otherwise(a + d * t)


def weighted_quantiles(counts: DataFrame, group: str, value: str, weight: str,
                       probs: list[float], n_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Exact quantiles from a value-count table (one row per (group, value)
    with ``weight`` rows behind it; NULL values and zero weights must be
    filtered out by the caller).  Linear interpolation as numpy does it.

    Returns (group, q ARRAY<DOUBLE>).

    Measured alternative, kept out on purpose: ranking only the buckets that
    hold the target ranks needs the bucket table in two more branches; it
    saved no scan and cost more task time (event log, sf0.1) than one
    bucketed running total, whose windows are already bounded per
    (group, bucket).
    """
    d = counts.select(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v"),
                      F.col(weight).cast("long").alias("_w"))
    cum = running_totals(d, ["_g"], "_v", ["_w"], n_buckets) \
        .withColumn("_before", F.col("cum__w") - F.col("_w"))
    n = d.groupBy("_g").agg(F.sum("_w").alias("_n"))
    prob_arr = F.array(*[F.lit(float(p)) for p in probs])
    targets = (n.select("_g", "_n", F.posexplode(prob_arr).alias("_i", "_p"))
               .withColumn("_pos", F.col("_p") * (F.col("_n") - 1))
               .withColumn("_lo", F.floor("_pos"))
               .withColumn("_hi", F.ceil("_pos"))
               .withColumn("_frac", F.col("_pos") - F.col("_lo")))
    ends = targets.select("_g", "_i", F.explode(F.array(
        F.struct(F.lit(0).alias("_end"), F.col("_lo").alias("_at")),
        F.struct(F.lit(1).alias("_end"), F.col("_hi").alias("_at")))).alias("_e")) \
        .select("_g", "_i", "_e._end", "_e._at")
    # bound: groups x probs x 2 rows.  Each distinct value probes only the
    # few targets of its group (equi-join on the group, range filter).
    hits = cum.join(bounded_broadcast(ends), "_g") \
        .where((F.col("_before") <= F.col("_at")) & (F.col("_at") < F.col("cum__w"))) \
        .groupBy("_g", "_i").agg(
            F.max(F.when(F.col("_end") == 0, F.col("_v"))).alias("_vlo"),
            F.max(F.when(F.col("_end") == 1, F.col("_v"))).alias("_vhi"))
    per_p = targets.join(hits, ["_g", "_i"]) \
        .select("_g", "_i", lerp(F.col("_vlo"), F.col("_vhi"), F.col("_frac")).alias("_q"))
    return (per_p.groupBy("_g")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_q"))),
                             lambda s: s["_q"]).alias("q"))
            .withColumnRenamed("_g", group))


def long_quantiles(long_df: DataFrame, group: str, value: str, probs: list[float],
                   method: str = "exact", accuracy: int = 10_000,
                   n_buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Quantiles of ``value`` per ``group`` with linear interpolation
    (numpy/pandas default).

    Returns one row per group with ``q`` = array of len(probs) doubles
    (all-NULL groups are absent).  ``method="approx"`` uses the
    ``percentile_approx`` sketch (rank error <= n/accuracy) instead.
    """
    d = long_df.select(F.col(group).alias("_g"), F.col(value).cast("double").alias("_v")) \
        .where(F.col("_v").isNotNull())
    if method == "approx":
        return d.groupBy("_g").agg(F.percentile_approx("_v", probs, accuracy).alias("q")) \
            .withColumnRenamed("_g", group)
    counts = d.groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_w"))
    return weighted_quantiles(counts, "_g", "_v", "_w", probs, n_buckets) \
        .withColumnRenamed("_g", group)


def bracketed_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                        accuracy: int = 10_000) -> dict[str, list[float] | None]:
    """Exact quantiles of several numeric columns from two scans.

    A sketch per column (``percentile_approx``, whose rank error is at most
    rows / accuracy) gives two values around every wanted rank.  The second
    scan counts what lies below the bracket, map-side, and shuffles only the
    distinct values inside it, about 8 / accuracy of the rows (all of a column
    with fewer than ``accuracy`` rows); the rank is then found there by ordered
    segments.  What is shuffled does not grow with the
    number of distinct values outside the brackets.
    """
    if not columns:
        return {}
    delta = 4 / accuracy            # the sketch's error, and two ranks for the interpolation
    edges = [x for p in probs for x in (max(0.0, p - delta), min(1.0, p + delta))]
    d = df.select(*[F.col(f"`{c}`").cast("double").alias(f"_c{i}") for i, c in enumerate(columns)])
    first = d.agg(*[x for i in range(len(columns)) for x in (
        F.count(f"_c{i}").alias(f"n{i}"), F.min(f"_c{i}").alias(f"lo{i}"), F.max(f"_c{i}").alias(f"hi{i}"),
        F.percentile_approx(f"_c{i}", edges, accuracy).alias(f"b{i}"))]).first()
    brackets = []                     # (group, column number, low, high): columns x probs entries
    for i in range(len(columns)):
        if first[f"n{i}"]:
            for j, p in enumerate(probs):
                few = first[f"n{i}"] < accuracy
                low = first[f"lo{i}"] if few or p - delta <= 0 else first[f"b{i}"][2 * j]
                high = first[f"hi{i}"] if few or p + delta >= 1 else first[f"b{i}"][2 * j + 1]
                brackets.append((i * len(probs) + j, i, low, high))
    if not brackets:
        return dict.fromkeys(columns)
    cells = F.explode(F.array(*[F.when(F.col(f"_c{i}") <= high, F.struct(
        F.lit(g).alias("_g"), F.when(F.col(f"_c{i}") >= low, F.col(f"_c{i}")).alias("_v")))
        for g, i, low, high in brackets])).alias("_x")
    inside = (d.select(cells).where(F.col("_x").isNotNull()).select("_x._g", "_x._v")
              .groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_w")))
    ends = []
    for g, i, _low, _high in brackets:
        pos = probs[g % len(probs)] * (first[f"n{i}"] - 1)
        ends += [(g, e, int(at)) for e, at in enumerate((math.floor(pos), math.ceil(pos)))]
    # What is inside the brackets, in order, after one NULL row for all below: the
    # value at each rank is found by one local pass per part.
    folder = scratch_folder(df.sparkSession, "brackets")
    ordered = segments.write_ordered(inside.select(
        F.col("_g").alias("feature"), F.col("_v").alias("dval"), F.lit(None).cast("string").alias("sval"),
        F.col("_w").alias("rn"), F.lit(0).cast("long").alias("cn")), folder)
    size = 1 + max(g for g, _, _ in ends)
    wanted: dict[int, list[int]] = {}
    for g, _, at in ends:
        wanted.setdefault(g, []).append(at)
    zeros = [0] * size
    _, picked = segments.levels(ordered, segments.totals(ordered), zeros, zeros, wanted)
    remove_scratch(df.sparkSession, folder)
    column_of = {g: i for g, i, _, _ in brackets}
    found = {(g, e): picked[g][at] for g, e, at in ends if at in picked[g]
             and not (math.isnan(picked[g][at]) and not math.isnan(first[f"hi{column_of[g]}"]))}
    if len(found) < len(ends):
        raise RuntimeError("a quantile lies outside its bracket")
    out: dict[str, list[float] | None] = dict.fromkeys(columns)
    for g, i, _low, _high in brackets:
        a, b = found[(g, 0)], found[(g, 1)]
        pos = probs[g % len(probs)] * (first[f"n{i}"] - 1)
        t = pos - math.floor(pos)
        value = b - (b - a) * (1 - t) if t >= 0.5 else a + (b - a) * t
        out[columns[i]] = (out[columns[i]] or []) + [value]
    return out


def column_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                     method: str = "exact", **kw) -> dict[str, list[float] | None]:
    """Quantiles for several numeric columns in one job; returns a small
    dict on the driver (columns x probs numbers -- fitted state)."""
    if not columns:
        return {}
    long_df = unpivot_numeric(df, columns)
    rows = long_quantiles(long_df, "column", "value", probs, method, **kw).collect()
    found = {r["column"]: list(r["q"]) if r["q"] is not None else None for r in rows}
    return {c: found.get(c) for c in columns}


def unpivot_numeric(df: DataFrame, columns: list[str], name: str = "column",
                    value: str = "value") -> DataFrame:
    """Wide numeric columns -> long (name, value DOUBLE); NULLs kept."""
    cols = [F.col(c).cast("double").alias(c) for c in columns]
    return df.select(*cols).unpivot([], columns, name, value)


# --------------------------------------------------------------------------
# ranks in a seeded hash order
# --------------------------------------------------------------------------
NULL_KEY = "\u2400"     # stands for NULL in order keys


def seeded_order_key(seed: int, *key_cols: str | Column) -> Column:
    """md5 of ``'<seed>:<key>'`` (several key columns joined by '|'; a NULL
    key counts as the marker NULL_KEY).

    The same hex digest comes out of Spark and DuckDB, so an SQL oracle can
    reproduce every split and sample.  Uniform over [0, 16^32).
    """
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_KEY))
             for c in key_cols]
    key = parts[0] if len(parts) == 1 else F.concat_ws("|", *parts)
    return F.md5(F.concat(F.lit(f"{seed}:"), key))


def row_order_key(df: DataFrame, seed: int, *key_cols: str) -> Column:
    """64 hex digits: ``seeded_order_key`` of the keys, then the md5 of all
    columns (NULL cells as NULL_KEY, joined by '|').  Rows that share a key are
    ordered by their other columns; only rows equal in every column tie."""
    return F.concat(seeded_order_key(seed, *key_cols), whole_row_key(df))


def whole_row_key(df: DataFrame) -> Column:
    """md5 of all columns, NULL cells as NULL_KEY, joined by '|'."""
    def text(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        plain = not isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType))
        return F.coalesce(c.cast("string") if plain else F.to_json(F.struct(c)), F.lit(NULL_KEY))
    return F.md5(F.concat_ws("|", *[text(f) for f in df.schema]))


def hash_prefix_len(max_group_rows: int, rows_per_bucket: int = 1_000_000) -> int:
    """Hex digits of the order key used as bucket: enough buckets that one
    bucket holds about ``rows_per_bucket`` rows of the largest group."""
    need = max(1, math.ceil(max_group_rows / rows_per_bucket))
    return min(8, max(2, math.ceil(math.log(need, 16)) if need > 1 else 2))


def hash_rank(df: DataFrame, order_key: str, groups: list[str] | None = None,
              tiebreak: list[str] | None = None, prefix_len: int = 3,
              rank_col: str = "_rank") -> DataFrame:
    """Exact ``row_number() over (partition by groups order by order_key,
    tiebreak)`` for a uniformly distributed hex ``order_key``.

    Bucket = first ``prefix_len`` hex digits; bucket counts (groups x 16^p
    rows) give offsets, the window only spans one (group, bucket).
    """
    groups = list(groups or [])
    tiebreak = list(tiebreak or [])
    b = df.withColumn("_bucket", F.substring(F.col(order_key), 1, prefix_len))
    counts = b.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_cnt"))
    w_prev = (Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))) \
        .orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*groups, "_bucket",
                            F.coalesce(F.sum("_cnt").over(w_prev), F.lit(0)).alias("_off"))
    w_in = Window.partitionBy(*groups, "_bucket").orderBy(order_key, *tiebreak)
    ranked = b.withColumn("_rn", F.row_number().over(w_in))
    # groups x 16^prefix_len rows; counted before it is broadcast.
    out = ranked.join(checked_broadcast(offsets), groups + ["_bucket"], "left")
    return out.withColumn(rank_col, (F.col("_off") + F.col("_rn")).cast("long")) \
        .drop("_bucket", "_rn", "_off")


# --------------------------------------------------------------------------
# value-count tables (one shuffle feeding many per-column measures)
# --------------------------------------------------------------------------
def value_counts_long(df: DataFrame, numeric: list[str], strings: list[str],
                      side: Column | None = None, keep_nulls: bool = True,
                      order_col: str | None = None) -> DataFrame:
    """(column, dval, sval[, _side], n): rows per distinct value of every
    column.  Numeric columns carry their value in ``dval`` (DOUBLE), the
    others in ``sval`` (STRING); NULL cells form their own row when
    ``keep_nulls``.  One projection (a single scan of ``df``), one explode,
    one map-side-combined aggregation: a value that holds a third of the
    table is one row after the partial step.
    """
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("dval"),
                      F.lit(None).cast("string").alias("sval")) for c in numeric]
    cells += [F.struct(F.lit(c).alias("column"), F.lit(None).cast("double").alias("dval"),
                       F.col(c).cast("string").alias("sval")) for c in strings]
    extra = [side.alias("_side")] if side is not None else []
    pos = [F.col(order_col).alias("_pos")] if order_col else []
    long_df = df.select(*extra, *pos, F.explode(F.array(*cells)).alias("_c")) \
        .select(*(["_side"] if side is not None else []), *(["_pos"] if order_col else []),
                "_c.column", "_c.dval", "_c.sval")
    if not keep_nulls:
        long_df = long_df.where(F.col("dval").isNotNull() | F.col("sval").isNotNull())
    keys = ["column", "dval", "sval"] + (["_side"] if side is not None else [])
    aggs = [F.count(F.lit(1)).alias("n")]
    if order_col:     # first appearance of each value (min of an orderable position)
        aggs.append(F.min("_pos").alias("first_pos"))
    return long_df.groupBy(*keys).agg(*aggs)


def counted(vc: DataFrame, present: Column, weight: str = "n") -> Column:
    """Filter condition ``present AND weight > 0`` written as ONE expression
    over the aggregate output, so the optimizer cannot push part of it below
    the shared aggregation (which would fork the plan and re-read the
    source instead of reusing the one shuffle)."""
    return F.coalesce(F.when(present, F.col(weight)), F.lit(0)) > 0


def side_value_counts(reference: DataFrame, current: DataFrame, numeric: list[str],
                      strings: list[str]) -> DataFrame:
    """(column, dval, sval, rn, cn): rows per distinct non-NULL value in the
    reference (rn) and in the current table (cn) -- one projection per
    side, one aggregation for both."""
    cols = numeric + strings
    both = reference.select(*cols, F.lit(0).alias("_s")) \
        .unionByName(current.select(*cols, F.lit(1).alias("_s")))
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("dval"),
                      F.lit(None).cast("string").alias("sval")) for c in numeric]
    cells += [F.struct(F.lit(c).alias("column"), F.lit(None).cast("double").alias("dval"),
                       F.col(c).cast("string").alias("sval")) for c in strings]
    long_df = both.select("_s", F.explode(F.array(*cells)).alias("_c")) \
        .select("_s", "_c.column", "_c.dval", "_c.sval") \
        .where(F.col("dval").isNotNull() | F.col("sval").isNotNull())
    return long_df.groupBy("column", "dval", "sval").agg(
        F.count_if(F.col("_s") == 0).alias("rn"), F.count_if(F.col("_s") == 1).alias("cn"))


def _class_table(df: DataFrame, group: str | None, name: str, rows: list[tuple], columns: str) -> DataFrame:
    """Driver rows (class, ...) as a table to join with ``_g``."""
    kind = df.schema[group].dataType.simpleString() if group is not None else "int"
    return df.sparkSession.createDataFrame(rows, f"{name} {kind}, {columns}")


def hash_thresholds(df: DataFrame, order_key: str, group: str | None, tiebreak: list[str],
                    quotas, prefix_len: int = 3, max_cut_rows: int = 1_000_000,
                    key_len: int = 32, leading: tuple[str, int] | None = None) -> tuple[dict, dict, dict]:
    """Cut keys for "the first q rows of each group in (order_key,
    tiebreak) order", with ``order_key`` a uniform hex hash of ``key_len`` digits.

    ``quotas`` is a dict group -> q, or a function of the group totals
    returning that dict (so one pass yields both the totals and the cuts).
    Returns (thresholds, totals, tied): thresholds[g] = the (order_key,
    *tiebreak) tuple of the q-th row of g, tied[g] = how many of the rows with
    exactly that key belong to the first q; ``group`` None means one group with
    key None.

    Passes over ``df``: one aggregation (rows per hex-prefix bucket: at most
    groups x 16^p rows), then only rows of the cut buckets (one per group):
    a cut bucket above ``max_cut_rows`` rows is re-cut with a longer prefix,
    and the final row_number runs over <= max_cut_rows rows per group.  Groups
    meet their cut in joins with a table of one row per group, so the plan has
    the same size for any number of groups.  ``leading`` names a column that
    holds the first so many digits of ``order_key``, where they cost less than
    all of it.
    The split / sample itself is then ``within_threshold``.
    """
    gcol = F.col(group) if group is not None else F.lit(0)
    b = df.withColumn("_g", gcol)

    def digits(n: int) -> Column:
        return F.col(leading[0] if leading and n <= leading[1] else order_key)

    counts = (b.groupBy("_g", F.substring(digits(prefix_len), 1, prefix_len).alias("_bucket"))
              .agg(F.count(F.lit(1)).alias("_cnt"))).cache()
    totals = {r["_g"]: r["_n"] for r in collect_bounded(
        counts.groupBy("_g").agg(F.sum("_cnt").alias("_n")), what="groups")}
    if group is not None and None in totals:
        counts.unpersist()
        raise ValueError("NULL group values cannot be stratified")
    public_totals = totals if group is not None else {None: totals.get(0, 0)}
    wanted = quotas(public_totals) if callable(quotas) else dict(quotas)
    wanted = {(g if group is not None else 0): q for g, q in wanted.items() if q > 0}
    if not wanted:
        counts.unpersist()
        return {}, public_totals, {}
    state = {}          # current cut per group: (prefix, rank inside the bucket)
    level, plen = counts, prefix_len
    pending = dict(wanted)
    while pending:
        asked = _class_table(df, group, "_gq", list(pending.items()), "_q long")
        w = Window.partitionBy("_g").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        cuts = collect_bounded(
            level.withColumn("_off", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
            .join(bounded_broadcast(asked), F.col("_g") == F.col("_gq"))
            .where((F.col("_off") < F.col("_q")) & (F.col("_q") <= F.col("_off") + F.col("_cnt")))
            .select("_g", "_bucket", (F.col("_q") - F.col("_off")).alias("_r"), "_cnt"), what="groups")
        if level is not counts:
            level.unpersist()
        big = {}
        for c in cuts:
            state[c["_g"]] = (c["_bucket"], c["_r"])
            if c["_cnt"] > max_cut_rows and plen < key_len:
                big[c["_g"]] = c["_r"]
        if not big:
            break
        # re-cut the large buckets with a longer prefix (rows of those buckets only)
        again = _class_table(df, group, "_gb", [(g, state[g][0]) for g in big], "_pre string")
        before, plen = plen, min(key_len, plen + 2)
        level = (b.join(bounded_broadcast(again), (F.col("_g") == F.col("_gb"))
                        & F.startswith(digits(before), F.col("_pre")))
                 .groupBy("_g", F.substring(digits(plen), 1, plen).alias("_bucket"))
                 .agg(F.count(F.lit(1)).alias("_cnt"))).cache()
        pending = big
    counts.unpersist()
    ends = _class_table(df, group, "_gc", [(g, pre, r) for g, (pre, r) in state.items()],
                        "_pre string, _r long")
    wr = Window.partitionBy("_g").orderBy(order_key, *tiebreak)
    hit = collect_bounded(
        b.join(bounded_broadcast(ends), (F.col("_g") == F.col("_gc"))
               & F.startswith(digits(max(len(pre) for pre, _ in state.values())), F.col("_pre")))
        .withColumn("_rn", F.row_number().over(wr)).withColumn("_rk", F.rank().over(wr))
        .where(F.col("_rn") == F.col("_r"))
        .select("_g", order_key, *tiebreak, (F.col("_rn") - F.col("_rk") + 1).alias("_tied")), what="groups")
    name = (lambda g: g) if group is not None else (lambda g: None)
    cut_keys = {name(r["_g"]): tuple(r[c] for c in [order_key] + list(tiebreak)) for r in hit}
    return cut_keys, public_totals, {name(r["_g"]): r["_tied"] for r in hit}


def within_threshold(df: DataFrame, order_key: str, tiebreak: list[str], group: str | None,
                     thresholds: dict, name: str) -> DataFrame:
    """Add the boolean ``name``: the row's (order_key, tiebreak) is <= its
    group's threshold (False for groups without one)."""
    cols = [order_key] + list(tiebreak)
    row = F.struct(*[F.col(c) for c in cols])

    def lit_struct(t):
        return F.struct(*[F.lit(v).alias(c) for v, c in zip(t, cols)])

    if group is None:
        t = thresholds.get(None)
        return df.withColumn(name, (row <= lit_struct(t)) if t is not None else F.lit(False))
    if len(thresholds) <= MAX_LITERAL_CLASSES:
        inside = F.lit(False)
        for g, t in thresholds.items():
            inside = inside | ((F.col(group) == F.lit(g)) & (row <= lit_struct(t)))
        return df.withColumn(name, F.coalesce(inside, F.lit(False)))
    kinds = ", ".join(f"_t{i} {df.schema[c].dataType.simpleString()}" for i, c in enumerate(cols))
    table = _class_table(df, group, "_gt", [(g, *t) for g, t in thresholds.items()], kinds)
    ends = F.struct(*[F.col(f"_t{i}").alias(c) for i, c in enumerate(cols)])
    # one row per class, counted on the driver
    joined = df.join(bounded_broadcast(table), F.col(group) == F.col("_gt"), "left")
    return (joined.withColumn(name, F.coalesce(row <= ends, F.lit(False)))
            .drop("_gt", *[f"_t{i}" for i in range(len(cols))]))
