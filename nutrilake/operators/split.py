"""Stratified split and folds (L1-L4).

Rows are ordered inside each class by a seeded md5 of the key; the first
``test quota`` rows of a class go to test.  Quotas are exact (largest
remainder, as the stratified splitter of scikit-learn computes them).  The
split needs only each class's cut key (``hash_thresholds``: bucket counts
plus a rank inside one cut bucket per class), after which it is a column
predicate.  Folds dealt round-robin need every rank and use ``hash_rank`` (windows
per (class, hash bucket)); folds that are blocks of the same order need k - 1 cuts
per class (``rank_cuts``) and no shuffle of the rows.  No class is ever one window
partition.
"""
from __future__ import annotations

import math
import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nutrilake import schema as S
from nutrilake.functions import cuts
from nutrilake.functions.ordered import (bounded_broadcast, collect_bounded, hash_prefix_len, hash_rank,
                                         hash_thresholds, seeded_order_key, whole_row_key, within_threshold)


def class_counts(df: DataFrame, target: str) -> dict[str, int]:
    """Rows per class (one small aggregation; K rows to the driver)."""
    return {r[0]: r[1] for r in collect_bounded(df.groupBy(target).agg(F.count(F.lit(1))),
                                                what="classes")}


def train_allocation(counts: dict, n_draws: int) -> dict:
    """Largest-remainder allocation of ``n_draws`` over classes in
    proportion to ``counts``; equal remainders are served in class order."""
    total = sum(counts.values())
    classes = sorted(counts, key=lambda c: (c is None, c))
    cont = {c: counts[c] / total * n_draws for c in classes}
    alloc = {c: math.floor(cont[c]) for c in classes}
    need = n_draws - sum(alloc.values())
    by_rem = sorted(classes, key=lambda c: (-(cont[c] - alloc[c]), classes.index(c)))
    for c in by_rem[:need]:
        alloc[c] += 1
    return alloc


def test_quotas(counts: dict, test_size: float) -> dict:
    """Test rows per class: n_test = ceil(test_size * n); train gets the
    largest-remainder share of n - n_test, test the rest of each class."""
    n = sum(counts.values())
    if min(counts.values()) < 2:
        raise ValueError("The least populated class has only 1 member; "
                         "every class needs at least 2 rows for a stratified split.")
    n_test = math.ceil(test_size * n) if test_size < 1 else int(test_size)
    n_train = n - n_test
    k = len(counts)
    if n_test < k or n_train < k:
        raise ValueError(f"test ({n_test}) and train ({n_train}) sizes must be at least "
                         f"the number of classes ({k})")
    train = train_allocation(counts, n_train)
    return {c: counts[c] - train[c] for c in counts}


def ranked_in_class(df: DataFrame, target: str, key: str | list[str], seed: int,
                    counts: dict) -> DataFrame:
    """Add ``_rank``: row_number within the class in md5(seed:key) order."""
    keys = [key] if isinstance(key, str) else list(key)
    ordered = df.withColumn("_order", seeded_order_key(seed, *keys))
    plen = hash_prefix_len(max(counts.values()) if counts else 1)
    return hash_rank(ordered, "_order", [target], keys, prefix_len=plen).drop("_order")


def stratified_split(df: DataFrame, target: str = S.TARGET_COLUMN, test_size: float = 0.2,
                     seed: int = 42, key: str | list[str] = S.ID_COLUMN,
                     split_col: str = "split") -> DataFrame:
    """L1: add ``split`` = 'train' / 'test'; sizes exact and disjoint.

    Test rows of a class are its first ``quota`` rows in md5(seed:key)
    order.  The cut is found once per class (``hash_thresholds``), so the
    split itself is a column predicate: no window and no shuffle when the
    split frame is read again.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ordered = df.withColumn("_order", seeded_order_key(seed, *keys))
    cuts, _totals, _tied = hash_thresholds(ordered, "_order", target, keys,
                                           lambda counts: test_quotas(counts, test_size))
    marked = within_threshold(ordered, "_order", keys, target, cuts, "_test")
    return (marked.withColumn(split_col, F.when(F.col("_test"), "test").otherwise("train"))
            .drop("_order", "_test"))


def train_test(df: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    s = stratified_split(df, **kw)
    col = kw.get("split_col", "split")
    return (s.where(F.col(col) == "train").drop(col), s.where(F.col(col) == "test").drop(col))


def _check_folds(counts: dict, k: int) -> None:
    largest, smallest = max(counts.values()), min(counts.values())
    if k < 2:
        raise ValueError("k must be at least 2")
    if k > largest:
        raise ValueError(f"n_splits={k} cannot be greater than the number of members "
                         f"in each class ({largest})")
    if k > smallest:
        warnings.warn(f"The least populated class has only {smallest} members, "
                      f"which is less than n_splits={k}.", stacklevel=3)


def fold_sizes(counts: dict, k: int) -> dict:
    """Rows of every class per fold: the rows sorted by class are dealt
    round-robin, so folds differ by one row at most, in all and per class."""
    out, at = {}, 0
    for c in sorted(counts):
        end = at + counts[c]
        out[c] = [(end - 1 - f) // k - (at - 1 - f) // k for f in range(k)]
        at = end
    return out


def stratified_fold_blocks(df: DataFrame, k: int = 5, target: str = S.TARGET_COLUMN, seed: int = 42,
                           key: str | list[str] = S.ID_COLUMN, fold_col: str = "fold",
                           max_cut_rows: int = cuts.MAX_CUT_ROWS) -> DataFrame:
    """L2 without a shuffle of the rows: a class in md5(seed:key) order is cut
    into k blocks of ``fold_sizes`` rows, and a row's fold is the number of cuts
    of its class that it comes after.

    Rows with equal keys are ordered by their other columns.  Rows equal in every
    column that lie across a cut are taken as one row with a count and dealt out
    again in the sizes that the folds need.  An empty table stays empty; a NULL
    target is an error, as in the split.  Columns must have an order of equality
    (no maps).
    """
    keys = [key] if isinstance(key, str) else list(key)
    order, row = seeded_order_key(seed, *keys), whole_row_key(df)
    sizes: dict = {}

    def ends(totals: dict) -> dict:
        if not totals:
            return {}
        _check_folds(totals, k)
        sizes.update(fold_sizes(totals, k))
        return {c: [sum(n[:f + 1]) for f in range(k - 1)] for c, n in sizes.items()}

    found, totals = cuts.rank_cuts(df, target, order, row, ends, max_cut_rows)
    if not totals:
        return df.withColumn(fold_col, F.lit(0))
    steps, tied = [], []
    for c, own in found.items():
        # an empty block repeats the rank before it (0 has no cut: every row comes after it)
        at = {x.rank: x for x in own}
        bounds = [sum(sizes[c][:f + 1]) for f in range(k - 1)]
        steps.append((c, [at[b].key if b else "" for b in bounds]))
        for x in {x.key: x for x in own if x.inside < x.rows}.values():
            for f in range(k):
                low, high = ([0] + bounds + [totals[c]])[f:f + 2]
                n = min(high, x.before + x.rows) - max(low, x.before)
                if n > 0:
                    tied.append((c, x.key, f, n))
    spark, kind = df.sparkSession, df.schema[target].dataType.simpleString()
    table = bounded_broadcast(spark.createDataFrame(steps, f"_fg {kind}, _cuts array<string>"))  # a row per class
    # The order columns are made once, before the comparison with every cut.
    keyed = df.withColumn("_ok", order).join(table, F.col(f"`{target}`") == F.col("_fg"))
    passed = F.filter("_cuts", lambda c: cuts.after(c, F.col("_ok"), row))
    out = keyed.withColumn("_fold", F.size(passed).cast("int"))
    if not tied:
        return out.select(*[F.col(f"`{c}`") for c in df.columns], F.col("_fold").alias(fold_col))
    # at most k - 1 keys per class
    split_keys = bounded_broadcast(spark.createDataFrame(
        [(c, x) for c, x in {(t[0], t[1]) for t in tied}], f"_tg {kind}, _tk string"))
    parts = bounded_broadcast(spark.createDataFrame(tied, f"_tg {kind}, _tk string, _tf int, _tn long"))
    same = (F.col("_fg") == F.col("_tg")) & (F.col("_ok") == F.substring("_tk", 1, cuts.KEY_DIGITS)) \
        & (row == F.substring("_tk", cuts.KEY_DIGITS + 1, cuts.KEY_DIGITS))
    rest = out.join(split_keys, same, "left_anti")
    names = [F.col(f"`{c}`") for c in df.columns]
    one = out.join(split_keys, same, "left_semi").select(*names, "_fg", "_ok").dropDuplicates()
    chunk = F.lit(100_000)
    copies = (one.join(parts, same)
              .withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_tn") - 1, chunk.cast("long"))))
              .repartition(F.col("_from"), F.col("_tf"))
              .withColumn("_c", F.explode(F.sequence(F.col("_from"), F.least(F.col("_tn"), F.col("_from") + chunk) - 1))))
    return rest.select(*names, F.col("_fold").alias(fold_col)).unionByName(
        copies.select(*names, F.col("_tf").alias(fold_col)))


def stratified_folds(df: DataFrame, k: int = 5, target: str = S.TARGET_COLUMN, seed: int = 42,
                     key: str | list[str] = S.ID_COLUMN, fold_col: str = "fold") -> DataFrame:
    """L2: ``fold`` in 0..k-1; each row is validation exactly once and each
    class is dealt round-robin over the folds in hash order.  Rows with a NULL
    key are dealt like any other; a NULL target is an error, as in the split."""
    counts = class_counts(df, target)
    if None in counts:
        raise ValueError("NULL group values cannot be stratified")
    _check_folds(counts, k)
    ranked = ranked_in_class(df, target, key, seed, counts)
    return ranked.withColumn(fold_col, ((F.col("_rank") - 1) % k).cast("int")).drop("_rank")


def recombine(train: DataFrame, test: DataFrame) -> DataFrame:
    """L3: train and test back into one frame (by column name)."""
    return train.unionByName(test)


def features_and_label(df: DataFrame, feature_cols: list[str], label: str = S.TARGET_COLUMN,
                       key: str | None = S.ID_COLUMN) -> DataFrame:
    """L4: the id (when present), feature columns and the label, side by
    side (X and y never lose their alignment)."""
    keep = ([key] if key and key in df.columns else []) + feature_cols + \
        ([label] if label in df.columns else [])
    return df.select(*keep)
