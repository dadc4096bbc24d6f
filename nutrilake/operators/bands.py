"""A3 as a search: the fewest bands of a number in which one label holds.

``stats.label_determinism`` checks one given banding.  Here the cuts are found: the
distinct values are dealt to range partitions, every task joins neighbours with the
same label to runs, and only the runs at the edges of tasks, two a task, meet on the
driver to be joined across them.
"""
from __future__ import annotations

import sys

from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nutrilake import schema as S
from nutrilake.functions.ordered import bounded_broadcast, collect_bounded
from nutrilake.session import scratch_folder

# Functions that run in Python workers are shipped by value: executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])

_RUN = "low double, high double, label string, rows long, violations long, first boolean, last boolean"


def _runs(batches):
    """Sorted (value, label, rows, violations) -> runs of one label; the first and
    the last run of the task are marked."""
    import pyarrow as pa

    out: list[list] = []
    begun = False

    def batch_of(rows):
        kinds = (pa.float64(), pa.float64(), pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                                          names=["low", "high", "label", "rows", "violations", "first", "last"])

    for batch in batches:
        for value, label, rows, wrong in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if out and out[-1][2] == label:
                out[-1][1] = value
                out[-1][3] += rows
                out[-1][4] += wrong
            else:
                out.append([value, value, label, rows, wrong, not begun, False])
                begun = True
        if len(out) > 1:
            yield batch_of(out[:-1])
            del out[:-1]
    if out:
        out[-1][6] = True
        yield batch_of(out)


def label_bands(df: DataFrame, column: str, label: str = S.TARGET_COLUMN) -> DataFrame:
    """(low, high, label, rows, violations): maximal runs of distinct values of
    ``column`` (as double, ends included) with the same label.

    The label of a value is its most frequent one, ties to the smaller, NULL (a label
    like any other) before all; violations are the rows with another label.  No
    banding with fewer bands has as few violations.  NULL values belong to no band,
    NaN comes after every number, -0.0 equals 0.0; an empty table has no bands.
    """
    cells = (df.select(F.col(f"`{column}`").cast("double").alias("v"), F.col(f"`{label}`").cast("string").alias("label"))
             .where(F.col("v").isNotNull()).groupBy("v", "label").agg(F.count(F.lit(1)).alias("k")))
    values = (cells.groupBy("v").agg(F.min_by("label", F.struct(-F.col("k"), F.col("label"))).alias("label"),
                                     F.sum("k").alias("n"), F.max("k").alias("most"))
              .select("v", "label", "n", (F.col("n") - F.col("most")).alias("wrong")))
    folder = scratch_folder(df.sparkSession, "bands")
    (values.repartitionByRange("v").sortWithinPartitions("v").mapInArrow(_runs, _RUN).write.parquet(folder))
    runs = df.sparkSession.read.schema(_RUN).parquet(folder)
    # At most two rows a task.
    edges = sorted(collect_bounded(runs.where("first OR last"), what="tasks"),
                   key=lambda r: (r["low"] != r["low"], r["low"]))
    starts, begin = [], None
    for before, now in zip([None, *edges], edges):
        if not (before and before["last"] and now["first"] and before["label"] == now["label"]):
            begin = now["low"]
        starts.append((now["low"], begin))
    table = bounded_broadcast(df.sparkSession.createDataFrame(starts, "_low double, _begin double"))
    return (runs.join(table, F.col("low") == F.col("_low"), "left")
            .groupBy(F.coalesce("_begin", "low").alias("_band"), "label")
            .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("rows").alias("rows"),
                 F.sum("violations").alias("violations"))
            .select("low", "high", "label", "rows", "violations"))
