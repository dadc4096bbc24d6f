"""Passes over a value-count table in the order of its values.

The table has one row per (feature, value): ``rn`` rows of a reference and ``cn``
of a current table.  ``write_ordered`` deals it to range partitions and writes
each in order.  A *segment* is a run of one feature inside one part, as one task
reads it; segments of a feature do not overlap, so the order of their first
values is the order of their rows.  A first pass gives every segment's totals;
prefix sums of those (a row per segment and feature, on the driver) are the
offsets from which every later pass counts on locally -- no window over a
feature, no join.
"""
from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nutrilake.functions.stats import PSI_EPSILON

# Functions that run in Python workers are shipped by value: executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])

PSI_UNIT = 1 << 50      # terms are added as whole numbers, so the sum does not depend on the parts
_COLUMNS = ("part", "feature", "dval", "sval", "rn", "cn")


@dataclass
class Segment:
    feature: int
    first: object            # number or string
    r: int
    c: int
    distinct: int            # values that the reference has
    before_r: int = 0
    before_c: int = 0


def write_ordered(counts: DataFrame, folder: str) -> DataFrame:
    """(part, feature, dval, sval, rn, cn) as Parquet in ``folder``, sorted in each file."""
    spark = counts.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["feature", "dval", "sval"]
    (counts.repartitionByRange(n, *order).sortWithinPartitions(*order)
     .withColumn("part", F.spark_partition_id()).write.parquet(folder))
    return spark.read.schema("feature int, dval double, sval string, rn long, cn long, part int").parquet(folder) \
        .select(*_COLUMNS)


def _runs(batches):
    """(starts a segment, feature, first value, dval, rn, cn) for every run of
    one (part, feature) in a batch; a run that goes on from the batch before
    does not start a segment."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part, feature = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero((part[1:] != part[:-1]) | (feature[1:] != feature[:-1])) + 1
        dval = batch.column(2).to_numpy(zero_copy_only=False)
        rn, cn = batch.column(4).to_numpy(), batch.column(5).to_numpy()
        for at, end in zip([0, *cuts], [*cuts, len(part)]):
            key = (part[at], feature[at])
            value = batch.column(2)[at].as_py()
            yield (key != last, int(feature[at]), batch.column(3)[at].as_py() if value is None else value,
                   dval[at:end], rn[at:end], cn[at:end])
            last = key


def totals(ordered: DataFrame) -> list[Segment]:
    """All segments, with the totals of the segments before them."""
    def run(batches):
        import pyarrow as pa

        out: list[list] = []
        for new, feature, first, _, rn, cn in _runs(batches):
            if new:
                number = not isinstance(first, str)
                out.append([feature, first if number else None, None if number else first, 0, 0, 0])
            out[-1][3] += int(rn.sum())
            out[-1][4] += int(cn.sum())
            out[-1][5] += int((rn > 0).sum())
        kinds = (pa.int32(), pa.float64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)],
                                         names=["feature", "dval", "sval", "r", "c", "distinct"])

    # Ordered as Spark orders values (NaN last), a row per segment.
    rows = (ordered.mapInArrow(run, "feature int, dval double, sval string, r long, c long, distinct long")
            .orderBy("feature", "dval", "sval").collect())
    found = [Segment(r["feature"], r["sval"] if r["dval"] is None else r["dval"], r["r"], r["c"], r["distinct"])
             for r in rows]
    for a, b in zip(found, found[1:]):
        if a.feature == b.feature:
            b.before_r, b.before_c = a.before_r + a.r, a.before_c + a.c
    return found


def _key(feature: int, first) -> tuple:
    return feature, "nan" if isinstance(first, float) and math.isnan(first) else first


def levels(ordered: DataFrame, found: list[Segment], n_r, n_c,
           wanted: dict[int, list[int]]) -> tuple[np.ndarray, dict[int, dict[int, float]]]:
    """The KS statistic of every feature, and the reference values at the
    ``wanted`` ranks (from 0) of features."""
    before = {_key(s.feature, s.first): (s.before_r, s.before_c) for s in found}
    ranks = {f: np.array(sorted(set(r)), np.int64) for f, r in wanted.items()}
    all_r, all_c = [int(n) for n in n_r], [int(n) for n in n_c]

    def run(batches):
        import pyarrow as pa

        out: list[tuple] = []
        furthest: dict[int, float] = {}
        for new, feature, first, dval, rn, cn in _runs(batches):
            if new:
                at_r, at_c = before[_key(feature, first)]
            r, c = at_r + np.cumsum(rn), at_c + np.cumsum(cn)
            share_r = r / all_r[feature] if all_r[feature] else r * 0.0
            share_c = c / all_c[feature] if all_c[feature] else c * 0.0
            furthest[feature] = max(furthest.get(feature, 0.0), float(np.abs(share_r - share_c).max()))
            if feature in ranks:
                own = ranks[feature]
                own = own[(own >= at_r) & (own < r[-1])]
                out += [(feature, int(k), float(v)) for k, v in zip(own, dval[np.searchsorted(r, own, side="right")])]
            at_r, at_c = int(r[-1]), int(c[-1])
        out += [(f, -1, v) for f, v in furthest.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int64()),
             pa.array([o[2] for o in out], pa.float64())], names=["feature", "rank", "value"])

    ks, picked = np.zeros(len(all_r)), {f: {} for f in wanted}
    # One row per (feature, rank).
    for row in (ordered.mapInArrow(run, "feature int, rank long, value double")
                .groupBy("feature", "rank").agg(F.max("value").alias("value")).collect()):
        if row["rank"] < 0:
            ks[row["feature"]] = row["value"]
        else:
            picked[row["feature"]][row["rank"]] = row["value"]
    return ks, picked


def ranks(probs: list[float], n: int) -> list[int]:
    """The ranks on both sides of every quantile of ``n`` values."""
    return [k for p in probs for k in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))]


def quantiles(probs: list[float], n: int, at: dict[int, float]) -> list[float]:
    """Linear quantiles with numpy's two-branch interpolation, from the values at ``ranks``."""
    out = []
    for p in probs:
        place = p * (n - 1)
        a, b, t = at[math.floor(place)], at[math.ceil(place)], place - math.floor(place)
        out.append(b - (b - a) * (1 - t) if t >= 0.5 else a + (b - a) * t)
    return out


def psi(ordered: DataFrame, n_r, n_c, inner: dict[int, np.ndarray]) -> np.ndarray:
    """PSI of every feature: over right-closed bins with the inner edges of
    ``inner``, over single values for the other features."""
    all_r, all_c = [int(n) for n in n_r], [int(n) for n in n_c]

    def term(r, c, f):
        a = np.maximum(r / all_r[f] if all_r[f] else r * 0.0, PSI_EPSILON)
        b = np.maximum(c / all_c[f] if all_c[f] else c * 0.0, PSI_EPSILON)
        return (b - a) * np.log(b / a)

    def run(batches):
        import pyarrow as pa

        cells: dict[int, np.ndarray] = {}
        sums: dict[int, int] = {}
        for _, feature, _, dval, rn, cn in _runs(batches):
            if feature in inner:
                bins = len(inner[feature]) + 1
                at = np.searchsorted(inner[feature], dval, side="left")
                own = cells.setdefault(feature, np.zeros((2, bins), np.int64))
                np.add.at(own[0], at, rn)
                np.add.at(own[1], at, cn)
            else:
                sums[feature] = sums.get(feature, 0) + int(np.rint(term(rn, cn, feature) * PSI_UNIT).astype(np.int64).sum())
        out = [(f, i, int(own[0, i]), int(own[1, i]), 0) for f, own in cells.items() for i in range(own.shape[1])]
        out += [(f, -1, 0, 0, s) for f, s in sums.items()]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)],
                                         names=["feature", "bin", "r", "c", "s"])

    found = np.zeros(len(all_r))
    # One row per (feature, bin).
    for row in (ordered.mapInArrow(run, "feature int, bin int, r long, c long, s long")
                .groupBy("feature", "bin").agg(F.sum("r").alias("r"), F.sum("c").alias("c"), F.sum("s").alias("s"))
                .orderBy("feature", "bin").collect()):
        f = row["feature"]
        found[f] += row["s"] / PSI_UNIT if row["bin"] < 0 else float(term(np.float64(row["r"]), np.float64(row["c"]), f)) \
            if row["r"] or row["c"] else 0.0
    return found


def numbered(ordered: DataFrame, found: list[Segment], start: int = 0) -> DataFrame:
    """(feature, sval, place): the strings (all with ``rn`` above 0) numbered from
    ``start`` in the order of the table, feature after feature; one local pass from
    the segments' offsets."""
    offsets, at = {}, start
    for s in found:
        offsets[_key(s.feature, s.first)] = at
        at += s.distinct

    def run(batches):
        import pyarrow as pa

        last, place = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part, feature = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero((part[1:] != part[:-1]) | (feature[1:] != feature[:-1])) + 1
            places = np.empty(len(part), np.int64)
            for at, end in zip([0, *cuts], [*cuts, len(part)]):
                key = (part[at], feature[at])
                if key != last:
                    place = offsets[_key(int(feature[at]), batch.column(3)[int(at)].as_py())]
                places[at:end] = np.arange(place, place + end - at)
                place, last = place + end - at, key
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(3), pa.array(places)],
                                             names=["feature", "sval", "place"])

    return ordered.mapInArrow(run, "feature int, sval string, place long")
