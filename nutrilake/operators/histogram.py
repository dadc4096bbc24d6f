"""Histogram engine of the boosting learners (M1, M2, M8).

Features become bin numbers once (one byte each); rows are kept as a compact
table in shared storage, ``BLOCK`` of them a row and feature by feature, so that
a pass hands few large buffers to Python.  A level of *all* trees of a round -- every class, and
in cross-validation every fold's model -- costs one pass over that table:

1. each task adds the gradients, second derivatives and rows of its part into
   cells (model, class, node, feature, bin);
2. the cells are summed by a ``groupBy`` over those keys;
3. running sums over the bins of a (model, class, node, feature) give the gain
   of every split, and ``max_by`` the best one of a node.

Only the best split of each node reaches the driver.  Gradients are summed as
whole numbers (units of 2^-24), so sums do not depend on the order of rows,
partitions or retries: equal data give equal trees, bit by bit, and a fold's
model inside one joint fit equals its own separate fit.

Scores of finished rounds are recomputed from the trees inside each pass and
written back to the table every ``KEEP_EVERY`` rounds, so a pass stays cheap
however many rounds are run.
"""
from __future__ import annotations

import sys
from dataclasses import dataclass, field

import numpy as np
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nutrilake.functions.ordered import collect_bounded
from nutrilake.session import remove_scratch, scratch_folder

# Functions that run in Python workers are shipped by value: executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])

FIXED = 1 << 24          # one gradient is a whole number of 1 / FIXED
MIN_GAIN = 1e-9          # a split must gain more than rounding can feign
KEEP_EVERY = 8           # rounds between two writes of the scores
BLOCK = 1 << 13          # rows of the input in one row of the table
BATCH_BYTES = 32 << 20   # of blocks read or handed to Python at once
GROUP_CELLS = 1 << 12    # features are counted together while their joint cells are so few
COUNT_UNIT = 1 << 36     # a block's second derivatives add up to less
QUANTILE_ACCURACY = 10_000
ALWAYS, NEVER = -1, -2   # fold of rows that train every model, or none (validation)

CELLS = "model int, class int, node int, feature int, bin int, g long, h long, n long"


@dataclass(frozen=True)
class Settings:
    objective: str           # "softmax" or "logistic" (one against the rest)
    rounds: int
    depth: int
    step: float
    min_rows: int = 1
    l2: float = 1.0
    rate: float = 1.0        # share of the rows that a round sees
    seed: int = 42


@dataclass
class Round:
    """The trees of one round: arrays (model, class, heap place); the children
    of place i are 2i + 1 and 2i + 2, a leaf has feature -1."""
    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, models: int, classes: int, depth: int) -> "Round":
        shape = (models, classes, 2 ** (depth + 1) - 1)
        return cls(np.full(shape, -1, np.int32), np.zeros(shape, np.int32), np.zeros(shape), np.zeros(shape))


@dataclass
class Forest:
    """What a fit returns: thresholds per feature, init scores and rounds for
    every model, and (iteration, split, value) log losses of model 0."""
    thresholds: list[np.ndarray]
    init: np.ndarray
    rounds: list[Round] = field(default_factory=list)
    losses: list[tuple] = field(default_factory=list)
    passes: int = 0


# ------------------------------------------------------------ binning
def fit_thresholds(rows: DataFrame, features: str, max_bins: int) -> list[np.ndarray]:
    """Split candidates per feature of the vector column ``features``.

    A feature of at most ``max_bins`` values is cut midway between each two of
    them, any other at ``max_bins - 1`` approximate quantiles.  A value goes left of a
    cut when it is not greater; NaN goes right of all.
    """
    values = rows.select(vector_to_array(features).alias("x"))

    def few(batches):
        import pyarrow as pa

        seen: list[np.ndarray] = []
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                seen = seen or [np.zeros(0)] * x.shape[1]
                for f in range(x.shape[1]):
                    if len(seen[f]) <= max_bins:
                        own = np.unique(x[:, f])
                        seen[f] = np.unique(np.append(seen[f], own[~np.isnan(own)]))[:max_bins + 1] + 0.0
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(seen)), [len(s) for s in seen]).astype(np.int32)),
             pa.array(np.concatenate(seen) if seen else np.zeros(0))], names=["feature", "value"])

    # At most max_bins + 1 values of a feature are kept on the way and reach the driver.
    place = F.row_number().over(Window.partitionBy("feature").orderBy("value"))
    found = (values.mapInArrow(few, "feature int, value double").distinct()
             .withColumn("place", place).where(F.col("place") <= max_bins + 1).collect())
    width = len(values.first()["x"]) if found or values.limit(1).count() else 0
    small: list[list[float]] = [[] for _ in range(width)]
    for r in found:
        small[r["feature"]].append(r["value"])
    wide = [f for f in range(width) if len(small[f]) > max_bins]
    quantiles = {}
    if wide:
        shares = [i / max_bins for i in range(1, max_bins)]
        # A group a feature: no task merges the sketches of all of them.
        own = values.select(F.posexplode(F.array(*[F.get("x", F.lit(f)) for f in wide])).alias("place", "value")) \
            .where(~F.isnan("value")).groupBy("place") \
            .agg(F.percentile_approx("value", shares, QUANTILE_ACCURACY).alias("cuts"))
        quantiles = {wide[r["place"]]: np.unique(r["cuts"]) for r in own.collect()}
    out = []
    for f in range(width):
        if f in quantiles:
            out.append(quantiles[f])
        else:
            v = np.sort(np.array(small[f], float))
            out.append(v[:-1] + (v[1:] - v[:-1]) / 2)
    return out


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def bin_rows(x: np.ndarray, thresholds: list[np.ndarray]) -> np.ndarray:
    """Bin numbers (rows, features): how many thresholds lie below the value."""
    kind = np.uint8 if max((len(t) for t in thresholds), default=0) < 256 else np.uint16
    out = np.empty(x.shape, kind)
    for f, cuts in enumerate(thresholds):
        out[:, f] = np.searchsorted(cuts, x[:, f], side="left")
    return out


@dataclass(frozen=True)
class Binned:
    """A table of blocks that fits may share: its split candidates, and which
    features of it a fit uses (None: all)."""
    table: DataFrame
    cuts: list[np.ndarray]
    folder: str
    features: tuple[int, ...] | None = None

    @property
    def thresholds(self) -> list[np.ndarray]:
        return self.cuts if self.features is None else [self.cuts[f] for f in self.features]

    @property
    def layout(self) -> tuple:
        kind = np.uint16 if max((len(t) for t in self.cuts), default=0) >= 256 else np.uint8
        return len(self.cuts), kind, None if self.features is None else list(self.features)

    def only(self, features: list[int]) -> "Binned":
        return Binned(self.table, self.cuts, self.folder, tuple(features))

    def remove(self) -> None:
        remove_scratch(self.table.sparkSession, self.folder)


BLOCK_COLUMNS = "u long, bins binary, y binary, fold binary"


def binned_table(rows: DataFrame, features: str, label: str, fold: str | None,
                 thresholds: list[np.ndarray], validation: DataFrame | None = None) -> DataFrame:
    """Blocks (u, bins, y, fold) of the training rows, and of ``validation`` rows
    with fold NEVER: bin numbers feature by feature, labels and folds as four
    bytes each; ``u`` numbers the first row, the others follow."""
    def columns(df: DataFrame, fold_of) -> DataFrame:
        return df.select(vector_to_array(features).alias("x"), F.col(label).cast("int").alias("y"),
                         fold_of.cast("int").alias("fold"))

    both = columns(rows, F.coalesce(F.col(fold), F.lit(ALWAYS)) if fold else F.lit(ALWAYS))
    if validation is not None:
        both = both.unionByName(columns(validation, F.lit(NEVER)))

    def cut(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        u, held, size = TaskContext.get().partitionId() << 33, [], 0

        def block(n: int) -> "pa.RecordBatch":
            nonlocal u, held, size
            bins, y, fold = (np.concatenate(part, axis=-1) for part in zip(*held))
            out = pa.RecordBatch.from_arrays(
                [pa.array([u], pa.int64()), *[pa.array([part[..., :n].tobytes()], pa.binary()) for part in (bins, y, fold)]],
                names=["u", "bins", "y", "fold"])
            held, size, u = [(bins[:, n:], y[n:], fold[n:])], size - n, u + n
            return out

        for batch in batches:
            if batch.num_rows:
                if batch.column(1).null_count:
                    raise ValueError("a row to train on has no label")
                y, fold = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int32) for c in (1, 2))
                held.append((np.ascontiguousarray(bin_rows(_matrix(batch.column(0)), thresholds).T), y, fold))
                size += batch.num_rows
                while size >= BLOCK:
                    yield block(BLOCK)
        if size:
            yield block(size)

    return both.mapInArrow(cut, BLOCK_COLUMNS).repartition(rows.sparkSession.sparkContext.defaultParallelism)


def _write_blocks(blocks: DataFrame, folder: str) -> DataFrame:
    """Written in small row groups: a reader holds one at a time."""
    blocks.write.option("parquet.block.size", BATCH_BYTES).parquet(folder)
    return blocks.sparkSession.read.parquet(folder)


def bin_once(rows: DataFrame, features: str, label: str, thresholds: list[np.ndarray], fold: str | None = None,
             validation: DataFrame | None = None) -> Binned:
    """The table of blocks in a scratch folder; ``remove`` it after the last fit."""
    folder = scratch_folder(rows.sparkSession, "bins")
    return Binned(_write_blocks(binned_table(rows, features, label, fold, thresholds, validation), folder),
                  thresholds, folder)


# ------------------------------------------------------------ rows against trees
def _blocks(batches, layout: tuple):
    """(u, bins (rows, features), y, fold, scores or None) of every block."""
    width, kind, chosen = layout
    for batch in batches:
        for block in batch.to_pylist():
            y, fold = np.frombuffer(block["y"], np.int32), np.frombuffer(block["fold"], np.int32)
            bins = np.frombuffer(block["bins"], kind).reshape(width, len(y))
            yield block["u"], (bins if chosen is None else bins[chosen]).T, y, fold, block.get("s")


def _descend(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """Heap place that each row reaches in one tree after ``levels`` steps."""
    if levels <= 6:                     # whole columns are compared, node by node from the last up
        def reach(place: int, left: int):
            if not left or feature[place] < 0:
                return place
            return np.where(bins[:, feature[place]] > cut[place], reach(2 * place + 2, left - 1), reach(2 * place + 1, left - 1))

        return np.broadcast_to(reach(0, levels), len(bins))
    at = np.zeros(len(bins), np.int64)
    row = np.arange(len(bins))
    for _ in range(levels):
        f = feature[at]
        inner = f >= 0
        if not inner.any():
            break
        right = bins[row, np.maximum(f, 0)] > cut[at]
        at = np.where(inner, 2 * at + 1 + right, at)
    return at


def _add_rounds(score: np.ndarray, bins: np.ndarray, rounds: list[Round], depth: int, step: float) -> None:
    for r in rounds:
        for m in range(score.shape[1]):
            for k in range(score.shape[2]):
                at = _descend(bins, r.feature[m, k], r.bin[m, k], depth)
                score[:, m, k] += (step * r.value[m, k])[at]


def _scores(kept: bytes | None, bins: np.ndarray, init: np.ndarray, rounds: list[Round], depth: int, step: float) -> np.ndarray:
    if kept is not None:
        score = np.frombuffer(kept).reshape(len(bins), *init.shape).copy()
    else:
        score = np.tile(init, (len(bins), 1, 1))
    _add_rounds(score, bins, rounds, depth, step)
    return score


def probabilities(score: np.ndarray, objective: str) -> np.ndarray:
    """Over the last axis: softmax, or one logistic value per class (not normalised)."""
    if objective == "softmax":
        p = np.exp(score - score.max(axis=-1, keepdims=True))
        return p / p.sum(axis=-1, keepdims=True)
    return 1 / (1 + np.exp(-score))


def _losses(p: np.ndarray, y: np.ndarray, objective: str) -> np.ndarray:
    """Log loss of every row and model; one-against-rest losses are averaged over the classes."""
    own = np.take_along_axis(p, np.broadcast_to(y[:, None, None], (*p.shape[:2], 1)), axis=2)[..., 0]
    if objective == "softmax":
        return -np.log(np.maximum(own, 1e-15))
    others = np.log(np.maximum(1 - p, 1e-15)).sum(axis=2) - np.log(np.maximum(1 - own, 1e-15))
    return -(np.log(np.maximum(own, 1e-15)) + others) / p.shape[2]


def _chosen(u: np.ndarray, settings: Settings, number: int) -> np.ndarray:
    """The rows that round ``number`` sees, by a hash of the row's number."""
    x = u.astype(np.uint64) + np.uint64((settings.seed * 1_000_003 + number) % (1 << 63)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) < np.uint64(int(settings.rate * (2 ** 64 - 1)))


def _grouped(sizes: list[int], limit: int) -> list[list[int]]:
    """Features dealt into groups whose joint bins are at most ``limit`` (a
    feature of more is a group of its own)."""
    groups: list[tuple[int, list[int]]] = []
    for f in sorted(range(len(sizes)), key=lambda f: -sizes[f]):
        i = next((i for i, (cells, _) in enumerate(groups) if cells * sizes[f] <= limit), None)
        if i is None:
            groups.append((sizes[f], [f]))
        else:
            groups[i] = (groups[i][0] * sizes[f], [*groups[i][1], f])
    return [group for _, group in groups]


class _Cells:
    """Sums of one level over the blocks of a task.

    Features of a group are counted by their joint bins, and each feature's
    cells are the margins.  Second derivatives and rows share a double: within a
    block the sum of the former stays below COUNT_UNIT."""

    def __init__(self, sizes: list[int], models: int, classes: int, nodes: int):
        self.sizes, self.nodes = sizes, nodes
        self.groups = _grouped(sizes, GROUP_CELLS // nodes)
        self.cells = [int(np.prod([sizes[f] for f in group])) for group in self.groups]
        self.sums = [np.zeros((models, classes, 3, nodes * n), np.int64) for n in self.cells]

    def places(self, bins: np.ndarray) -> list[np.ndarray]:
        """The joint bin of every row, by group."""
        out = []
        for group in self.groups:
            place = bins[:, group[0]].astype(np.int64)
            for f in group[1:]:
                place *= self.sizes[f]
                place += bins[:, f]
            out.append(place)
        return out

    def add(self, m: int, k: int, places: list[np.ndarray], node, g: np.ndarray, h: np.ndarray, here: np.ndarray) -> None:
        """``here``: the rows that count, at ``node``."""
        g, both = np.where(here, g, 0.0), np.where(here, h + COUNT_UNIT, 0.0)
        if self.nodes > 1:
            node = np.where(here, node, 0)
        for place, n, sums in zip(places, self.cells, self.sums):
            index = place + node * n if self.nodes > 1 else place
            # Sums of whole numbers below 2^53 are exact in doubles.
            sums[m, k, 0] += np.bincount(index, g, self.nodes * n).astype(np.int64)
            other = np.bincount(index, both, self.nodes * n).astype(np.int64)
            sums[m, k, 1] += other & (COUNT_UNIT - 1)
            sums[m, k, 2] += other >> 36

    def rows(self):
        """Columns (model, class, node, feature, bin, g, h, n) of the cells with rows, feature by feature."""
        for group, sums in zip(self.groups, self.sums):
            joint = sums.reshape(*sums.shape[:3], self.nodes, *[self.sizes[f] for f in group])
            for i, f in enumerate(group):
                own = joint.sum(axis=tuple(4 + j for j in range(len(group)) if j != i))
                m, k, node, b = np.nonzero(own[:, :, 2])
                yield m, k, node, np.full(len(m), f), b, *(own[m, k, part, node, b] for part in range(3))


def _cells_pass(binned: Binned, init, done: list[Round], current: Round | None, level: int, number: int, settings: Settings):
    """Cells of one level of round ``number``; at level 0 also the losses of the
    rounds before (class -1, node 0 training and 1 validation rows).  With
    ``current`` None only the losses."""
    layout, sizes = binned.layout, [len(t) + 1 for t in binned.thresholds]
    models, classes = init.shape

    def run(batches):
        import pyarrow as pa

        cells = _Cells(sizes, models, classes, 2 ** level) if current is not None else None
        losses = np.zeros((models, 2, 2), np.int64)
        for u, bins, y, fold, kept in _blocks(batches, layout):
            p = probabilities(_scores(kept, bins, init, done, settings.depth, settings.step), settings.objective)
            if level == 0:
                loss = np.rint(_losses(p, y, settings.objective) * FIXED).astype(np.int64)
                for m in range(models):
                    for side, rows in enumerate(((fold != m) & (fold != NEVER), fold == NEVER)):
                        losses[m, side] += (loss[rows, m].sum(), rows.sum())
            if current is None:
                continue
            places = cells.places(bins)
            seen = fold != NEVER
            if settings.rate < 1:
                seen &= _chosen(u + np.arange(len(y)), settings, number)
            for m in range(models):
                trained = seen & (fold != m)
                for k in range(classes):
                    # A negative node: the row stopped at a leaf above.
                    node = _descend(bins, current.feature[m, k], current.bin[m, k], level) - (2 ** level - 1)
                    own = p[:, m, k]
                    cells.add(m, k, places, node, np.rint((own - (y == k)) * FIXED), np.rint(own * (1 - own) * FIXED),
                              trained & (node >= 0))
        out = []
        if level == 0:
            m, side = np.nonzero(losses[..., 1])
            zero = np.zeros(len(m), np.int64)
            out.append((m, zero - 1, side, zero, zero, losses[m, side, 0], zero, losses[m, side, 1]))
        if cells is not None:
            out += cells.rows()
        kinds = [pa.int32()] * 5 + [pa.int64()] * 3
        names = [c.split()[0] for c in CELLS.split(", ")]
        for columns in out:
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)
    return run


def best_splits(cells: DataFrame, settings: Settings) -> DataFrame:
    """(model, class, node, g, h, n, best): totals of every node and its best
    split (gain, feature, bin, gl, hl) or null.  Ties go to the lower feature,
    then the lower bin."""
    keys = ["model", "class", "node", "feature"]
    summed = cells.repartition(*keys).groupBy(*keys, "bin").agg(
        F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
    whole = "PARTITION BY model, class, node, feature"
    sums = summed.selectExpr(*keys, "bin", *[f"sum({c}) OVER ({whole} ORDER BY bin) AS {c}l" for c in "ghn"],
                             *[f"sum({c}) OVER ({whole}) AS {c}" for c in "ghn"])

    def part(g: str, h: str) -> str:
        return f"({g}) / {float(FIXED)}D * (({g}) / {float(FIXED)}D) / (({h}) / {float(FIXED)}D + {float(settings.l2)}D)"

    gain = f"{part('gl', 'hl')} + {part('g - gl', 'h - hl')} - {part('g', 'h')}"
    allowed = f"class >= 0 AND nl >= {settings.min_rows} AND n - nl >= {max(1, settings.min_rows)}"
    return (sums.selectExpr("model", "class", "node", "g", "h", "n",
                            f"CASE WHEN {allowed} THEN struct({gain} AS gain, -feature AS f, -bin AS b, gl, hl) END AS split")
            .groupBy("model", "class", "node")
            .agg(F.max("g").alias("g"), F.max("h").alias("h"), F.max("n").alias("n"), F.max("split").alias("best")))


# ------------------------------------------------------------ the fit
def _leaf(g: int, h: int, classes: int, settings: Settings) -> float:
    """Newton step; the softmax's trees move together, which (K - 1) / K makes up for."""
    share = (classes - 1) / classes if settings.objective == "softmax" else 1.0
    return -share * (g / FIXED) / (h / FIXED + settings.l2) if h / FIXED + settings.l2 > 0 else 0.0


def init_scores(counts: dict[tuple[int, int], int], models: int, classes: int, folds: bool, objective: str) -> np.ndarray:
    """Log shares (softmax) or log odds of the classes among each model's training rows."""
    out = np.zeros((models, classes))
    for m in range(models):
        n = [sum(c for (fold, y), c in counts.items() if y == k and fold != NEVER and not (folds and fold == m))
             for k in range(classes)]
        for k in range(classes):
            rest = sum(n) if objective == "softmax" else sum(n) - n[k]
            out[m, k] = np.log(max(n[k], 1) / max(rest, 1))
    return out


def fit_forest(rows: DataFrame, features: str, label: str, classes: int, settings: Settings, max_bins: int,
               fold: str | None = None, models: int = 1, validation: DataFrame | None = None,
               thresholds: list[np.ndarray] | None = None, keep=None, binned: Binned | None = None) -> Forest:
    """Train ``models`` forests together.  Without ``fold`` there is one, on all
    rows; with it, model m trains on the rows whose fold is not m.

    ``keep`` is called with (table, binned, forest, rounds that its scores do not hold)
    before the table of bins is removed.  ``binned`` holds the same rows from
    ``bin_once`` and stays.
    """
    spark = rows.sparkSession
    # Blocks are few and large.  Read when a plan runs, so left set.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    own = binned is None
    if own:
        if thresholds is None:
            thresholds = fit_thresholds(rows, features, max_bins)
        binned = bin_once(rows, features, label, thresholds, fold, validation)
    thresholds, table = binned.thresholds, binned.table
    folders = [binned.folder] if own else []
    counts = {(r["fold"], r["y"]): r["n"] for r in collect_bounded(
        _label_counts(table, binned.layout).groupBy("fold", "y").agg(F.sum("n").alias("n")), what="classes")}
    forest = Forest(thresholds, init_scores(counts, models, classes, fold is not None, settings.objective))
    done: list[Round] = []          # rounds that the table's scores do not hold yet

    def cells(current: Round | None, level: int, number: int) -> list:
        forest.passes += 1
        got = best_splits(table.mapInArrow(
            _cells_pass(binned, forest.init, done, current, level, number, settings), CELLS), settings).collect()
        for r in got:
            if r["class"] < 0 and r["model"] == 0 and number > 0:
                forest.losses.append((number, "validation" if r["node"] else "train", r["g"] / FIXED / r["n"]))
        return [r for r in got if r["class"] >= 0]

    for number in range(settings.rounds):
        trees = Round.empty(models, classes, settings.depth)
        for level in range(settings.depth):
            split = False
            for r in cells(trees, level, number):
                m, k, at = r["model"], r["class"], 2 ** level - 1 + r["node"]
                best = r["best"]
                trees.value[m, k, at] = _leaf(r["g"], r["h"], classes, settings)
                if best is not None and best["gain"] > MIN_GAIN:
                    split = True
                    trees.feature[m, k, at], trees.bin[m, k, at] = -best["f"], -best["b"]
                    trees.gain[m, k, at] = best["gain"]
                    trees.value[m, k, 2 * at + 1] = _leaf(best["gl"], best["hl"], classes, settings)
                    trees.value[m, k, 2 * at + 2] = _leaf(r["g"] - best["gl"], r["h"] - best["hl"], classes, settings)
            if not split:
                break
        forest.rounds.append(trees)
        done.append(trees)
        if len(done) == KEEP_EVERY and number + 1 < settings.rounds:
            folders.append(scratch_folder(spark, "scores"))
            table, done = _write_blocks(_with_scores(table, binned.layout, forest.init, done, settings), folders[-1]), []
            for path in folders[:-1]:
                remove_scratch(spark, path)
            del folders[:-1]
    if validation is not None:
        cells(None, 0, settings.rounds)
    result = keep(table, binned, forest, done) if keep else None
    for path in folders:
        remove_scratch(spark, path)
    return forest if keep is None else result


def _label_counts(table: DataFrame, layout: tuple) -> DataFrame:
    """(fold, y, n) of every block."""
    def run(batches):
        import pyarrow as pa

        for _, _, y, fold, _ in _blocks(batches, layout):
            pairs, n = np.unique(np.stack([fold, y]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1]), pa.array(n)], names=["fold", "y", "n"])

    return table.select("u", "bins", "y", "fold").mapInArrow(run, "fold int, y int, n long")


def _with_scores(table: DataFrame, layout: tuple, init, done, settings: Settings) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for i, (_, bins, _, _, kept) in enumerate(_blocks([batch], layout)):
                score = _scores(kept, bins, init, done, settings.depth, settings.step)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(i, 1) for c in ("u", "bins", "y", "fold")],
                     pa.array([score.tobytes()], pa.binary())], names=["u", "bins", "y", "fold", "s"])

    return table.mapInArrow(run, BLOCK_COLUMNS + ", s binary")


def left_out_predictions(table: DataFrame, layout: tuple, forest: Forest, done: list[Round], settings: Settings) -> DataFrame:
    """(fold, label, prediction, n) by block: every row judged by the model that did not train on it."""
    init = forest.init

    def run(batches):
        import pyarrow as pa

        for _, bins, y, fold, kept in _blocks(batches, layout):
            score = _scores(kept, bins, init, done, settings.depth, settings.step)
            rows = np.flatnonzero(fold >= 0)
            best = score[rows, fold[rows]].argmax(axis=1).astype(np.int32)
            judged, n = np.unique(np.stack([fold[rows], y[rows], best]), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([*map(pa.array, judged), pa.array(n)],
                                             names=["fold", "label", "prediction", "n"])

    return table.mapInArrow(run, "fold int, label int, prediction int, n long")


def node_rows(forest: Forest, model: int = 0) -> list[tuple]:
    """One model as flat rows (round, class, node, feature, threshold, left,
    right, value), nodes numbered from the root of their tree in pre-order."""
    out = []
    for number, r in enumerate(forest.rounds):
        for k in range(r.feature.shape[1]):
            nodes: list[list] = []

            def build(at: int) -> int:
                mine = len(nodes)
                f = int(r.feature[model, k, at])
                if f < 0:
                    nodes.append([-1, 0.0, -1, -1, float(r.value[model, k, at])])
                else:
                    nodes.append([f, float(forest.thresholds[f][r.bin[model, k, at]]), -1, -1, 0.0])
                    nodes[mine][2] = build(2 * at + 1)
                    nodes[mine][3] = build(2 * at + 2)
                return mine

            build(0)
            out += [(number, k, i, *n) for i, n in enumerate(nodes)]
    return out
