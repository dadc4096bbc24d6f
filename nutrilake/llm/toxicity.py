"""Operator 3: toxicity by a linear classifier over character n-grams whose
features are scaled by naive Bayes log-count ratios.

Features are the character n-grams (3 to 6) of the lower-cased text, present or
not.  Training, on labelled rows only:

1. documents with each n-gram are counted per class in hashed cells, and cells
   whose log-odds stand out from chance are kept;
2. inside those cells exact 64-bit n-grams are counted per class; the
   ``MAX_FEATURES`` that stand out most become the features, each with its
   ratio r = log((p + a) / (P + 2a)) - log((q + a) / (Q + 2a));
3. a logistic regression is fitted on present * r.

A score is sigmoid(bias + sum of weight * r over the features present), so a
text of any length is judged whole and an empty text scores by the bias.

Scale: labelled rows are sampled by class and hash down to about ``MAX_TRAIN_ROWS``
(the documented bound of the fit), so counting, the model and what the driver
holds do not grow with the corpus.  Scoring is one narrow pass over all texts;
most n-grams are turned away by a bit table that fits the cache.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nutrilake.llm.common import small_batches, written

ORDERS = (3, 4, 5, 6)
MAX_TRAIN_ROWS = 16_000
MAX_FEATURES = 8_192
CELL_BITS = 20
MIN_Z = 4.0
SMOOTH = 0.5
THRESHOLD = 0.3
CHUNK = 1 << 19      # characters handled at once

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def sample_sizes(pos: int, neg: int, max_rows: int) -> tuple[int, int]:
    """Rows of either class in the sample: toxic ones up to half the bound, or more if others are few."""
    toxic = min(pos, max(max_rows // 2, max_rows - neg))
    return toxic, min(neg, max_rows - toxic)


def hash_cut(rows: int, total: int) -> int:
    """The largest 64-bit hash taken when about ``rows`` of ``total`` rows are wanted."""
    return max(-(1 << 63), -(1 << 63) + (1 << 64) * rows // max(1, total) - 1)


def _chunks(texts: list[str], longest: int):
    """Lists of (row, string): all texts in order, padded by a space at both
    ends; long ones in overlapping parts, so that no n-gram is lost."""
    chunk: list[tuple[int, str]] = []
    size = 0
    for row, text in enumerate(texts):
        text = f" {text.lower()} "
        for at in range(0, max(1, len(text) - longest + 1), CHUNK):
            part = text[at:at + CHUNK + longest - 1]
            chunk.append((row, part))
            size += len(part)
            if size >= CHUNK:
                yield chunk
                chunk, size = [], 0
    if chunk:
        yield chunk


def _grams(chunk: list[tuple[int, str]], orders: tuple[int, ...]):
    """Yields (row of each n-gram, 64-bit hash of each n-gram) per order."""
    codes = np.frombuffer("".join(s for _, s in chunk).encode("utf-32-le", "surrogatepass"),
                          np.uint32).astype(np.uint64)
    sizes = np.array([len(s) for _, s in chunk])
    part = np.repeat(np.arange(len(chunk), dtype=np.int32), sizes)
    rows = np.array([r for r, _ in chunk])
    value = codes + np.uint64(1)
    rolling, n = value, 1
    while n < max(orders):
        rolling = rolling[:-1] * _MULTIPLIER + value[n:]
        n += 1
        if n in orders and len(rolling):
            mixed = rolling ^ (rolling >> np.uint64(29))
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            mixed ^= mixed >> np.uint64(32)
            inside = part[:len(rolling)] == part[n - 1:]
            yield rows, part, inside, mixed


def _cells(mixed: np.ndarray) -> np.ndarray:
    return (mixed >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _count_cells(orders):
    def count(batches):
        import pyarrow as pa

        totals = np.zeros((2, 1 << CELL_BITS), np.int32)
        for batch in batches:
            texts, toxic = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for row, text in enumerate(texts):
                found = [_cells(m[ok]) for chunk in _chunks([text], max(orders))
                         for _, _, ok, m in _grams(chunk, orders)]
                if found:
                    totals[int(toxic[row])][np.unique(np.concatenate(found))] += 1
        cells = np.flatnonzero(totals.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells), pa.array(totals[1][cells]), pa.array(totals[0][cells])],
            names=["cell", "pos", "neg"])
    return count


def _count_grams(orders, wanted: np.ndarray):
    def count(batches):
        import pyarrow as pa

        table = np.zeros(1 << CELL_BITS, bool)
        table[wanted] = True
        for batch in batches:
            texts, toxic = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            grams, label = [], []
            for row, text in enumerate(texts):
                found = [g[table[_cells(g)]] for chunk in _chunks([text], max(orders))
                         for _, _, ok, m in _grams(chunk, orders) for g in (m[ok],)]
                if found:
                    own = np.unique(np.concatenate(found))
                    grams.append(own)
                    label.append(np.full(len(own), toxic[row], np.int64))
            if grams:
                key, at = np.unique(np.concatenate(grams), return_inverse=True)
                is_pos = np.concatenate(label)
                pos = np.bincount(at, weights=is_pos, minlength=len(key)).astype(np.int64)
                neg = np.bincount(at, minlength=len(key)) - pos
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(pos), pa.array(neg)],
                    names=["gram", "pos", "neg"])
    return count


class Features:
    """The chosen n-grams: sorted hashes with a bit table in front."""

    def __init__(self, grams: np.ndarray, orders: tuple[int, ...]):
        self.grams, self.orders = grams, orders
        self.table = np.zeros(1 << CELL_BITS, bool)
        self.table[_cells(grams)] = True

    def present(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(row, feature) pairs, each once."""
        n, pairs = len(self.grams), [np.zeros(0, np.int64)]
        for chunk in _chunks(texts, max(self.orders)):
            for rows, part, inside, mixed in _grams(chunk, self.orders):
                at = np.flatnonzero(self.table[_cells(mixed)])
                at = at[inside[at]]
                gram = mixed[at]
                feature = np.minimum(np.searchsorted(self.grams, gram), n - 1)
                hit = self.grams[feature] == gram
                pairs.append(rows[part[at[hit]]] * n + feature[hit])
        pair = np.unique(np.concatenate(pairs))
        return pair // n, pair % n


def _fit_logistic(row: np.ndarray, feature: np.ndarray, ratio: np.ndarray, label: np.ndarray,
                  penalty: float = 1.0, rounds: int = 300) -> tuple[np.ndarray, float]:
    """L2-regularised logistic regression on present * ratio by gradient
    descent with momentum and adaptive steps; returns weights and bias."""
    n, x = len(ratio), ratio[feature]
    weight, bias = np.zeros(n), float(np.log((label.sum() + 1) / (len(label) - label.sum() + 1)))
    square = np.bincount(feature, weights=x * x, minlength=n) / 4 + penalty
    velocity, speed = np.zeros(n), 0.0
    mean_active = max(1.0, len(row) / max(1, len(label)))
    for _ in range(rounds):
        margin = bias + np.bincount(row, weights=weight[feature] * x, minlength=len(label))
        error = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label
        slope = np.bincount(feature, weights=error[row] * x, minlength=n) + penalty * weight
        velocity = 0.9 * velocity - 0.5 * slope / square / mean_active
        speed = 0.9 * speed - 0.5 * error.sum() / (len(label) / 4) / mean_active
        weight, bias = weight + velocity, bias + speed
    return weight, bias


class ToxicityModel:
    def __init__(self, grams: np.ndarray, weights: np.ndarray, bias: float, orders: tuple[int, ...]):
        self.grams, self.weights, self.bias, self.orders = grams, weights, bias, orders

    def score(self, docs: DataFrame, text: str = "text", name: str = "score") -> DataFrame:
        """Add the score of every whole text; null and empty texts get the bias."""
        small_batches(docs.sparkSession)
        fields = [f for f in docs.schema if f.name != name]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + f", {name} double"
        grams, weights, bias, orders = self.grams, self.weights, self.bias, self.orders
        at = [f.name for f in fields].index(text)

        def run(batches):
            import pyarrow as pa

            features = Features(grams, orders) if len(grams) else None
            for batch in batches:
                texts = [t or "" for t in batch.column(at).to_pylist()]
                margin = np.full(len(texts), bias)
                if features and texts:
                    row, feature = features.present(texts)
                    margin += np.bincount(row, weights=weights[feature], minlength=len(texts))
                score = 1 / (1 + np.exp(-np.clip(margin, -50, 50)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)],
                                                 names=[*batch.schema.names, name])

        return docs.select(*[f"`{f.name}`" for f in fields]).mapInArrow(run, schema)


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS,
                 max_features: int = MAX_FEATURES, orders: tuple[int, ...] = ORDERS) -> ToxicityModel:
    """Fit on the rows of ``docs`` that ``labels`` (doc_id, toxic) marks and
    that are not held out.  Null labels and null doc_ids are ignored; a doc_id
    labelled twice is toxic if any label says so; a document that occurs twice
    counts twice.  About ``max_rows`` rows, picked by the hash of doc_id, are
    used: every toxic one up to half of them, others for the rest; the bias is
    corrected for it.  Without a row of either class every text scores by the
    prior.
    """
    small_batches(docs.sparkSession)
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()
                          & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    pos, neg = known.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first()
    want_pos, want_neg = sample_sizes(pos, neg, max_rows)
    # Log-odds in the corpus less those in the sample.
    shift = float(np.log(want_neg / neg) - np.log(want_pos / pos)) if want_pos and want_neg else 0.0
    cut = F.when(F.col("toxic") == 1, F.lit(hash_cut(want_pos, pos))).when(
        F.col("toxic") == 0, F.lit(hash_cut(want_neg, neg)))
    # Bounded by max_rows, so it may be broadcast whatever the corpus.
    sample = F.broadcast(known.where(F.xxhash64("doc_id") <= cut))
    rows = written(docs.select("doc_id", "text").join(sample, "doc_id").repartition(8, "doc_id")
                   .select(F.coalesce("text", F.lit("")).alias("text"), "toxic"), "train")
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_pos, n_neg = n.get(1, 0), n.get(0, 0)
    prior = float(np.log((n_pos + 1) / (n_neg + 1))) + shift
    if not n_pos or not n_neg:
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), prior, orders)
    a = F.lit(SMOOTH)
    ratio = (F.log((F.col("pos") + a) / (n_pos + 2 * SMOOTH))
             - F.log((F.col("neg") + a) / (n_neg + 2 * SMOOTH)))
    z = F.abs(ratio) / F.sqrt(1 / (F.col("pos") + a) + 1 / (F.col("neg") + a))

    def top(counts: DataFrame, key: str):
        return (counts.groupBy(key).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
                .select(key, ratio.alias("ratio"), z.alias("z")).where(F.col("z") >= MIN_Z)
                .orderBy(F.desc("z"), key).limit(max_features).collect())

    cells = np.array([r["cell"] for r in top(
        rows.mapInArrow(_count_cells(orders), "cell long, pos int, neg int"), "cell")], np.int64)
    if not len(cells):
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), prior, orders)
    chosen = top(rows.mapInArrow(_count_grams(orders, cells), "gram long, pos long, neg long"), "gram")
    grams = np.array([r["gram"] for r in chosen], np.int64).view(np.uint64)
    if not len(grams):
        return ToxicityModel(grams, np.zeros(0), prior, orders)
    order = np.argsort(grams)
    grams, ratios = grams[order], np.array([r["ratio"] for r in chosen])[order]

    def active(batches):
        import pyarrow as pa

        features = Features(grams, orders)
        for batch in batches:
            row, feature = features.present(batch.column(0).to_pylist())
            parts = np.split(feature.astype(np.int32), np.searchsorted(row, np.arange(1, batch.num_rows)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([p.tolist() for p in parts], pa.list_(pa.int32()))],
                names=["toxic", "features"])

    # At most max_rows rows of feature numbers: the bounded sample of the fit.
    found = rows.mapInArrow(active, "toxic int, features array<int>").toArrow()
    lists = found.column("features").combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    label = found.column("toxic").to_numpy().astype(float)
    weight, bias = _fit_logistic(np.repeat(np.arange(len(label)), lengths),
                                 lists.values.to_numpy().astype(np.int64), ratios, label)
    return ToxicityModel(grams, weight * ratios, bias + shift, orders)


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with held_out, score and predicted added."""
    scored = fit_toxicity(docs, labels).score(docs)
    return (scored.withColumn("held_out", held_out(F.col("doc_id")))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))
