"""Operator 12: language identification by sparse multinomial logistic
regression on TF-IDF character n-grams.

1. The vocabulary is every character n-gram (1 to 4, lower-cased text) found in
   ``MIN_DOCS`` documents of the training rows, counted exactly by 64-bit hash.
2. Document frequencies of the vocabulary are counted over *all* documents that
   may be learned from; idf = 1 + log((1 + N) / (1 + df)).
3. A feature is SCALE * tf * idf, tf the share of the text's n-gram occurrences.
   Weights are trained by follow-the-regularised-leader with an L1 and an L2
   penalty (FTRL-Proximal): every shard of the training rows passes on from the
   same state, the shards' states are averaged after each pass.
4. One temperature, fitted on training rows that the weights have not seen,
   turns margins into probabilities; class shares of the corpus replace those of
   the sample.

A document may be learned from when its id and language are not null, it has a
letter, and ``held_out`` does not hold.  A text's language is the most probable
one (the first in order, should two tie) and ``score`` its probability.

Defined results: a text that is null or has no letter is ``und`` with score 0;
so is every text if there is nothing to learn from.  With one language to learn
every other text is that language with score 1.  A null doc_id is not held out
and teaches nothing.  Repeated rows are scored each and weigh in counts, but
teach once.  Texts are read whole, long ones in overlapping parts.

Scale: the training rows are the documented bound of the fit (``max_rows``,
shared evenly among languages, picked by hash of id and text).  The count of
document frequencies and the scoring are one narrow pass each.  Shuffled and
sent to the driver are numbers per n-gram of the vocabulary.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nutrilake.functions.ordered import collect_bounded
from nutrilake.llm.common import small_batches, written

ORDERS = (1, 2, 3, 4)
MAX_TRAIN_ROWS = 8_000
MAX_LANGUAGES = 1_000
MIN_DOCS = 5
SCALE = 100.0
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.002
PASSES = 4
SHARD_ROWS = 1_000
CALIBRATION = 8          # one training row in so many is kept for the temperature
UNKNOWN = "und"
CHUNK = 1 << 18          # characters handled at once
SLOT_BITS = 21

_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


# ------------------------------------------------------------ n-grams
def _parts(texts: list[str], longest: int) -> Iterator[list[tuple[int, str, int]]]:
    """Lists of (row, string, starts): n-grams that begin in the first
    ``starts`` characters of a string; every place of a text is one such start."""
    chunk: list[tuple[int, str, int]] = []
    size = 0
    for row, text in enumerate(texts):
        text = f" {text.lower()} "
        for at in range(0, len(text), CHUNK):
            part = text[at:at + CHUNK + longest - 1]
            chunk.append((row, part, min(CHUNK, len(text) - at)))
            size += len(part)
            if size >= CHUNK:
                yield chunk
                chunk, size = [], 0
    if chunk:
        yield chunk


def occurrences(texts: list[str], orders: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, 64-bit hash) of every n-gram occurrence, rows ascending per yield."""
    for chunk in _parts(texts, max(orders)):
        codes = np.frombuffer("".join(s for _, s, _ in chunk).encode("utf-32-le", "surrogatepass"),
                              np.uint32).astype(np.uint64) + np.uint64(1)
        sizes = np.array([len(s) for _, s, _ in chunk])
        owner = np.repeat(np.arange(len(chunk)), sizes)
        place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        left = sizes[owner] - place
        left[place >= np.array([n for *_, n in chunk])[owner]] = 0      # starts of the next part
        rows = np.array([r for r, *_ in chunk])[owner]
        rolling = codes
        for n in range(1, max(orders) + 1):
            if n > 1:
                rolling = rolling[:-1] * _MULTIPLIER + codes[n - 1:]
            if n in orders and len(rolling):
                at = np.flatnonzero(left[:len(rolling)] >= n)
                mixed = rolling[at]
                mixed ^= mixed >> np.uint64(32)
                mixed *= np.uint64(0x9FB21C651E98DF25)
                mixed ^= mixed >> np.uint64(28)
                mixed *= np.uint64(0x9FB21C651E98DF25)
                mixed ^= mixed >> np.uint64(31)
                yield rows[at], mixed


class Vocabulary:
    """Sorted n-gram hashes behind a table of their leading bits."""

    def __init__(self, grams: np.ndarray, orders: tuple[int, ...]):
        self.grams, self.orders = grams, orders
        edges = np.arange((1 << SLOT_BITS) + 1, dtype=np.uint64) << np.uint64(64 - SLOT_BITS)
        self.first = np.searchsorted(grams, edges[:-1]).astype(np.int32)
        self.first = np.append(self.first, np.int32(len(grams)))
        self.deepest = int(np.diff(self.first).max(initial=0))

    def find(self, mixed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``mixed``, feature) of the n-grams that are in the vocabulary, by place."""
        slot = (mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        feature, end = self.first[slot], self.first[slot + 1]
        hit = np.full(len(mixed), -1, np.int32)
        at = np.flatnonzero(feature < end)
        for depth in range(self.deepest):
            own = feature[at] + np.int32(depth)
            same = self.grams[own] == mixed[at]
            hit[at[same]] = own[same]
            at = at[~same & (own + 1 < end[at])]
        found = np.flatnonzero(hit >= 0)
        return found, hit[found]

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Features of one text and their tf (share of all n-gram occurrences)."""
        total, features = 0, [np.zeros(0, np.int32)]
        for _, mixed in occurrences([text], self.orders):
            total += len(mixed)
            features.append(self.find(mixed)[1])
        feature, n = np.unique(np.concatenate(features), return_counts=True)
        return feature, n / max(1, total)


# ------------------------------------------------------------ passes over documents
def _count_grams(orders: tuple[int, ...]) -> Callable:
    def count(batches):
        import pyarrow as pa

        for batch in batches:
            own = [np.unique(np.concatenate([m for _, m in occurrences([t], orders)]))
                   for t in batch.column(0).to_pylist()]
            if own:
                gram, docs = np.unique(np.concatenate(own), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(docs)],
                                                 names=["gram", "docs"])
    return count


def _count_documents(grams: np.ndarray, orders: tuple[int, ...]) -> Callable:
    """Documents of this task that hold each n-gram of the vocabulary."""
    def count(batches):
        import pyarrow as pa

        vocabulary = Vocabulary(grams, orders)
        docs, rows = np.zeros(len(grams), np.int64), max(1, (1 << 23) // len(grams))
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for at in range(0, len(texts), rows):
                some = texts[at:at + rows]
                present = np.zeros((len(some), len(grams)), bool)
                for row, mixed in occurrences(some, orders):
                    place, feature = vocabulary.find(mixed)
                    present[row[place], feature] = True
                docs += present.sum(axis=0)
        found = np.flatnonzero(docs)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(docs[found])], names=["feature", "docs"])
    return count


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The closed form of FTRL-Proximal: exact zeros where |z| <= L1."""
    return -np.sign(z) * np.maximum(np.abs(z) - L1, 0) / ((BETA + np.sqrt(n)) / ALPHA + L2)


def _softmax(margin: np.ndarray) -> np.ndarray:
    p = np.exp(margin - margin.max(axis=-1, keepdims=True))
    return p / p.sum(axis=-1, keepdims=True)


def _shard_pass(grams, orders, idf, z, n) -> Callable:
    """One pass of FTRL over the rows (text, class) of a task, from state z, n;
    the last row of the state is the bias, which bears no L1 penalty."""
    def run(batches):
        import pyarrow as pa

        vocabulary, own_z, own_n = Vocabulary(grams, orders), z.copy(), n.copy()
        rows = 0
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                feature, tf = vocabulary.counts(text)
                x = SCALE * tf * idf[feature]
                at = np.append(feature, len(grams))
                x = np.append(x, 1.0)
                w = _weights(own_z[at], own_n[at])
                w[-1] = -own_z[-1] / ((BETA + np.sqrt(own_n[-1])) / ALPHA + L2)
                error = _softmax(x @ w)
                error[label] -= 1
                slope = x[:, None] * error[None, :]
                squares = own_n[at] + slope * slope
                own_z[at] += slope - (np.sqrt(squares) - np.sqrt(own_n[at])) / ALPHA * w
                own_n[at] = squares
                rows += 1
        moved = np.flatnonzero((own_n != n).ravel())
        if rows:
            # Place -1 counts the shards.
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(-1, moved)), pa.array(np.append(1.0, (own_z - z).ravel()[moved])),
                 pa.array(np.append(0.0, (own_n - n).ravel()[moved]))], names=["at", "dz", "dn"])
    return run


def _margins(grams, orders, per_gram, bias, texts: list[str], vocabulary: Vocabulary | None = None) -> np.ndarray:
    """Margins (text, class): bias + mean over n-gram occurrences of their rows of ``per_gram``."""
    vocabulary = vocabulary or Vocabulary(grams, orders)
    total, margin = np.zeros(len(texts)), np.zeros((len(texts), len(bias)))
    for row, mixed in occurrences(texts, orders):
        total += np.bincount(row, minlength=len(texts))
        place, feature = vocabulary.find(mixed)
        if len(place):
            row = row[place]
            first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            margin[row[first]] += np.add.reduceat(per_gram[feature], first, axis=0)
    return bias + margin / np.maximum(total, 1)[:, None]


def fit_temperature(margin: np.ndarray, label: np.ndarray, shift: np.ndarray, weight: np.ndarray) -> float:
    """The temperature (0.01 to 100) with the least weighted log loss, by golden section on its logarithm.

    As in Platt scaling the targets are (N + 1) / (N + 2), not 1, so that texts
    which are all told apart do not call for certainty.
    """
    rows, classes = margin.shape
    target = np.full((rows, classes), 1 / (rows + 2) / max(1, classes - 1))
    target[np.arange(rows), label] = (rows + 1) / (rows + 2)

    def loss(log_t: float) -> float:
        p = _softmax(margin / np.exp(log_t) + shift)
        return -float((weight[:, None] * target * np.log(np.maximum(p, 1e-300))).sum())

    low, high, golden = np.log(0.01), np.log(100.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


# ------------------------------------------------------------ model
class LanguageModel:
    """Languages in order, sparse weights per n-gram, bias, temperature and the
    log of corpus share over sample share per language."""

    def __init__(self, languages: list[str], grams: np.ndarray, per_gram: np.ndarray, bias: np.ndarray,
                 temperature: float, shift: np.ndarray, orders: tuple[int, ...]):
        self.languages, self.grams, self.per_gram, self.bias = languages, grams, per_gram, bias
        self.temperature, self.shift, self.orders = temperature, shift, orders

    def predict(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``docs`` with lang_pred and score in place of columns of those names."""
        small_batches(docs.sparkSession)
        fields = [f for f in docs.schema if f.name not in ("lang_pred", "score", "_letter")]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        at = [f.name for f in fields].index(text)
        names, grams, per_gram, bias = self.languages, self.grams, self.per_gram, self.bias
        temperature, shift, orders = self.temperature, self.shift, self.orders

        def run(batches):
            import pyarrow as pa

            vocabulary = Vocabulary(grams, orders)
            for batch in batches:
                known = np.array(batch.column(batch.num_columns - 1).to_pylist(), bool) & bool(names)
                texts = batch.column(at).filter(pa.array(known)).to_pylist()
                language = np.full(batch.num_rows, UNKNOWN, object)
                score = np.zeros(batch.num_rows)
                if texts:
                    p = _softmax(_margins(grams, orders, per_gram, bias, texts, vocabulary) / temperature + shift)
                    best = p.argmax(axis=1)
                    language[known] = np.array(names, object)[best]
                    score[known] = p[np.arange(len(p)), best]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(language.tolist(), pa.string()), pa.array(score)],
                    names=[*batch.schema.names[:-1], "lang_pred", "score"])

        return (docs.select(*[f"`{f.name}`" for f in fields], has_letter(F.col(text)).alias("_letter"))
                .mapInArrow(run, f"{schema}, lang_pred string, score double"))


def even_shares(counts: list[int], total: int) -> list[int]:
    """Rows of each class in a sample of ``total``: equal, what small classes leave goes to the others."""
    shares, left = [0] * len(counts), total
    for rank, k in enumerate(sorted(range(len(counts)), key=counts.__getitem__)):
        shares[k] = min(counts[k], left // (len(counts) - rank))
        left -= shares[k]
    return shares


def fit_language(docs: DataFrame, max_rows: int = MAX_TRAIN_ROWS, orders: tuple[int, ...] = ORDERS,
                 min_docs: int = MIN_DOCS, passes: int = PASSES) -> LanguageModel:
    """Fit on the rows of ``docs`` (doc_id, text, lang) that may be learned from."""
    small_batches(docs.sparkSession)
    known = docs.select("doc_id", "text", "lang").where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
        & has_letter(F.col("text")))
    counted = sorted((r["lang"], r["n"]) for r in collect_bounded(
        known.groupBy("lang").agg(F.count("*").alias("n")), MAX_LANGUAGES, "languages"))
    languages, counts = [r[0] for r in counted], [r[1] for r in counted]
    no_grams = np.zeros(0, np.uint64)
    if len(languages) < 2:
        return LanguageModel(languages, no_grams, np.zeros((0, len(languages))), np.zeros(len(languages)),
                             1.0, np.zeros(len(languages)), orders)
    # A row is taken when its hash is below its language's cut.
    shares = even_shares(counts, max_rows)
    cuts = [-(1 << 63) + (1 << 64) * s // n - 1 for s, n in zip(shares, counts)]
    per_language = F.create_map(*[F.lit(v) for l, c, k in zip(languages, cuts, range(len(cuts))) for v in (
        l, f"{max(c, -(1 << 63))} {k}")])
    cut = F.split(F.element_at(per_language, F.col("lang")), " ")
    mark = F.xxhash64("doc_id", "text")
    # Equal rows have one hash, so they are one row of the sample: its size is bounded.
    sample = (known.withColumn("h", mark).withColumn("c", cut).where(F.col("h") <= F.col("c")[0].cast("long"))
              .groupBy("h", "doc_id").agg(F.first("text").alias("text"), F.min(F.col("c")[1].cast("int")).alias("label")))
    shards = max(1, -(-sum(shares) // SHARD_ROWS))
    sample = written(sample.repartition(shards, F.xxhash64("h", F.lit("shard"))).sortWithinPartitions("h", "doc_id")
                     .select("text", "label", (F.pmod(F.xxhash64("h", F.lit("calibration")), F.lit(CALIBRATION)) == 0)
                             .alias("aside")), "language-sample")
    fit_on, aside = sample.where(~F.col("aside")), sample.where(F.col("aside"))

    # The sample bounds the vocabulary: numbers per n-gram of it reach the driver.
    found = (fit_on.select("text").mapInArrow(_count_grams(orders), "gram long, docs long")
             .groupBy("gram").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
             .select("gram").toArrow())
    grams = np.sort(found.column("gram").to_numpy().view(np.uint64))
    k, v = len(languages), len(grams)
    df = np.zeros(v)
    if v:
        for batch in (known.select("text").mapInArrow(_count_documents(grams, orders), "feature long, docs long")
                      .groupBy("feature").agg(F.sum("docs").alias("docs")).toArrow().to_batches()):
            df[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    idf = 1 + np.log((1 + sum(counts)) / (1 + df))

    z, n = np.zeros((v + 1, k)), np.zeros((v + 1, k))
    for _ in range(passes):
        moved = (fit_on.select("text", "label")
                 .mapInArrow(_shard_pass(grams, orders, idf, z, n), "at long, dz double, dn double")
                 .groupBy("at").agg(F.sum("dz").alias("dz"), F.sum("dn").alias("dn")).toArrow())
        at, dz, dn = (moved.column(name).to_numpy() for name in ("at", "dz", "dn"))
        if not len(at):
            break
        ran, moves = dz[at < 0].sum(), at >= 0
        z.ravel()[at[moves]] += dz[moves] / ran
        n.ravel()[at[moves]] += dn[moves] / ran
    weights = _weights(z, n)
    bias = -z[-1] / ((BETA + np.sqrt(n[-1])) / ALPHA + L2)
    kept = np.flatnonzero(weights[:-1].any(axis=1))
    grams, per_gram = grams[kept], SCALE * idf[kept, None] * weights[kept]

    # Log of corpus share over sample share.
    corpus, taken = np.array(counts, float), np.maximum(np.array(shares, float), 1)
    ratio = (corpus / corpus.sum()) / (taken / taken.sum())
    shift, temperature = np.log(ratio), 1.0

    def margins(batches):
        import pyarrow as pa

        vocabulary = Vocabulary(grams, orders)
        for batch in batches:
            found = _margins(grams, orders, per_gram, bias, batch.column(0).to_pylist(), vocabulary)
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found.tolist(), pa.list_(pa.float64()))],
                                             names=["label", "margin"])

    # At most the calibration share of the sample.
    judged = aside.select("text", "label").mapInArrow(margins, "label int, margin array<double>").collect()
    if judged:
        label = np.array([r["label"] for r in judged])
        temperature = fit_temperature(np.array([r["margin"] for r in judged]), label, shift, ratio[label])
    return LanguageModel(languages, grams, per_gram, bias, temperature, shift, orders)


def identify_language(docs: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` with held_out, lang_pred and score added."""
    return (fit_language(docs, max_rows).predict(docs.drop("held_out"))
            .withColumn("held_out", held_out(F.col("doc_id"))))
