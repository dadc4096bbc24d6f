"""Operator 10: removal of repeated byte strings by prefix-free parsing.

Triggers of a rolling hash cut every text into phrases; equal text is cut
alike, so repeats can be found among phrases instead of among all positions.

* Trigger: the leftmost minimum of a rolling 16-byte hash over the next 256
  positions.  (A minimum, not a residue, so that phrases are bounded on any
  text.)  Every start of a 400-byte string belongs to one trigger, the one its
  string chooses; the starts of one trigger are a run, the *phrase*.
* Dictionary: phrases by K, the hash of the 145 bytes from the trigger that
  all their strings share, and S, the hash of the whole phrase with its context
  (from its first start to the end of its last string).
* Parse: (document, place, K, S) for every phrase.
* Corpus order: equal 400-byte strings have equal triggers, hence equal K, so
  the suffix order, as deep as 400 bytes, is needed only inside a K.  Where S
  occurs twice all strings of the phrase do.  Where K meets several S, the
  strings of one phrase per S are ordered by their own hashes (with K: 128
  bits).  Neighbours in the order are only compared for equality, so ranks of
  suffixes are never materialised.

Scale: one row per ~128 bytes is shuffled, and one per byte only near the ends
of repeats.  Copies collapse to (K, S) with map-side combine; joins back are
ordinary joins whose hot keys Spark can split.  Texts are shuffled only for
documents that hold a repeated K, told by a bitmap of fixed size (2 MB).
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nutrilake.llm.common import small_batches, written

LENGTH = 400
GRAM = 16
REACH = 256                     # positions a trigger is the minimum of; a power of two
SHARED = LENGTH - REACH + 1     # bytes from the trigger that all strings of a phrase share
CHUNK = 1 << 20
FILTER_BITS = 24


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any byte ranges of one buffer (polynomials modulo 2^64)."""

    LETTERS = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, base: int):
        n = len(data)
        if base not in self.powers or len(self.powers[base][0]) < n + 1:
            inverse = pow(base, -1, 1 << 64)
            self.powers[base] = tuple(np.concatenate(
                [np.ones(1, np.uint64), np.cumprod(np.full(max(n, CHUNK) + 1024, b, np.uint64))])
                for b in (base, inverse))
        power, self.inverse = self.powers[base]
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(self.LETTERS[data] * power[:n], out=self.prefix[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.prefix[stop] - self.prefix[start]) * self.inverse[start]


BASE_1, BASE_2 = 0x2545F4914F6CDD1D, 0x9E6C63D0876A9A47


def phrases(data: np.ndarray, ends: np.ndarray, starts: np.ndarray):
    """Phrases of documents starts[i]:ends[i] of one buffer.

    Returns (document, first start, starts - 1, K, S), one entry per phrase.
    """
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    one = Rolling(data, BASE_1)
    n = len(data) - GRAM + 1
    low = one.prefix[GRAM:] - one.prefix[:-GRAM]
    low *= one.inverse[:n]
    low = _mix(low)
    low &= ~np.uint64(0xFFFFFF)
    low |= np.arange(n, dtype=np.uint64)        # equal hashes: the leftmost
    step = 1
    while step < REACH:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    trigger = (low & np.uint64(0xFFFFFF)).astype(np.int64)
    valid = np.zeros(len(trigger) + 1, np.int32)
    room = ends - starts >= LENGTH
    np.add.at(valid, starts[room], 1)
    np.add.at(valid, np.minimum(ends[room] - LENGTH + 1, len(trigger)), -1)
    at = np.flatnonzero(np.cumsum(valid[:-1]) > 0)
    if not len(at):
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    t = trigger[at]
    edge = np.flatnonzero((np.diff(at) != 1) | (np.diff(t) != 0))
    first, last = at[np.append(0, edge + 1)], at[np.append(edge, len(at) - 1)]
    t = trigger[first]
    key = one.of(t, t + SHARED)
    whole = Rolling(data, BASE_2).of(first, last + LENGTH)
    place = _mix(((t - first) * 4096 + (last - first)).astype(np.uint64))
    return np.searchsorted(starts, first, side="right") - 1, first, last - first, _mix(key), _mix(whole) ^ place


def _buffers(rows):
    """Texts gathered into buffers of about CHUNK bytes: (data, starts, ends,
    index of the row, place of the part in its text).  Long texts come in parts
    that overlap by LENGTH - 1, so every string lies in one part."""
    parts, size = [], 0
    for i, text in rows:
        raw = np.frombuffer(text, np.uint8)
        for at in range(0, max(1, len(raw) - LENGTH + 1), CHUNK):
            part = raw[at:at + CHUNK + LENGTH - 1]
            parts.append((i, at, part))
            size += len(part)
            if size >= CHUNK:
                yield _buffer(parts)
                parts, size = [], 0
    if parts:
        yield _buffer(parts)


def _buffer(parts):
    ends = np.cumsum([len(p) for _, _, p in parts])
    return (np.concatenate([p for _, _, p in parts]), ends - [len(p) for _, _, p in parts], ends,
            np.array([i for i, _, _ in parts]), np.array([at for _, at, _ in parts]))


def _parse(batches):
    import pyarrow as pa

    for batch in batches:
        ids, hashes = batch.column(0), batch.column(1)
        texts = batch.column(2)
        rows = ((i, texts[i].as_py().encode("utf-8", "surrogatepass")) for i in range(batch.num_rows))
        for data, starts, ends, index, offset in _buffers(
                (i, t) for i, t in rows if len(t) >= LENGTH):
            doc, first, span, key, whole = phrases(data, ends, starts)
            if len(doc):
                row = pa.array(index[doc])
                yield pa.RecordBatch.from_arrays(
                    [ids.take(row), hashes.take(row), pa.array((first - starts[doc] + offset[doc])),
                     pa.array(span.astype(np.int32)), pa.array(key.view(np.int64)), pa.array(whole.view(np.int64))],
                    names=["doc_id", "th", "first", "span", "k", "s"])


def _strings(batches):
    """The hash of every 400-byte string of the given phrases of a document;
    ``at`` is -1 for a phrase that needs no answer."""
    import pyarrow as pa

    for batch in batches:
        for i in range(batch.num_rows):
            data = np.frombuffer(batch.column(1)[i].as_py().encode("utf-8", "surrogatepass"), np.uint8)
            found = batch.column(2)[i].values
            first, span, key, own = (found.field(n).to_numpy(zero_copy_only=False)
                                     for n in ("first", "span", "k", "own"))
            for lo in range(0, len(first), 4096):
                f, c = first[lo:lo + 4096], span[lo:lo + 4096].astype(np.int64) + 1
                phrase = np.repeat(np.arange(len(f)), c)
                p = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c) + f[phrase]
                base = int(f.min())
                roll = Rolling(data[base:int(p.max()) + LENGTH], BASE_2)
                value = _mix(roll.of(p - base, p - base + LENGTH))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.full(len(p), i))),
                     pa.array(np.where(own[lo:lo + 4096][phrase], p, -1)),
                     pa.array(key[lo:lo + 4096][phrase]), pa.array(value.view(np.int64))],
                    names=["probe", "at", "k", "h"])


def _removed(size: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Bytes covered by the strings that start in first..last (per entry)."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, np.minimum(last + LENGTH, size), -1)
    return np.cumsum(change[:-1]) > 0


def repeated_starts(docs: DataFrame) -> DataFrame:
    """(doc_id, th, runs): per document text the runs [first, last] of starts
    whose 400-byte string starts anywhere else too; th = xxhash64(text)."""
    texts = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"),
                        F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    parse = written(texts.where(F.octet_length("text") >= LENGTH).mapInArrow(
        _parse, f"doc_id {kind}, th long, first long, span int, k long, s long"), "parse")
    dictionary = written(parse.groupBy("k", "s").agg(F.count("*").alias("n")), "dictionary")
    keys = (dictionary.groupBy("k").agg(F.count("*").alias("n_s"), F.sum("n").alias("n_k"))
            .where(F.col("n_k") >= 2).select("k", "n_s"))
    # The places of every phrase whose K occurs twice.
    found = written(parse.join(dictionary.join(keys, "k"), ["k", "s"]), "found")
    # S occurs twice: the whole phrase repeats, wherever it stands.
    whole = (found.where(F.col("n") >= 2).groupBy("doc_id", "th").agg(F.collect_list(F.struct(
        "first", (F.col("first") + F.col("span")).alias("last"))).alias("runs")))
    # K meets several S: one phrase of each is looked at string by string.
    place = F.struct("doc_id", "th", "first", "span")
    several = found.where(F.col("n_s") >= 2)
    single = several.where(F.col("n") == 1).select("k", place.alias("e"), F.lit(True).alias("own"))
    copies = (several.where(F.col("n") >= 2).groupBy("k", "s").agg(F.min(place).alias("e"))
              .select("k", "e", F.lit(False).alias("own")))
    probes = written(
        single.unionByName(copies).groupBy("e.doc_id", "e.th")
        .agg(F.collect_list(F.struct("e.first", "e.span", "k", "own")).alias("found"))
        .withColumn("probe", F.monotonically_increasing_id()), "probes")
    some = possible(texts, probes, kind)
    asked = some.dropDuplicates(["doc_id", "th"]).join(
        probes.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "probe", "found"),
        F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")))
    strings = asked.select("probe", "text", "found").mapInArrow(
        _strings, "probe long, at long, k long, h long")
    same = F.count("*").over(Window.partitionBy("k", "h"))
    points = (strings.withColumn("n", same).where((F.col("n") >= 2) & (F.col("at") >= 0))
              .groupBy("probe").agg(F.collect_list(F.struct(F.col("at").alias("first"), F.col("at").alias("last"))).alias("runs")))
    named = points.join(probes.select("probe", "doc_id", "th"), "probe").select("doc_id", "th", "runs")
    return whole.unionByName(named).groupBy("doc_id", "th").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def id_bitmap(ids: DataFrame) -> np.ndarray:
    """A bit per hash value of doc_id: at most 2^FILTER_BITS bits reach the driver."""
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))
    rows = (ids.select(h.alias("h")).groupBy(F.bitmap_bucket_number("h").alias("b"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("h")).alias("bits")).collect())
    bits = np.zeros((1 << FILTER_BITS) // 8 + 8192, np.uint8)
    for r in rows:
        at = (r["b"] - 1) * 4096 if r["b"] else 0
        bits[at:at + 4096] |= np.frombuffer(r["bits"], np.uint8)
    return bits


def _held(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    # bitmap_bucket_number(h) = 1 + (h - 1) / 32768 and bitmap_bit_position(h) = (h - 1) % 32768 for h > 0;
    # h = 0 has bucket 0 and position 0, that is, it shares the bit of h = 1.
    x = np.maximum(h - 1, 0)
    return (bits[x >> 3] >> (x & 7).astype(np.uint8)) & 1 > 0


def possible(texts: DataFrame, ids: DataFrame, kind: str, inside: bool = True) -> DataFrame:
    """Rows of (doc_id, th, text) whose doc_id may be in ``ids`` (inside), by
    the bitmap, so that other texts are not shuffled; or those surely not in it."""
    bits = id_bitmap(ids)

    def keep(batches):
        import pyarrow as pa
        for batch in batches:
            held = _held(bits, batch.column(3).to_numpy())
            yield pa.RecordBatch.from_arrays(batch.columns[:3], names=batch.schema.names[:3]).filter(
                pa.array(held if inside else ~held))

    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))
    return texts.withColumn("h", h).mapInArrow(keep, f"doc_id {kind}, th long, text string")


def remove_repeats(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """Remove every byte covered by a LENGTH-byte string that starts anywhere
    else as well, judged on the input, matches within one document only.

    One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256 and, on request, what is left as ``kept`` (binary, since a cut
    may fall inside a character).  Null text is empty; texts shorter than
    LENGTH lose nothing; a repeated row is a copy like any other; a null
    doc_id is kept as null; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"),
                        F.coalesce("text", F.lit("")).alias("text"))
    runs = written(repeated_starts(docs), "runs")
    zero = F.lit(0).cast("long")
    raw = F.col("text").cast("binary")
    extra = [raw.alias("kept")] if keep_text else []
    clean = possible(texts, runs, kind, inside=False).select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"),
        zero.alias("n_spans"), F.sha2(raw, 256).alias("kept_sha256"), *extra)
    r = runs.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "runs")
    held = possible(texts, runs, kind).join(
        r, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left")

    def cut(batches):
        import hashlib

        import pyarrow as pa
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for text, found in zip(batch.column(1), batch.column(2)):
                data = np.frombuffer(text.as_py().encode("utf-8", "surrogatepass"), np.uint8)
                gone = np.zeros(len(data), bool)
                if found.is_valid and len(found.values):
                    gone = _removed(len(data), found.values.field("first").to_numpy(),
                                    found.values.field("last").to_numpy())
                spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
                rest = data[~gone].tobytes()
                for values, value in zip(out, (len(data), int(gone.sum()), spans,
                                               hashlib.sha256(rest).hexdigest(), rest)):
                    values.append(value)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            n = 5 if keep_text else 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(v, t) for v, t in zip(out[:n], types)]], names=["doc_id", *names[:n]])

    schema = (f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
              + (", kept binary" if keep_text else ""))
    return clean.unionByName(held.select("doc_id", "text", "runs").mapInArrow(cut, schema))
