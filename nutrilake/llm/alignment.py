"""Operator 11: cross-tokenizer alignment with external spill counting.

Two tokenizers cut the same bytes, so both token sequences tile them.  Places
where both end cut a text into groups; the pieces between all ends of either
sequence are the links, one per pair of overlapping tokens.

1. Every task encodes its texts and collects one record per (pair, document)
   with its links.  When ``SPILL`` records are held they are sorted,
   radix-partitioned by A id and written as one *run*: a row per radix with
   zstd-compressed pairs, their documents, and their document counts.
2. The counts of a radix are merged by a heap over its runs, ``FAN_IN`` runs at
   a time, in levels, until one run a radix is left.  Counts are kept per run
   and pair, so the heap moves pairs, not records.
3. All pairs of an A id lie in one radix, and A-major order brings them
   together: the last merge knows each A id's highest count when it leaves it.
4. The runs are streamed against the final counts of their radix; links times
   count, and links at the highest count, go back to the documents by number.

Documents are numbered within their run, so doc_ids may repeat or be null.

Defined results: a text that is null, empty or not restored by the bytes of
either tokenizer has no tokens: zeros and an empty digest.  Strings of special
tokens inside texts are plain text.  Repeated rows are documents of their own.

Scale: texts are read once and not shuffled.  No hot token makes a large group:
what meets in a merge is at most FAN_IN sorted pair lists of one radix, each
bounded by the vocabularies; records of a pair stay with their runs.  The final
counts are broadcast only when their measured size is small.
"""
from __future__ import annotations

import heapq
import itertools
import json
import struct

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nutrilake.llm.common import small_batches, worker_cache, written

RADICES = 32
SPILL = 3_000_000          # records held by a task before it writes a run
FAN_IN = 64                # runs merged by one heap
BROADCAST_BYTES = 48 << 20
BATCH_BYTES = 32 << 20     # of compressed runs handed to Python at once
DOC_BITS = 20              # documents numbered within a run
LONG_TEXT = 1 << 16        # a list of texts is encoded at once up to this many characters, or one by one


# ------------------------------------------------------------ tokenizers
class ByteLevel:
    """Ids and token bytes of a byte-level BPE file of ``tokenizers``.

    The same vocabulary is run by ``tiktoken`` (see operator 2); texts with very
    long runs of white space go to ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import re

        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)
        # The byte-level alphabet: printable bytes stand for themselves, the others follow from 256.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(plain)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        special = {t["content"]: t["id"] for t in vocabulary["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in token): i
                 for token, i in vocabulary["model"]["vocab"].items() if token not in special}
        self.bytes_of = [b""] * (max([*ranks.values(), *special.values()]) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        for token, i in special.items():
            self.bytes_of[i] = token.encode()
        self.sizes = np.array([len(t) for t in self.bytes_of])
        # Fixed pattern of the byte-level pre-tokenizer.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self._fast = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._slow, self._long_white = Tokenizer.from_file(path), re.compile(r"\s{1000}")
        self._slow.encode_special_tokens = True

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._slow.encode(" " + t, add_special_tokens=False).ids if self._long_white.search(t)
                else self._fast.encode_ordinary(" " + t) for t in texts]


class Pieces:
    """Ids and token bytes of a ``sentencepiece`` model, which adds the space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self._model.is_byte(i) else p.replace("▁", " ").encode()
                         for i, p in enumerate(map(self._model.id_to_piece, range(self._model.vocab_size())))]
        self.sizes = np.array([len(t) for t in self.bytes_of])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


def load_tokenizer(path: str):
    """By the file's ending: ``.json`` byte-level BPE, ``.model`` sentencepiece; once per worker."""
    cache = worker_cache()
    if ("align", path) not in cache:
        cache["align", path] = ByteLevel(path) if path.endswith(".json") else Pieces(path)
    return cache["align", path]


# ------------------------------------------------------------ one batch of texts
class Aligned:
    """Tokens of a list of texts laid end to end: ids and ends of both sides,
    the document of each token, and one link per piece between ends."""

    def __init__(self, texts: list[str], a, b):
        a_ids, b_ids, used = [], [], []
        for k, (text, x, y) in enumerate(zip(texts, a.encode(texts), b.encode(texts))):
            if text:
                whole = b" " + text.encode("utf-8", "surrogatepass")
                if b"".join(map(a.bytes_of.__getitem__, x)) == whole == b"".join(map(b.bytes_of.__getitem__, y)):
                    a_ids.append(x)
                    b_ids.append(y)
                    used.append(k)
        self.n = len(texts)
        self.a, self.a_doc = self._flat(a_ids, used)
        self.b, self.b_doc = self._flat(b_ids, used)
        a_end = np.cumsum(a.sizes[self.a])
        b_end = np.cumsum(b.sizes[self.b])
        self.a_cut, self.b_cut = self._member(a_end, b_end), self._member(b_end, a_end)
        ends = np.union1d(a_end, b_end)
        self.link_a = np.searchsorted(a_end, ends)
        self.link_b = np.searchsorted(b_end, ends)

    @staticmethod
    def _flat(ids: list[list[int]], used: list[int]) -> tuple[np.ndarray, np.ndarray]:
        sizes = [len(own) for own in ids]
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.int64, sum(sizes))
        return flat, np.repeat(np.array(used, np.int64), sizes)

    @staticmethod
    def _member(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        if not len(y):
            return np.zeros(len(x), bool)
        return y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x

    def per_document(self, documents: np.ndarray) -> np.ndarray:
        return np.bincount(documents, minlength=self.n)

    def group_texts(self, names: list[str], a_names: int) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` per document; ``names`` as by ``id_names``, the
        first ``a_names`` of them for side A."""
        a_group = np.cumsum(self.a_cut) - self.a_cut
        b_group = np.cumsum(self.b_cut) - self.b_cut
        groups = int(self.a_cut.sum())
        a_size, b_size = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        b_before, a_upto = np.cumsum(b_size) - b_size, np.cumsum(a_size)
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + b_before[a_group]] = self.a * 2 + self.a_cut
        code[np.arange(len(self.b)) + a_upto[b_group]] = a_names + self.b * 2 + self.b_cut
        ends = np.cumsum(self.per_document(self.a_doc) + self.per_document(self.b_doc)).tolist()
        named = list(map(names.__getitem__, code.tolist()))
        return ["".join(named[at:end])[:-1] for at, end in zip([0, *ends], ends)]


def id_names(size: int, last: str) -> list[str]:
    """Every id followed by a comma, and by the sign at the end of a group's side."""
    return [f"{i}{sign}" for i in range(size) for sign in (",", last)]


# ------------------------------------------------------------ runs
def _pack(*arrays: np.ndarray) -> bytes:
    import zstandard

    data = b"".join(struct.pack("<q", len(a)) + a.astype("<i8").tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unpack(blob: bytes) -> list[np.ndarray]:
    import zstandard

    data, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(data):
        (n,) = struct.unpack_from("<q", data, at)
        out.append(np.frombuffer(data, "<i8", n, at + 8))
        at += 8 + 8 * n
    return out


def radix_of(a: np.ndarray, radices: int) -> np.ndarray:
    """The radix of A ids: scrambled, so that frequent low ids spread."""
    return ((a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % radices


def run_rows(record: np.ndarray, links: np.ndarray, b_size: int, radices: int):
    """(radix, pairs, n_pairs, documents) of one run.  A record is a pair
    (a * b_size + b) and a document number below it, sorted; ``pairs`` holds the
    pairs, as differences, and their document counts, ``documents`` the numbers
    and links in the same order."""
    pair, document = record >> DOC_BITS, record & ((1 << DOC_BITS) - 1)
    radix = radix_of(pair // b_size, radices)
    order = np.argsort(radix, kind="stable")
    edges = np.searchsorted(radix[order], np.arange(radices + 1))
    for r in range(radices):
        own = order[edges[r]:edges[r + 1]]
        if len(own):
            key, count = np.unique(pair[own], return_counts=True)
            step = np.diff(document[own], prepend=0)
            yield r, _pack(np.diff(key, prepend=0), count), len(key), _pack_small(step, links[own])


def _pack_small(step: np.ndarray, links: np.ndarray) -> bytes:
    """Document differences and links, as few bytes wide as they need."""
    import zstandard

    parts = []
    for x in (step, links):
        kind = next(k for k in ("<i1", "<i2", "<i4", "<i8")
                    if np.iinfo(k).min <= x.min() and x.max() <= np.iinfo(k).max)
        parts.append(struct.pack("<cq", kind[-1].encode(), len(x)) + x.astype(kind).tobytes())
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _unpack_small(blob: bytes) -> list[np.ndarray]:
    import zstandard

    data, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(data):
        width, n = struct.unpack_from("<cq", data, at)
        kind = "<i" + width.decode()
        out.append(np.frombuffer(data, kind, n, at + 9).astype(np.int64))
        at += 9 + n * int(width)
    return out


def merge_counts(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Heap merge of sorted (pairs, counts) lists; equal pairs add up."""
    key: list[int] = []
    total: list[int] = []
    last = -1
    for k, n in heapq.merge(*[zip(p.tolist(), c.tolist()) for p, c in runs]):
        if k == last:
            total[-1] += n
        else:
            key.append(k)
            total.append(n)
            last = k
    return np.array(key, np.int64), np.array(total, np.int64)


def highest(key: np.ndarray, count: np.ndarray, b_size: int) -> np.ndarray:
    """Whether each pair (A-major order) has its A id's highest count."""
    a = key // b_size
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, np.int64)
    return count == np.repeat(np.maximum.reduceat(count, first), np.diff(np.append(first, len(a)))) if len(a) else a == 0


# ------------------------------------------------------------ the Spark job
def _encode_documents(docs: DataFrame, a_path: str, b_path: str, keep_groups: bool, radices: int, spill: int) -> DataFrame:
    """Rows of two kinds: one per document (radix null) and one per (run, radix)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {id_type}, run long, document int, n_a long, n_b long, n_groups long, n_links long, "
              f"groups string, radix int, pairs binary, n_pairs long, documents binary")

    def encode(batches):
        import hashlib

        import pyarrow as pa
        from pyspark import TaskContext

        a, b = load_tokenizer(a_path), load_tokenizer(b_path)
        names = id_names(len(a.bytes_of), "|") + id_names(len(b.bytes_of), ";")
        fields = pa.schema([
            ("run", pa.int64()), ("document", pa.int32()), ("n_a", pa.int64()), ("n_b", pa.int64()),
            ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()), ("radix", pa.int32()),
            ("pairs", pa.binary()), ("n_pairs", pa.int64()), ("documents", pa.binary())])
        run, document, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def flush(id_kind):
            code = np.concatenate([c for c, _ in held])
            links = np.concatenate([n for _, n in held])
            order = np.argsort(code, kind="stable")
            rows = list(run_rows(code[order], links[order], len(b.bytes_of), radices))
            n = len(rows)
            none = [None] * n
            return pa.RecordBatch.from_arrays(
                [pa.array(none, id_kind)] + [pa.array(v, f.type) for v, f in zip(
                    [[run] * n, none, none, none, none, none, none, [r[0] for r in rows], [r[1] for r in rows],
                     [r[2] for r in rows], [r[3] for r in rows]], fields)],
                names=["doc_id", *fields.names])

        id_kind = None
        for batch in batches:
            id_kind = batch.column(0).type
            texts = [t or "" for t in batch.column(1).to_pylist()]
            at = 0
            while at < len(texts):
                # So many texts at once that together they stay small; a longer one goes alone.
                end, chars = at + 1, len(texts[at])
                while end < len(texts) and chars + len(texts[end]) <= LONG_TEXT:
                    chars += len(texts[end])
                    end += 1
                some = texts[at:end]
                if document + len(some) >= 1 << DOC_BITS or size >= spill:
                    if held:
                        yield flush(id_kind)
                    run, document, held, size = run + 1, 0, [], 0
                found = Aligned(some, a, b)
                pair = found.a[found.link_a] * len(b.bytes_of) + found.b[found.link_b]
                owner = found.a_doc[found.link_a]
                code, links = np.unique((pair << DOC_BITS) | (owner + document), return_counts=True)
                if len(code):
                    held.append((code, links))
                    size += len(code)
                groups = found.group_texts(names, 2 * len(a.bytes_of))
                if not keep_groups:
                    groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                n = len(some)
                none = [None] * n
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, n)] + [pa.array(v, f.type) for v, f in zip(
                        [[run] * n, np.arange(document, document + n), found.per_document(found.a_doc),
                         found.per_document(found.b_doc), found.per_document(found.a_doc[found.a_cut]),
                         found.per_document(owner), groups, none, none, none, none], fields)],
                    names=["doc_id", *fields.names])
                document += n
                at = end
        if held:
            yield flush(id_kind)

    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def count_pairs(runs: DataFrame, b_size: int, fan_in: int = FAN_IN) -> DataFrame:
    """(radix, pairs, n_pairs) of the whole corpus: ``pairs`` holds pairs, counts
    and whether a count is its A id's highest.  Runs are merged ``fan_in`` at a time."""
    def merge(table):
        import pyarrow as pa

        lists = []
        for blob in table.column("pairs").to_pylist():
            step, count = _unpack(blob)[:2]
            lists.append((np.cumsum(step), count))
        key, count = merge_counts(lists)
        return pa.table({"radix": pa.array([table.column("radix")[0].as_py()], pa.int32()),
                         "part": pa.array([table.column("part")[0].as_py()], pa.int64()),
                         "pairs": pa.array([_pack(np.diff(key, prepend=0), count, highest(key, count, b_size))], pa.binary()),
                         "n_pairs": pa.array([len(key)], pa.int64())})

    parts = runs.select("radix", F.xxhash64("run").alias("part"), "pairs", "n_pairs")
    most = parts.groupBy("radix").count().agg(F.max("count")).first()[0] or 0
    while True:
        groups = -(-most // fan_in)
        # A radix's runs are dealt evenly by hash; the last round takes all that are left.
        merged = (parts.withColumn("part", F.pmod(F.col("part"), F.lit(max(1, groups))))
                  .groupBy("radix", "part").applyInArrow(merge, "radix int, part long, pairs binary, n_pairs long"))
        parts = written(merged, "pair-counts")
        if groups <= 1:
            return parts.drop("part")
        most = groups


def align_tokens(docs: DataFrame, a_path: str, b_path: str, keep_groups: bool = True, radices: int = RADICES,
                 spill: int = SPILL, fan_in: int = FAN_IN, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) per row of ``docs``.

    ``groups`` is ``a1,a2|b1;a3|b2,b3`` (ids of both sides per group); with
    ``keep_groups=False`` its SHA-256 in lowercase hex, '' without tokens.
    """
    spark = docs.sparkSession
    small_batches(spark)
    # Runs are few and large: bound what a worker holds by bytes too.  Read when the plan runs, so left set.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    b_size = len(load_tokenizer(b_path).bytes_of)
    found = written(_encode_documents(docs, a_path, b_path, keep_groups, radices, spill)
                    .withColumn("kind", F.when(F.col("radix").isNull(), F.lit("document")).otherwise(F.lit("run"))),
                    "aligned", "kind")
    runs = found.where(F.col("kind") == "run")
    counts = count_pairs(runs, b_size, fan_in)
    # One row a radix; its size is measured, beyond the bound the runs are dealt by radix instead.
    weight = counts.agg(F.coalesce(F.sum(F.octet_length("pairs")), F.lit(0))).first()[0]
    counts = counts.select("radix", F.col("pairs").alias("final"))
    joined = runs.select("run", "radix", "pairs", "documents").join(
        F.broadcast(counts) if weight <= broadcast_bytes else counts, "radix")

    def give_back(batches):
        """Per run and radix the sums of its documents, by number."""
        import pyarrow as pa

        finals: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            out = []
            run_column, radix_column, pairs, documents, final = batch.columns
            for i in range(batch.num_rows):
                radix = radix_column[i].as_py()
                if radix not in finals:
                    if len(finals) >= RADICES:
                        finals.clear()
                    step, *rest = _unpack(final[i].as_py())
                    finals[radix] = [np.cumsum(step), *rest]
                key, count, best = finals[radix]
                step, here = _unpack(pairs[i].as_py())
                at = np.repeat(np.searchsorted(key, np.cumsum(step)), here)
                number, links = _unpack_small(documents[i].as_py())
                number = np.cumsum(number)
                n = int(number.max()) + 1
                # Whole numbers below 2^53, so float sums are exact.
                n_best = np.bincount(number, weights=links * best[at], minlength=n)
                total = np.bincount(number, weights=links * count[at], minlength=n)
                held = np.flatnonzero(total)
                out.append((run_column[i].as_py(), held, n_best[held].astype(np.int64), total[held].astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64())]
                + [pa.array([_pack(o[1], o[2], o[3]) for o in out], pa.binary())], names=["run", "sums"])

    def add_up(table):
        """The documents of one run (bounded by its number) with all radices added."""
        import pyarrow as pa

        parts = [_unpack(s) for s in table.column("sums").to_pylist()]
        n = max((int(p[0].max()) + 1 for p in parts if len(p[0])), default=0)
        sums = np.zeros((2, n), np.int64)
        for number, n_best, total in parts:
            sums[0][number] += n_best
            sums[1][number] += total
        run = table.column("run")[0].as_py()
        return pa.table({"run": pa.array([run] * n, pa.int64()), "document": pa.array(np.arange(n, dtype=np.int32)),
                         "n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1])})

    sums = (joined.select("run", "radix", "pairs", "documents", "final")
            .mapInArrow(give_back, "run long, sums binary")
            .groupBy("run").applyInArrow(add_up, "run long, document int, n_best long, count_sum long"))
    zero = F.lit(0).cast("long")
    return (found.where(F.col("kind") == "document")
            .select("run", "document", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")
            .join(sums, ["run", "document"], "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
                    F.coalesce("count_sum", zero).alias("count_sum"), "groups"))
