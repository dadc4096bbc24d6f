"""Operator 2: best-fit packing by a linear grouping scheme.

Documents become token pieces of at most ``capacity`` tokens.  Pieces of one
length are interchangeable, so the whole plan follows from the histogram of
lengths, which has at most ``capacity`` rows whatever the corpus:

1. large lengths (over a quarter of the capacity) are sorted and cut into
   groups of equal cardinality; within a group lengths round up to the largest;
2. configurations of the few rounded sizes are chosen by the configuration
   linear program (columns generated by a knapsack), multiplicities rounded
   down;
3. actual lengths replace the rounded ones: every slot of a configuration
   takes a run of its group, so sequences come in blocks of equal content;
4. all other pieces, longest first, go to the fullest sequences they fit in
   (best fit over blocks of sequences with equal room), then to new ones.

The plan is a list of intervals (length, from rank, per sequence) -> (first
sequence, offset): the place of a piece is arithmetic on its rank among the
pieces of its length.  Ranks come from one count per (partition, length).

Scale: the texts are read once and never shuffled; what is shuffled is one
small row per piece.  The driver sees the histogram only.  The pieces are
written to shared storage first, so ranks do not depend on retries.
"""
from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nutrilake.llm.common import small_batches, worker_cache, written

CAPACITY = 2048
END_ID = 0
GROUPS = 64


def encoder(path: str):
    """text -> uint32 ids by the vocabulary file, loaded once per worker.

    The byte-level vocabulary of the ``tokenizers`` file is run by ``tiktoken``
    (the same ids several times faster; see the test); texts with very long
    runs of white space go to ``tokenizers`` itself.
    """
    cache = worker_cache()
    if path not in cache:
        import json
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
        # Fixed pattern of the byte-level pre-tokenizer.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        fast = tiktoken.Encoding("ids", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        slow, long_white = Tokenizer.from_file(path), re.compile(r"\s{1000}")

        def ids(text: str) -> np.ndarray:
            if long_white.search(text):
                return np.array(slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
            return fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False)

        cache[path] = ids
    return cache[path]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY,
                 keep_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, _part, _rank[, ids]).

    A document is its ids followed by id 0, so null and empty texts have
    length 1.  A longer document is cut so that its first piece takes the
    remainder and every other piece is full.  ``_rank`` counts the pieces of
    one length within the partition ``_part``.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, _part int, _rank long"
              + (", ids array<int>" if keep_ids else ""))

    def cut(batches):
        import zlib

        import pyarrow as pa
        from pyspark import TaskContext

        ids_of, part = encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            out: list[list] = [[] for _ in range(8 if keep_ids else 7)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(ids_of(text.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                start = 0
                for piece in range(-(-len(ids) // capacity)):
                    length = len(ids) - start - (len(ids) - start - 1) // capacity * capacity
                    own = ids[start:start + length]
                    row = [doc_id, piece, start, length, zlib.crc32(own.tobytes()), part, seen[length]]
                    for values, value in zip(out, row + [own.astype(np.int32)] * keep_ids):
                        values.append(value)
                    seen[length] += 1
                    start += length
            types = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.int64(),
                     pa.int32(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "_part", "_rank", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)],
                                             names=names[:len(out)])

    return docs.select("doc_id", F.col("text")).mapInArrow(cut, schema)


def _solve_configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], float]]:
    """Configuration LP: fewest sequences that hold ``demand[g]`` items of each
    rounded size.  Returns (items per size, multiplicity).

    Sizes exceed a quarter of the capacity, so a configuration has up to three
    items: with few sizes all configurations are listed and the simplex method
    prices them together.
    """
    k = len(sizes)
    width = np.array([*sizes, 0])
    i, j, h = np.meshgrid(*[np.arange(k + 1)] * 3, indexing="ij")
    listed = np.stack([i.ravel(), j.ravel(), h.ravel()], axis=1)
    listed = listed[(listed[:, 0] <= listed[:, 1]) & (listed[:, 1] <= listed[:, 2]) & (listed[:, 0] < k)
                    & (width[listed].sum(axis=1) <= capacity)]
    columns = np.diag([capacity // s for s in sizes]).astype(float)
    need = np.array(demand, float)
    for _ in range(100 * k + 500):
        inverse = np.linalg.inv(columns)
        price = np.append(np.maximum(inverse.sum(axis=0), 0.0), 0.0)
        value = price[listed].sum(axis=1)
        best = int(value.argmax())
        if value[best] <= 1 + 1e-7:
            break
        column = np.bincount(listed[best], minlength=k + 1)[:k].astype(float)
        amount, change = inverse @ need, inverse @ column
        usable = change > 1e-9
        ratio = np.where(usable, np.maximum(amount, 0) / np.where(usable, change, 1), np.inf)
        columns[:, int(ratio.argmin())] = column
    amount = np.linalg.solve(columns, need)
    return [([int(x) for x in columns[:, j]], max(0.0, float(amount[j]))) for j in range(k)]


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> np.ndarray:
    """Intervals (length, rank_from, n, sequence_from, per_sequence, offset), by
    length and rank: pieces rank_from .. rank_from + n - 1 of that length fill
    sequences from sequence_from on, ``per_sequence`` in each, from ``offset``."""
    used = dict.fromkeys(histogram, 0)      # pieces placed so far, per length
    rows: list[tuple[int, int, int, int, int, int]] = []
    rooms: dict[int, list[tuple[int, int]]] = {}   # free room -> blocks (first sequence, sequences)
    order: list[int] = []                   # the rooms that occur, ascending
    n_sequences = 0

    def place(length: int, n: int, first: int, per: int, offset: int) -> None:
        rows.append((length, used[length], n, first, per, offset))
        used[length] += n

    def free(room: int, first: int, count: int) -> None:
        if count:
            if room not in rooms:
                rooms[room] = []
                insort(order, room)
            rooms[room].append((first, count))

    # 1. Large lengths, longest first, in groups of equal cardinality, rounded up.
    large = sorted((x for x in histogram if capacity // 4 < x < capacity), reverse=True)
    total = sum(histogram[x] for x in large)
    share = -(-total // groups) if total else 0
    runs: list[list[list[int]]] = []        # per group: [length, count] in descending order
    filled = share
    for length in large:
        left = histogram[length]
        while left:
            if filled == share:
                runs.append([])
                filled = 0
            take = min(left, share - filled)
            runs[-1].append([length, take])
            filled, left = filled + take, left - take
    merged: list[list[list[int]]] = []      # groups that round up to one size are one size
    for run in runs:
        if merged and merged[-1][0][0] == run[0][0]:
            merged[-1].extend(run)
        else:
            merged.append(run)
    # 2. and 3. Configurations; every slot takes the next run of its group.
    if merged:
        sizes, demand = [r[0][0] for r in merged], [sum(n for _, n in r) for r in merged]
        for column, amount in _solve_configurations(sizes, demand, capacity):
            slots = [g for g, n in enumerate(column) for _ in range(n)]
            left = int(amount + 1e-6)
            for g, n in enumerate(column):
                if n:
                    left = min(left, sum(c for _, c in merged[g]) // n)
            if not slots:
                continue
            # slot s of the next `left` sequences takes `left` consecutive items of its group
            taken: list[list[list[int]]] = []
            for g in slots:
                want, mine = left, []
                while want:
                    run = merged[g][0]
                    n = min(run[1], want)
                    mine.append([run[0], n])
                    run[1] -= n
                    want -= n
                    if not run[1]:
                        merged[g].pop(0)
                taken.append(mine)
            while left:
                count = min(t[0][1] for t in taken)
                offset = 0
                for t in taken:
                    place(t[0][0], count, n_sequences, 1, offset)
                    offset += t[0][0]
                    t[0][1] -= count
                    if not t[0][1]:
                        t.pop(0)
                free(capacity - offset, n_sequences, count)
                n_sequences += count
                left -= count
    # 4. Everything else, longest first, best fit.
    for length in sorted(histogram, reverse=True):
        left = histogram[length] - used[length]
        while left:
            at = bisect_left(order, length)
            if at == len(order):
                count = -(-left // (capacity // length))
                free(capacity, n_sequences, count)
                n_sequences += count
                at = bisect_left(order, length)
            room = order[at]
            first, count = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                order.pop(at)
            per = room // length
            whole = min(count, left // per)
            if whole:
                place(length, whole * per, first, per, capacity - room)
                free(room - per * length, first, whole)
                left -= whole * per
            if whole < count:
                if 0 < left < per:
                    place(length, left, first + whole, left, capacity - room)
                    free(room - left * length, first + whole, 1)
                    left, whole = 0, whole + 1
                free(room, first + whole, count - whole)
    return np.array(sorted(rows), np.int64).reshape(-1, 6)


def pack(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Add sequence_id and offset to written pieces (from ``token_pieces``)."""
    counts = pieces.groupBy("_part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in
                 counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    plan = plan_sequences(histogram, capacity, groups)
    before = (F.sum("n").over(Window.partitionBy("length").orderBy("_part")) - F.col("n"))
    shifts = counts.select(F.col("_part").alias("_p"), F.col("length").alias("_l"), before.alias("_before"))
    ranked = (pieces.join(shifts, (F.col("_part") == F.col("_p")) & (F.col("length") == F.col("_l")))
              .withColumn("_rank", F.col("_rank") + F.col("_before"))
              .drop("_p", "_l", "_before", "_part"))
    schema = (", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "_rank")
              + ", sequence_id long, offset long")

    def locate(batches):
        import pyarrow as pa

        # one sortable key per interval; a length is below 2^23 and a rank below 2^40
        keys = (plan[:, 0] << 40) + plan[:, 1]
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            at = batch.schema.get_field_index("_rank")
            rank = batch.column(at).to_numpy()
            row = plan[np.searchsorted(keys, (length << 40) + rank, side="right") - 1]
            inside = rank - row[:, 1]
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [n for i, n in enumerate(batch.schema.names) if i != at]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(row[:, 3] + inside // row[:, 4]),
                 pa.array(row[:, 5] + inside % row[:, 4] * length)],
                names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(locate, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY,
                   groups: int = GROUPS, keep_ids: bool = False) -> DataFrame:
    """Pack every row of ``docs`` (doc_id, text; other columns are ignored).

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset (and ids on request).  Repeated rows are packed once each; a null
    doc_id is kept as null; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    pieces = written(token_pieces(docs, tokenizer, capacity, keep_ids), "pieces")
    return pack(pieces, capacity, groups)
