"""Operator 5: n-gram Jaccard join with parity sketches.

A document's set holds the 64-bit hashes of its 5-word shingles.  Its *parity
sketch* is the bit vector over all hash values in which every member flips one
bit (XOR): members that collide cancel, so two sketches differ in at most as
many bits as the sets have members in one but not in both.  The sketch is used
in two forms: its set bits in order (sparse), and XOR-folded to a few words
whose number follows from the size of the set (dense); folding can only lower
the distance, which therefore stays a lower bound.

Similarity of 3/4 means that a set of n members keeps all but floor(n / 4) of
them in the other.  Pigeonhole: among any floor(n/4) + m set bits of a sketch
at least m are set in the other, too.

1. Equal sets become one class (128-bit hash of the set).
2. The first floor(n/4) + floor(n/16) + 1 set bits of every class are shuffled,
   once.  A class that shares fewer than floor(n/16) + 1 of them with other
   classes has no link.  This removes almost all documents.
3. For the rest, all bits are counted.  A bit that is set nowhere else is
   lost to any partner, so a class with more than floor(n/4) such bits has no
   link, and the pigeonhole needs only the rarest of the others: a passage
   that very many documents hold is no key unless it makes up most of them.
4. Within (bit, size band) every class meets the one with the fewest bits of
   its own.  Of those it takes the most popular as its *hub* and is compared with it on whole texts,
   which gives first components and, per class, the members its hub has and it
   lacks (miss) and its members that others have but the hub has not (odd).
5. A bit whose classes all are in one component needs nothing more.  In the
   others, pairs of classes of different components are formed if lower bounds
   of their difference allow a link: from their sizes; from the bits they cannot
   share; for classes of one hub own + own + |miss - miss| + |odd - odd|; and the
   Hamming distance of their dense sketches.  They are verified on whole texts.

So every link joins two members of one component in the end; no pair is
emitted for classes that are already connected, and of a cloud of copies too
far from each other hardly any.

Scale: one row per ~3 words is shuffled; keys, not pairs, carry the hot
groups; texts are shuffled for surviving classes only, found by a bitmap of
fixed size.  Links and components stay in tables.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nutrilake.llm.common import small_batches, written
from nutrilake.llm.components import components
from nutrilake.llm.repeats import possible
from nutrilake.llm.shingles import mix, shingle_sets

BATCH = 256


def _similar(both: int, a: int, b: int) -> bool:
    return 100 * both >= 75 * (a + b - both)


def _band(n: Column) -> Column:
    """Size band: linked sets are in equal or neighbouring bands (ratio 4/3)."""
    return F.floor(F.log(n) / F.log(F.lit(4 / 3))).cast("int")


def _slices(batch):
    for at in range(0, batch.num_rows, BATCH):
        yield batch.slice(at, BATCH)


def _describe(batches):
    """(doc_id, th, n, s1, s2, bits) per document.  ``bits`` are given for the
    first document of a task with this set, null for its copies."""
    import pyarrow as pa

    seen: set[int] = set()
    for whole in batches:
        for batch in _slices(whole):
            sets = shingle_sets([t or "" for t in batch.column(2).to_pylist()])
            n = np.array([len(s) for s in sets], np.int64)
            s1 = np.array([np.bitwise_xor.reduce(s) if len(s) else 0 for s in sets], np.uint64)
            s2 = np.array([mix(s).sum(dtype=np.uint64) if len(s) else 0 for s in sets], np.uint64)
            bits: list = []
            for s, key in zip(sets, s1.tolist()):
                if len(s) and key not in seen:
                    seen.add(key)
                    bits.append(s[:len(s) // 4 + len(s) // 16 + 1].view(np.int64))
                else:
                    bits.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n), pa.array(s1.view(np.int64)),
                 pa.array(s2.view(np.int64)), pa.array(bits, pa.list_(pa.int64()))],
                names=["doc_id", "th", "n", "s1", "s2", "bits"])


def _dense(s: np.ndarray) -> np.ndarray:
    """Parity sketch folded to a power of two of 64-bit words, 4 bits a member or more."""
    words = 1 << max(0, (4 * len(s) - 1).bit_length() - 6)
    out = np.zeros(words, np.uint64)
    np.bitwise_xor.at(out, ((s >> np.uint64(6)) % np.uint64(words)).astype(np.int64),
                      np.uint64(1) << (s & np.uint64(63)))
    return out.view(np.int64)


def _all_bits(batches):
    import pyarrow as pa

    for whole in batches:
        for batch in _slices(whole):
            sets = shingle_sets(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                 pa.array([_dense(s) for s in sets], pa.list_(pa.int64()))], names=["node", "bits", "dense"])


def _compare(batches):
    """Pairs of texts -> how many members they share, and whether they are linked."""
    import pyarrow as pa

    for whole in batches:
        for batch in _slices(whole):
            texts = list(dict.fromkeys(batch.column(2).to_pylist() + batch.column(3).to_pylist()))
            sets = dict(zip(texts, shingle_sets(texts)))
            both, linked = [], []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                a, b = sets[a], sets[b]
                both.append(len(np.intersect1d(a, b, assume_unique=True)))
                linked.append(_similar(both[-1], len(a), len(b)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(both, pa.int64()), pa.array(linked, pa.bool_())],
                                             names=["x", "y", "both", "linked"])


def _compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (x, y) with ``both`` and ``linked`` from their whole texts."""
    tx = texts.select(F.col("node").alias("x"), F.col("text").alias("tx"))
    ty = texts.select(F.col("node").alias("y"), F.col("text").alias("ty"))
    return (pairs.join(tx, "x").join(ty, "y").select("x", "y", "tx", "ty")
            .mapInArrow(_compare, "x long, y long, both long, linked boolean"))


def _folded(a: Column, words: Column) -> Column:
    """A dense sketch folded once more if it has twice the words asked for."""
    return F.when(F.size(a) <= words, a).otherwise(F.transform(
        F.slice(a, 1, words), lambda x, i: x.bitwiseXOR(F.get(a, i + words))))


def _hamming(a: Column, b: Column) -> Column:
    words = F.least(F.size(a), F.size(b))
    return F.aggregate(F.zip_with(_folded(a, words), _folded(b, words),
                                  lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("long")),
                       F.lit(0).cast("long"), lambda total, x: total + x)


def similar_documents(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, th, n_shingles, class_id, component_id.

    ``component_id`` is the smallest doc_id reachable by links of similarity
    0.75 or more, the own one included; ``class_id`` the smallest doc_id with
    the very same set; th = xxhash64(text) tells rows of one doc_id apart.
    Null and empty texts and texts without words have no shingles and are
    linked with nothing, not even with each other.  Repeated rows are linked.
    A null doc_id counts only where a component has no other.  Other columns
    are ignored; an empty table gives no rows.
    """
    return _labelled(docs).drop("label")


def _labelled(docs: DataFrame) -> DataFrame:
    """``similar_documents`` with ``label``, which is unique to the component:
    component_id is not where doc_ids repeat or are null.  Null without words."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"),
                        F.coalesce("text", F.lit("")).alias("text"))
    described = written(texts.mapInArrow(
        _describe, f"doc_id {kind}, th long, n long, s1 long, s2 long, bits array<long>"), "sets")
    kinds = ["s1", "s2", "n"]
    classes = written(
        described.where(F.col("n") > 0).groupBy(*kinds)
        .agg(F.min(F.struct("doc_id", "th")).alias("e"), F.min("doc_id").alias("class_id"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")
    # 2. Bits that two different sets share.
    rows = described.where(F.col("bits").isNotNull()).select(F.explode("bits").alias("bit"), "s1")
    w = Window.partitionBy("bit")
    shared = (rows.withColumn("lo", F.min("s1").over(w)).withColumn("hi", F.max("s1").over(w))
              .where(F.col("lo") < F.col("hi")).dropDuplicates(["bit", "s1"]))
    n_shared = shared.groupBy("s1").agg(F.count("*").alias("n_shared"))
    left = written(classes.join(n_shared, "s1").where(
        F.col("n_shared") > F.floor(F.col("n") / 16)).select("node", "n", "e.doc_id", "e.th"), "left")
    # 3. All bits of the classes left, by their whole texts.
    some = possible(texts, left, kind).dropDuplicates(["doc_id", "th"])
    ids = left.select("node", "n", F.col("doc_id").alias("_id"), F.col("th").alias("_th"))
    whole = written(some.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")))
                    .select("node", "n", "text"), "texts")
    sets = written(whole.select("node", "text").mapInArrow(
        _all_bits, "node long, bits array<long>, dense array<long>"), "bits")
    bits = (sets.select("node", F.explode("bits").alias("bit"))
            .withColumn("df", F.count("*").over(Window.partitionBy("bit"))).where(F.col("df") >= 2))
    order = Window.partitionBy("node").orderBy("df", "bit")
    held = (bits.withColumn("m", F.count("*").over(Window.partitionBy("node")))
            .withColumn("place", F.row_number().over(order)))
    size = whole.select(F.col("node").alias("_node"), "n")
    own = F.col("n") - F.col("m")                       # bits set in no other class
    keys = written(held.join(size, F.col("node") == F.col("_node"))
                   .withColumn("place", F.col("place") + own).where(F.col("place") <= F.floor(F.col("n") / 4) + 1)
                   .select("bit", "node", "n", "m", "place", _band(F.col("n")).alias("band")), "keys")
    # 4. Every class and, per bit and band, the one with the fewest bits of its own, which is the likeliest
    # to be near the others; the most popular of these is its hub.
    least = F.min(F.struct((F.col("n") - F.col("m")).alias("own"), "node")).over(Window.partitionBy("bit", "band"))
    met = written(keys.withColumn("hub", least["node"]).where(F.col("hub") != F.col("node")).select("node", "hub").distinct(), "met")
    popular = met.groupBy("hub").agg(F.count("*").alias("c"))
    choice = met.join(popular, "hub").select("node", "hub", "c").unionByName(
        popular.select(F.col("hub").alias("node"), "hub", "c"))
    best = written(choice.groupBy("node").agg(F.max_by("hub", F.struct("c", -F.col("hub"))).alias("hub")), "best")
    first = written(_compared(best.where(F.col("node") != F.col("hub")).select(
        F.col("node").alias("x"), F.col("hub").alias("y")), whole), "first")
    label = components(first.where("linked")).select(F.col("node").alias("_node"), "label")
    # 5. Pairs between components, where a bit has several.
    n_hub = left.select(F.col("node").alias("y"), F.col("n").alias("n_hub"))
    near_hub = first.join(n_hub, "y").select(F.col("x").alias("_node"), F.col("y").alias("hub"), "both", "n_hub")
    hubs = near_hub.unionByName(best.where(F.col("node") == F.col("hub")).select(
        F.col("node").alias("_node"), "hub", F.lit(None).cast("long").alias("both"), F.lit(0).cast("long").alias("n_hub")))
    known = keys.join(label, F.col("node") == F.col("_node"), "left").drop("_node").select(
        "bit", "node", "n", "m", "place", "band", F.coalesce("label", "node").alias("label"))
    w = Window.partitionBy("bit")
    open_keys = (known.withColumn("lo", F.min("label").over(w)).withColumn("hi", F.max("label").over(w))
                 .where(F.col("lo") < F.col("hi")).drop("lo", "hi"))
    own = F.when(F.col("both").isNotNull(), F.col("n") - F.col("m")).otherwise(0)
    mixed = written(
        open_keys.join(hubs, F.col("node") == F.col("_node"), "left")
        .select("bit", "node", "n", "m", "place", "band", "label", "hub", own.alias("own"),
                F.coalesce(F.col("n_hub") - F.col("both"), F.lit(0)).alias("miss"),
                F.when(F.col("both").isNotNull(), F.col("m") - F.col("both")).otherwise(0).alias("odd")), "mixed")
    names = [c for c in mixed.columns if c != "bit"]
    a = mixed.select("bit", F.explode(F.array("band", F.col("band") + 1)).alias("b"),
                     *[F.col(c).alias(f"{c}_x") for c in names])
    b = mixed.select("bit", F.col("band").alias("b"), *[F.col(c).alias(f"{c}_y") for c in names])
    both = F.col("n_x") + F.col("n_y")
    apart = (F.col("own_x") + F.col("own_y") + F.abs(F.col("miss_x") - F.col("miss_y"))
             + F.abs(F.col("odd_x") - F.col("odd_y")))
    # a meets its own band (in order of node) and the next larger one; linked sets share 3 (n + n) / 7 members
    # and differ in (n + n) / 7 at most; at the first bit they share, what stands from its place on is all
    # they can share
    could = ((F.col("label_x") != F.col("label_y"))
             & ((F.col("band_x") != F.col("band_y")) | (F.col("node_x") < F.col("node_y")))
             & (4 * F.least("n_x", "n_y") >= 3 * F.greatest("n_x", "n_y"))
             & (7 * F.least("m_x", "m_y") >= 3 * both)
             & (7 * (F.least(F.col("n_x") - F.col("place_x"), F.col("n_y") - F.col("place_y")) + 1) >= 3 * both)
             & (~F.coalesce(F.col("hub_x") == F.col("hub_y"), F.lit(False)) | (7 * apart <= both)))
    pairs = (a.join(b, ["bit", "b"]).where(could)
             .select(F.col("node_x").alias("x"), F.col("node_y").alias("y"), both.alias("both")).distinct())
    dense = sets.select(F.col("node").alias("_node"), "dense")
    near = (pairs.join(dense.withColumnRenamed("dense", "dx"), F.col("x") == F.col("_node")).drop("_node")
            .join(dense.withColumnRenamed("dense", "dy"), F.col("y") == F.col("_node"))
            .where(7 * _hamming(F.col("dx"), F.col("dy")) <= F.col("both")).select("x", "y"))
    second = written(_compared(near, whole), "second")
    links = first.where("linked").select("x", "y").unionByName(second.where("linked").select("x", "y"))
    final = components(links).select(F.col("node").alias("_node"), "label")
    # Back to documents: the smallest doc_id of each component.
    marked = written(classes.join(final, F.col("node") == F.col("_node"), "left")
                     .select(*kinds, "class_id", F.coalesce("label", "node").alias("label")), "marked")
    least = (marked.groupBy("label").agg(F.min("class_id").alias("component_id"))
             .withColumnRenamed("label", "_label"))
    named = marked.join(least, F.col("label") == F.col("_label")).select(
        *[F.col(c).alias(f"_{c}") for c in kinds], "class_id", "component_id", "label")
    return (described.drop("bits").join(named, (F.col("s1") == F.col("_s1")) & (F.col("s2") == F.col("_s2"))
                                        & (F.col("n") == F.col("_n")), "left")
            .select("doc_id", "th", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "label"))


def one_per_component(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the row of
    its smallest doc_id stays (one row, should it hold that doc_id twice; a null
    doc_id only if it has no other).  Components are told apart by their links,
    not by doc_id.  Every document without words stays."""
    keep = (_labelled(docs).where(F.col("n_shingles") > 0).groupBy("label")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("e"))
            .select(F.col("e.doc_id").alias("_id"), F.col("e.th").alias("_th")))
    th = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    columns = [docs[f"`{c}`"] for c in docs.columns]
    words = F.coalesce(docs["text"], F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    rest = [F.col(f"`{c}`").cast("string") for c in docs.columns if c not in ("doc_id", "text")]
    one = Window.partitionBy("doc_id", "_near_th").orderBy(*rest or [F.lit(0)])
    stay = (docs.where(words).join(keep, docs["doc_id"].eqNullSafe(F.col("_id")) & (th == F.col("_th")))
            .select(*columns, F.col("_th").alias("_near_th")).withColumn("_near_n", F.row_number().over(one))
            .where(F.col("_near_n") == 1).drop("_near_n", "_near_th"))
    return stay.unionByName(docs.where(~words).select(*columns))
