"""Operator 7: mixing sources to target weights.

Words are summed per source, a target per source follows from the weights,
``rate = target / source size`` is its repetition rate, and every document is
emitted ``floor(rate)`` times plus one more time when its hash-seeded coin,
uniform in [0, 1), falls below the fraction of the rate.

Scale: one aggregation over (source, size) with map-side combine, so a source
holding a third of all rows costs one row per task; targets come from a few
sums over the sources table; the sources table meets the documents in a join
whose hot side Spark can split.  The coin depends on the seed and the doc_id
alone, so reruns and retried tasks agree.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nutrilake.llm.common import WORD, global_rank, written

MAX_RATE = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3),
                   share: float = 1.0, max_rate: int = MAX_RATE) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    Sources in code-point order, null last, take the weights in turn.  The
    budget is ``share`` of all words.  A source whose part exceeds ``max_rate``
    times its size stops there and the excess is reshared by weight among the
    rest, until none is above.  Each round is one aggregation over the sources
    table; only three sums reach the driver.  A source without words gets 0.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # order: null last; repartitionByRange and row_number use the same columns
    ranked = global_rank(totals, [F.col("source").isNull(), F.col("source")], "_rank")
    pattern = F.array(*[F.lit(w) for w in weights])
    table = written(ranked.withColumn(
        "weight", F.element_at(pattern, (F.col("_rank") % len(weights)).cast("int") + 1)), "sources")
    first = table.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = share * (first[0] or 0)
    level, n_capped = (budget / first[1] if first[1] else 0.0), -1
    cap = max_rate * F.col("source_size")
    while True:
        over = F.lit(level) * F.col("weight") > cap
        capped, open_weight, n = table.agg(
            F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("weight"))),
            F.count(F.when(over, 1))).first()
        if n == n_capped or not open_weight:
            break
        level, n_capped = (budget - (capped or 0)) / open_weight, n
    target = F.least(F.lit(level) * F.col("weight"), cap.cast("double"))
    return table.select("source", "source_size", target.alias("target"))


def coin(doc_id: Column, seed: int) -> Column:
    """Uniform in [0, 1): the first 52 bits of md5("seed:doc_id")."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0,
             max_rate: int = MAX_RATE, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, rate, copies.

    Null text has size 0; documents without words are emitted by their rate
    like any other (a source without any words has rate 0 and is not taken).
    Rows that share a doc_id share its coin; null doc_ids share one coin.
    Other columns of ``docs`` are ignored.  An empty table gives no rows.
    """
    sizes = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    targets = source_targets(sizes, weights, share, max_rate)
    t = targets.select(F.col("source").alias("_source"), "source_size", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (sizes.join(t, sizes["source"].eqNullSafe(t["_source"])).drop("_source")
            .withColumn("rate", rate)
            .withColumn("copies", F.floor("rate")
                        + (coin(F.col("doc_id"), seed) < F.col("rate") - F.floor("rate")).cast("int")))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0,
                  max_rate: int = MAX_RATE, seed: int = 7) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each repeated as planned.

    The rate of a document depends on its source alone, so documents meet the
    small sources table rather than their own plan rows; every column of
    ``docs`` is kept, whatever its name.
    """
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    t = written(source_targets(sizes, weights, share, max_rate).select(
        F.struct(F.col("source").alias("s"),
                 F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                 .otherwise(0.0).alias("r")).alias("_mix_rate")), "rates")
    r = F.col("_mix_rate.r")
    copies = (F.floor(r) + (coin(docs["doc_id"], seed) < r - F.floor(r)).cast("int")).cast("int")
    keep = [docs[f"`{c}`"] for c in docs.columns]
    return (docs.join(t, docs["source"].eqNullSafe(F.col("_mix_rate.s")))
            .select(*keep, F.explode(F.array_repeat(F.lit(0), copies)).alias("_mix_copy"))
            .drop("_mix_copy"))
