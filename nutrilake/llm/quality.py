"""Operator 6: quality rules with a rule bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements
and one bit per failed rule.  Policies are versioned bit masks applied to the
ledger later, without reading any text, and ablations are counts over the bits.

Scale: one narrow pass over the texts with column expressions only, no
shuffle; a document is measured inside its own row.  Ablations aggregate the
bit patterns (at most 2^rules of them) with map-side combine.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nutrilake.llm.common import WHITE_RUN, WORD

# Rule name -> condition under which a document fails it, over the measurements.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "many_symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_text_lines",
    "word_length": "n_words > 0 and (word_chars < 2 * n_words or word_chars > 20 * n_words)",
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}

# Versioned policies: the rules that reject a document.
BASE = ("few_words", "repeated_windows")
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": (*BASE, "many_symbols", "repeated_lines", "word_length"),
}


def mask(rules: tuple[str, ...]) -> int:
    return sum(BITS[r] for r in rules)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every whole text (null text: no words).

    Words are runs of anything but ASCII white space.  ``n_repeat_words``
    counts the words that lie in some three-word window found twice or more:
    windows are hashed (64 bits, within one document), sorted with their
    places, and equal neighbours mark the places they cover.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", text.alias("_t"))
    d = d.select(
        "doc_id", "_t",
        F.filter(F.split("_t", WHITE_RUN), lambda w: w != "").alias("_w"),
        F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(WORD)).alias("_l"))
    d = d.select(
        "doc_id", F.size("_w").cast("long").alias("n_words"),
        F.length(F.array_join("_w", "")).cast("long").alias("word_chars"),
        F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size("_l").cast("long").alias("n_text_lines"),
        F.when(F.size("_w") >= 3, F.transform(
            F.sequence(F.lit(0), F.size("_w") - 3),
            lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)))).alias("_h"))
    d = d.withColumn("_p", F.when(
        F.size(F.array_distinct("_h")) < F.size("_h"),
        F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda j, k: F.get("_p", j)["h"] == F.get("_p", k)["h"]
    marks = F.filter(F.sequence(F.lit(0), F.size("_p") - 1),
                     lambda j: F.coalesce(same(j, j - 1), F.lit(False))
                     | F.coalesce(same(j, j + 1), F.lit(False)))
    d = d.withColumn("_m", F.when(F.col("_p").isNotNull(), marks))
    start = lambda j: F.get("_p", j)["i"]
    covered = F.flatten(F.transform(
        "_m", lambda j: F.array(start(j), start(j) + 1, start(j) + 2)))
    repeats = F.when(F.col("_p").isNull(), 0).otherwise(F.size(F.array_distinct(covered)))
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_text_lines",
                    repeats.cast("long").alias("n_repeat_words"))


def fail_bits() -> Column:
    bits = F.lit(0).cast("long")
    for name, condition in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(condition), F.lit(BITS[name])).otherwise(0).cast("long"))
    return bits


def rule_ledger(docs: DataFrame) -> DataFrame:
    """The ledger: doc_id, the measurements and ``fail_bits``; one row per row of
    ``docs`` (repeated rows repeat).  Empty or null texts have zero words and
    fail ``few_words``.  Other columns of ``docs`` are ignored."""
    return measured(docs).withColumn("fail_bits", fail_bits())


def apply_policy(ledger: DataFrame, version: str) -> DataFrame:
    """Add ``kept`` under a policy version; no text is read."""
    return ledger.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(mask(POLICIES[version]))) == 0)


def ablation(ledger: DataFrame, version: str) -> DataFrame:
    """Per rule of a policy: documents failing it, documents only it rejects
    (what leaving it out would bring back) and documents kept by the policy.

    The ledger is first summed by its bit patterns, then patterns are compared
    with the mask by bitwise operations.
    """
    rules = POLICIES[version]
    m = F.lit(mask(rules))
    patterns = (ledger.groupBy(F.col("fail_bits").bitwiseAND(m).alias("bits"))
                .agg(F.count("*").alias("n")))
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).cast("long").alias("bit"))
                               for r in rules])).alias("r")
    return (patterns.select("bits", "n", each)
            .groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
                 F.sum(F.when(F.col("bits") == 0, F.col("n")).otherwise(0)).alias("n_kept")))
