"""Cut keys for many ranks at once, in a seeded hash order.

``rank_cuts`` finds, for every class, the rows at several ranks of the order
(md5 of the seeded key, then md5 of the whole row).  Once the cuts are known, the
part of a row is a comparison of its own key with the few cuts of its class: no
window and no shuffle of the rows.

Passes: one aggregation to rows per (class, hash prefix), then only the rows whose
prefix holds a cut, with longer prefixes until a prefix holds few rows.  A key that
a third of all rows share (a missing id) is a long prefix like any other: the
digits after it come from the whole row.  Rows equal in every column are one row
with a count.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nutrilake.functions.ordered import bounded_broadcast, collect_bounded

KEY_DIGITS = 32
DIGITS = 2 * KEY_DIGITS
PREFIXES = (3, 6, 9, KEY_DIGITS + 3, KEY_DIGITS + 6, KEY_DIGITS + 9, DIGITS)
MAX_CUT_ROWS = 1_000_000


@dataclass(frozen=True)
class Cut:
    """The key at a wanted rank, the rows of the class before that key, and the
    rows that have it (more than one only where whole rows repeat)."""
    rank: int
    key: str
    before: int
    rows: int

    @property
    def inside(self) -> int:
        return self.rank - self.before


def _digits(key: Column, row: Column, n: int) -> Column:
    """The first n digits of the order; the whole row is hashed only beyond the key's."""
    return F.substring(key, 1, n) if n <= KEY_DIGITS else F.concat(key, F.substring(row, 1, n - KEY_DIGITS))


def _rows_table(df: DataFrame, group: str, rows: list[tuple], columns: str) -> DataFrame:
    kind = df.schema[group].dataType.simpleString()
    return df.sparkSession.createDataFrame(rows, f"_wg {kind}, {columns}")


def rank_cuts(df: DataFrame, group: str, key: Column, row: Column, ranks,
              max_cut_rows: int = MAX_CUT_ROWS) -> tuple[dict, dict]:
    """(cuts, totals): ``cuts[class]`` has one ``Cut`` per wanted rank, in order;
    ``totals[class]`` its rows.  ``ranks`` maps the totals to {class: [ranks from 1]};
    ranks of 0 or beyond the class have no cut.  A null class is an error.
    ``max_cut_rows`` steers only how long prefixes become."""
    base = df.select(F.col(f"`{group}`").alias("_g"), key.alias("_key"), row.alias("_row"))
    level = (base.groupBy("_g", _digits(F.col("_key"), F.col("_row"), PREFIXES[0]).alias("_part"))
             .agg(F.count(F.lit(1)).alias("_n")).withColumn("_pre", F.lit(""))).cache()
    totals = {r["_g"]: r["_n"] for r in collect_bounded(
        level.groupBy("_g").agg(F.sum("_n").alias("_n")), what="classes")}
    if None in totals:
        level.unpersist()
        raise ValueError("NULL group values cannot be stratified")
    wanted = {g: sorted({q for q in qs if 0 < q <= totals.get(g, 0)}) for g, qs in ranks(totals).items()}
    # (class, prefix) -> [(rank in the class, rank inside the prefix)]
    pending = {(g, ""): [(q, q) for q in qs] for g, qs in wanted.items() if qs}
    found: dict = {g: [] for g in totals}
    for at, size in enumerate(PREFIXES):
        if not pending:
            break
        if at:
            asked = _rows_table(df, group, list(pending), "_pre string")
            shared = F.startswith(_digits(F.col("_key"), F.col("_row"), size), F.col("_pre"))
            level = (base.join(bounded_broadcast(asked), (F.col("_g") == F.col("_wg")) & shared)
                     .groupBy("_g", "_pre", _digits(F.col("_key"), F.col("_row"), size).alias("_part"))
                     .agg(F.count(F.lit(1)).alias("_n"))).cache()
        asked = _rows_table(df, group, [(g, p, r, q) for (g, p), qs in pending.items() for q, r in qs],
                            "_wp string, _r long, _q long")
        w = Window.partitionBy("_g", "_pre").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        hits = collect_bounded(
            level.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
            .join(bounded_broadcast(asked), (F.col("_g") == F.col("_wg")) & (F.col("_pre") == F.col("_wp"))
                  & (F.col("_off") < F.col("_r")) & (F.col("_r") <= F.col("_off") + F.col("_n")))
            .select("_g", "_q", "_r", "_part", "_off", "_n"), what="cuts")
        level.unpersist()
        pending = {}
        for h in hits:
            inside = h["_r"] - h["_off"]
            if size == DIGITS:
                found[h["_g"]].append(Cut(h["_q"], h["_part"], h["_q"] - inside, h["_n"]))
            else:
                pending.setdefault((h["_g"], h["_part"]), []).append((h["_q"], inside))
        if pending and max(h["_n"] for h in hits) <= max_cut_rows:
            found_now = _last(df, base, group, pending)
            for g, cut in found_now:
                found[g].append(cut)
            pending = {}
    return {g: sorted(c, key=lambda x: x.rank) for g, c in found.items()}, totals


def _last(df: DataFrame, base: DataFrame, group: str, pending: dict) -> list[tuple]:
    """The cuts inside prefixes that hold few rows: distinct whole keys with running totals."""
    asked = _rows_table(df, group, list(pending), "_pre string")
    whole = _digits(F.col("_key"), F.col("_row"), DIGITS)
    size = max(len(pre) for _, pre in pending)
    near = F.startswith(_digits(F.col("_key"), F.col("_row"), size), F.col("_pre"))
    keys = (base.join(bounded_broadcast(asked), (F.col("_g") == F.col("_wg")) & near)
            .groupBy("_g", "_pre", whole.alias("_part")).agg(F.count(F.lit(1)).alias("_n")))
    ranks = _rows_table(df, group, [(g, p, r, q) for (g, p), qs in pending.items() for q, r in qs],
                        "_wp string, _r long, _q long")
    w = Window.partitionBy("_g", "_pre").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    hits = collect_bounded(
        keys.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
        .join(bounded_broadcast(ranks), (F.col("_g") == F.col("_wg")) & (F.col("_pre") == F.col("_wp"))
              & (F.col("_off") < F.col("_r")) & (F.col("_r") <= F.col("_off") + F.col("_n")))
        .select("_g", "_q", "_r", "_part", "_off", "_n"), what="cuts")
    return [(h["_g"], Cut(h["_q"], h["_part"], h["_q"] - (h["_r"] - h["_off"]), h["_n"])) for h in hits]


def after(cut: Column, key: Column, row: Column) -> Column:
    """Does a row come after the cut (a column with all digits)?"""
    head, tail = F.substring(cut, 1, KEY_DIGITS), F.substring(cut, KEY_DIGITS + 1, KEY_DIGITS)
    return F.when(key != head, key > head).otherwise(row > tail)
