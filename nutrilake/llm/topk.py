"""Operator 4: exact top-k search as a Voronoi kNN join on inner products.

Queries and data are grouped by their nearest pivots.  Summaries of the groups
give every query group a bound, only data that may pass it are replicated to
the group, and each (query group, block of a data group) is solved locally:

* equal vectors are one *class*; beyond the k + 1 smallest ids of a class none
  can be among k results, so a class carries k + 1 ids at most;
* query cell i has a pivot p_i and a radius U_i = max |q - p_i|, data cell j a
  pivot s_j and a radius R_j = max |o - s_j|;
* q.o >= p_i.o - U_i |o| for all q in cell i, so the (k + 1)-th largest such
  bound over the data is a score that every query of the cell reaches;
* q.o <= p_i.s_j + |p_i| R_j + U_i (|s_j| + R_j) for all o in cell j: pairs of
  cells below the reach of i do not meet at all; of the cells that do, a vector
  with p_i.o + U_i |o| below it is not sent;
* a cell is cut into blocks of bounded size, queries go to the blocks that
  hold a vector for them, and the best k per (query, block) are merged.

Scores are exact integer inner products: products of doubles where the norms
prove them exact, Python integers elsewhere.  A score beyond 64 bits counts as
the nearest long, as a component beyond 64 bits does.  Ties go to the smaller id.

Scale: pivots grow with the square root of the rows up to ``max_pivots``; the
driver holds pivots x pivots numbers.  High-dimensional data without clusters
prune little: then the join does the work of a blocked scan, every query part
against every block.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nutrilake.llm.common import written

MAX_PIVOTS = 256
BLOCK_ROWS = 4_096


def quantised(table: DataFrame, id_col: str, vector_col: str, scale: int = 1024) -> DataFrame:
    """(id, v): integer vectors floor(scale * x).  Null vectors and vectors
    with null or non-finite components take no part."""
    x = F.transform(F.col(vector_col), lambda c: F.floor(c.cast("double") * scale))
    fine = F.forall(F.col(vector_col), lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                    & (F.abs(c.cast("double")) < float("inf")))
    return (table.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & fine)
            .select(F.col(id_col).cast("long").alias("id"), x.alias("v")))


LONG = np.iinfo(np.int64)


def _integers(column) -> np.ndarray:
    """Arrow list column of equal lengths -> int64 matrix."""
    lists = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _matrix(column) -> np.ndarray:
    return _integers(column).astype(np.float64)


def _norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(1))


def _nearest(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = (x * x).sum(1)[:, None] - 2 * x @ pivots.T + (pivots * pivots).sum(1)[None, :]
    at = d.argmin(1)
    return at, _norms(x - pivots[at])


def inner_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact products of the rows of two int64 matrices, kept within 64 bits."""
    left, right = q.astype(np.float64), x.astype(np.float64)
    products = left @ right.T
    # no partial sum exceeds the product of the norms, so below 2^52 every step is exact
    unsure = _norms(left)[:, None] * _norms(right)[None, :] >= 2.0 ** 52
    scores = np.where(unsure, 0, products).astype(np.int64)
    for i, j in zip(*np.nonzero(unsure)):
        exact = sum(a * b for a, b in zip(q[i].tolist(), x[j].tolist()))
        scores[i, j] = min(max(exact, LONG.min), LONG.max)
    return scores


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, max_pivots: int = MAX_PIVOTS,
          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row (id, v) of ``queries`` the
    k best rows of ``vectors`` (id, v) other than those with its own id.

    Ties go to the smaller id; fewer than k candidates give fewer rows.  Ids
    that repeat with equal vectors count once.  Vectors of another length than
    the query's are no candidates of it: each length is joined on its own.
    """
    spark = vectors.sparkSession
    key = ["d", "v"]
    # Equal vectors become one class with the k + 1 smallest ids; kept map-side small.
    classes = (vectors.select("id", F.size("v").alias("d"), "v").dropDuplicates(["v", "id"])
               .withColumn("h", F.xxhash64("v")))
    spread = classes.withColumn("s", F.pmod(F.xxhash64("id"), F.lit(64)))
    first = Window.partitionBy("v", "s").orderBy("id")
    some = spread.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    data = written(some.groupBy(*key).agg(
        F.slice(F.sort_array(F.collect_list("id")), 1, k + 1).alias("ids")), "classes")
    asked = written(queries.select("id", F.size("v").alias("d"), "v").dropDuplicates(["id", "v"]), "asked")
    lengths = [r["d"] for r in asked.select("d").distinct().collect()]
    results = [_join(data.where(F.col("d") == d), asked.where(F.col("d") == d), k, max_pivots, block_rows)
               for d in lengths if d > 0]
    if not results:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = results[0]
    for other in results[1:]:
        best = best.unionByName(other)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _pivots(vectors: DataFrame, n: int) -> np.ndarray:
    """At most ``n`` different vectors, picked by hash."""
    return np.unique(_matrix(vectors.orderBy(F.xxhash64("v")).select("v").limit(n).toArrow().column("v")), axis=0)


def _grouped(vectors: DataFrame, pivots: np.ndarray, ids: str, name: str) -> DataFrame:
    """(v, <ids>, cell, far), written: every vector with its nearest pivot."""
    def assign(batches):
        import pyarrow as pa
        for batch in batches:
            if batch.num_rows:
                cell, far = _nearest(_matrix(batch.column(0)), pivots)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(far)],
                                                 names=["v", ids, "cell", "far"])

    of = "long" if ids == "id" else "array<long>"
    return written(vectors.select("v", ids).mapInArrow(assign, f"v array<long>, {ids} {of}, cell int, far double"), name)


def _summary(grouped: DataFrame, n_cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Radius (-1 without rows) and rows of every cell."""
    radius, rows = np.full(n_cells, -1.0), np.zeros(n_cells, np.int64)
    for r in grouped.groupBy("cell").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect():
        radius[r["cell"]], rows[r["cell"]] = r["far"] * (1 + 1e-9) + 1e-6, r["n"]
    return radius, rows


def _join(data: DataFrame, asked: DataFrame, k: int, max_pivots: int, block_rows: int) -> DataFrame:
    n_data, n_asked = data.count(), asked.count()
    # cells of about a quarter of a block, and no more than the root of the rows
    n_cells = max(1, min(max_pivots, int(n_data ** 0.5), -(-4 * n_data // block_rows)))
    pivots, centres = _pivots(asked, max(1, min(max_pivots, int(n_asked ** 0.5) // 2))), _pivots(data, n_cells)
    grouped = _grouped(asked, pivots, "id", "query-cells")
    dealt = _grouped(data, centres, "ids", "data-cells")
    radius, n_queries = _summary(grouped, len(pivots))
    reach_of, n_rows = _summary(dealt, len(centres))
    n_parts = -(-n_queries // block_rows)       # parts of bounded size of the queries of a cell
    live = np.flatnonzero(radius >= 0)
    sizes = _norms(pivots)
    inner = np.maximum(radius, 0)

    def slack(norms: np.ndarray) -> np.ndarray:
        """(query cells, rows): what rounding may cost a bound."""
        return 1e-9 * (sizes + inner)[:, None] * norms[None, :] + 1e-6

    def lower(batches):
        """The k + 1 largest lower bounds per query cell among the rows of this task."""
        import pyarrow as pa
        best = np.zeros((len(pivots), 0))
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                norms = _norms(x)
                low = pivots @ x.T - inner[:, None] * norms[None, :] - slack(norms)
                low = np.repeat(low, np.minimum(batch.column(1).to_numpy(), k + 1), axis=1)
                best = np.sort(np.concatenate([best, low], axis=1), axis=1)[:, -(k + 1):]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(live, best.shape[1]).astype(np.int32)), pa.array(best[live].ravel())],
            names=["cell", "low"])

    lows = dealt.select("v", F.size("ids").alias("n")).mapInArrow(lower, "cell int, low double")
    # The (k + 1)-th best bound: one of the k + 1 may be the query itself.
    nth = Window.partitionBy("cell").orderBy(F.desc("low"))
    reach = np.full(len(pivots), -np.inf)
    for r in lows.withColumn("n", F.row_number().over(nth)).where(F.col("n") == k + 1).collect():
        # scores beyond 64 bits are equal, so no bound lies among them
        reach[r["cell"]] = -np.inf if r["low"] <= LONG.min else min(r["low"], 2.0 ** 62)
    spread = np.maximum(reach_of, 0)
    norms = _norms(centres)
    meets = (pivots @ centres.T + sizes[:, None] * spread[None, :] + inner[:, None] * (norms + spread)[None, :]
             + slack(norms + spread) >= reach[:, None]) & (radius >= 0)[:, None]
    n_blocks = np.maximum(1, -(-n_rows // block_rows))
    first_block = np.concatenate([[0], np.cumsum(n_blocks)[:-1]])

    def wanted(batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, query cell, block) of the vectors of a batch that a query cell may need."""
        x, home = _matrix(batch.column(0)), batch.column(1).to_numpy()
        norms = _norms(x)
        high = pivots @ x.T + inner[:, None] * norms[None, :] + slack(norms)
        cell, at = np.nonzero((high >= reach[:, None]) & meets[:, home])
        block = first_block[home] + batch.column(2).to_numpy() % n_blocks[home]
        return at, cell, block[at]

    def targets(batches):
        import pyarrow as pa
        for batch in batches:
            if batch.num_rows:
                _, cell, block = wanted(batch)
                pairs = np.unique(np.stack([cell, block]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0].astype(np.int32)), pa.array(pairs[1].astype(np.int64))],
                                                 names=["cell", "block"])

    def send(batches):
        """Each vector to every part of the query cells it may serve."""
        import pyarrow as pa
        for batch in batches:
            if batch.num_rows:
                at, cell, block = wanted(batch)
                part = np.concatenate([np.arange(n) for n in n_parts[cell]] or [np.zeros(0, np.int64)])
                at, cell, block = (np.repeat(c, n_parts[cell]) for c in (at, cell, block))
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.astype(np.int32)), pa.array(part.astype(np.int32)), pa.array(block.astype(np.int64)),
                     batch.column(0).take(take), batch.column(3).take(take)],
                    names=["cell", "part", "block", "v", "ids"])

    rows = dealt.select("v", "cell", F.pmod(F.xxhash64("v"), F.lit(1 << 40)).alias("h"), "ids")
    sent = rows.mapInArrow(send, "cell int, part int, block long, v array<long>, ids array<long>")
    met = rows.select("v", "cell", "h").mapInArrow(targets, "cell int, block long").distinct()
    # Queries in parts of bounded size, each copied to the blocks that hold a vector for it.
    parts = F.array(*[F.lit(int(n)) for n in n_parts])
    copies = grouped.select(
        "cell", F.pmod(F.xxhash64("id"), F.get(parts, F.col("cell"))).cast("int").alias("part"), "id", "v") \
        .join(met, "cell")

    def solve(left, right):
        import pyarrow as pa
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                          "score": pa.array([], pa.int64())})
        if not left.num_rows or not right.num_rows:
            return empty
        x = _integers(right.column("v"))
        lists = right.column("ids").combine_chunks()
        ids, owner = lists.flatten().to_numpy(), np.repeat(np.arange(len(x)), np.diff(lists.offsets.to_numpy()))
        out = []
        q, q_ids = _integers(left.column("v")), left.column("id").to_numpy()
        for at in range(0, len(q), 256):
            scores = inner_products(q[at:at + 256], x)
            for row, own in zip(scores, q_ids[at:at + 256]):
                # classes that can hold one of the k best, then their ids in order
                if len(row) > k + 1:
                    edge = np.partition(row, len(row) - k - 1)[len(row) - k - 1]
                    rows = np.flatnonzero(row[owner] >= edge)
                else:
                    rows = np.arange(len(owner))
                rows = rows[ids[rows] != own]
                rows = rows[np.lexsort((ids[rows], ~row[owner[rows]]))[:k]]
                out.append((np.full(len(rows), own), ids[rows], row[owner[rows]]))
        return pa.table({n: pa.array(np.concatenate([o[i] for o in out]).astype(np.int64))
                         for i, n in enumerate(("query_id", "vec_id", "score"))})

    return (copies.groupBy("cell", "part", "block").cogroup(sent.groupBy("cell", "part", "block"))
            .applyInArrow(solve, "query_id long, vec_id long, score long"))
