"""Operator 13: embedding whitening by a bidiagonal qd solver.

1. Blockwise QR: every task folds its centred rows into one triangular factor,
   factors are folded together in rounds until a few are left.
2. Householder reflections make the last factor R bidiagonal: R = U B W'.
3. dqds (differential quotient-difference with shifts) on B finds the singular
   values to high relative accuracy.
4. For each wanted value a twisted factorisation of B'B - s^2 I, put together
   from its stationary and its progressive qd transform at the row where they
   meet best, gives the vector; W carries it back to a whitening direction.

The covariance itself is never formed, so small components keep the accuracy
that squaring would lose.

Vectors become whole numbers floor(scale * c).  The fit list holds each distinct
vector once, so copies do not weigh; every remaining row is whitened.

Defined results.  Rows whose vector is null, empty or holds null or non-finite
entries are left out; repeated rows stay repeated.  Vectors of another length
are a fit of their own.  A direction without variance (fewer distinct vectors
than components, constant dimensions) has no row, as its scale would be zero.
``deviation`` is exact and null where it does not fit 64 bits.  Entries beyond
2^40 after scaling are refused, since sums of them are not exact.  Of equal
eigenvalues any orthogonal directions are taken.

Scale: the rows are read in narrow passes, the distinct vectors cross one
shuffle; what reaches the driver is d x d numbers, d the vector length.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nutrilake.llm.common import written

SCALE = 256
COMPONENTS = 4
MAX_ENTRY = 1 << 40
BLOCK_ROWS = 8_192
FOLD = 32                # triangular factors folded by one task
MAX_LENGTHS = 1_000      # different vector lengths, each a fit of its own
NO_VARIANCE = 1e-12      # singular values below this share of the largest count as zero
_EPS = np.finfo(float).eps


# ------------------------------------------------------------ dense kernels (d x d)
def triangle(rows: np.ndarray) -> np.ndarray:
    """The d x d upper triangular factor of ``rows`` (zero rows fill it up)."""
    d = rows.shape[1]
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((d - len(r), d))]) if len(r) < d else r


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(q, e, W): r = U B W' with B upper bidiagonal, diagonal q, superdiagonal e."""
    a, d = r.copy(), len(r)
    w = np.eye(d)

    def reflector(x):
        v, size = x.copy(), np.linalg.norm(x)
        v[0] += np.copysign(size, x[0])
        length = np.linalg.norm(v)
        return v / length if length else v

    for k in range(d):
        v = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < d - 2:
            v = reflector(a[k, k + 1:])
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ v, v)
            w[:, k + 1:] -= 2 * np.outer(w[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def dqds(diagonal: np.ndarray, superdiagonal: np.ndarray) -> np.ndarray:
    """Singular values of the upper bidiagonal matrix, largest first.

    Works on squares q, e; a transform that would give a negative q shows that
    its shift exceeds the smallest value left and is repeated with a smaller one.
    """
    top = max(np.abs(diagonal).max(initial=0.0), np.abs(superdiagonal).max(initial=0.0))
    if not top:
        return np.zeros(len(diagonal))
    found: list[float] = []
    blocks = [((diagonal / top) ** 2, (superdiagonal / top) ** 2, 0.0)]
    while blocks:
        q, e, sigma = blocks.pop()
        shift = 0.0
        while len(q):
            n = len(q)
            if n == 1:
                found.append(sigma + q[0])
                break
            if n == 2:
                # Eigenvalues of [[q0, sqrt(q0 e0)], [., q1 + e0]] without cancellation.
                half = (q[0] + q[1] + e[0]) / 2
                root = np.sqrt(max(0.0, ((q[0] - q[1]) / 2) ** 2 + e[0] * (q[0] + q[1]) / 2 + e[0] ** 2 / 4))
                high = half + root
                found += [sigma + high, sigma + (q[0] * (q[1] / high) if high else 0.0)]
                break
            small = np.flatnonzero(e <= _EPS * _EPS * (sigma + np.minimum(q[:-1], q[1:])))
            if len(small):
                cut = int(small[-1])
                blocks.append((q[:cut + 1].copy(), e[:cut].copy(), sigma))
                q, e, shift = q[cut + 1:].copy(), e[cut + 1:].copy(), 0.0
                continue
            while True:
                new_q, new_e = np.empty(n), np.empty(n - 1)
                d = q[0] - shift
                least = d
                for i in range(n - 1):
                    new_q[i] = d + e[i]
                    if d < 0 or new_q[i] <= 0:
                        break
                    ratio = q[i + 1] / new_q[i]
                    new_e[i] = e[i] * ratio
                    d = d * ratio - shift
                    least = min(least, d)
                else:
                    if d >= 0:
                        new_q[-1] = d
                        break
                shift = shift / 4 if shift > _EPS * (sigma + q.min()) else 0.0
                if shift == 0.0 and q.min() <= 0:
                    # An exact zero: one plain sweep chases it to the end.
                    q = np.maximum(q, np.finfo(float).tiny)
            sigma += shift
            q, e = new_q, new_e
            # The smallest d bounds the smallest value from above; the end tells how near it is.
            shift = max(0.0, min(least, q[-1] - np.sqrt(q[-1] * e[-1])) * (0.98 if e[-1] > q[-1] / 64 else 1 - 1e-10))
    return top * np.sqrt(np.maximum(np.sort(np.array(found))[::-1], 0.0))


def _twisted(square: np.ndarray, off: np.ndarray, low: np.ndarray, value: float) -> np.ndarray:
    """Vector z of (L D L' - value I) z = gamma e_r for the best twist row r;
    D = square, L has the subdiagonal low, off = square * low^2."""
    n = len(square)
    tiny = np.finfo(float).tiny ** 0.5

    def pivot(x):
        return x if abs(x) > tiny else -tiny

    down_l, s = np.empty(n - 1), np.empty(n)
    s[0] = -value
    for i in range(n - 1):                      # stationary: from the top
        plus = pivot(square[i] + s[i])
        down_l[i] = square[i] * low[i] / plus
        s[i + 1] = down_l[i] * low[i] * s[i] - value
    up_u, p = np.empty(n - 1), np.empty(n)
    p[-1] = square[-1] - value
    for i in range(n - 2, -1, -1):              # progressive: from the bottom
        minus = pivot(off[i] + p[i + 1])
        ratio = square[i] / minus
        up_u[i] = low[i] * ratio
        p[i] = p[i + 1] * ratio - value
    gamma = s + p + value
    r = int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -down_l[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -up_u[i] * z[i]
    size = np.abs(z).max()
    z = z / size
    return z / np.linalg.norm(z)


def singular_vectors(diagonal: np.ndarray, superdiagonal: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Right singular vectors (columns) of the bidiagonal matrix for ``values``
    (its largest ones, falling).  They are made orthogonal; one that vanishes by
    that, as among equal values, is found again by inverse iteration."""
    n = len(diagonal)
    b = np.diag(diagonal) + np.diag(superdiagonal, 1)
    top = values[0]
    q = np.where(np.abs(diagonal) < _EPS * _EPS * top, _EPS * _EPS * top, diagonal)
    square, low = q * q, superdiagonal / q[:-1]
    off = superdiagonal * superdiagonal
    rng = np.random.default_rng(13)
    out = np.zeros((n, len(values)))
    for k, value in enumerate(values):
        z = _twisted(square, off, low, value * value)

        def apart(z):
            for _ in range(2):
                for j in range(k):
                    z = z - out[:, j] * (out[:, j] @ z)
            return z

        z = apart(z)
        wrong = np.linalg.norm(b.T @ (b @ z) - value * value * z)
        if np.linalg.norm(z) < 0.5 or wrong > 1e-13 * n * top * top:
            matrix = b.T @ b - (value * value + 4 * _EPS * top * top) * np.eye(n)
            z = apart(rng.normal(size=n))
            for _ in range(6):
                z = apart(np.linalg.solve(matrix, z / np.linalg.norm(z)))
        out[:, k] = z / np.linalg.norm(z)
    return out


# ------------------------------------------------------------ the Spark job
@dataclass(frozen=True)
class Whitening:
    """A fit for vectors of one length: n distinct vectors with sums ``sums``,
    unit ``directions`` (d x components), their eigenvalues, the trace."""
    n: int
    sums: np.ndarray
    directions: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def whole_vectors(table: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): x = floor(scale * c) of every vector without null or
    non-finite entries."""
    fine = F.forall(F.col(vector_col), lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))
                    & (F.abs(c.cast("double")) < float("inf")))
    x = F.transform(F.col(vector_col), lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long"))
    return (table.where(F.col(vector_col).isNotNull() & (F.size(vector_col) > 0) & fine)
            .select(F.col(id_col).alias("vec_id"), x.alias("x")))


def _matrix(column) -> np.ndarray:
    lists = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
    if x.size and max(int(x.max()), -int(x.min())) > MAX_ENTRY:
        raise ValueError(f"a vector entry exceeds {MAX_ENTRY} after scaling")
    return x


def _totals(batches):
    """Rows and exact sums per dimension of one task."""
    import pyarrow as pa

    n, sums = 0, None
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch.column(0))
            own = [int(s) for s in x.sum(axis=0)]
            n, sums = n + len(x), own if sums is None else [a + b for a, b in zip(sums, own)]
    if n:
        yield pa.RecordBatch.from_pylist([{"n": n, "sums": [str(s) for s in sums]}])


def _rows(matrices: list[np.ndarray]):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([pa.array([m.ravel().tolist() for m in matrices], pa.list_(pa.float64()))],
                                      names=["r"])


def fit_whitening(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the column x of ``distinct`` (vectors of one length, each once)."""
    # One (n, sums) per task; added up as whole numbers of any size.
    parts = distinct.select("x").mapInArrow(_totals, "n long, sums array<string>")
    added = (parts.select("n", F.posexplode("sums").alias("at", "s"))
             .groupBy("at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
             .orderBy("at").collect())
    if not added:
        return None
    n, sums, d = added[0]["n"], np.array([int(r["s"]) for r in added], dtype=object), len(added)
    # x - S/n in two exact steps: whole part by integers, then the fraction.
    base = np.array([int(s) // n for s in sums], np.int64)
    rest = np.array([int(s) % n / n for s in sums])

    def factor(batches):
        r = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                own = (_matrix(batch.column(0).slice(at, BLOCK_ROWS)) - base) - rest
                r = triangle(own if r is None else np.vstack([r, own]))
        if r is not None:
            yield _rows([r])

    def fold(batches):
        r = None
        for batch in batches:
            for row in batch.column(0).to_pylist():
                own = np.array(row).reshape(d, d)
                r = own if r is None else triangle(np.vstack([r, own]))
        if r is not None:
            yield _rows([r])

    factors = written(distinct.select("x").mapInArrow(factor, "r array<double>"), "factors")
    left = factors.count()
    while left > FOLD:
        left = -(-left // FOLD)
        factors = written(factors.repartition(left).mapInArrow(fold, "r array<double>"), "factors")
    r = triangle(np.vstack([np.array(row["r"]).reshape(d, d) for row in factors.collect()]))
    diagonal, above, w = bidiagonalise(r)
    values = dqds(diagonal, above)
    wanted = values[:components]
    wanted = wanted[wanted > NO_VARIANCE * values[0]] if values[0] > 0 else wanted[:0]
    directions = w @ singular_vectors(diagonal, above, wanted) if len(wanted) else np.zeros((d, 0))
    return Whitening(n, sums, directions, wanted ** 2 / n, float((r * r).sum() / n))


def apply_whitening(rows: DataFrame, fit: Whitening) -> DataFrame:
    """(vec_id, x, deviation, whitened array) for rows of the fit's length."""
    n, sums = fit.n, fit.sums
    base = np.array([int(s) // n for s in sums], np.int64)
    rest = np.array([int(s) % n / n for s in sums])
    project = fit.directions / np.sqrt(fit.eigenvalues)[None, :]
    largest_sum = max(abs(int(s)) for s in sums)
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1))
            bound = n * max(int(x.max()), -int(x.min())) + largest_sum
            if bound * bound * len(sums) < 1 << 63:
                y = x * n - sums.astype(np.int64)
                deviation = pa.array((y * y).sum(axis=1))
            else:
                exact = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(row, sums)) for row in x]
                deviation = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
            white = ((x - base) - rest) @ project
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), deviation, pa.array(white.tolist(), pa.list_(pa.float64()))],
                names=["vec_id", "x", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(
        run, f"vec_id {kind}, x array<long>, deviation long, whitened array<double>")


def identity_error(distinct: DataFrame, fit: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance less the
    identity, measured on the rows."""
    k = len(fit.eigenvalues)
    if not k:
        return 0.0
    white = apply_whitening(distinct.select(F.lit(0).cast("long").alias("vec_id"), "x"), fit)

    def moments(batches):
        import pyarrow as pa

        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                y = np.array(batch.column(0).to_pylist())
                sums, products = sums + y.sum(axis=0), products + y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k + k * k)), pa.array(np.append(sums, products.ravel()))],
                                         names=["at", "s"])

    total = np.zeros(k + k * k)
    for row in (white.select("whitened").mapInArrow(moments, "at long, s double")
                .groupBy("at").agg(F.sum("s").alias("s")).collect()):
        total[row["at"]] = row["s"]
    mean = total[:k] / fit.n
    covariance = total[k:].reshape(k, k) / fit.n - np.outer(mean, mean)
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
           components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error):
    one row per remaining row of ``table`` and component, from 1 by falling variance."""
    rows = whole_vectors(table, id_col, vector_col, scale)
    kind = rows.schema["vec_id"].dataType.simpleString()
    distinct = written(rows.select("x").distinct().select("x", F.size("x").alias("d")), "distinct")
    lengths = [r["d"] for r in distinct.select("d").distinct().limit(MAX_LENGTHS + 1).collect()]
    if len(lengths) > MAX_LENGTHS:
        raise ValueError(f"vectors of more than {MAX_LENGTHS} lengths")
    out = table.sparkSession.createDataFrame(
        [], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
            "identity_error double")
    for d in sorted(lengths):
        own = distinct.where(F.col("d") == d)
        fit = fit_whitening(own, components)
        explained = F.array(*[F.lit(float(e / fit.trace)) for e in fit.eigenvalues]) if fit.trace else F.array()
        white = apply_whitening(rows.where(F.size("x") == d), fit)
        out = out.unionByName(
            white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(fit.n).cast("long").alias("n"),
                    "deviation", "whitened",
                    F.get(explained, F.col("at")).cast("double").alias("explained"),
                    F.lit(identity_error(own, fit)).alias("identity_error")))
    return out
