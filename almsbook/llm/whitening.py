"""Whitening of embeddings by their principal components, with eigenvectors refined from single precision.

Vectors become whole numbers, x = floor(64 c) + 1,000,000 per entry, and the fit list holds each distinct one once. Sums
and the covariance are exact: tasks add whole numbers, centred on the whole number next to the mean before they are
multiplied, and the driver takes off what the mean lies beside it. So no order of addition and no repeated task can
change them, and the offset costs no digits.

The covariance is small (a square of the dimension). Its eigenvectors are found in float32 and then corrected by the
iteration of Ogita and Aishima, which is matrix products in extended precision (numpy's ``longdouble``) alone: with
R = I - X'X and S = X'AX, X becomes X + XE, where E holds (S + L R) / (difference of the eigenvalues). That formula fails where
float32 could not tell eigenvalues apart. Such clusters are found by the error bound 2 (|S - L| + |A| |R|); within one,
R / 2 keeps the vectors orthogonal, and a sub-solve of the small matrix X_J'(A - mu I)X_J, shifted by the mean mu of the
cluster, in float64 turns them the right way. The iteration ends when what is left beside the diagonals no longer falls.

At scale only the distinct vectors move, in one shuffle that combines copies first; they are written once and read three
times (sums, covariance, and the measured covariance of the result). Partial sums are as many as there are cores, not as the data has
partitions, and are added by Spark. The driver gets d(d+1)/2 numbers.

Defined results: rows whose vector is null or holds a null, NaN or infinite entry have no output; vectors of different
lengths are populations of their own, each with its fit list, components and n; components whose eigenvalue is zero to
double precision (at most d 2^-50 of the largest) do not exist, so a single distinct vector or an empty one has no rows; entries
beyond 2^53 after scaling count as 2^53; a deviation beyond the type is null; repeated rows have their rows each, a
null id stays null; equal eigenvalues have any orthogonal vectors; an empty table gives no rows; other columns are not
looked at.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almsbook.sources.storage import materialize

STEPS_PER_UNIT = 64
OFFSET = 1_000_000
LARGEST = float(1 << 53)
EXACT = 1 << 53
SAFE = 1 << 62


def whole(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, dim, x)``: the vectors that take part, in whole numbers."""
    own = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = own.where(F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))

    def scaled(c):
        return F.floor(F.greatest(F.least(c * STEPS_PER_UNIT, F.lit(LARGEST)), F.lit(-LARGEST))).cast("long") + OFFSET

    return finite.select("vec_id", F.size("v").alias("dim"), F.transform("v", scaled).alias("x"))


def matrices(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(dim, row numbers, int64 matrix)`` for each length in a batch of vectors."""
    sizes, values = column.value_lengths().to_numpy(), column.flatten().to_numpy()
    starts = np.cumsum(sizes) - sizes
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        yield int(dim), rows, values[starts[rows][:, None] + np.arange(dim)]


def largest(a: np.ndarray) -> int:
    return int(max(abs(int(a.max())), abs(int(a.min())))) if a.size else 0


def exact_sum(x: np.ndarray) -> np.ndarray:
    """Column sums as Python integers."""
    return x.sum(axis=0).astype(object) if largest(x) * max(1, len(x)) < SAFE else x.astype(object).sum(axis=0)


def exact_products(y: np.ndarray) -> np.ndarray:
    """``y' y`` as Python integers: float64 products of so few rows at a time that every sum is exact."""
    top = max(1, largest(y))
    rows = EXACT // (top * top)
    if rows < 1:
        wide = y.astype(object)
        return wide.T.dot(wide)
    total = np.zeros((y.shape[1],) * 2, object)
    for lo in range(0, len(y), min(rows, 1 << 16)):
        block = y[lo : lo + min(rows, 1 << 16)].astype(float)
        total += (block.T @ block).astype(np.int64).astype(object)
    return total


def few_tasks(fit: DataFrame) -> DataFrame:
    """As many partitions as a few per core at most, read one after the other: each makes one partial sum."""
    return fit.coalesce(max(1, 3 * fit.sparkSession.sparkContext.defaultParallelism))


_SUMS = pa.schema([("dim", pa.int32()), ("i", pa.int32()), ("n", pa.int64()), ("total", pa.decimal128(38, 0))])
_PRODUCTS = pa.schema([("dim", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("total", pa.decimal128(38, 0))])


def _decimals(values) -> pa.Array:
    from decimal import Context

    exact = Context(prec=60)
    return pa.array([exact.create_decimal(int(v)) for v in values], pa.decimal128(38, 0))


def sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and sum of every entry, by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for dim, _, x in matrices(batch.column("x")):
                n, total = held.get(dim, (0, np.zeros(dim, object)))
                held[dim] = (n + len(x), total + exact_sum(x))
        for dim, (n, total) in held.items():
            if dim:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()), _decimals(total)], schema=_SUMS
                )

    partial = few_tasks(fit).select("x").mapInArrow(run, "dim int, i int, n long, total decimal(38,0)")
    out: dict[int, tuple[int, list[int]]] = {}
    for row in partial.groupBy("dim", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("dim", "i").collect():
        out.setdefault(row["dim"], (row["n"], []))[1].append(int(row["total"]))
    return out


def covariances(fit: DataFrame, known: dict[int, tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """n² times the covariance, exactly, as matrices of Python integers by dimension."""
    centres = {dim: [(2 * s + n) // (2 * n) for s in total] for dim, (n, total) in known.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in matrices(batch.column("x")):
                if dim:
                    products = exact_products(x - np.array(centres[dim], np.int64))
                    held[dim] = held[dim] + products if dim in held else products
        for dim, total in held.items():
            i, j = np.triu_indices(dim)
            for lo in range(0, len(i), 50_000):
                at = slice(lo, lo + 50_000)
                columns = [pa.array(np.full(len(i[at]), dim, np.int32)), pa.array(i[at].astype(np.int32)), pa.array(j[at].astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*columns, _decimals(total[i[at], j[at]])], schema=_PRODUCTS)

    partial = few_tasks(fit).select("x").mapInArrow(run, "dim int, i int, j int, total decimal(38,0)")
    table = partial.groupBy("dim", "i", "j").agg(F.sum("total").alias("total")).toArrow()
    places = [table.column(c).to_numpy() for c in ("dim", "i", "j")]
    totals = table.column("total").to_pylist()
    out = {}
    for dim, (n, total) in known.items():
        rest = np.array([s - n * m for s, m in zip(total, centres[dim], strict=True)], object)
        own = np.zeros((dim, dim), object)
        for k in np.flatnonzero(places[0] == dim):
            i, j = int(places[1][k]), int(places[2][k])
            own[i, j] = own[j, i] = int(totals[k])
        out[dim] = n * own - np.outer(rest, rest)
    return out


def extended(whole_numbers: np.ndarray, divisor: int) -> np.ndarray:
    """Python integers over ``divisor`` in extended precision: the float64 next to each, plus what that leaves out."""
    high = whole_numbers.astype(float)
    low = np.array([int(v) - int(h) for v, h in zip(whole_numbers.ravel(), high.ravel(), strict=True)], object).reshape(high.shape).astype(float)
    return (high.astype(np.longdouble) + low) / np.longdouble(divisor)


def clusters_of(values: np.ndarray, bound: float) -> list[np.ndarray]:
    """Indices of neighbouring eigenvalues no further apart than ``bound``, two at least."""
    order = np.argsort(values)
    breaks = np.flatnonzero(np.diff(values[order]) > bound) + 1
    return [part for part in np.split(order, breaks) if len(part) > 1]


def orthonormal(x: np.ndarray) -> np.ndarray:
    """The nearest matrix with orthonormal columns, for one that nearly is."""
    for _ in range(2):
        x = x + x @ (np.eye(x.shape[1], dtype=np.longdouble) - x.T @ x) / 2
    return x


def refined_eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors in columns of a symmetric matrix in extended precision."""
    top = np.abs(a).max() if a.size else 0
    if not top:
        return np.zeros(len(a), np.longdouble), np.eye(len(a), dtype=np.longdouble)
    a = a / top
    norm, one, eps = np.linalg.norm(a.astype(float), 2), np.eye(len(a), dtype=np.longdouble), np.finfo(np.longdouble).eps * len(a)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    best, least, stalled = x, np.inf, 0
    # Errors are squared by every step; the bound on the steps is only there for the sake of an end.
    for _ in range(50):
        r, s = one - x.T @ x, x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        beside = s - np.diag(np.diag(s))
        residual = max(np.abs(r).max(), np.abs(beside).max())
        stalled = stalled + 1 if residual > least / 2 else 0
        if residual < least:
            best, least = x.copy(), residual
        if least <= eps or stalled == 3:
            break
        bound = 2 * (np.linalg.norm(beside.astype(float)) + norm * np.linalg.norm(r.astype(float)))
        gap = values[None, :] - values[:, None]
        apart = np.abs(gap) > bound
        e = np.triu(np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2), 1)
        # E + E' = R, which keeps rounding over a small gap a mere turn.
        x = x + x @ (e + np.tril(r - e.T, -1) + np.diag(np.diag(r)) / 2)
        for part in clusters_of(values, bound):
            own = x[:, part]
            block = own.T @ (a @ own - values[part].mean() * own)
            size = np.abs(block).max()
            if size > eps:
                turn = np.linalg.eigh(((block + block.T) / (2 * size)).astype(float))[1].astype(np.longdouble)
                x[:, part] = own @ orthonormal(turn)
    x = orthonormal(best)
    x = x / np.sqrt((x * x).sum(axis=0))
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    return values[order] * top, x * np.where(x[np.abs(x).argmax(axis=0), np.arange(len(a))] < 0, -1, 1)


class Whitener:
    """Sums, components and eigenvalues of one population."""

    def __init__(self, n: int, total: list[int], squared: np.ndarray, components: int) -> None:
        values, vectors = refined_eigen(extended(squared, n * n))
        trace = values.sum()
        kept = [k for k in range(min(components, len(values))) if values[k] > len(values) * 2.0**-50 * values[0]] if trace > 0 else []
        self.n, self.total = n, total
        self.explained = [float(values[k] / trace) for k in kept]
        self.map = (vectors[:, kept] / np.sqrt(values[kept])).astype(float) if kept else np.zeros((len(values), 0))

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n x - S``, exactly."""
        fits = self.n * (largest(x) + 1) + max(map(abs, self.total)) < SAFE
        kind = np.int64 if fits else object
        return self.n * x.astype(kind) - np.array(self.total, kind)

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations / self.n).astype(float) @ self.map


def squares(deviations: np.ndarray) -> list[int]:
    """Sum of squares of every row, exactly."""
    if largest(deviations) ** 2 * max(1, deviations.shape[1]) < SAFE:
        return (deviations * deviations).sum(axis=1).tolist()
    wide = deviations.astype(object)
    return (wide * wide).sum(axis=1).tolist()


def identity_error(fit: DataFrame, whiteners: dict[int, Whitener]) -> float:
    """Largest entry, in absolute value, of the covariance of the whitened fit lists minus the identity, measured over all their vectors."""
    schema = pa.schema([("dim", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("total", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in matrices(batch.column("x")):
                if dim:
                    own = whiteners[dim]
                    w = own.whitened(own.deviations(x))
                    # The last row holds the sums themselves.
                    both = np.vstack([w.T @ w, w.sum(axis=0)])
                    held[dim] = held[dim] + both if dim in held else both
        for dim, total in held.items():
            i, j = np.indices(total.shape).reshape(2, -1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), dim, np.int32)), pa.array(i), pa.array(j), pa.array(total.ravel())], schema=schema)

    partial = few_tasks(fit).select("x").mapInArrow(run, "dim int, i int, j int, total double")
    found = {(r["dim"], r["i"], r["j"]): r["total"] for r in partial.groupBy("dim", "i", "j").agg(F.sum("total").alias("total")).collect()}
    error = 0.0
    for dim, own in whiteners.items():
        k = own.map.shape[1]
        if k:
            means = np.array([found[dim, k, j] for j in range(k)]) / own.n
            products = np.array([[found[dim, i, j] for j in range(k)] for i in range(k)]) / own.n
            error = max(error, float(np.abs(products - np.outer(means, means) - np.eye(k)).max()))
    return error


def whiten(vectors: DataFrame, components: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, dim, component, n, deviation, whitened, explained, identity_error)``, a row per vector and component."""
    rows = whole(vectors, id_col, vector_col)
    fit = materialize(rows.select("x").distinct(), "fit")
    known = sums(fit)
    squared = covariances(fit, known)
    whiteners = {dim: Whitener(n, total, squared[dim], components) for dim, (n, total) in known.items()}
    error = identity_error(fit, whiteners)
    schema = pa.schema([
        ("vec_id", pa.int64()), ("dim", pa.int32()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.decimal128(38, 0)),
        ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id")
            for dim, numbers, x in matrices(batch.column("x")):
                own = whiteners.get(dim)
                k = own.map.shape[1] if own else 0
                if not k:
                    continue
                deviations = own.deviations(x)
                square = squares(deviations)
                fits = _decimals([s if s < 10**38 else 0 for s in square])
                if max(square) >= 10**38:
                    fits = pa.array([v if s < 10**38 else None for v, s in zip(fits.to_pylist(), square, strict=True)], pa.decimal128(38, 0))
                count = len(numbers)
                repeat = np.repeat(np.arange(count), k)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(numbers[repeat])), pa.array(np.full(count * k, dim, np.int32)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), count)), pa.array(np.full(count * k, own.n)),
                    fits.take(pa.array(repeat)), pa.array(own.whitened(deviations).ravel()),
                    pa.array(np.tile(np.array(own.explained), count)), pa.array(np.full(count * k, error)),
                ], schema=schema)

    return rows.select("vec_id", "x").mapInArrow(
        run, "vec_id long, dim int, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    )


def digest(vectors: DataFrame) -> DataFrame:
    out = whiten(vectors)
    return out.select(
        "vec_id", "component", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"), "whitened", "explained", "identity_error"
    )
