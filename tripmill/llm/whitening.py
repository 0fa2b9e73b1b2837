"""Whitening of vectors by a spectral divide and conquer of their covariance.

Spark makes the fit list, each distinct vector once, and adds up its exact sums and its centred covariance, a
matrix whose size is the dimension alone. The driver takes that matrix apart: the polar factor of the matrix
less a shift, by QDWH iterations, is the matrix sign, and with it comes the projector onto all eigenvectors
above the shift. Its range splits the space into two invariant subspaces, and each part is split again with a
shift of its own until the parts are single eigenvectors. Parts below the components asked for are left whole.
The mean and the scaled components are broadcast, and every vector is projected where it lies.

Vectors are whole numbers, so sums, counts and squared deviations are exact at any size. Covariances centre
before they multiply.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.llm.common import add_vectors, stored, without

SCALE = 256
SEED = 17
EPS = np.finfo(np.float64).eps
MAX_STEPS = 40
MAX_SHIFTS = 24
HALF = np.int64(32)
ROWS = 4096

ADDED = ["n", "component", "deviation", "whitened", "explained", "identity_error"]


def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal factor of a symmetric matrix, by dynamically weighted Halley iterations.

    Each step maps the singular values by x(a + b x^2) / (1 + c x^2), with weights from a lower bound of the
    smallest: first by the QR factors of [sqrt(c) X; I], then, once c is small, by a Cholesky factor of I + c X'X.
    """
    n = len(a)
    x = a / max(np.linalg.norm(a), np.finfo(float).tiny)
    try:
        least = max(1 / np.linalg.norm(np.linalg.inv(x)), EPS)
    except np.linalg.LinAlgError:
        least = EPS
    eye = np.eye(n)
    for _ in range(MAX_STEPS):
        square = least * least
        root = np.cbrt(4 * (1 - square) / square**2)
        stem = np.sqrt(1 + root)
        wa = stem + np.sqrt(max(8 - 4 * root + 8 * (2 - square) / (square * stem), 0)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.concatenate((np.sqrt(wc) * x, eye)))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            lower = np.linalg.cholesky(eye + wc * (x.T @ x))
            half = np.linalg.solve(lower, x.T)
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(lower.T, half).T
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x = new
        least = min(least * (wa + wb * square) / (1 + wc * square), 1.0)
        if moved <= np.cbrt(EPS) and 1 - least < 10 * EPS or moved <= 4 * EPS * n:
            break
    return x


def invariant_split(a: np.ndarray, shift: float) -> tuple[float, np.ndarray, np.ndarray] | None:
    """Bases of the eigenspaces above and below the shift, after what still couples them; None if one is empty."""
    n = len(a)
    projector = (polar_factor(a - shift * np.eye(n)) + np.eye(n)) / 2
    above = int(round(float(np.trace(projector))))
    if not 0 < above < n:
        return None
    # Subspace iteration on a projector settles at once; the second step cleans the first.
    start = projector @ np.random.default_rng(SEED).standard_normal((n, above))
    first = projector @ np.linalg.qr(start)[0]
    whole = np.linalg.qr(first, mode="complete")[0]
    left, right = whole[:, :above], whole[:, above:]
    return float(np.linalg.norm(right.T @ a @ left)), left, right


def shifts_of(a: np.ndarray) -> Iterator[float]:
    """Shifts to try: the median of the diagonal, then the mean, which lies between two eigenvalues or on one, and about it."""
    n = len(a)
    mean = float(np.trace(a)) / n
    yield float(np.median(np.diag(a)))
    yield mean
    spread = float(np.linalg.norm(a - mean * np.eye(n))) / np.sqrt(n)
    for draw in np.random.default_rng(SEED).uniform(-1, 1, MAX_SHIFTS):
        yield mean + spread * float(draw)


def best_split(a: np.ndarray, tiny: float) -> tuple[np.ndarray, np.ndarray] | None:
    """The first split that parts the space within rounding, or the best of all tried."""
    best = None
    for shift in shifts_of(a):
        split = invariant_split(a, shift)
        if split and (best is None or split[0] < best[0]):
            best = split
            if best[0] <= 100 * tiny:
                break
    return best and best[1:]


def spectral_components(a: np.ndarray, count: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns.

    A part whose eigenvalues cannot be told apart in double precision has any orthonormal basis.
    """
    n = len(a)
    count = n if count is None else min(count, n)
    if not count:
        return np.zeros(0), np.zeros((n, 0))
    tiny = EPS * n * max(np.linalg.norm(a), np.finfo(float).tiny)
    vectors: list[np.ndarray] = []
    parts = [(a, np.eye(n))]  # the last part holds the largest eigenvalues
    while parts and len(vectors) < count:
        part, basis = parts.pop()
        part = (part + part.T) / 2
        flat = len(part) == 1 or np.linalg.norm(part - np.trace(part) / len(part) * np.eye(len(part))) <= tiny
        split = None if flat else best_split(part, tiny)
        if split is None:
            vectors += list(basis.T)
        else:
            parts += [(side.T @ part @ side, basis @ side) for side in reversed(split)]
    found = np.linalg.qr(np.array(vectors).T)[0]
    values = np.einsum("ij,ij->j", found, a @ found)
    order = np.argsort(-values, kind="stable")[:count]
    return values[order], found[:, order]


@dataclass
class Whitening:
    """What is fitted: n and S of the fit list, and per component its variance, share and unit vector."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float

    def project(self, x: np.ndarray) -> np.ndarray:
        mean = np.array([s / self.n for s in self.sums])
        return (x - mean) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum of (n x - S)^2 of each row, exactly."""
        largest = max(map(abs, self.sums), default=0) + self.n * (int(np.abs(x).max(initial=0)) + 1)
        if largest * largest * max(1, x.shape[1]) < 1 << 62:
            apart = self.n * x - np.array(self.sums, dtype=np.int64)
            return (apart * apart).sum(axis=1).tolist()
        return [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]


def whole_numbers(vector: Column) -> Column:
    """floor(SCALE * c) of each entry; null for a vector that is null or has an entry without one in 64 bits."""
    wide = F.transform(vector.cast("array<double>"), lambda c: F.lit(float(SCALE)) * c)
    fits = F.forall(wide, lambda c: F.coalesce((F.abs(c) < F.lit(2.0**62)) & ~F.isnan(c), F.lit(False)))
    return F.when(vector.isNotNull() & fits, F.transform(wide, lambda c: F.floor(c).cast("long")))


def usual_length(rows: DataFrame) -> int:
    """The length that most vectors have; of several the smallest."""
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    first = lengths.orderBy(F.desc("n"), "d").limit(1).collect()
    return first[0]["d"] if first else 0


def matrix_of(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), size)


def exact_sums(rows: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of each dimension: sums of upper and lower halves, added up as decimals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, upper, lower = 0, np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            x = matrix_of(batch.column(0), size)
            count += len(x)
            upper += (x >> HALF).sum(axis=0)
            lower += (x & np.int64((1 << 32) - 1)).sum(axis=0)
        rows = [np.arange(size), np.full(size, count), upper, lower]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], names=["d", "n", "u", "l"])

    parts = rows.select("x").mapInArrow(run, "d long, n long, u long, l long")
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "u", "l")]
    found = {r["d"]: r for r in parts.groupBy("d").agg(*wide).collect()}
    if not found:
        return 0, []
    return int(found[0]["n"]), [(int(found[d]["u"]) << 32) + int(found[d]["l"]) for d in range(size)]


def added_products(rows: DataFrame, size: int, of: Callable, centre: np.ndarray) -> np.ndarray:
    """Sum over all rows of v'v, for v what `of` makes of a block of vectors, less the centre."""
    width = len(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        total = np.zeros((width, width))
        for batch in batches:
            x = matrix_of(batch.column(0), size)
            for at in range(0, len(x), ROWS):
                v = of(x[at : at + ROWS]) - centre
                total += v.T @ v
        yield total.ravel()

    return add_vectors(rows.select("x"), run, width * width).reshape(width, width)


def added_rows(rows: DataFrame, size: int, of: Callable, width: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        total = np.zeros(width)
        for batch in batches:
            total += of(matrix_of(batch.column(0), size)).sum(axis=0)
        yield total

    return add_vectors(rows.select("x"), run, width)


def fit(rows: DataFrame, size: int, components: int | None) -> Whitening:
    """Fit on the distinct vectors x of the rows, all of length `size`."""
    listed = stored(rows.select("x").distinct(), "fit-list")
    n, sums = exact_sums(listed, size) if size else (0, [])
    if not n:
        return Whitening(0, [], np.zeros(0), np.zeros((size, 0)), np.zeros(0), 0.0)
    mean = np.array([s / n for s in sums])
    covariance = added_products(listed, size, lambda x: x.astype(np.float64), mean) / n
    trace = float(np.trace(covariance))
    values, vectors = spectral_components(covariance, components) if trace > 0 else (np.zeros(0), np.zeros((size, 0)))
    # Directions in which the vectors do not vary cannot be whitened.
    kept = values > EPS * size * trace
    values, vectors = values[kept], vectors[:, kept]
    found = Whitening(n, sums, values, vectors, values / trace if trace > 0 else values, 0.0)
    if len(values):
        centre = added_rows(listed, size, found.project, len(values)) / n
        spread = added_products(listed, size, found.project, centre) / n
        found.identity_error = float(np.abs(spread - np.eye(len(values))).max())
    return found


def whiten(vectors: DataFrame, *, vector_column: str = "embedding", components: int | None = None) -> DataFrame:
    """The table with a row per vector and component, the largest variances first, and what was fitted.

    Added are n, component (from 1), deviation (decimal), whitened, explained and identity_error; columns with
    these names are replaced. Left out are vectors that are null, hold a null or non-finite entry or one beyond 64
    bits, or have another length than most. Repeated rows are fitted once and all returned. Directions without
    variance are no components: a table of equal vectors, or of none, has no rows.
    """
    base = without(vectors, [*ADDED, "__x"])
    rows = base.withColumn("__x", whole_numbers(F.col(f"`{vector_column}`"))).filter("__x IS NOT NULL")
    size = usual_length(rows.select(F.col("__x").alias("x")))
    rows = rows.filter(F.size("__x") == size)
    found = fit(rows.select(F.col("__x").alias("x")), size, components)
    width = len(found.values)
    schema = T.StructType(
        [
            *base.schema.fields,
            T.StructField("__w", T.ArrayType(T.DoubleType())),
            T.StructField("__deviation", T.DecimalType(38, 0)),
        ]
    )
    shared = vectors.sparkSession.sparkContext.broadcast(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        for batch in batches:
            x = matrix_of(batch.column(batch.num_columns - 1), size)
            flat = pa.array(found.project(x).ravel() if width and len(x) else [], pa.float64())
            ends = pa.array(np.arange(len(x) + 1) * width, pa.int32())
            exact = [str(d) if abs(d) < 10**38 else None for d in found.deviations(x)] if width else [None] * len(x)
            columns = [*batch.columns[:-1], pa.ListArray.from_arrays(ends, flat), pa.array(exact, pa.string()).cast(pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    each = rows.mapInArrow(run, schema)
    columns = [F.col(f"`{c}`") for c in base.columns]
    placed = each.select(*columns, "__deviation", F.posexplode("__w").alias("__at", "__value"))
    shares = F.array(*[F.lit(float(s)) for s in found.explained]) if width else F.array(F.lit(0.0))
    return placed.select(
        *columns,
        F.lit(found.n).cast("long").alias("n"),
        (F.col("__at") + 1).alias("component"),
        F.col("__deviation").alias("deviation"),
        F.col("__value").alias("whitened"),
        F.get(shares, F.col("__at")).alias("explained"),
        F.lit(found.identity_error).alias("identity_error"),
    )
