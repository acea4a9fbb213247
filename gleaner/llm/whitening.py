"""Whitening of embeddings by shifted CholeskyQR over distributed Gram passes.

Entries become whole numbers, `floor(256 * c)`, and each different vector counts once in what is fitted.
The rows of the fit, less their mean, are the matrix A. A pass sums the Gram matrix of A's rows as they
stand, takes its Cholesky factor R on the driver, and the next pass divides the rows by R through
triangular solves; the first factor is of the Gram matrix with a small shift, so that it exists however
close to dependent the columns are. The product of all factors is the R of A = QR, to the precision of A
itself and not of its square, and its singular values and right vectors give the components.

Rows whose vector is null, or holds null or non-finite entries, fall away, as do rows whose vector is
empty or has another length than most (of equally many, the longer). Entries beyond the range of a long
stop at its limits. Repeated rows and rows of null ids stay; vectors are told apart by their whole
numbers. Components that have no variance, beyond rounding, have `whitened` null and `explained` 0;
`identity_error` is over the others (0 if there is none). A deviation beyond the range of a long is null.
Of components with equal variance any order may result; signs are such that the largest entry (the first
of equal ones) is positive. An empty table gives no rows; columns other than the named ones aren't
looked at. `fit` bounds the Arrow batches of the session, unless it has a bound of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, staged

#: Rows of a batch that are worked on at once.
BLOCK = 4096
#: Columns that a triangular solve takes one by one before a matrix product takes them together.
PANEL = 32


@dataclass
class Whitening:
    """What was fitted: number and exact sums of the vectors, unit components in rows, their variances, and the share of all variance."""

    n: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Centred rows on the components, to variance 1; NaN where a component has none."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.variances > 0, 1 / np.sqrt(self.variances), np.nan)
        return (x - self.mean) @ self.components.T * scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The exact sum over dimensions of (n * x - S) ** 2 of each row; null beyond the range of a long."""
        largest = self.n * max(int(x.max(initial=0)), -int(x.min(initial=0))) + max(map(abs, self.sums), default=0)
        if largest * largest * x.shape[1] < 1 << 63:
            d = self.n * x - np.array(self.sums, np.int64)
            return (d * d).sum(axis=1).tolist()
        exact = [sum((self.n * c - s) ** 2 for c, s in zip(row, self.sums, strict=True)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def whole_numbers(embeddings: DataFrame, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows whose vector has finite entries alone, x as longs."""
    v = F.col(vector)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    x = F.transform(v, lambda c: F.floor(c.cast("double") * 256).cast("long"))
    return embeddings.where(v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False))).select(F.col(id_).alias("vec_id"), x.alias("x"))


def of_one_length(rows: DataFrame) -> tuple[DataFrame, int]:
    """The rows whose vector has the commonest length, and that length, 0 if there are no rows."""
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    d = most["d"] if most else 0
    return rows.where(F.size("x") == d), d


def matrices(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    """The vectors of batches, a row each, in blocks."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield batch.slice(at, BLOCK).column("x").flatten().to_numpy().reshape(-1, d)


def divided(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """The rows of `a` times the inverse of the upper triangle `r`, by substitution."""
    q = np.array(a, np.float64)
    for at in range(0, r.shape[0], PANEL):
        to = min(at + PANEL, r.shape[0])
        q[:, at:to] -= q[:, :at] @ r[:at, at:to]
        for j in range(at, to):
            q[:, j] = (q[:, j] - q[:, at:j] @ r[at:j, j]) / r[j, j]
    return q


def summed(rows: DataFrame, d: int, shape: tuple[int, ...], kind: str, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of `part` over all blocks: each task sums its own, fewer tasks sum these, the driver sums what they leave."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, kind)
        for x in matrices(batches, d):
            total += part(x)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, kind)
        for batch in batches:
            for raw in batch.column("total").to_pylist():
                total += np.frombuffer(raw, kind).reshape(shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

    totals = rows.select("x").mapInArrow(first, "total binary")
    tasks = rows.rdd.getNumPartitions()
    if tasks > 64:
        totals = totals.repartition(round(tasks**0.5)).mapInArrow(again, "total binary")
    return sum((np.frombuffer(r["total"], kind).reshape(shape) for r in totals.collect()), np.zeros(shape, kind))  # 64, or the square root of the tasks


def exact_sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of rows and the sums of their dimensions, from sums of the upper and lower halves of the numbers."""

    def part(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[[len(x)], [0]], [(x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]], axis=1)

    total = summed(rows, d, (2, d + 1), "<i8", part).tolist()
    return total[0][0], [(high << 32) + low for high, low in zip(total[0][1:], total[1][1:], strict=True)]


def triangle(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """An upper triangular factor of a Gram matrix, with a shift if asked for or if there is none without."""
    d = len(gram)
    size = float(np.linalg.eigvalsh(gram)[-1])
    shift = min(11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2, 1e-4) * size
    if not shifted:
        try:
            return np.linalg.cholesky(gram).T
        except np.linalg.LinAlgError:
            pass
    return np.linalg.cholesky(gram + shift * np.eye(d)).T


def root(gram: np.ndarray) -> np.ndarray:
    """A factor F of a Gram matrix, F'F = gram: its Cholesky factor, or for one that isn't of full rank, from its eigenvectors."""
    try:
        return np.linalg.cholesky(gram).T
    except np.linalg.LinAlgError:
        values, vectors = np.linalg.eigh(gram)
        return np.sqrt(np.maximum(values, 0))[:, None] * vectors.T


def factor(rows: DataFrame, n: int, mean: np.ndarray, passes: int = 3) -> np.ndarray:
    """R of the QR factors of the centred rows, by `passes` Gram passes; each divides the rows by the factors of those before it."""
    d = len(mean)
    factors: list[np.ndarray] = []

    def gram() -> np.ndarray:
        held = list(factors)

        def part(x: np.ndarray) -> np.ndarray:
            q = x - mean
            for r in held:
                q = divided(q, r)
            return q.T @ q

        return summed(rows, d, (d, d), "<f8", part)

    for i in range(passes):
        g = gram()
        if not g.any():  # no row differs from the mean
            return g
        factors.append(root(g) if i == passes - 1 else triangle(g, n, i == 0))
    whole = factors[0]
    for r in factors[1:]:
        whole = r @ whole
    return whole


def fit(vectors: DataFrame, components: int | None = None) -> Whitening | None:
    """Fits a whitening to the different vectors of `vectors`, rows (x) of one length; None without rows."""
    small_batches(vectors.sparkSession)
    rows = staged(vectors.select("x").distinct())
    first = rows.select(F.size("x").alias("d")).first()
    if first is None:
        return None
    d = first["d"]
    n, sums = exact_sums(rows, d)
    mean = np.array([s / n for s in sums])
    _, sizes, axes = np.linalg.svd(factor(rows, n, mean))
    noise = (sizes[0] + n**0.5 * np.abs(mean).max()) * max(n**0.5, d) * np.finfo(float).eps
    variances = np.where(sizes > noise, sizes**2 / n, 0.0)
    signs = np.sign(axes[np.arange(d), np.argmax(np.abs(axes), axis=1)])
    k = min(d, components or d)
    total = variances.sum()
    found = Whitening(n, sums, (axes * signs[:, None])[:k], variances[:k], variances[:k] / total if total else np.zeros(k))
    full = int((found.variances > 0).sum())
    if full:
        whitened = Whitening(n, sums, found.components[:full], found.variances[:full], found.explained[:full])

        def part(x: np.ndarray) -> np.ndarray:
            w = whitened.whitened(x)
            return w.T @ w

        found.identity_error = float(np.abs(summed(rows, d, (full, full), "<f8", part) / n - np.eye(full)).max())
    return found


def project(rows: DataFrame, fitted: Whitening) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row and component; `rows` are (vec_id, x)."""
    k = len(fitted.components)
    held = rows.sparkSession.sparkContext.broadcast(fitted)  # as large as the components

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(at, BLOCK)
                x = piece.column("x").flatten().to_numpy().reshape(piece.num_rows, -1)
                whitened = model.whitened(x)
                columns = [
                    piece.column("vec_id").take(pa.array(np.repeat(np.arange(len(x)), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(x) * k, model.n, np.int64)),
                    pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k))), pa.array(whitened.ravel(), mask=np.isnan(whitened.ravel())), pa.array(np.tile(model.explained, len(x))), pa.array(np.full(len(x) * k, model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whitened(embeddings: DataFrame, components: int, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Every row that has a vector, on the first `components` components of the whole table."""
    rows, _ = of_one_length(whole_numbers(embeddings, id_, vector))
    fitted = fit(rows, components)
    if fitted is None:
        kind = rows.schema["vec_id"].dataType.simpleString()
        return embeddings.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return project(rows, fitted)
