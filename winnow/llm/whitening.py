"""Whitening of embeddings by shifted CholeskyQR.

The centred fit rows A are orthogonalised by passes over the table: each pass sums the Gram matrix of Q = A R^-1, found
by triangular solves against the R composed so far, and the driver factors that d x d matrix (Cholesky; the first
pass adds a shift of rounding size, so that it never fails) and composes R.  After a few passes Q is orthonormal, so the singular values and
right vectors of the small R are those of A.  Only d x d matrices reach the driver, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from winnow.llm.storage import written

SCALE = 256
PASSES = 8
LONG = 2**63 - 1


def units(vector: Column) -> Column:
    """floor(256 * component) as long, per component; a double beyond a long takes the nearest one."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long"))


def usable(vector: Column) -> Column:
    """Neither null nor empty, and every component is a finite number."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


@dataclass(frozen=True)
class Whitening:
    """Fitted on ``n`` vectors of ``dim`` components with sums ``sums``; ``axes`` has a unit eigenvector per column."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    @property
    def dim(self) -> int:
        return len(self.sums)

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums]) if self.n else np.zeros(0)


def rows_of(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, dim) if batch.num_rows else np.zeros((0, dim), np.int64)


def solve_right(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """a r^-1 for an upper triangular r, column by column."""
    q = np.empty_like(a)
    for j in range(r.shape[0]):
        q[:, j] = (a[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def summed(fit_rows: DataFrame, dim: int, terms) -> np.ndarray:
    """The sum over all batches of ``terms(batch)``, a matrix of one shape: a row per entry and task, added by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            part = terms(rows_of(batch, dim))
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], names=["cell", "value"])

    cells = fit_rows.select("x").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    return cells.orderBy("cell").toPandas()["value"].to_numpy()


def cholesky(gram: np.ndarray, n: int, shifted: bool = False) -> np.ndarray:
    """Upper triangular R with R^T R = gram, plus a shift of rounding size if asked for or where gram isn't positive definite."""
    dim = gram.shape[0]
    unit = 11 * (n * dim + dim * (dim + 1)) * np.finfo(float).eps * max(float(np.linalg.norm(gram, 2)), 1e-300)
    shift = unit if shifted else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(dim)).T
        except np.linalg.LinAlgError:
            shift = max(unit, shift * 100)


def fit(vectors: DataFrame, vector_col: str = "embedding", tolerance: float = 1e-12) -> Whitening:
    """Fit on each distinct vector of integer units once, centred, divisor n.

    Vectors that are null, empty or hold null or non-finite components are left out, and so are those whose length is
    not the most common one (ties: the shorter). An empty table gives a fit with n = 0 and no axes. Directions without
    variance get no axis.
    """
    x = vectors.where(usable(F.col(vector_col))).select(units(F.col(vector_col)).alias("x"))
    distinct = written(x.groupBy("x").agg(F.count(F.lit(1)).alias("copies")), "vectors")
    common = distinct.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if common is None:
        return Whitening(0, (), np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    dim, n = common["dim"], common["count"]
    fit_rows = distinct.where(F.size("x") == dim)
    sums = fit_rows.select(F.posexplode("x")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s")).orderBy("pos").collect()
    sums = tuple(int(r["s"]) for r in sums)
    mean = np.array([s / n for s in sums])

    def gram(r: np.ndarray | None) -> np.ndarray:
        def terms(rows: np.ndarray) -> np.ndarray:
            a = rows - mean
            q = a if r is None else solve_right(a, r)
            return q.T @ q

        return summed(fit_rows, dim, terms).reshape(dim, dim)

    first = gram(None)
    composed, last = cholesky(first, n, shifted=True), first
    for _ in range(PASSES):
        before, last = last, gram(composed)
        # done when Q is orthonormal, or when what is left are directions without variance, which no pass changes
        if np.abs(last - np.eye(dim)).max() < 1e-14 * n**0.5 * dim or np.abs(last - before).max() < 1e-15:
            break
        composed = cholesky(last, n) @ composed
    else:
        last = gram(composed)
    # what is left of Q^T Q beyond the identity (rounding, and directions without variance) is folded into R
    kept, turn = np.linalg.eigh(last)
    _, singular, axes = np.linalg.svd((np.sqrt(np.maximum(kept, 0))[:, None] * turn.T) @ composed)
    trace = float((singular**2).sum()) / n
    live = singular > max(tolerance * singular[0], 1e-9)
    eigenvalues, axes = singular[live] ** 2 / n, axes[live].T
    scaled = axes / np.sqrt(eigenvalues)
    k = scaled.shape[1]
    if not k:
        return Whitening(n, sums, axes, eigenvalues, trace, 0.0)
    centre = summed(fit_rows, dim, lambda rows: ((rows - mean) @ scaled).sum(axis=0)) / n

    def spread(rows: np.ndarray) -> np.ndarray:
        y = (rows - mean) @ scaled - centre
        return y.T @ y

    error = float(np.abs(summed(fit_rows, dim, spread).reshape(k, k) / n - np.eye(k)).max())
    return Whitening(n, sums, axes, eigenvalues, trace, error)


def deviations(rows: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """sum over dimensions of (n * x - S)^2 per row, exact; null where it doesn't fit a long."""
    far = max((abs(s) for s in sums), default=0) + n * int(np.abs(rows).max(initial=0))
    if far * far * max(1, len(sums)) <= LONG:
        return ((rows * n - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    exact = (sum((n * int(x) - s) ** 2 for x, s in zip(row, sums, strict=True)) for row in rows)
    return [d if d <= LONG else None for d in exact]


def whiten(vectors: DataFrame, fitted: Whitening, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4) -> DataFrame:
    """Per usable row of the fitted length and component from 1 up to ``components``: id, component, n, deviation,
    whitened, explained, identity_error.

    Rows are taken as they come, repeated ones too; a null id stays null; other columns are not looked at. A table
    whose vectors have fewer directions with variance has fewer components, a single distinct vector none.
    """
    k = min(components, fitted.axes.shape[1] if fitted.n else 0)
    scaled = fitted.axes[:, :k] / np.sqrt(fitted.eigenvalues[:k]) if k else np.zeros((fitted.dim, 0))
    explained = fitted.eigenvalues[:k] / fitted.trace if k else np.zeros(0)
    mean, dim, n, sums = fitted.mean, fitted.dim, fitted.n, fitted.sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = rows_of(batch, dim)
            out = (rows - mean) @ scaled
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(deviations(rows, n, sums), pa.int64()), pa.array(list(out), pa.list_(pa.float64()))],
                names=["id", "deviation", "w"],
            )

    id_type = vectors.schema[id_col].dataType.simpleString()
    x = vectors.where(usable(F.col(vector_col)) & (F.size(vector_col) == dim) & F.lit(k > 0)).select(F.col(id_col).alias("id"), units(F.col(vector_col)).alias("x"))
    done = x.mapInArrow(run, f"id {id_type}, deviation long, w array<double>")
    share = F.array(*[F.lit(float(e)) for e in explained]) if k else F.array().cast("array<double>")
    return done.select("id", "deviation", F.posexplode("w").alias("pos", "whitened")).select(
        F.col("id").alias(id_col), (F.col("pos") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", F.get(share, F.col("pos")).alias("explained"), F.lit(fitted.identity_error).alias("identity_error"),
    )
