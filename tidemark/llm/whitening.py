"""Whitening of embeddings by the leading components of their covariance.

Entries are put on an integer grid first (``floor(scale * c) + shift``), so equal vectors are
equal exactly and every sum over a dimension is an exact integer. The fit list holds each
distinct grid vector once. Tasks sum the products of its centred entries; one number per
cell of the covariance reaches the driver (dimensions squared, whatever the number of rows).
There the matrix is made tridiagonal by Householder reflections, its leading eigenvalues are
bisected by Sturm counts, and inverse iteration gives their vectors, those of close
eigenvalues being made orthogonal to each other again in every step. The projection
(dimensions times components) is broadcast and applied where the rows are.

Rows whose vector is null, empty or holds null or non-finite entries are left out. Ids may be
null or repeated: every remaining row has its own results. Extra columns are ignored. An empty
table gives an empty result. Vectors of different lengths have no common covariance: a
ValueError names the lengths. Entries must stay below 2**62 / scale. With fewer dimensions
than components asked for there is a component per dimension. A component without variance
(one distinct vector, or fewer distinct vectors than components) has ``explained`` 0,
``whitened`` null, and does not count for ``identity_error``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
CLUSTER = 1e-3  # eigenvalues closer than this share of the norm are one cluster
NO_VARIANCE = 1e-12  # share of the trace below which a component has no variance


@dataclass(frozen=True)
class Whitening:
    """What the fit list gives: its size, exact sums and leading components."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # dimensions x components, unit length
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def varied(self) -> np.ndarray:
        return self.values > NO_VARIANCE * self.trace

    def projection(self) -> np.ndarray:
        """Eigenvectors over the roots of their values; zero where there is no variance."""
        roots = np.sqrt(np.where(self.varied, self.values, 1.0))
        return np.where(self.varied, self.vectors / roots, 0.0)

    def explained(self) -> np.ndarray:
        return np.where(self.varied, self.values, 0.0) / (self.trace or 1.0)


# --- the symmetric eigenproblem, of as many rows as there are dimensions ----------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, off-diagonal, q) with matrix = q @ T @ q.T, by Householder reflections."""
    a = matrix.astype(np.float64).copy()
    d = len(a)
    q = np.eye(d)
    for k in range(d - 2):
        v = a[k + 1 :, k].copy()
        length = np.sqrt(v @ v)
        if length == 0:
            continue
        v[0] += length if v[0] >= 0 else -length
        v /= np.sqrt(v @ v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        column = a[k + 1 :, k]
        column -= 2 * (v @ column) * v
        a[k, k + 1 :] = column
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each number of ``at``."""
    tiny = np.finfo(float).tiny ** 0.5
    below = np.zeros(len(at), np.int64)
    pivot = np.ones(len(at))
    for i, here in enumerate(diagonal):
        pivot = here - at - (off[i - 1] ** 2 / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        below += pivot < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected until its interval is one rounding."""
    d = len(diagonal)
    around = np.abs(np.concatenate([off, [0]])) + np.abs(np.concatenate([[0], off]))
    low, high = (diagonal - around).min(), (diagonal + around).max()
    pad = max(abs(low), abs(high)) * 1e-12
    lo, hi = np.full(k, low - pad), np.full(k, high + pad)
    rank = d - 1 - np.arange(k)  # so many eigenvalues are smaller
    while True:
        middle = lo + (hi - lo) / 2
        open_ = (middle > lo) & (middle < hi)
        if not open_.any():
            return middle
        above = sturm_counts(diagonal, off, middle) <= rank
        lo, hi = np.where(open_ & above, middle, lo), np.where(open_ & ~above, middle, hi)


def _solve(diagonal: np.ndarray, off: np.ndarray, value: float, right: np.ndarray, norm: float) -> np.ndarray:
    """(T - value) y = right by elimination with row exchanges."""
    d = len(diagonal)
    least = (norm or 1.0) * np.finfo(float).eps
    main, up = (diagonal - value).tolist(), [*off.tolist(), 0.0]
    second, y = [0.0] * d, right.tolist()
    for i in range(d - 1):
        low = off[i]
        if abs(main[i]) < abs(low):
            main[i], low = low, main[i]
            up[i], main[i + 1] = main[i + 1], up[i]
            second[i], up[i + 1] = up[i + 1], 0.0
            y[i], y[i + 1] = y[i + 1], y[i]
        if main[i] == 0:
            main[i] = least
        factor = low / main[i]
        main[i + 1] -= factor * up[i]
        up[i + 1] -= factor * second[i]
        y[i + 1] -= factor * y[i]
    for i in range(d - 1, -1, -1):
        if abs(main[i]) < least:
            main[i] = least
        rest = up[i] * y[i + 1] if i + 1 < d else 0.0
        rest += second[i] * y[i + 2] if i + 2 < d else 0.0
        y[i] = (y[i] - rest) / main[i]
    return np.array(y)


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, turns: int = 5) -> np.ndarray:
    """Unit eigenvectors (columns) of the falling ``values`` of the tridiagonal matrix."""
    d = len(diagonal)
    norm = max(np.abs(diagonal).max(initial=0.0), np.abs(off).max(initial=0.0))
    random = np.random.default_rng(d)
    found: list[np.ndarray] = []
    cluster = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            cluster = j
        y = random.standard_normal(d)
        for _ in range(turns):
            y = _solve(diagonal, off, value, y / np.abs(y).max(), norm)
            for _ in range(2):  # twice is enough
                for x in found[cluster:]:
                    y -= (x @ y) * x
            if not np.abs(y).max() > 0:
                y = random.standard_normal(d)
            y /= np.abs(y).max()
            y /= np.sqrt(y @ y)
        found.append(y)
    return np.array(found).reshape(len(values), d).T


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit vectors."""
    scale = np.abs(matrix).max(initial=0.0) or 1.0
    diagonal, off, q = tridiagonal(matrix / scale)
    values = leading_values(diagonal, off, k)
    return values * scale, q @ inverse_iteration(diagonal, off, values)


# --- the distributed passes -------------------------------------------------------------------


def on_grid(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """The vector as an array of longs; null if it is null, empty or holds an entry that is
    null or not finite."""
    finite = F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf"))
    )
    entries = F.transform(
        vector, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long") + F.lit(shift)
    )
    return F.when(finite & (F.size(vector) > 0), entries)


def _rows(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _summed(fit: DataFrame, d: int, cells_of, kind: str) -> list:
    """Sum of ``cells_of(block of grid vectors)`` (a flat array) over the fit list, cell by
    cell: one array per task is dealt out, one number per cell reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                cells = cells_of(_rows(batch.column(0), d))
                total = cells if total is None else total + cells
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total))), pa.array(total)], ["cell", "value"]
            )

    rows = (
        fit.select("x")
        .mapInArrow(run, f"cell long, value {kind}")
        .groupBy("cell")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    cells = [0] * len(rows)
    for row in rows:
        cells[row["cell"]] = row["value"]
    return cells


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """``fit`` has a column ``x``, each distinct grid vector once; null if it has no rows."""
    sizes = fit.groupBy(F.size("x").alias("size")).count().orderBy("size").limit(10).collect()
    if not sizes:
        return None
    if len(sizes) > 1:
        raise ValueError(f"vectors of different lengths: {[r['size'] for r in sizes]}")
    d, n = sizes[0]["size"], sizes[0]["count"]
    sums = [int(s) for s in _summed(fit, d, lambda x: x.sum(axis=0), "long")]
    mean = np.array([s / n for s in sums])
    upper = np.triu_indices(d)

    def products(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return (centred.T @ centred)[upper]

    covariance = np.zeros((d, d))
    covariance[upper] = np.array(_summed(fit, d, products, "double")) / n
    covariance += np.triu(covariance, 1).T
    values, vectors = leading_components(covariance, min(components, d))
    return Whitening(n, sums, values, vectors, float(np.trace(covariance)))


def identity_error(fit: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened fit list's covariance minus the identity."""
    mean, projection, varied = model.mean, model.projection(), model.varied
    k = int(varied.sum())
    if not k:
        return 0.0

    def products(x: np.ndarray) -> np.ndarray:
        white = ((x - mean) @ projection)[:, varied]
        return np.concatenate([(white.T @ white).ravel(), white.sum(axis=0)])

    cells = np.array(_summed(fit, len(mean), products, "double")) / model.n
    covariance = cells[: k * k].reshape(k, k) - np.outer(cells[k * k :], cells[k * k :])
    return float(np.abs(covariance - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Exact sums of (n * x - sum)**2 over the dimensions, as decimals."""
    kind = pa.decimal128(38, 0)
    far = max(abs(int(x.max())), abs(int(x.min()))) * n + max(map(abs, sums))
    if far * far * len(sums) < 1 << 62:
        gaps = n * x - np.array(sums, np.int64)
        return pa.array((gaps * gaps).sum(axis=1)).cast(pa.decimal128(19, 0)).cast(kind)
    totals = (sum((n * int(c) - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x)
    return pa.array([Decimal(t) for t in totals], kind)


def project(rows: DataFrame, model: Whitening) -> DataFrame:
    """``rows`` has the columns id and x. One row per row and component: id, ``component``
    (from 1), ``deviation`` decimal(38,0) (exact), ``whitened`` and ``explained``."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast((model.mean, model.projection()))
    n, sums, varied, explained = model.n, model.sums, model.varied, model.explained()
    k, d = len(varied), len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, projection = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows(batch.column(1), d)
            white = (x - mean) @ projection
            each = pa.array(np.repeat(np.arange(len(x)), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    _deviations(x, n, sums).take(each),
                    pa.array(white.ravel(), mask=np.tile(~varied, len(x))),
                    pa.array(np.tile(explained, len(x))),
                ],
                ["id", "component", "deviation", "whitened", "explained"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "x").mapInArrow(
        run, f"id {kind}, component int, deviation decimal(38,0), whitened double, explained double"
    )


def whiten(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    shift: int = SHIFT,
) -> DataFrame:
    """One row per remaining row of ``vectors`` and component: id, ``component``, ``n``,
    ``deviation`` decimal(38,0), ``whitened``, ``explained`` and ``identity_error``."""
    spark = vectors.sparkSession
    grid = on_grid(F.col(vector_col), scale, shift).alias("x")
    with Scratch(spark) as scratch:
        rows = vectors.select(F.col(id_col).alias("id"), grid).where("x is not null")
        # Copies collapse before they are dealt out, whatever their number.
        fit = scratch.write(rows.select("x").distinct(), "fit")
        model = fit_whitening(fit, components)
        if model is None:
            projected = rows.selectExpr(
                "id", "1 as component", "cast(0 as decimal(38,0)) as deviation",
                "0d as whitened", "0d as explained",
            ).where("false")
            n, error = 0, 0.0
        else:
            projected, n, error = project(rows, model), model.n, identity_error(fit, model)
        return projected.select(
            F.col("id").alias(id_col),
            "component",
            F.lit(n).cast("long").alias("n"),
            "deviation",
            "whitened",
            "explained",
            F.lit(error).alias("identity_error"),
        )
