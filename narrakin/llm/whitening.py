"""Whitening of vectors: shifted CholeskyQR by distributed Gram passes, then the SVD of R."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from narrakin.session import settle, ship_package

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Entries beyond this are taken as this, so that what they become fits a long.
LARGEST = float(1 << 40)
#: Most rounds of CholeskyQR; three are enough for vectors of full rank.
ROUNDS = 10
#: Tasks of a Gram pass for each core. A task returns one triangle of sums however many rows it reads.
TASKS_PER_CORE = 4
#: Rows worked on at a time.
STEP = 4096
#: A direction with less of the greatest standard deviation than this has no variance but rounding.
FLAT = 1e-13
_UNIT = 2.0 ** -53


def all_finite(vector: Column) -> Column:
    """Whether a vector is there and all its entries are."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def scaled(vectors: DataFrame) -> DataFrame:
    """vec_id and x, the whole numbers floor(1024 c) + 100000, of the rows whose entries are all there and finite."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("c"))
    whole = lambda c: F.floor(F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), c)) * SCALE) + OFFSET
    return rows.where(all_finite(F.col("c"))).select("vec_id", F.transform("c", whole).alias("x"))


def solve_right(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """rows times the inverse of an upper triangular matrix, by substitution column by column."""
    out = np.empty_like(rows)
    for j in range(len(upper)):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def cholesky(gram: np.ndarray, shift: float = 0.0) -> np.ndarray:
    """Upper triangular R with R'R = gram + shift; the shift grows as far as rounding makes it necessary."""
    least = 10 * len(gram) * _UNIT * float(np.abs(gram).max())
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, least)


class Centred:
    """Rows of one length around their mean, which is kept as a whole number and a rest for precision."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.near = [(2 * s + n) // (2 * n) for s in sums]
        self.rest = [s - n * b for s, b in zip(sums, self.near)]
        self.factors: list[np.ndarray] = []

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array(self.near, np.int64)).astype(np.float64) - np.array(self.rest, np.float64) / self.n

    def orthogonal(self, x: np.ndarray) -> np.ndarray:
        """The centred rows times the inverses of all factors found so far."""
        out = self.rows(x)
        for upper in self.factors:
            out = solve_right(out, upper)
        return out

    def r(self) -> np.ndarray:
        """The product of the factors: r'r is the Gram matrix of the centred rows."""
        out = np.eye(len(self.near))
        for upper in self.factors:
            out = upper @ out
        return out

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2; None where one does not fit a long."""
        away = x - np.array(self.near, np.int64)
        bound = self.n * (int(np.abs(away).max(initial=0)) + 1)
        kind = np.int64 if len(self.near) * bound * bound < 1 << 63 else object
        exact = self.n * away.astype(kind) - np.array(self.rest, kind)
        return [v if v < 1 << 63 else None for v in (exact * exact).sum(axis=1).tolist()]


def _matrices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """dim, row numbers and the rows themselves, a few thousand of one length at a time."""
    lists = batch.column(column)
    flat, sizes = lists.flatten().to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())
    begins = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    for dim in np.unique(sizes[sizes > 0]).tolist():
        at = np.flatnonzero(sizes == dim)
        for start in range(0, len(at), STEP):
            part = at[start:start + STEP]
            yield dim, part, flat[begins[part][:, None] + np.arange(dim)]


_SUMS = "dim long, i int, high long, low long, n long"
_GRAM = "dim long, i int, j int, g double"


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the upper and lower halves of the entries, so that none overflows."""
    total: dict[int, tuple[np.ndarray, np.ndarray, int]] = {}
    for batch in batches:
        for dim, part, x in _matrices(batch, "x"):
            high, low, n = total.get(dim, (0, 0, 0))
            total[dim] = high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0), n + len(part)
    for dim, (high, low, n) in total.items():
        ones = np.ones(dim, np.int64)
        yield pa.RecordBatch.from_arrays([
            pa.array(dim * ones), pa.array(np.arange(dim, dtype=np.int32)), pa.array(high), pa.array(low), pa.array(n * ones)],
            names=["dim", "i", "high", "low", "n"])


def _triangles(make):
    """Partial Gram matrices of what `make(dim, x)` gives for rows x: one upper triangle per task and length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in _matrices(batch, "x"):
                rows = make(dim, x)
                total[dim] = total.get(dim, 0) + rows.T @ rows
        for dim, gram in total.items():
            i, j = np.triu_indices(len(gram))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(i), dim, np.int64)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(gram[i, j])],
                names=["dim", "i", "j", "g"])
    return run


def _grams(rows: DataFrame, make) -> dict[int, np.ndarray]:
    """Gram matrix by length of vector; what reaches the driver is bounded by the number of dimensions."""
    found = rows.mapInArrow(_triangles(make), _GRAM).groupBy("dim", "i", "j").agg(F.sum("g").alias("g")).toArrow()
    dims, i, j, g = (found.column(c).to_numpy() for c in ("dim", "i", "j", "g"))
    out = {}
    for dim in np.unique(dims).tolist():
        at = dims == dim
        size = int(i[at].max()) + 1
        gram = np.zeros((size, size))
        gram[i[at], j[at]] = gram[j[at], i[at]] = g[at]
        out[dim] = gram
    return out


def centre(rows: DataFrame) -> dict[int, Centred]:
    """Count and exact sums of the rows of each length."""
    found = rows.mapInArrow(_sum_up, _SUMS).groupBy("dim", "i").agg(
        F.sum("high").alias("high"), F.sum("low").alias("low"), F.sum("n").alias("n")).orderBy("dim", "i").collect()
    by_dim: dict[int, list] = {}
    for r in found:
        by_dim.setdefault(r["dim"], []).append(r)
    return {dim: Centred(rs[0]["n"], [(r["high"] << 32) + r["low"] for r in rs]) for dim, rs in by_dim.items()}


def factorise(spark: SparkSession, rows: DataFrame, models: dict[int, Centred]) -> None:
    """Shifted CholeskyQR of the centred rows of every length: each pass adds a triangular factor.

    The first Gram matrix is shifted so that it can be factorised however near to dependent the
    dimensions are; the passes after it make the rows orthonormal to rounding. Directions without
    variance stay at zero.
    """
    waiting = set(models)
    for _ in range(ROUNDS):
        if not waiting:
            return
        state = spark.sparkContext.broadcast({dim: models[dim] for dim in waiting})
        some = rows.where(F.size("x").isin(sorted(waiting)))
        grams = _grams(some, lambda dim, x: state.value[dim].orthogonal(x))
        for dim in sorted(waiting):
            model, gram = models[dim], grams[dim]
            if not gram.any():
                model.factors.append(gram)
                waiting.discard(dim)
            elif model.factors:
                values = np.linalg.eigvalsh(gram)
                if np.all((np.abs(values - 1) < 1e-11) | (values < 1e-9)):
                    waiting.discard(dim)
                model.factors.append(cholesky(gram))
            else:
                shift = 11 * (model.n * dim + dim * (dim + 1)) * _UNIT * float(np.trace(gram))
                model.factors.append(cholesky(gram, shift))


class Components:
    """Leading eigenvectors of a covariance, from the SVD of R, and the scale that whitens with them."""

    def __init__(self, model: Centred, components: int):
        _, sizes, axes = np.linalg.svd(model.r())
        axes = axes * np.where(np.take_along_axis(axes, np.abs(axes).argmax(1)[:, None], 1) < 0, -1.0, 1.0)
        total = float((sizes ** 2).sum())
        kept = min(components, len(sizes))
        self.live = sizes[:kept] > FLAT * sizes[0]
        self.explained = sizes[:kept] ** 2 / total if total > 0 else np.zeros(kept)
        self.axes = axes[:kept].T
        self.scale = np.sqrt(model.n) / np.where(self.live, sizes[:kept], np.inf)

    def whiten(self, rows: np.ndarray) -> np.ndarray:
        return rows @ self.axes * self.scale


def _projector(state, errors: dict[int, float]):
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part, x in _matrices(batch, "x"):
                model, parts = state.value[dim]
                values, m, k = parts.whiten(model.rows(x)), len(part), len(parts.live)
                repeat = lambda array: pa.array(np.tile(array, m))
                deviations = pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
                yield pa.RecordBatch.from_arrays([
                    batch.column("vec_id").take(pa.array(np.repeat(part, k))), repeat(np.arange(1, k + 1, dtype=np.int32)),
                    pa.array(np.full(m * k, model.n, np.int64)), deviations,
                    pa.array(values.ravel(), mask=np.tile(~parts.live, m)), repeat(parts.explained),
                    pa.array(np.full(m * k, errors[dim])),
                ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return project


def whiten(spark: SparkSession, vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Each vector projected on the leading components of the covariance of all, at unit variance.

    vectors: vec_id, embedding array of numbers; other columns are ignored. Rows whose vector is null
    or holds null or non-finite entries are dropped; entries beyond 2^40 are taken as 2^40. Returns
    per row and component vec_id, component, n, deviation, whitened, explained, identity_error.
    Vectors of different lengths are fitted apart, each length with its own n; empty ones have no
    component and so no row. A component without variance (one row only, equal rows, dependent
    dimensions) has whitened null and explained 0, and is left out of identity_error. deviation is
    null where it does not fit a long. Repeated and null ids are rows like others.
    """
    ship_package(spark)
    rows = settle(scaled(vectors), "whitening-rows")
    rows = rows.coalesce(TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    models = centre(rows)
    factorise(spark, rows, models)
    state = spark.sparkContext.broadcast({dim: (model, Components(model, components)) for dim, model in models.items()})

    def whitened(dim: int, x: np.ndarray) -> np.ndarray:
        model, parts = state.value[dim]
        return np.column_stack([parts.whiten(model.rows(x))[:, parts.live], np.ones(len(x))])

    errors = {}
    for dim, gram in _grams(rows, whitened).items():
        covariance = gram[:-1, :-1] / gram[-1, -1] - np.outer(gram[:-1, -1], gram[-1, :-1]) / gram[-1, -1] ** 2
        errors[dim] = float(np.abs(covariance - np.eye(len(covariance))).max(initial=0.0))
    return rows.mapInArrow(_projector(state, errors),
                           "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
