"""Whitening of embeddings by incremental eigendecomposition.

Vectors become whole numbers, x = floor(SCALE * c). The fit list holds each
distinct x vector once; the covariance is over it, divisor n.

1. Every partition of the fit list applies centred rank-one updates: behind n
   vectors of mean m, a vector x adds n/(n+1) (x-m)(x-m)' to the scatter. The new
   spectrum solves the secular equation 1 + rho * sum z_i^2 / (d_i - t) = 0. Entries
   with a vanishing z_i, or with equal d_i after a rotation, keep their eigenpair
   (deflation). Eigenvectors are made from the z that fits the found roots exactly,
   so they stay orthogonal.
2. Spectra are combined pairwise, in a tree over partitions: the eigenpairs of one
   and the shift between the means go into the other as successive rank-one updates.
3. The result is a basis of the whole space, close to the eigenvectors. One
   distributed Rayleigh-Ritz step, a sum of centred products in that basis over the
   fit list, gives them to double precision.

Between steps travel d x d numbers for each partition; the driver gets one such
matrix. ``ROWS`` vectors make a partition of the fit list.

Defined results: rows without a vector, with null or non-finite entries, with
entries of ``LARGEST`` or more, or without entries are dropped; so are vectors whose
length is not the most frequent one (of equally frequent ones the longest counts).
Repeated vectors count once in the fit and each gets its rows. A component without variance
(fewer distinct vectors than components) has no whitened value, and explains 0. A deviation that
does not fit into a long is null. An empty table gives no rows; a row without an id keeps its null;
other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from regua.llm.common import ship, store

SCALE, COMPONENTS = 256, 4
#: Distinct vectors for each incremental spectrum, spectra combined in one task.
ROWS, FAN = 1 << 14, 16
#: Entries of this size or more do not fit after scaling.
LARGEST = float(1 << 53)
#: Share of the largest eigenvalue below which there is no variance.
NOTHING = 1e-12
EPSILON = np.finfo(float).eps


# --- rank-one updates -----------------------------------------------------------


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots t of 1 + rho * sum z_i^2 / (d_i - t) for ascending distinct d, nonzero z, rho > 0.

    Returns the roots and the matrix d_j - t_i (row i), which is accurate even where
    a root is next to a pole: each root is found as a distance from its nearer pole.
    """
    k = len(d)
    weight = rho * z * z
    reach = weight.sum()
    if k == 1:
        return d + weight, -weight.reshape(1, 1)
    width = np.append(np.diff(d), reach)
    middle = d + width / 2
    right = 1 + (weight / (d - middle[:, None])).sum(1) < 0
    right[-1] = False
    nearest = np.arange(k) + right
    # The last root may lie anywhere up to the reach; others in the half next to their pole.
    low, high = np.where(right, -width / 2, 0.0), np.where(right, 0.0, width / 2)
    high[-1] = reach
    delta = d - d[nearest][:, None]
    t = (low + high) / 2
    # The poles on either side; the last root has its two largest ones.
    first = np.append(np.arange(k - 1), k - 2)
    below = (np.arange(k) <= first[:, None]).astype(float)
    open_, ones = np.arange(k), np.ones(k)
    for _ in range(100):
        own, at = t[open_], first[open_]
        gap = delta[open_] - own[:, None]
        inverse = 1 / gap
        terms = weight * inverse
        # Terms of poles below the root are negative, those above are positive.
        left = np.einsum("ij,ij->i", terms, below[open_])
        f = 1 + terms @ ones
        low[open_], high[open_] = np.where(f < 0, own, low[open_]), np.where(f < 0, high[open_], own)
        done = np.abs(f) <= 8 * EPSILON * (f - 2 * left)
        done |= high[open_] - low[open_] <= 2 * EPSILON * np.abs(own)
        if done.all():
            break
        slope = terms * inverse
        lower, both = np.einsum("ij,ij->i", slope, below[open_]), slope @ ones
        rows = np.arange(len(open_))
        a, b = gap[rows, at], gap[rows, at + 1]
        # Both poles next to the root are kept, the rest is fitted: a quadratic in the step.
        c = f - a * lower - b * (both - lower)
        p, q = (a + b) * f - a * b * both, a * b * f
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(p * p - 4 * q * c, 0))
            new = own + np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
            if open_[-1] == k - 1:
                last = (p[-1] + root[-1]) / (2 * abs(c[-1])) if p[-1] >= 0 else 2 * q[-1] / (p[-1] - root[-1])
                new[-1] = own[-1] + last
        inside = (new > low[open_]) & (new < high[open_])
        t[open_] = np.where(done, own, np.where(inside, new, (low[open_] + high[open_]) / 2))
        open_ = open_[~done]
    return d[nearest] + t, delta - t[:, None]


def rank_one(values: np.ndarray, vectors: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Spectrum of V diag(values) V' + rho (V z)(V z)', ascending; ``values`` ascend, rho >= 0."""
    norm = float(np.sqrt(z @ z))
    if not norm or rho <= 0:
        return values, vectors
    z, rho = z / norm, rho * norm * norm
    tolerance = 8 * EPSILON * max(abs(values[-1]), abs(values[0]), rho)
    values = values.copy()
    live = np.flatnonzero(rho * np.abs(z) > tolerance)
    if len(live) > 1 and _close(values[live], z[live], tolerance).any():
        vectors, z = vectors.copy(), z.copy()
        kept = [live[0]]
        for j in live[1:]:
            i = kept[-1]
            r = np.hypot(z[i], z[j])
            c, s = z[j] / r, -z[i] / r
            if abs((values[j] - values[i]) * c * s) > tolerance:
                kept.append(j)
                continue
            # All of z goes to the second of two nearly equal values.
            z[i], z[j] = 0, r
            a, b = vectors[:, i].copy(), vectors[:, j].copy()
            vectors[:, i], vectors[:, j] = c * a + s * b, c * b - s * a
            x, y = values[i], values[j]
            values[i], values[j] = x * c * c + y * s * s, x * s * s + y * c * c
            kept[-1] = j
        live = np.array(kept)
        live = live[np.argsort(values[live], kind="stable")]
    if not len(live):
        return values, vectors
    roots, gap = secular_roots(values[live], z[live], rho)
    fitted = _fitted(values[live], gap) * np.where(z[live] < 0, -1, 1)
    turn = fitted / gap
    turn /= np.sqrt((turn * turn).sum(1))[:, None]
    vectors = vectors.copy()
    vectors[:, live] = vectors[:, live] @ turn.T
    values[live] = roots
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


def _close(d: np.ndarray, z: np.ndarray, tolerance: float) -> np.ndarray:
    square = z[1:] ** 2 + z[:-1] ** 2
    return np.diff(d) * np.abs(z[1:] * z[:-1]) <= tolerance * square


def _fitted(d: np.ndarray, gap: np.ndarray) -> np.ndarray:
    """Sizes of the z (times the root of rho) for which the found roots are exact."""
    k = len(d)
    j, i = np.arange(k)[:, None], np.arange(k)
    other = np.minimum(np.where(j < i, j, j + 1), k - 1)
    below = d[other] - d
    below[-1] = 1
    return np.sqrt(np.abs(np.prod(-gap / below, axis=0)))


class Spectrum:
    """Count, exact sums and scatter (values, vectors) of the vectors taken in."""

    def __init__(self, dims: int):
        self.n = 0
        self.sums = [0] * dims
        self.values, self.vectors = np.zeros(dims), np.eye(dims)

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def add(self, rows: np.ndarray) -> None:
        """Take in whole-number vectors, one after another."""
        for row in rows:
            if self.n:
                off = row - self.mean()
                self.values, self.vectors = rank_one(
                    self.values, self.vectors, self.vectors.T @ off, self.n / (self.n + 1)
                )
            self.sums = [s + x for s, x in zip(self.sums, row.tolist())]
            self.n += 1

    def merge(self, other: Spectrum) -> None:
        if not other.n:
            return
        if self.n:
            off = other.mean() - self.mean()
            parts = [(off, self.n * other.n / (self.n + other.n))]
            parts += [(other.vectors[:, j], v) for j, v in enumerate(other.values.tolist()) if v > 0]
            for direction, weight in parts:
                self.values, self.vectors = rank_one(self.values, self.vectors, self.vectors.T @ direction, weight)
        else:
            self.values, self.vectors = other.values, other.vectors
        self.n += other.n
        self.sums = [a + b for a, b in zip(self.sums, other.sums)]


# --- what travels ---------------------------------------------------------------

STATE = "part long, n long, sums array<decimal(38,0)>, numbers binary"
_DECIMALS = pa.list_(pa.decimal128(38, 0))


def _bytes(numbers: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, numbers, allow_pickle=False)
    return out.getvalue()


def _numbers(data: bytes) -> np.ndarray:
    return np.load(io.BytesIO(data), allow_pickle=False)


def _state(part: int, n: int, sums: list[int], numbers: np.ndarray) -> pa.Table:
    return pa.table(
        {
            "part": pa.array([part], pa.int64()),
            "n": pa.array([n], pa.int64()),
            "sums": pa.array([[Decimal(s) for s in sums]], _DECIMALS),
            "numbers": pa.array([_bytes(numbers)], pa.binary()),
        }
    )


def _spectra(group: pa.Table | pa.RecordBatch) -> Iterator[Spectrum]:
    for n, sums, numbers in zip(*(group.column(c).to_pylist() for c in ("n", "sums", "numbers"))):
        spectrum = Spectrum(len(sums))
        spectrum.n, spectrum.sums = n, [int(s) for s in sums]
        held = _numbers(numbers)
        spectrum.values, spectrum.vectors = held[0], held[1:]
        yield spectrum


def _merge_spectra(part: int, group: pa.Table) -> pa.Table:
    group = group.sort_by("part")
    spectra = _spectra(group)
    whole = next(spectra)
    for other in spectra:
        whole.merge(other)
    return _state(part, whole.n, whole.sums, np.vstack((whole.values, whole.vectors)))


def _add_numbers(part: int, group: pa.Table) -> pa.Table:
    group = group.sort_by("part")
    total = sum(_numbers(b) for b in group.column("numbers").to_pylist())
    return _state(part, sum(group.column("n").to_pylist()), [], total)


def _together(combine: Callable[[int, pa.Table], pa.Table], groups: int) -> Callable[[pa.Table], pa.Table]:
    return lambda group: combine(group.column("part")[0].as_py() % groups, group)


def _combined(parts: DataFrame, combine: Callable[[int, pa.Table], pa.Table], name: str) -> pa.Table:
    """The one state that all states make, combined about ``FAN`` at a time."""
    parts = store(parts, name)
    left = parts.count()
    while left > 1:
        left = -(-left // FAN)
        together = _together(combine, left)
        parts = store(parts.groupBy(F.col("part") % left).applyInArrow(together, STATE), name)
    return parts.toArrow()


def _by_part(fit: DataFrame, dims: int, work: Callable[[np.ndarray], np.ndarray], name: str) -> np.ndarray:
    """Sum over the fit list of what ``work`` makes of its vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, total = None, 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch.column(1), dims)
            part = batch.column(0)[0].as_py() if part is None else part
            total = total + work(rows.astype(float))
            n += len(rows)
        if n:
            yield from _state(part, n, [], total).to_batches()

    # A task may hold the vectors of several parts; its sums go by the first of them.
    return _numbers(_combined(fit.mapInArrow(run, STATE), _add_numbers, name).column("numbers")[0].as_py())


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


# --- fitting ----------------------------------------------------------------------


class Whitening(NamedTuple):
    """A fitted transformation: whitened = (x - sums / n) @ vectors / sqrt(values)."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float

    def positive(self) -> np.ndarray:
        return self.values > NOTHING * self.trace

    def weights(self) -> np.ndarray:
        """The matrix that whitens centred vectors; columns without variance are NaN."""
        scale = np.where(self.positive(), self.values, np.nan)
        return self.vectors / np.sqrt(scale)


def whole_vectors(embeddings: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``embeddings`` with usable vectors, and these as whole numbers in ``x``; an existing ``x`` is replaced."""
    fits = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < LARGEST))
    usable = embeddings.where(F.coalesce(fits & (F.size(vector) > 0), F.lit(False)))
    return usable.withColumn("x", F.transform(vector, lambda c: F.floor(c.cast("double") * scale)))


def fit(vectors: DataFrame, components: int = COMPONENTS, rows: int = ROWS) -> Whitening | None:
    """The whitening of the distinct ``x`` of ``vectors``, which are of one length; None if there are none."""
    ship(vectors.sparkSession)
    distinct = store(vectors.select("x").distinct(), "distinct_vectors")
    first = distinct.first()
    if first is None:
        return None
    dims = len(first.x)
    parts = distinct.count() // rows + 1
    listed = distinct.repartition(parts).select(F.spark_partition_id().cast("long").alias("part"), "x")
    listed = store(listed, "fit_list")

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectra: dict[int, Spectrum] = {}
        for batch in batches:
            own = batch.column(0).to_numpy()
            x = _matrix(batch.column(1), dims)
            for part in np.unique(own).tolist():
                spectra.setdefault(part, Spectrum(dims)).add(x[own == part])
        for part, s in spectra.items():
            yield from _state(part, s.n, s.sums, np.vstack((s.values, s.vectors))).to_batches()

    spectra = listed.repartition(parts, "part").mapInArrow(update, STATE)
    start = next(_spectra(_combined(spectra, _merge_spectra, "spectra")))
    n, mean = start.n, start.mean()
    # Rayleigh-Ritz in the whole basis found.
    basis = np.linalg.qr(start.vectors[:, ::-1])[0]

    def products(x: np.ndarray) -> np.ndarray:
        inside = (x - mean) @ basis
        return inside.T @ inside

    ritz = _by_part(listed, dims, products, "ritz") / n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    top = np.argsort(-values, kind="stable")[:components]
    found = basis @ turn[:, top]
    found /= np.sqrt((found * found).sum(0))
    found *= np.where(found[np.abs(found).argmax(0), np.arange(found.shape[1])] < 0, -1, 1)
    model = Whitening(n, start.sums, found, np.maximum(values[top], 0), float(np.trace(ritz)), 0.0)
    weights = model.weights()[:, model.positive()]
    kept = weights.shape[1]
    if not kept:
        return model

    def moments(x: np.ndarray) -> np.ndarray:
        y = (x - mean) @ weights
        return np.vstack((y.sum(0), y.T @ y))

    sums = _by_part(listed, dims, moments, "moments") / n
    error = np.abs(sums[1:] - np.outer(sums[0], sums[0]) - np.eye(kept)).max()
    return model._replace(identity_error=float(error))


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum of (n * x - S)^2 of each row."""
    largest = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if x.shape[1] * largest**2 < 1 << 63:
        off = n * x - np.array(sums, np.int64)
        return (off * off).sum(1).tolist()
    found = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [f if f < 1 << 63 else None for f in found]


OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(
    embeddings: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", vector: str = "embedding", rows: int = ROWS
) -> DataFrame:
    """One row for each usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = embeddings.sparkSession
    narrow = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("embedding"))
    usable = whole_vectors(narrow).select("vec_id", "x")
    lengths = usable.groupBy(F.size("x").alias("dims")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("dims")).first()
    if most is None:
        return spark.createDataFrame([], OUT)
    dims = most.dims
    usable = usable.where(F.size("x") == dims)
    model = fit(usable, components, rows)
    mean = np.array([s / model.n for s in model.sums])
    weights = model.weights()
    kept = weights.shape[1]
    explained = model.values / model.trace if model.trace > 0 else np.zeros(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dims)
            y = ((x - mean) @ weights).ravel()
            total = len(x) * kept
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), kept))),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(total, model.n, np.int64)),
                    pa.array([d for d in _deviations(x, model.n, model.sums) for _ in range(kept)], pa.int64()),
                    pa.array(y, from_pandas=True),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(total, model.identity_error)),
                ],
                names=[field.split()[0] for field in OUT.split(", ")],
            )

    return usable.mapInArrow(run, OUT)
